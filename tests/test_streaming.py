from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from newsloom.functions import text as T
from newsloom.operators import dedup
from newsloom.operators import keywords as K
from newsloom.plans import ingest
from newsloom.plans import views as V
from newsloom.sources import readers
from newsloom.sources.parts import Parts, Table
from newsloom.streaming import pipelines as S

SCHEMA = (
    "article_id long, feed_source_id int, source string, chu_de string, title string, content string, "
    "published_at timestamp_ntz, publish_date string"
)


def article(i, title, day, content="phim mới"):
    at = datetime(2026, 5, 26) + timedelta(days=day, minutes=i)
    return i, i % 2, "bao", "GiaiTri", title, content, at, at.strftime("%Y-%m-%d")


FILES = [
    [article(1, "Tin A", 0), article(3, "tin  a", 0), article(2, "Tin B", 1)],
    [article(5, "TIN A", 0), article(4, "tin b", 1), article(6, "Tin C", 2, "robot ai phim")],
    [article(8, "tin c", 2), article(7, "Tin A", 5)],
]


@pytest.fixture
def landed(spark, tmp_path):
    """Three files that a stream takes one per batch, oldest first."""
    folder = tmp_path / "landing"
    for n, rows in enumerate(FILES):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
    return str(folder)


def stream(spark, landed):
    return S.file_stream(spark, landed, spark.read.parquet(landed).schema, maxFilesPerTrigger="1")


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def rows_of(spark):
    return spark.createDataFrame([], SCHEMA).schema


@pytest.fixture(autouse=True)
def checkpoints(spark, tmp_path_factory):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))


def test_dedup_equals_batch_over_all_files(spark, landed, tmp_path):
    out = str(tmp_path / "out")
    store = S.dedup_store(spark, out, rows_of(spark))
    finish(S.run_batches(stream(spark, landed), S.dedup_writer(store, out + "/checkpoint"), out + "/checkpoint"))
    kept = store.read("articles").collect()
    assert {r.article_id for r in kept} == {r.article_id for r in dedup.first_wins(spark.read.parquet(landed)).collect()} == {1, 2, 6, 7}
    assert {r.batch_id for r in kept} == {0, 1, 2}


def test_a_batch_that_runs_twice_changes_nothing(spark, tmp_path):
    store = S.dedup_store(spark, str(tmp_path / "out"), rows_of(spark))
    handle = S.dedup_writer(store, "run")
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in FILES]
    for batch_id in (0, 1, 1, 2, 2):
        handle(frames[batch_id], batch_id)
    assert sorted(r.article_id for r in store.read("articles").collect()) == [1, 2, 6, 7]


def test_trending_partials_equal_batch(spark, landed, tmp_path):
    out = str(tmp_path / "out")
    store = S.counts_store(spark, out, fan=2)
    handle = S.batch_writer(K.trending_words, store, "parts", out + "/checkpoint")
    finish(S.run_batches(stream(spark, landed), handle, out + "/checkpoint"))
    assert any(p.level for p in store.version().parts)
    merged = S.merge_counts(store.read("parts"))
    batch = K.trending_words(spark.read.parquet(landed))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, batch.collect()))


def test_stateful_daily_counts_equal_batch(spark, landed, tmp_path):
    """Update mode keeps the last count of every group; the highest is the total."""
    out = str(tmp_path / "out")

    def handle(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/counts/batch_id={batch_id}")

    query = (
        S.daily_counts(stream(spark, landed)).writeStream.outputMode("update").foreachBatch(handle)
        .option("checkpointLocation", out + "/checkpoint").trigger(availableNow=True).start()
    )
    finish(query)
    last = spark.read.parquet(out + "/counts").groupBy(*K.RESULT).agg(F.max(K.COUNT).alias(K.COUNT))
    batch = K.trending_words(spark.read.parquet(landed))
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, batch.collect()))


def test_bounded_dedup_drops_copies_within_the_horizon(spark, landed, tmp_path):
    out = str(tmp_path / "out")
    kept = S.dedup_within(stream(spark, landed), "30 days")
    query = (
        kept.writeStream.format("parquet").option("path", out + "/kept")
        .option("checkpointLocation", out + "/checkpoint").trigger(availableNow=True).start()
    )
    finish(query)
    rows = spark.read.parquet(out + "/kept").collect()
    titles = sorted((r.feed_source_id, " ".join(r.title.lower().split()), r.published_at.date().day) for r in rows)
    assert titles == [(0, "tin b", 27), (0, "tin c", 28), (1, "tin a", 26), (1, "tin a", 31)]


def test_restart_takes_only_new_files(spark, landed, tmp_path):
    out = str(tmp_path / "out")
    titles = lambda b: b.select("article_id", T.normalize_title(F.col("title")).alias("t"))
    store = Parts(spark, out, {"rows": Table(StructType.fromDDL("article_id long, t string"))})
    handle = S.batch_writer(titles, store, "rows", out + "/checkpoint")
    finish(S.run_batches(stream(spark, landed), handle, out + "/checkpoint"))
    spark.createDataFrame([article(9, "Tin D", 3)], SCHEMA).coalesce(1).write.mode("append").parquet(landed)
    finish(S.run_batches(stream(spark, landed), handle, out + "/checkpoint"))
    assert sorted(r.article_id for r in store.read("rows").collect()) == list(range(1, 10))


def items(rows):
    return rows.select(
        F.col("article_id").alias("item_id"), "feed_source_id", "title", F.concat(F.lit("http://x/"), "article_id").alias("link"),
        F.col("content").alias("description"), F.lit(None).cast("string").alias("guid"), F.lit("a").alias("author"),
        F.col("publish_date").alias("pub_date"), F.lit("0").alias("comments"),
    )


@pytest.fixture
def feeds(spark):
    rows = spark.createDataFrame([(0, 1, True), (1, 1, True), (2, 1, True)], "id int, category_id int, is_active boolean")
    return rows.withColumn("last_fetched_at", F.lit(None).cast("timestamp_ntz"))


@pytest.fixture
def crawled(spark):
    return spark.createDataFrame([], "url string, content string")


def test_cycles_over_three_batches_store_what_one_batch_stores(spark, landed, tmp_path, feeds, crawled):
    now, out = datetime(2026, 6, 1), str(tmp_path / "out")
    store = ingest.store_of(spark, out + "/store", feeds)
    started = ingest.utc_now()
    finish(S.run_batches(stream(spark, landed), S.cycle_writer(store, feeds, crawled, out + "/checkpoint", items), out + "/checkpoint"))
    stored = store.read("articles")
    whole = ingest.ingest_cycle(items(spark.read.parquet(landed)), feeds, stored.limit(0), crawled, now)
    assert {r.link for r in stored.collect()} == {r.link for r in whole.articles.collect()}
    assert sorted(r.id for r in stored.collect()) == list(range(1, stored.count() + 1))
    total = lambda log: log.agg(F.sum("articles_fetched"), F.sum("articles_saved"), F.sum("duplicates_found")).first()
    assert total(store.read("logs")) == total(whole.log)
    assert store.read("feeds").where("last_fetched_at is not null").count() == 2
    # each cycle has its own time, and took some
    logs = store.read("logs").collect()
    assert len({r.started_at for r in logs}) == 3 and min(r.started_at for r in logs) >= started
    assert all((r.execution_time_ms > 0) == (r.status == "success") for r in logs)
    assert all(r.execution_time_ms == 0 for r in logs if r.status == "failed") and any(r.status == "failed" for r in logs)
    assert len({r.id for r in logs}) == len(logs)


def test_a_lost_checkpoint_loses_no_cycle(spark, landed, tmp_path, feeds, crawled):
    """Another stream over the same store, from batch 0: nothing goes, nothing comes twice, ids go on."""
    out = str(tmp_path / "out")
    store = ingest.store_of(spark, out + "/store", feeds)
    for name in ("first", "second"):
        if name == "second":
            spark.createDataFrame([article(20, "Tin Z", 3)], SCHEMA).coalesce(1).write.mode("append").parquet(landed)
        checkpoint = f"{out}/{name}"
        finish(S.run_batches(stream(spark, landed), S.cycle_writer(store, feeds, crawled, checkpoint, items), checkpoint))
    rows = store.read("articles").collect()
    links = sorted(r.link for r in rows)
    assert links == sorted({f"http://x/{i}" for i in (1, 2, 6, 7, 20)}) and sorted(r.id for r in rows) == [1, 2, 3, 4, 5]
    assert len(store.version().runs) == 2 and store.read("logs").select("id").distinct().count() == store.read("logs").count() == 21


def test_a_lost_checkpoint_loses_no_items_and_no_counts(spark, landed, tmp_path):
    out = str(tmp_path / "out")
    store = Parts(spark, out, {"rows": Table(rows_of(spark))})
    for run, batches in (("first", FILES[:2]), ("second", FILES[2:])):
        handle = S.batch_writer(lambda rows: rows, store, "rows", run)
        for batch_id, rows in enumerate(batches):
            handle(spark.createDataFrame(rows, SCHEMA), batch_id)
    assert sorted(r.article_id for r in store.read("rows").collect()) == [1, 2, 3, 4, 5, 6, 7, 8]


def test_a_lost_checkpoint_overwrites_nothing(spark, tmp_path):
    store = S.dedup_store(spark, str(tmp_path / "out"), rows_of(spark))
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in FILES]
    for run, batches in (("first", (0, 1)), ("second", (0, 1, 2))):
        handle = S.dedup_writer(store, run)
        for batch_id in batches:
            handle(frames[batch_id], batch_id)
    assert sorted(r.article_id for r in store.read("articles").collect()) == [1, 2, 6, 7]


@pytest.mark.parametrize("table", ["articles", "filters", "manifest"])
def test_a_cycle_that_dies_leaves_nothing_visible(spark, tmp_path, feeds, crawled, monkeypatch, table):
    store = ingest.store_of(spark, str(tmp_path / "store"), feeds)
    handle = S.cycle_writer(store, feeds, crawled, "run", items)
    handle(spark.createDataFrame(FILES[0], SCHEMA), 0)
    before = {t: sorted(map(str, store.read(t).collect())) for t in store.tables}
    write, keep = Parts.write, Parts._store

    def dies(self, name, rows, part, level=0):
        done = write(self, name, rows, part, level)
        if name == table:
            raise RuntimeError("killed")
        return done

    with monkeypatch.context() as broken:
        broken.setattr(Parts, "write", dies)
        if table == "manifest":
            broken.setattr(Parts, "_store", lambda self, version: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            handle(spark.createDataFrame(FILES[1], SCHEMA), 1)
    assert {t: sorted(map(str, store.read(t).collect())) for t in store.tables} == before
    assert keep is Parts._store
    handle(spark.createDataFrame(FILES[1], SCHEMA), 1)
    handle(spark.createDataFrame(FILES[1], SCHEMA), 1)
    assert sorted(r.link for r in store.read("articles").collect()) == ["http://x/1", "http://x/2", "http://x/6"]
    assert sorted(r.id for r in store.read("articles").collect()) == [1, 2, 3]


def test_feed_files_as_a_stream(spark, tmp_path, feeds, crawled):
    """Files landed in two turns: items once each, unreadable records set aside, a store that goes on."""
    out, base = str(tmp_path / "out"), tmp_path / "landed"
    item = lambda n: f"<item><title>T {n}</title><link>http://x/{n}</link><pubDate>2026-05-2{n}</pubDate></item>"
    store = ingest.store_of(spark, out + "/store", feeds)
    for turn, bodies in enumerate(({0: item(1) + item(1) + item(2), 1: item(3) + "<item><title>broken</link></item>"}, {0: item(2) + item(4), 9: item(5)})):
        for feed, body in bodies.items():
            folder = base / f"feed_source_id={feed}"
            folder.mkdir(parents=True, exist_ok=True)
            (folder / f"{turn}.xml").write_text(f"<rss><channel>{body}</channel></rss>")
        finish(S.run_batches(readers.stream_rss_items(spark, str(base)), S.feed_cycle_writer(store, feeds, crawled, out + "/c"), out + "/c"))
    assert sorted(r.link for r in store.read("articles").collect()) == [f"http://x/{n}" for n in (1, 2, 3, 4)]
    rejects = store.read("rejects").collect()
    assert len(rejects) == 1 and "broken" in rejects[0].record and rejects[0].path.endswith("feed_source_id=1/0.xml")
    logs = {(r.cycle_id, r.feed_source_id): (r.articles_fetched, r.articles_saved, r.duplicates_found) for r in store.read("logs").collect()}
    assert logs[0, 0] == (2, 2, 0) and logs[1, 0] == (2, 1, 1) and logs[1, 1] == (0, 0, 0)


def test_streams_read_a_table_of_many_files(spark, tmp_path):
    rows = [(i, f"Tin {i % 5}\nphim mới {i}", "en", f"src{1 + i % 3}", 20) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    nations = spark.createDataFrame([(i, f"N{i}", 0) for i in range(5)], "n_nationkey int, n_name string, n_regionkey int")
    nations.write.parquet(f"{tmp_path}/nation.parquet")
    folder, nothing = str(tmp_path), spark.createDataFrame([], "url string, content string")
    news = V.articles(spark, folder)
    assert sorted(r.item_id for r in S.run_ingest(spark, folder).collect()) == list(range(12))
    firsts = dedup.first_wins(news).collect()
    assert sorted(S.run_dedup(spark, folder).collect()) == sorted(firsts) and firsts
    counts = K.trending_words(news, stopwords=V.STOPWORDS).collect()
    assert sorted(S.run_trending(spark, folder).collect()) == sorted(counts) and counts
    assert S.run_ingest_log(spark, folder).agg(F.sum("articles_saved")).first()[0] == S.run_cycles(spark, folder, nothing).count() > 0


def test_feed_files_land_in_few_files(spark, tmp_path, monkeypatch):
    """One file for each feed and landing, and one broken record each, not one for every file of documents."""
    rows = [(i, f"Tin {i}\nphim mới {i}", "en", f"src{1 + i % 2}", 20) for i in range(48)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    nations = spark.createDataFrame([(i, f"N{i}", 0) for i in range(5)], "n_nationkey int, n_name string, n_regionkey int")
    nations.write.parquet(f"{tmp_path}/nation.parquet")
    monkeypatch.setattr(S, "work_folder", lambda spark, name: f"{tmp_path}/{name}")
    monkeypatch.setattr(V, "table", lambda spark, folder, name, read=V.table: read(spark, folder, name).repartition(4))
    logs = S.run_feed_log(spark, str(tmp_path)).collect()
    assert sum(r.articles_fetched + r.dropped for r in logs) == 48 and sum(r.rejected for r in logs) == 3
    assert len(list(tmp_path.glob("feed_files/landed/feed_source_id=*/*.xml"))) == 2 * 3


def test_a_batch_of_feed_files_drops_copies_once(spark, tmp_path):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path))
    kind = "item_id long, feed_source_id int, title string, path string, _corrupt_record string"
    copies = [(1, 1, "a", "x", None), (1, 1, "a", "y", None), (2, 1, "b", "x", None)]
    broken = [(9, 1, None, "x", "<item>"), (9, 1, None, "x", "<item>"), (1, 1, None, "y", "<it")]
    items, rejects = readers.rss_batch(spark.createDataFrame(copies + broken, kind).repartition(3))
    assert sorted(tuple(r) for r in items.collect()) == [(1, 1, "a"), (2, 1, "b")]
    assert sorted(tuple(r) for r in rejects.collect()) == [(1, "x", "<item>"), (1, "x", "<item>"), (1, "y", "<it")]
    assert "Aggregate" not in items._jdf.queryExecution().optimizedPlan().toString()
