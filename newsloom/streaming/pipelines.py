"""Incremental runs over files that keep arriving.

Every batch commits what it made as one version of a ``Parts`` store, under the id of its stream's checkpoint and
its number. A batch that is run again after a failure replaces what it left, one that was committed is
skipped, and a stream that starts again without its checkpoint adds to what is there.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from newsloom import schemas
from newsloom.operators import keywords
from newsloom.operators.dedup import KEY, with_key
from newsloom.plans import ingest
from newsloom.plans import views as V
from newsloom.session import ensure_checkpoint_dir, work_folder
from newsloom.sources import readers
from newsloom.sources.parts import FAN, Parts, Table, run_name
from newsloom.sources.writers import table_of_none


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", **options: str) -> DataFrame:
    """New files of a folder as a stream."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def run_batches(
    rows: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None
):
    """Start ``handle`` on each micro-batch: on a timer, or once over all that is there."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(**trigger).start()
    )


def batch_writer(transform: Callable[[DataFrame], DataFrame], store: Parts, table: str, run: str) -> Callable[[DataFrame, int], None]:
    """Commit ``transform`` of each batch as a part of ``table``. ``run`` is the stream's checkpoint, or a name."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        name, version = run_of(store.spark, run), store.version()
        if not store.done(name, batch_id, version):
            store.publish(name, batch_id, [store.write(table, transform(batch), f"{name}-{batch_id}")])

    return handle


def run_of(spark: SparkSession, run: str) -> str:
    """The id in a checkpoint folder; a name that is no path stands for itself."""
    return run_name(spark, run) if "/" in run else run


def counts_store(spark: SparkSession, out: str, fan: int = FAN) -> Parts:
    """Partial keyword counts; merges sum them up."""
    return Parts(spark, out, {"parts": Table(schemas.TRENDING, merge=merge_counts)}, fan)


def dedup_store(spark: SparkSession, out: str, articles: StructType, fan: int = FAN) -> Parts:
    """The accepted articles with their batch, and their keys by day."""
    keys = StructType.fromDDL("_feed string, _title string, _day string")
    return Parts(spark, out, {
        "articles": Table(StructType([*articles.fields, StructField("batch_id", LongType())])), "keys": Table(keys, ("_day",)),
    }, fan)


def dedup_writer(
    store: Parts, run: str, row_id: str = "article_id", published: str = "published_at",
) -> Callable[[DataFrame, int], None]:
    """Keep the first article of every key, within the batch and against all earlier batches of any run.

    Exact, without a horizon. Accepted keys are stored by day, so a batch reads the stored keys of its
    own days only.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        name, version = run_of(store.spark, run), store.version()
        if store.done(name, batch_id, version):
            return
        firsts = with_key(batch, published).groupBy(*KEY).agg(F.min(row_id).alias(row_id))
        # the days of the batch choose the stored partitions that are read
        seen = store.read("keys", version).join(firsts.select("_day").distinct(), "_day", "left_semi")
        fresh = firsts.join(seen.select(*KEY), KEY, "left_anti").checkpoint()
        accepted = batch.join(fresh.select(row_id), row_id, "left_semi").withColumn("batch_id", F.lit(batch_id))
        part = f"{name}-{batch_id}"
        store.publish(name, batch_id, [store.write("articles", accepted, part), store.write("keys", fresh, part)])

    return handle


def dedup_within(stream: DataFrame, horizon: str, published: str = "published_at") -> DataFrame:
    """Bounded state instead: a copy that comes more than ``horizon`` later passes."""
    keyed = with_key(stream, published).withColumn("_event", F.col(published).cast("timestamp"))
    kept = keyed.withWatermark("_event", horizon).dropDuplicatesWithinWatermark(KEY)
    return kept.drop(*KEY, "_event")


def daily_counts(stream: DataFrame, published: str = "published_at", late: str | None = None) -> DataFrame:
    """Stateful keyword counts per day window; with ``late``, closed days leave the state."""
    event = F.col(published).cast("timestamp")
    rows = stream.withColumn("_event", event)
    if late:
        rows = rows.withWatermark("_event", late)
    text = F.concat_ws(" ", "title", "content")
    words = keywords.explode_keywords(rows, text, ["_event", F.col("source").alias("nguon"), "chu_de"])
    counted = words.groupBy(F.window("_event", "1 day"), "nguon", "chu_de", "tu_khoa").count()
    return counted.select(
        F.date_format("window.start", "yyyyMMdd").alias("ngay"), "nguon", "chu_de", "tu_khoa",
        F.col("count").alias(keywords.COUNT),
    )


def merge_counts(parts: DataFrame) -> DataFrame:
    """Totals over the partial counts of all batches."""
    return parts.groupBy(*keywords.RESULT).agg(F.sum(keywords.COUNT).alias(keywords.COUNT))


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    """The given table as a stream, be it one file or a folder of files; a stream takes a single file as a pattern only."""
    schema = V.table(spark, folder, "documents").schema
    return file_stream(spark, f"{folder}/{{documents}}.parquet", schema)


def _articles(batch: DataFrame) -> DataFrame:
    """The articles of a batch; the given table is one file, so its rows are dealt out first."""
    return V.articles_of(batch.repartition("doc_id"))


def _run(rows: DataFrame, handle: Callable[[DataFrame, int], None], out: str) -> None:
    query = run_batches(rows, handle, f"{out}/checkpoint")
    query.awaitTermination()


def run_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Parsed items of the documents as they arrive."""
    out, parse = work_folder(spark, "ingest"), lambda batch: ingest.parse_items(V.items_of(_articles(batch)))
    store = Parts(spark, out, {"items": Table(ingest.parse_items(V.items(spark, folder)).schema)})
    _run(_documents(spark, folder), batch_writer(parse, store, "items", f"{out}/checkpoint"), out)
    return store.read("items")


def run_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """First article of every key, over all batches."""
    ensure_checkpoint_dir(spark)
    out = work_folder(spark, "dedup")
    store = dedup_store(spark, out, V.articles(spark, folder).schema)
    keep = dedup_writer(store, f"{out}/checkpoint")
    _run(_documents(spark, folder), lambda batch, batch_id: keep(_articles(batch), batch_id), out)
    return store.read("articles").drop("batch_id")


def cycle_writer(
    store: Parts, feeds: DataFrame, crawled: DataFrame, run: str, parse: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    clock: Callable[[], datetime] = ingest.utc_now,
) -> Callable[[DataFrame, int], None]:
    """One ingest cycle per micro-batch against all that is stored, each with its own time.

    ``run`` is the checkpoint of the stream, or a name.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        ingest.store_cycle(store, parse(batch), feeds, crawled, run_of(store.spark, run), batch_id, clock=clock)

    return handle


def feed_cycle_writer(
    store: Parts, feeds: DataFrame, crawled: DataFrame, run: str, clock: Callable[[], datetime] = ingest.utc_now,
) -> Callable[[DataFrame, int], None]:
    """One ingest cycle per micro-batch of feed files; records that are no XML go to the store's ``rejects``."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        items, rejects = readers.rss_batch(batch)
        ingest.store_cycle(store, items, feeds, crawled, run_of(store.spark, run), batch_id, clock=clock, rejects=rejects)

    return handle


def run_feed_files(spark: SparkSession, folder: str, landings: int = 3) -> Parts:
    """The items of the documents, landed as feed files in several turns with a broken record each, and taken in as
    a stream that is started after each landing."""
    ensure_checkpoint_dir(spark)
    out, feeds = work_folder(spark, "feed_files"), V.feeds(spark, folder)
    store, nothing = ingest.store_of(spark, f"{out}/store", feeds), table_of_none(spark, "url string, content string")
    named, turns = F.col("pub_date").alias("pubDate"), F.pmod("item_id", F.lit(landings)).alias("turn")
    items = V.items(spark, folder).select(turns, "feed_source_id", "title", "link", "guid", "author", named)
    # the texts are read once for all landings, and a feed lands in few files, however many the documents come in
    items.hint("rebalance", "turn", "feed_source_id").write.partitionBy("turn").parquet(f"{out}/items")
    items = spark.read.schema(items.schema).parquet(f"{out}/items")
    handle = feed_cycle_writer(store, feeds, nothing, f"{out}/checkpoint")
    for turn in range(landings):
        rows = items.where(F.col("turn") == turn).drop("turn")
        rows.write.mode("append").format("xml").option("rootTag", "channel").option("rowTag", "item").partitionBy("feed_source_id").save(f"{out}/landed")
        broken = spark.createDataFrame([(f"<channel><item><title>broken {turn}</title><link></item></channel>", 1)], "value string, feed_source_id int")
        broken.write.mode("append").partitionBy("feed_source_id").text(f"{out}/landed")
        _run(readers.stream_rss_items(spark, f"{out}/landed"), handle, out)
    return store


def run_feed_log(spark: SparkSession, folder: str) -> DataFrame:
    """What each landing of feed files brought, by feed, with the unreadable records."""
    store = run_feed_files(spark, folder)
    bad = store.read("rejects").groupBy("cycle_id", "feed_source_id").agg(F.count("*").alias("rejected"))
    logs = store.read("logs").where("status = 'success'").join(bad, ["cycle_id", "feed_source_id"], "left")
    return logs.select("cycle_id", "feed_source_id", "articles_fetched", "dropped", F.coalesce("rejected", F.lit(0)).alias("rejected"))


def _run_cycles(spark: SparkSession, folder: str, crawled: DataFrame) -> Parts:
    out, now = work_folder(spark, "cycles"), datetime.fromisoformat(V.BATCH_TIME)
    feeds = V.feeds(spark, folder)
    store = ingest.store_of(spark, f"{out}/store", feeds)
    parse = lambda batch: V.items_of(_articles(batch))
    _run(_documents(spark, folder), cycle_writer(store, feeds, crawled, f"{out}/checkpoint", parse, lambda: now), out)
    return store


def run_cycles(spark: SparkSession, folder: str, crawled: DataFrame) -> DataFrame:
    """The stored articles after all cycles."""
    return _run_cycles(spark, folder, crawled).read("articles")


def run_ingest_log(spark: SparkSession, folder: str) -> DataFrame:
    """One log row per active feed and cycle."""
    nothing = table_of_none(spark, "url string, content string")
    logs = _run_cycles(spark, folder, nothing).read("logs")
    return logs.drop("id", "started_at", "execution_time_ms").withColumnRenamed("cycle_id", "batch_id")


def run_trending(spark: SparkSession, folder: str) -> DataFrame:
    """Keyword counts kept as partial counts per batch, merged on reading."""
    out = work_folder(spark, "trending")
    store, count = counts_store(spark, out), lambda batch: keywords.trending_words(V.grouped(V.articles_of(batch)), stopwords=V.STOPWORDS)
    _run(_documents(spark, folder), batch_writer(count, store, "parts", f"{out}/checkpoint"), out)
    return merge_counts(store.read("parts"))
