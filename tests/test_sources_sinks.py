import json
import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.operators import keywords as K
from newsloom.plans import ingest, serving
from newsloom.plans.queries import QUERIES
from newsloom.sources import readers, seeds, writers

LINE = {"publish_date": "2026-05-26", "source": "bao1", "title": "Tin mới", "content": "phim mới"}


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def test_scan_json_lines_skips_missing_folders(spark, tmp_path):
    put(tmp_path / "giai_tri", "a.json", json.dumps(LINE) + "\n" + json.dumps(LINE))
    put(tmp_path / "suc_khoe", "a.json", json.dumps({"source": "x"}))
    articles, skipped = readers.scan_json_lines(spark, str(tmp_path))
    assert skipped == ["cong_nghe"]
    assert sorted((r.chu_de, r.title) for r in articles.collect()) == [
        ("GiaiTri", "Tin mới"), ("GiaiTri", "Tin mới"), ("SucKhoe", None)
    ]
    with pytest.raises(FileNotFoundError):
        readers.scan_json_lines(spark, str(tmp_path / "nowhere"))


def test_scan_json_array_keeps_corrupt_records_apart(spark, tmp_path):
    record = {**LINE, "id": "1", "category": "Entertainment", "created_at": "2026-05-26T00:00:00Z"}
    put(tmp_path / "giai_tri", "articles.json", json.dumps([record, record], indent=1))
    put(tmp_path / "cong_nghe", "articles.json", '[{"id": "2", ')
    articles, skipped = readers.scan_json_array(spark, str(tmp_path))
    assert skipped == ["suc_khoe"]
    assert [(r.chu_de, r.content) for r in articles.collect()] == [("Entertainment", "phim mới")] * 2
    corrupt, _ = readers.scan_json_array(spark, str(tmp_path), keep_corrupt=True)
    assert len(corrupt.collect()) == 1


RSS = """<?xml version="1.0" encoding="UTF-8"?>
<rss version="2.0" xmlns:slash="http://purl.org/rss/1.0/modules/slash/"><channel><title>Feed</title>
<item><title><![CDATA[ Tin <b>A</b> ]]></title><link>https://a.vn/1</link><description><![CDATA[<p>x &amp; y</p>]]></description>
<guid>g1</guid><pubDate>Tue, 26 May 2026 08:30:00 +0700</pubDate><slash:comments>4</slash:comments></item>
<item><title>tin   &lt;b&gt;a&lt;/b&gt;</title><link>https://a.vn/2</link><pubDate>2026-05-26T20:00:00Z</pubDate></item>
<item><title> </title><link>https://a.vn/3</link><pubDate>2026-05-26</pubDate></item>
<item><title>No date</title><link>https://a.vn/4</link><pubDate>soon</pubDate><slash:comments>many</slash:comments></item>
<item><title>Same link</title><link>https://a.vn/1</link><description>d</description><pubDate>2026-05-27</pubDate></item>
</channel></rss>"""


def feed_items(spark, tmp_path):
    put(tmp_path / "rss" / "feed_source_id=1", "feed.xml", RSS)
    items = readers.scan_rss_items(spark, str(tmp_path / "rss"))
    return items.withColumn("item_id", F.monotonically_increasing_id())


def test_large_json_arrays_are_read_in_blocks(spark, tmp_path):
    """Braces, quotes and backslashes in strings, nested objects, a broken record; many blocks of few bytes."""
    rng = random.Random(3)
    words = ['"', "\\", "}", "{", "},", '\\"}', "[", "],", "\n", "é", "plain", ",", '{"a": 1}']
    texts = ["".join(rng.choice(words) for _ in range(rng.randrange(12))) for _ in range(400)]
    records = [{"id": str(i), "title": t, "content": t * 2, "nested": {"a": {"b": t}}} if i % 5 == 0 else {"id": str(i), "title": t, "content": t * 2} for i, t in enumerate(texts)]
    (tmp_path / "giai_tri").mkdir()
    (tmp_path / "giai_tri" / "a.json").write_text(json.dumps(records, ensure_ascii=False, indent=1))
    (tmp_path / "giai_tri" / "b.json").write_text(json.dumps(records[:3]).replace('"id": "1"', '"id" "1"'))
    (tmp_path / "giai_tri" / "empty.json").write_text("[]")
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    for k in keys:
        spark.conf.set(k, "700")
    try:
        assert readers.json_array_records(spark, str(tmp_path / "giai_tri")).count() == 403
        blocks = spark.read.option("lineSep", "}").text(str(tmp_path / "giai_tri")).rdd.getNumPartitions()
        articles, _ = readers.scan_json_array(spark, str(tmp_path))
        got = sorted((int(r.id), r.title, r.content) for r in articles.collect())
        corrupt = readers.scan_json_array(spark, str(tmp_path), keep_corrupt=True)[0].collect()
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)
    assert blocks > 20
    assert got == sorted([(i, t, t * 2) for i, t in enumerate(texts)] + [(i, texts[i], texts[i] * 2) for i in (0, 2)])
    assert len(corrupt) == 1 and '"id" "1"' in corrupt[0][readers.CORRUPT]


def test_large_categories_are_landed_as_several_arrays(spark, tmp_path):
    rows = [(str(i), f"t{i} }}", 'x"{[,' * (i % 7), "bao", "giai_tri" if i % 10 else "suc_khoe", "2026-05-26") for i in range(200)]
    names = "id string, title string, content string, source string, category string, publish_date string"
    articles = spark.createDataFrame(rows, names)
    for limit, files in ((200, 10), (10**6, 2)):
        base = tmp_path / str(limit)
        writers.land_json_arrays(articles, str(base), "id", max_chars=limit)
        landed = sorted(base.rglob("part-*"))
        landed = [p for p in landed if p.is_file()]
        arrays = [json.loads(p.read_text(encoding="utf-8")) for p in landed]
        assert sum(map(len, arrays)) == 200 and (len(landed) == 2 if files == 2 else len(landed) >= files)
        assert limit > 200 or max(sum(len(r["content"]) for r in a) for a in arrays) < 1500
        found = readers.scan_json_array(spark, str(base), {"category=giai_tri": "a", "category=suc_khoe": "b"})[0]
        assert sorted(map(tuple, found.select(*[n.split()[0] for n in names.split(", ")]).collect())) == sorted(rows)


def test_stored_pages_equal_the_query(spark, tmp_path, capsys):
    logs = spark.range(3000).select(
        F.col("id").alias("log_id"), (F.col("id") % 7).cast("int").alias("feed_source_id"),
        F.when(F.col("id") % 3 == 0, "failed").otherwise("success").alias("status"),
        F.timestamp_add("SECOND", (F.col("id") * 37) % 991, F.lit("2026-01-01").cast("timestamp_ntz")).alias("started_at"),
    )
    adaptive = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(adaptive, "false")
    try:
        serving.store_log_pages(logs, str(tmp_path))
    finally:
        spark.conf.set(adaptive, "true")
    keys = lambda df: [(r.started_at, r.log_id, r.total) for r in df.collect()]
    for offset, feed, status in ((0, None, None), (37, 3, None), (990, None, "failed"), (2970, None, None), (5000, None, None), (60, 2, "failed")):
        own = serving.stored_logs_page(spark, str(tmp_path), 50, offset, feed, status)
        assert keys(own) == keys(serving.logs_page(logs, 50, offset, feed, status))
    every = keys(serving.logs_page(logs, 1000, 0, 3, "success"))
    seen, last = [], None
    while page := keys(serving.stored_logs_page(spark, str(tmp_path), 60, 0, 3, "success", after=last)):
        seen, last = seen + page, page[-1][:2]
    assert seen == every
    serving.stored_logs_page(spark, str(tmp_path), 10, 2500).explain()
    assert re.search(r"PartitionFilters: \[[^]]*part#\d+ (= \d+|IN \([\d,]+\))", capsys.readouterr().out)


def test_scan_rss_items(spark, tmp_path):
    items = feed_items(spark, tmp_path)
    assert items.count() == 5
    parsed = {r.link: r for r in ingest.parse_items(items).where("link <> 'https://a.vn/1'").collect()}
    assert parsed["https://a.vn/3"].title is None
    assert parsed["https://a.vn/4"].published_date is None
    first = ingest.parse_items(items).where("guid = 'g1'").first()
    assert (first.title, first.comment_count, first.feed_source_id) == ("Tin <b>A</b>", 4, 1)
    assert first.published_date == datetime(2026, 5, 26, 8, 30)


def test_feed_files_give_equal_items_once(spark, tmp_path):
    """Copies of one text whose dates are written in two forms, as 20240114 and as 2024-01-14."""
    rows = [(i, "Phim mới\nrobot", "en", "src1", 14) for i in (2, 7, 14, 19)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["feed_files"](spark, str(tmp_path)).collect()
    assert len(found) == len(set(found)) and {r.published_date.day for r in found} == {9}


def test_ingest_cycle_over_feed_files(spark, tmp_path):
    """Same title in other case and spacing, same link, blank title and bad date are left out."""
    items = feed_items(spark, tmp_path)
    feeds = seeds.seed_feeds(spark)
    nothing = spark.createDataFrame([], schemas.ARTICLE)
    crawled = spark.createDataFrame(
        [("https://a.vn/1", "w" * 51), ("https://a.vn/1", "w" * 60), ("https://a.vn/1", "short")], "url string, content string"
    )
    now = datetime(2026, 5, 28)
    cycle = ingest.ingest_cycle(items, feeds, nothing, crawled, now)
    rows = cycle.articles.collect()
    assert [(r.id, r.link, r.slug, r.content_html, r.description) for r in rows] == [
        (1, "https://a.vn/1", "tin-b-a-b", "w" * 60, "x & y")
    ]
    assert set(cycle.articles.columns) == {f.name for f in schemas.ARTICLE}
    log = {r.feed_source_id: r for r in cycle.log.collect()}
    assert (log[1].status, log[1].articles_fetched, log[1].articles_saved, log[1].duplicates_found) == ("success", 3, 1, 2)
    assert (log[2].status, log[2].error_message) == ("failed", "Failed to fetch feed")
    assert {r.id: r.last_fetched_at for r in cycle.feeds.collect()}[1] == now
    assert cycle.feeds.where("last_fetched_at is not null").count() == 1
    assert log[1].dropped == 2
    totals = ingest.cycle_totals(ingest.cycle_stats(cycle.decided)).first()
    assert tuple(totals) == (3, 1, 2, 2)
    assert cycle.metrics == {"saved": 1, "duplicate": 2, "dropped": 2}
    # The next cycle finds everything stored.
    again = ingest.ingest_cycle(items, cycle.feeds, cycle.articles, crawled, now)
    assert again.articles.count() == 0


def test_load_stopwords(spark, tmp_path):
    put(tmp_path, "stop.txt", " và \n\ncủa\nvà\n")
    assert sorted(r.word for r in readers.load_stopwords(spark, str(tmp_path / "stop.txt")).collect()) == ["của", "và"]
    assert readers.load_stopwords(spark, str(tmp_path / "none.txt")).isEmpty()


def test_load_lexicon(spark, tmp_path):
    put(tmp_path, "w.xml", '<?xml version="1.0"?><corpus><body><w msd="noun">Hà  Nội</w><w>xe đạp</w></body></corpus>')
    put(tmp_path, "pairs.txt", "òa\toà\nóa\toá\n")
    words = readers.load_lexicon(spark, str(tmp_path / "w.xml")).collect()
    assert sorted((r.word, r.kind) for r in words) == [("Hà Nội", "noun"), ("xe đạp", None)]
    assert [tuple(r) for r in readers.load_rewrite_pairs(spark, str(tmp_path / "pairs.txt")).collect()] == [("òa", "oà"), ("óa", "oá")]


def test_seed_dimensions(spark):
    assert seeds.seed_categories(spark).count() == 3
    feeds = seeds.seed_feeds(spark)
    assert [r["count"] for r in feeds.groupBy("category_id").count().orderBy("category_id").collect()] == [3, 3, 3]


def test_seed_if_empty(spark, tmp_path):
    path = str(tmp_path / "categories")
    rows = seeds.seed_categories(spark)
    assert writers.seed_if_empty(rows, path)
    assert not writers.seed_if_empty(rows.limit(1), path)
    assert spark.read.parquet(path).count() == 3
    assert writers.seed_if_empty(rows.limit(1), path, reset=True)
    assert spark.read.parquet(path).count() == 1


def trending(spark):
    return spark.createDataFrame(
        [("20260526", "bao1", "GiaiTri", "phim", 3), ("20260527", None, "SucKhoe", "", 1), ("20260526", "", "GiaiTri", 'a"b,c', 2)],
        "ngay string, nguon string, chu_de string, tu_khoa string, so_lan_xuat_hien long",
    )


def test_result_schema(spark):
    assert [f.dataType for f in writers.to_result_schema(trending(spark)).schema] == [f.dataType for f in schemas.TRENDING]
    broken = trending(spark).withColumn("tu_khoa", F.nullif("tu_khoa", F.lit("phim")))
    with pytest.raises(Exception, match="tu_khoa must not be null"):
        writers.to_result_schema(broken).collect()


def test_sink_roundtrips(spark, tmp_path):
    path = str(tmp_path / "out")
    stored = writers.write_trending(trending(spark), path, single_file=True)
    wanted = sorted(map(str, trending(spark).collect()))
    assert sorted(map(str, stored.collect())) == wanted
    assert sorted(map(str, writers.read_csv(spark, path + "_csv").collect())) == wanted
    assert len(list((tmp_path / "out_csv").glob("*.csv"))) == 1
    assert next((tmp_path / "out_csv").glob("*.csv")).read_text().startswith("ngay,nguon,chu_de,tu_khoa,so_lan_xuat_hien")


def test_partitioned_sink_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "by_day")
    writers.write_result(trending(spark), path, partition_by="ngay")
    newer = trending(spark).where("ngay = '20260527'").withColumn("so_lan_xuat_hien", F.lit(7))
    writers.write_result(newer, path, partition_by="ngay")
    table = spark.read.schema(schemas.TRENDING).parquet(path)
    assert {(r.ngay, r.so_lan_xuat_hien) for r in table.collect()} == {("20260526", 3), ("20260526", 2), ("20260527", 7)}


def test_land_raw_zone_and_read_back(spark, tmp_path):
    articles = spark.createDataFrame(
        [("2026-05-26", "bao1", "A", "phim hay", 1), ("2026-05-27", "bao2", "B", "robot", 2)],
        "publish_date string, source string, title string, content string, category_id int",
    )
    folders = spark.createDataFrame([(1, "giai_tri"), (2, "cong_nghe")], "category_id int, category string")
    writers.land_raw_zone(articles, folders, str(tmp_path / "raw"))
    names = {f"category={k}": v for k, v in readers.FOLDERS.items()}
    landed, skipped = readers.scan_json_lines(spark, str(tmp_path / "raw"), names)
    assert skipped == ["category=suc_khoe"]
    assert {(r.chu_de, r.title) for r in landed.collect()} == {("GiaiTri", "A"), ("CongNghe", "B")}
    assert K.trending_words(landed).count() == 3
    more = articles.where("category_id = 1").unionByName(articles.where("category_id = 1").withColumn("category_id", F.lit(9)))
    writers.land_raw_zone(more, folders, str(tmp_path / "raw"))  # leaves the other folders alone
    put(tmp_path, "raw/category=cong_nghe/bad.json", "{not json\n")
    landed, _ = readers.scan_json_lines(spark, str(tmp_path / "raw"), names | {"category=_unknown": "none"})
    assert sorted((r.chu_de, r.title) for r in landed.collect()) == [("CongNghe", "B"), ("GiaiTri", "A"), ("none", "A")]
    corrupt, _ = readers.scan_json_lines(spark, str(tmp_path / "raw"), names, keep_corrupt=True)
    assert [r._corrupt_record for r in corrupt.collect()] == ["{not json"]


def test_serving_table(spark):
    rows = trending(spark).withColumn("so_lan_xuat_hien", F.nullif("so_lan_xuat_hien", F.lit(3)))
    writers.publish_serving_table(rows, "table_trending_words", "2026-05-28 00:00:00")
    table = spark.table("table_trending_words")
    assert sorted(r.so_lan_xuat_hien for r in table.collect()) == [1, 1, 2]
    top = spark.sql("SELECT tu_khoa, SUM(so_lan_xuat_hien) AS tong FROM table_trending_words GROUP BY tu_khoa ORDER BY tong DESC LIMIT 20")
    assert top.first().tong == 2
    assert table.schema["created_at"].dataType.typeName() == "timestamp_ntz"


def test_scan_table_reads_only_wanted_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select("id", F.lit("x").alias("wide")).write.parquet(path)
    plan = readers.scan_table(spark, path).where("id > 3").select("id")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<id:bigint>" in plan and "GreaterThan(id,3)" in plan
