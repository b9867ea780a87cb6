"""What a cycle need not do twice, or for items that are not saved."""

from datetime import datetime

from newsloom.plans import ingest, queries

SF = "/root/testdata/sf0.001"


def test_stored_items_are_parsed_once(spark):
    stored = queries._stored_items(spark, SF)
    plan = stored._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan  # a reader of the stored items does not parse them again
    assert stored.count()


def test_only_saved_items_are_parsed_whole(spark, tmp_path):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path))
    kind = "item_id long, feed_source_id int, title string, link string, description string, guid string, author string, pub_date string, comments string"
    row = lambda n: (n, 1, "A title", "https://a/1", "text", "g", " Desk ", "2026-01-01", "0")
    items = spark.createDataFrame([row(1), row(2)], kind)
    feeds = spark.createDataFrame([(1, 7, True, None)], "id int, category_id int, is_active boolean, last_fetched_at timestamp_ntz")
    nothing = spark.createDataFrame([], "url string, content string")
    cycle = ingest.ingest_cycle(
        items, feeds, None, nothing, datetime(2026, 1, 1), known=lambda _: spark.createDataFrame([], "digest binary"),
        last=spark.createDataFrame([(4,)], "id long"),
    )
    assert [(r.id, r.author, r.category_id) for r in cycle.articles.collect()] == [(5, "Desk", 7)]
    plan = cycle.articles._jdf.queryExecution().optimizedPlan().toString()
    assert "trim(author" in plan.split("Join Inner")[0]
    assert "trim(author" not in plan[plan.index("Join Inner"):]
