import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from newsloom.operators import dedup
from newsloom.operators.matching import attach_by_key
from newsloom.operators.numbering import assign_ids

SCHEMA = "article_id long, feed_source_id int, title string, published_at timestamp_ntz"


def made(n, seed):
    """Articles of which about a third are copies of one."""
    rng, start, rows = random.Random(seed), datetime(2026, 5, 26), []
    for i in range(n):
        if rng.random() < 0.34:
            rows.append((i, 1, rng.choice(["Hot  News", " hot news", "HOT NEWS"]), start + timedelta(hours=rng.randrange(24))))
        else:
            title = rng.choice(["a", "A ", "b", "c d", "", None, f"t{i}"])
            rows.append((i, rng.randrange(3), title, start + timedelta(hours=rng.randrange(72))))
    return rows


def key(row):
    return row[1], row[3].date(), " ".join((row[2] or "").lower().split())


@pytest.fixture(scope="module")
def rows():
    return made(600, 1)


def firsts_of(rows):
    firsts = {}
    for row in sorted(rows):
        firsts.setdefault(key(row), row[0])
    return firsts


def test_first_wins_is_brute_force_and_idempotent(spark, rows):
    once = dedup.first_wins(spark.createDataFrame(rows, SCHEMA))
    assert {r.article_id for r in once.collect()} == set(firsts_of(rows).values())
    assert dedup.first_wins(once).count() == once.count()


def test_marks_are_what_first_wins_drops(spark, rows):
    marked = dedup.mark_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    firsts = firsts_of(rows)
    assert len(marked) == len(rows)
    for r in marked:
        first = firsts[key((r.article_id, r.feed_source_id, r.title, r.published_at))]
        assert r.is_duplicate == (r.article_id != first)
        assert r.duplicate_of_id == (first if r.is_duplicate else None)


def test_duplicate_pairs_has_one_row_per_duplicate(spark, rows):
    marked = dedup.mark_duplicates(spark.createDataFrame(rows, SCHEMA))
    pairs = dedup.duplicate_pairs(marked).collect()
    titles = {r[0]: r[2] for r in rows}
    assert len(pairs) == marked.where("is_duplicate").count()
    assert all(p.original_title == titles[p.duplicate_of_id] for p in pairs)


def test_new_items_and_duplicate_of(spark, rows):
    stored = made(80, 2)
    known = firsts_of(stored)
    items = spark.createDataFrame(rows, SCHEMA.replace("article_id", "item_id"))
    table = spark.createDataFrame(stored, SCHEMA)
    fresh = {r.item_id for r in dedup.new_items(items, table).collect()}
    assert fresh == {i for k, i in firsts_of(rows).items() if k not in known}
    compat = {r.item_id for r in dedup.new_items(items, table, compat=True).collect()}
    assert compat == {r[0] for r in rows if key(r) not in known}
    found = {r.item_id: (r.is_duplicate, r.duplicate_id) for r in dedup.duplicate_of(items, table).collect()}
    assert found == {r[0]: (key(r) in known, known.get(key(r))) for r in rows}


def test_unique_links_keeps_null_guids(spark):
    rows = [(1, "l1", "g1"), (2, "l1", "g2"), (3, "l2", "g1"), (4, "l3", None), (5, "l4", None)]
    items = spark.createDataFrame(rows, "item_id long, link string, guid string")
    assert {r.item_id for r in dedup.unique_links(items).collect()} == {1, 4, 5}


def test_attach_spreads_a_hot_key(spark, rows):
    df = spark.range(20000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    lookup = spark.createDataFrame([("hot", 1), ("7", 2)], "k string, v int")
    joined = attach_by_key(df, lookup, ["k"], "id")
    counts = defaultdict(int)
    for r in joined.groupBy("v").count().collect():
        counts[r.v] = r["count"]
    assert counts == {1: 6667, 2: 1, None: 13332}


@pytest.mark.parametrize("partitions", [1, 7])
def test_assign_ids_is_dense_in_order(spark, partitions):
    values = random.Random(3).sample(range(10000), 3000)
    df = spark.createDataFrame([(v, f"x{v % 5}") for v in values], "v int, s string").repartition(partitions)
    rows = assign_ids(df, ["s", "v"], start=100).collect()
    wanted = {v: i for i, (_, v) in enumerate(sorted((f"x{v % 5}", v) for v in values), 101)}
    assert {r.v: r.id for r in rows} == wanted


def test_assign_ids_start_from_a_table(spark):
    stored = spark.createDataFrame([(5,), (9,)], "id long")
    rows = assign_ids(spark.range(3).select(F.col("id").alias("n")), ["n"], start=stored.agg(F.max("id"))).collect()
    assert sorted(r.id for r in rows) == [10, 11, 12]
    empty = assign_ids(spark.range(2).select(F.col("id").alias("n")), ["n"], start=stored.where("id < 0").agg(F.max("id")))
    assert sorted(r.id for r in empty.collect()) == [1, 2]
