"""The index of stored keys, and the parts that a store consists of."""

import os
import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from newsloom.operators import history
from newsloom.plans import ingest
from newsloom.sources.parts import Parts, Table

ITEM = "item_id long, feed_source_id int, title string, link string, description string, guid string, author string, pub_date string, comments string"


@pytest.fixture(autouse=True)
def checkpoints(spark, tmp_path_factory):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))


def digests(spark, numbers):
    return spark.createDataFrame([(n,) for n in numbers], "n long").select(history.digest("link", F.col("n")).alias("digest"))


def add(store, spark, cycle, numbers):
    tables = history.index_tables(digests(spark, numbers))
    store.publish("run", cycle, [store.write(t, rows, f"run-{cycle}") for t, rows in tables.items()])


def found(store, spark, numbers):
    return history.known_digests(digests(spark, numbers), store).count()


def test_known_digests_are_exact(spark, tmp_path):
    store = Parts(spark, str(tmp_path), history.TABLES, fan=2)
    assert found(store, spark, [1, 2]) == 0
    add(store, spark, 0, range(3000))
    add(store, spark, 1, [5000, 5000, 5001])
    add(store, spark, 2, [])
    assert max(p.level for p in store.version().parts) > 0
    assert found(store, spark, range(2000, 6000)) == 1002
    assert found(store, spark, [*[7] * 50, 5001, 9999]) == 2


def test_few_buckets_are_read_and_filters_pass_few(spark, tmp_path, capsys):
    store = Parts(spark, str(tmp_path), history.TABLES)
    add(store, spark, 0, range(20000))
    passed = history.candidates(digests(spark, range(10**6, 10**6 + 4000)), store.read("filters")).count()
    assert passed < 100
    assert history.candidates(digests(spark, range(500)), store.read("filters")).count() == 500
    history.known_digests(digests(spark, [3]), store).explain()
    plan = capsys.readouterr().out
    assert re.search(r"PartitionFilters: \[[^]]*bucket#\d+ (= \d+|IN)", plan), plan


def test_a_digest_keeps_values_apart(spark):
    row = spark.range(1).select(
        history.digest("k", F.lit("a"), F.lit("bc")).alias("a"), history.digest("k", F.lit("ab"), F.lit("c")).alias("b"),
        history.digest("l", F.lit("a"), F.lit("bc")).alias("c"), history.digest("k", F.lit("a"), F.lit(None).cast("string")).alias("d"),
    ).first()
    assert len({bytes(row.a), bytes(row.b), bytes(row.c)}) == 3 and row.d is None


def batches(seed):
    """Three batches of items with a hot title, a hot link and a hot guid, bad rows and copies across batches."""
    rng, rows = random.Random(seed), []
    for i in range(180):
        title = rng.choice(["Hot  title", "hot title", f"Title {rng.randrange(40)}", None, f"T {i}"])
        link = rng.choice(["http://hot", f"http://x/{rng.randrange(60)}", None, f"http://y/{i}"])
        guid = rng.choice([None, None, "hot-guid", f"g{rng.randrange(60)}", f"h{i}"])
        date = rng.choice(["2024-01-01", "2024-01-02", "2024-01-01T10:00:00Z", "no date"])
        rows.append((i, rng.choice([0, 1, 2, 9]), title, link, "text", guid, "a", date, "1"))
    return [rows[:60], rows[60:120], rows[120:]]


def plain(every):
    """The cycles in plain Python: accepted item ids by batch and the counts of all outcomes."""
    taken, out = (set(), set(), set()), []
    for rows in every:
        left, dropped = [], 0
        for item, feed, title, link, _, guid, _, date, _ in sorted(rows):
            if feed not in (0, 1):
                continue
            if title is None or link is None or not date[0].isdigit():
                dropped += 1
            else:
                left.append((item, (feed, date[:10], " ".join(title.lower().split())), link, guid))
        valid = len(left)
        for level in range(3):
            seen, kept = set(), []
            for row in left:
                key = row[level + 1]
                if key is None or (key not in taken[level] and key not in seen):
                    kept.append(row)
                seen.add(key)
            left = kept
        for row in left:
            for level in range(3):
                taken[level].add(row[level + 1])
        out.append(([r[0] for r in left], {"saved": len(left), "duplicate": valid - len(left), "dropped": dropped}))
    return out


def test_cycles_against_the_index_equal_the_full_check(spark, tmp_path):
    feeds = spark.createDataFrame([(0, 1, True), (1, 1, True), (2, 1, False)], "id int, category_id int, is_active boolean")
    feeds = feeds.withColumn("last_fetched_at", F.lit(None).cast("timestamp_ntz"))
    nothing = spark.createDataFrame([], "url string, content string")
    store, every = ingest.store_of(spark, str(tmp_path / "s"), feeds, fan=2), batches(4)
    expected = plain(every)
    for cycle_id, (rows, (saved, counts)) in enumerate(zip(every, expected)):
        items = spark.createDataFrame(rows, ITEM)
        before = store.read("articles")
        whole = ingest.ingest_cycle(items, feeds, before, nothing, datetime(2026, 1, 1))
        assert sorted(r.item_id for r in whole.decided.where("outcome = 'saved'").collect()) == saved
        assert ingest.store_cycle(store, items, feeds, nothing, "run", cycle_id) == counts == whole.metrics
    logs = store.read("logs").groupBy("cycle_id").agg(F.sum("articles_saved"), F.sum("duplicates_found"), F.sum("dropped")).orderBy("cycle_id").collect()
    assert [tuple(r)[1:] for r in logs] == [(c["saved"], c["duplicate"], c["dropped"]) for _, c in expected]
    assert [r.id for r in store.read("articles").orderBy("id").collect()] == list(range(1, 1 + sum(len(s) for s, _ in expected)))


def files(folder):
    return sum(name.endswith(".parquet") for _, _, names in os.walk(folder) for name in names)


def test_merges_keep_the_files_few(spark, tmp_path):
    """Fifty batches of counts: few parts at any time, and the sums stay right."""
    schema = StructType.fromDDL("word string, n long")
    total = lambda rows: rows.groupBy("word").agg(F.sum("n").alias("n"))
    store, most = Parts(spark, str(tmp_path), {"counts": Table(schema, merge=total)}, fan=4), 0
    for batch in range(50):
        part = store.write("counts", spark.createDataFrame([("a", 1), (f"w{batch % 7}", batch)], schema).coalesce(1), f"run-{batch}")
        store.publish("run", batch, [part])
        most = max(most, files(str(tmp_path)))
    assert len([p for p in store.version().parts]) <= 3 * 3 and most <= 3 * 3 + 4 * 3 + 4
    sums = {r.word: r.n for r in total(store.read("counts")).collect()}
    assert sums == {"a": 50, **{f"w{k}": sum(b for b in range(50) if b % 7 == k) for k in range(7)}}


def test_readers_of_the_version_before_a_merge_find_their_files(spark, tmp_path):
    schema = StructType.fromDDL("n long")
    store = Parts(spark, str(tmp_path), {"rows": Table(schema)}, fan=2)
    put = lambda batch: store.publish("run", batch, [store.write("rows", spark.createDataFrame([(batch,)], schema), f"run-{batch}")])
    put(0)
    reader = store.read("rows")
    put(1)  # merges both
    assert [r.n for r in reader.collect()] == [0] and sorted(r.n for r in store.read("rows").collect()) == [0, 1]
    assert store.done("run", 1) and not store.done("run", 2) and not store.done("other", 0)


def test_a_replaced_table_keeps_its_last_part(spark, tmp_path):
    schema = StructType.fromDDL("n long")
    store = Parts(spark, str(tmp_path), {"state": Table(schema, replaced=True)})
    for batch in range(3):
        store.publish("run", batch, [store.write("state", spark.createDataFrame([(batch,)], schema), f"run-{batch}")])
    assert [r.n for r in store.read("state").collect()] == [2]
