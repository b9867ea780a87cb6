"""Runs every registered query beside its SQL: ``python tests/check_oracle.py <folder> [name ...]``."""

import datetime
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry  # noqa: E402


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def connect(folder):
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def compare(spark, con, folder, name):
    """None where Spark and SQL agree, else what differs."""
    frame = entry.queries()[name](spark, folder)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return f"rows only: {frame.count()}", True
    got = frame.collect()
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    wanted = result.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}", False
    ours, theirs = rows_of(frame.columns, got), rows_of(columns, wanted)
    if ours == theirs:
        return f"{len(got)} rows", True
    only_ours, only_theirs = ours - theirs, theirs - ours
    clip = lambda c: [tuple(str(v)[:150] for v in r) for r in list(c)[:2]]
    return (f"{len(got)} vs {len(wanted)} rows, {sum(only_ours.values())} only in Spark {clip(only_ours)}, "
            f"{sum(only_theirs.values())} only in SQL {clip(only_theirs)}"), False


def main():
    folder, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = []
    for name in names or sorted(entry.queries()):
        start = time.time()
        try:
            text, ok = compare(spark, con, folder, name)
        except Exception as error:
            text, ok = f"{type(error).__name__}: {str(error)[:600]}", False
        print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - start:.1f}s {text}", flush=True)
        if not ok:
            bad.append(name)
    print(datetime.datetime.now(), "bad:", bad)
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
