"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_by_key(
    rows: DataFrame, lookup: DataFrame, keys: list[str], row_id: str, salts: int | None = None
) -> DataFrame:
    """Left join of ``rows`` to a ``lookup`` that has one row per key.

    Each key is split by a hash of the row id. The lookup is first joined to the
    distinct (key, salt) pairs, at most ``salts`` per key, so the wide join moves
    a hot key to many tasks and copies lookup rows only for pairs that exist. There are
    as many salts as shuffle partitions, so a hot key can use all of them; the result
    does not depend on the number.
    """
    salts = salts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(row_id), F.lit(salts)).cast("int"))
    pairs = salted.select(*keys, "_salt").distinct()
    per_pair = pairs.join(lookup, keys, "inner")
    return salted.join(per_pair, [*keys, "_salt"], "left").drop("_salt")


def keep_first(rows: DataFrame, keys: list[str], row_id: str) -> DataFrame:
    """One row per key, the one with the lowest id.

    The key is aggregated map-side, so copies of one key never meet in a task;
    the payload then joins on the id, which is unique.
    """
    first = rows.groupBy(*keys).agg(F.min(row_id).alias(row_id)).select(row_id)
    return rows.join(first, row_id, "left_semi")
