"""Dense surrogate ids without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.session import ensure_checkpoint_dir

ROW_BITS = (1 << 33) - 1


def assign_ids(rows: DataFrame, order: list[str], start: int | DataFrame = 0, name: str = "id") -> DataFrame:
    """Number the rows ``start + 1, start + 2, ...`` along ``order``, which must be unique.

    Rows are range partitioned and sorted, then checkpointed, so a lost executor
    cannot move a row to another partition between counting and numbering. Each
    row gets its place in its partition plus the rows of earlier partitions; the
    running sum is over one row per partition. ``start`` may be a one-row frame.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    placed = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .checkpoint()
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS)) + 1)
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part").agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    first = start.scalar() if isinstance(start, DataFrame) else F.lit(start)
    numbered = placed.join(F.broadcast(offsets), "_part")  # one row per partition
    return numbered.select(
        (F.coalesce(first, F.lit(0)) + F.col("_before") + F.col("_place")).alias(name), *rows.columns
    )
