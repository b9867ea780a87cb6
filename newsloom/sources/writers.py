"""Sinks and table upkeep."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom import schemas


def to_result_schema(table: DataFrame) -> DataFrame:
    """The result columns in order and type; a null keyword or count is an error."""
    def required(name: str, value):
        message = F.lit(f"{name} must not be null")
        return F.when(value.isNull(), F.raise_error(message)).otherwise(value).alias(name)

    checked = [
        F.col(f.name).cast(f.dataType) if f.nullable else required(f.name, F.col(f.name).cast(f.dataType))
        for f in schemas.TRENDING.fields
    ]
    return table.select(*checked)


def write_result(table: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Result as Parquet, overwritten.

    With ``partition_by`` only the partitions in ``table`` are replaced. Rows are
    rebalanced by it first, so that each value is a few files of even size, and a
    value with most of the rows is split over tasks.
    """
    rows = to_result_schema(table)
    if partition_by is None:
        rows.write.mode("overwrite").parquet(path)
        return
    (
        rows.hint("rebalance", partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_by).parquet(path)
    )


def write_csv(table: DataFrame, path: str, single_file: bool = False) -> None:
    """Result as CSV with a header. One file only on request, for a small report."""
    rows = table.coalesce(1) if single_file else table
    rows.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A null is an absent field and an empty string a quoted one; the null mark keeps them apart."""
    return spark.read.option("header", True).option("nullValue", "\\N").schema(schemas.TRENDING).csv(path)


def write_trending(table: DataFrame, path: str, single_file: bool = False) -> DataFrame:
    """The whole result: Parquet first, then the CSV from the stored files.

    Returns the stored table, so counts and previews do not run the job again.
    """
    write_result(table, path)
    stored = table.sparkSession.read.parquet(path)
    write_csv(stored, f"{path}_csv", single_file)
    return stored


def append(rows: DataFrame, path: str) -> None:
    """Append as one job: a failed job leaves nothing visible."""
    rows.write.mode("append").parquet(path)


def table_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table, empty where the path does not exist; any other failure is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return table_of_none(spark, schema)


def table_of_none(spark: SparkSession, schema) -> DataFrame:
    """A table without rows. The limit tells the optimizer, which then leaves out joins and aggregates over it."""
    return spark.createDataFrame([], schema).limit(0)


def seed_if_empty(rows: DataFrame, path: str, reset: bool = False) -> bool:
    """Write seed rows where the table has none; ``reset`` replaces what is there."""
    if not reset and not table_or_empty(rows.sparkSession, path, rows.schema).isEmpty():
        return False
    rows.write.mode("overwrite").parquet(path)
    return True


def land_raw_zone(articles: DataFrame, categories: DataFrame, base: str, rejects: str = "_unknown") -> None:
    """Articles as one JSON Lines folder per category, ``category=<folder>/``.

    ``categories`` maps ``category_id`` to the folder name; articles of no known
    category go to ``rejects``. Only the folders that receive articles are replaced.
    """
    rows = articles.join(categories.select("category_id", "category"), "category_id", "left")
    (
        rows.select("publish_date", "source", "title", "content", F.coalesce("category", F.lit(rejects)).alias("category"))
        .hint("rebalance", "category").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("category").json(base)
    )


def land_json_arrays(articles: DataFrame, base: str, row_id: str, max_chars: int) -> None:
    """Articles as files of one JSON array each, ``category=<folder>/part=<n>/``, every row in one of them.

    There are as many parts as hold about ``max_chars`` of content each, so no task writes more however large a
    category is.
    """
    total = articles.agg(F.sum(F.length("content"))).first()[0] or 0
    parts = 1 + total // max_chars
    lines = articles.select(
        "category", F.pmod(F.xxhash64(row_id), F.lit(parts)).alias("part"), F.col(row_id).alias("_id"),
        F.to_json(F.struct(*articles.columns)).alias("line"),
    )
    array = Window.partitionBy("category", "part").orderBy("_id")
    opening = F.when(F.row_number().over(array) == 1, "[").otherwise(",")
    closing = F.when(F.lead(F.lit(1)).over(array).isNull(), "]").otherwise("")
    # the rows come from the window in the order of the files
    lines.select("category", "part", F.concat(opening, "line", closing).alias("value")).write.partitionBy("category", "part").text(base)


def publish_serving_table(table: DataFrame, name: str, created_at: str) -> None:
    """The serving table, with a count of 1 where none is given and a creation time."""
    stamp = F.lit(created_at).cast("timestamp_ntz")
    rows = table.withColumns({
        "so_lan_xuat_hien": F.coalesce("so_lan_xuat_hien", F.lit(1)).cast("int"), "created_at": stamp,
    })
    rows.write.mode("overwrite").saveAsTable(name)


def write_jdbc(rows: DataFrame, url: str, table: str, partitions: int, properties: dict[str, str]) -> None:
    """Append to a database table over at most ``partitions`` connections."""
    rows.coalesce(partitions).write.mode("append").jdbc(url, table, properties=properties)
