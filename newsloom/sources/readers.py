"""Sources: landed article files, feed files, tables and word lists."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from newsloom import schemas
from newsloom.functions import text as T
from newsloom.session import ensure_checkpoint_dir

# The landing folders and their category labels.
FOLDERS = {"giai_tri": "GiaiTri", "cong_nghe": "CongNghe", "suc_khoe": "SucKhoe"}
CORRUPT = "_corrupt_record"


def union_categories(frames: dict[str, DataFrame], label: str = "chu_de") -> DataFrame:
    """Union by name with the category as a constant column; missing columns are null."""
    tagged = [df.withColumn(label, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def _scan_folders(read, base: str, folders: dict[str, str]) -> tuple[DataFrame, list[str]]:
    frames, skipped = {}, []
    for folder, name in folders.items():
        try:
            frames[name] = read(f"{base.rstrip('/')}/{folder}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            skipped.append(folder)
    if not frames:
        raise FileNotFoundError(f"no category folder could be read under {base}")
    return union_categories(frames), skipped


def scan_json_lines(
    spark: SparkSession, base: str, folders: dict[str, str] | None = None, keep_corrupt: bool = False
) -> tuple[DataFrame, list[str]]:
    """Articles of all readable category folders, and the folders that were skipped.

    ``keep_corrupt`` returns the unreadable lines, in ``_corrupt_record``, instead of the articles.
    """
    schema = StructType([*schemas.RAW_ARTICLE.fields, StructField(CORRUPT, StringType())])
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
    rows, skipped = _scan_folders(reader.json, base, folders or FOLDERS)
    if keep_corrupt:
        return rows.where(F.col(CORRUPT).isNotNull()), skipped
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT), skipped


def json_array_records(spark: SparkSession, path: str) -> DataFrame:
    """file, number and record (JSON text) of the objects in files that hold one array each.

    A file is read in blocks by many tasks, cut at every closing brace. Whether a brace is one of a record or
    stands in a string or inside another object is told by the quotes and braces before it: each block's sums are
    carried over to the next ones, one row a block, and inside a block they are running sums. Text
    between a record and the next is dropped, so a broken record is returned as it is.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("piece"),
    )
    # the last piece of a file has a brace behind it only if the bytes say so
    read = F.sum(F.octet_length("piece") + 1) == F.max("size")
    files = pieces.groupBy("file").agg(F.max(F.struct("block", "at")).alias("last"), read.alias("whole"))
    closed = (F.struct("block", "at") != F.col("last")) | F.col("whole")
    pieces = pieces.join(files, "file").withColumn("closed", closed).drop("size", "last", "whole")
    bare = F.regexp_replace("piece", r"\\.", "")  # without escaped characters
    pieces = pieces.withColumn("quotes", F.regexp_count(bare, F.lit('"')) % 2)
    pieces = _carried(pieces, "quotes", "quoted")
    # a piece that begins inside a string gets the quote that is missing; then strings go
    whole = F.concat(F.when(F.col("quoted") % 2 == 1, '"').otherwise(""), F.regexp_replace("piece", r"\\.", ""))
    outside = F.regexp_replace(whole, '"[^"]*("|$)', "")
    inside_string = (F.col("quoted") + F.col("quotes")) % 2 == 1
    depth = F.regexp_count(outside, F.lit("[{]")) - F.when(inside_string | ~F.col("closed"), 0).otherwise(1)
    pieces = _carried(pieces.withColumn("step", depth).withColumn("open", inside_string), "step", "depth")
    # a record ends where the braces are even again
    ends = (F.col("closed") & ~F.col("open") & (F.col("depth") + F.col("step") <= 0)).cast("int")
    pieces = _carried(pieces.withColumn("ends", ends), "ends", "record_no")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda p: p["piece"]), "}")
    records = pieces.groupBy("file", "record_no").agg(text.alias("text"), F.max("ends").alias("ended"))
    body = F.regexp_replace(F.col("text"), r"(?s)^[\s,\[\]]+", "")
    records = records.select("file", F.col("record_no").alias("number"), body.alias("body"), "ended").where("body <> '' or ended = 1")
    return records.select("file", "number", F.concat("body", F.when(F.col("ended") == 1, "}").otherwise("")).alias("record"))


def _carried(pieces: DataFrame, value: str, name: str) -> DataFrame:
    """The sum of ``value`` over the pieces of the file before each one, as ``name``."""
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = pieces.groupBy("file", "block").agg(F.sum(value).alias("_sum"))
    blocks = blocks.select("file", "block", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    rows = pieces.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(blocks, ["file", "block"])
    return rows.withColumn(name, F.col("_before") + F.col("_inside")).drop("_before", "_inside")


def scan_json_array(
    spark: SparkSession, base: str, folders: dict[str, str] | None = None, keep_corrupt: bool = False
) -> tuple[DataFrame, list[str]]:
    """The same for files that hold one JSON array, however large; the category comes from the record.

    ``keep_corrupt`` returns the unreadable records, in ``_corrupt_record``, instead of the articles.
    """
    schema = StructType([*schemas.RAW_ARTICLE_ARRAY.fields, StructField(CORRUPT, StringType())])
    parsed = F.from_json("record", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    read = lambda path: json_array_records(spark, path).select(parsed.alias("r")).select("r.*")
    rows, skipped = _scan_folders(read, base, folders or FOLDERS)
    if keep_corrupt:
        return rows.where(F.col(CORRUPT).isNotNull()), skipped
    clean = rows.where(F.col(CORRUPT).isNull()).drop("chu_de", CORRUPT)
    return clean.withColumn("chu_de", F.col("category")), skipped


def scan_rss_items(spark: SparkSession, base: str) -> DataFrame:
    """Every item of every feed file under ``base/feed_source_id=N/``, as raw strings.

    ``item_id`` is a hash of feed and content, the same however often the files are read;
    equal items of one feed share it and count as one.
    """
    rows = spark.read.format("xml").option("rowTag", "item").schema(schemas.RSS_ITEM).load(base)
    return _raw_items(rows).dropDuplicates(["item_id"])


def _raw_items(rows: DataFrame) -> DataFrame:
    rows = rows.withColumnsRenamed({"pubDate": "pub_date", "slash:comments": "comments"})
    feed = [c for c in rows.columns if c == "feed_source_id"]
    content = [F.coalesce(c, F.lit("\0")) for c in ("title", "link", "description", "guid", "pub_date", "author", "comments")]
    return rows.withColumn("item_id", F.xxhash64(*feed, *content))


def stream_rss_items(spark: SparkSession, base: str, max_files: int | None = None) -> DataFrame:
    """The items of feed files that land under ``base/feed_source_id=N/``, as a stream.

    A record that is no XML comes with its text in ``_corrupt_record``; ``path`` is the file it is from. A
    file that repeats an item gives it again: ``new_items`` drops copies inside a batch.
    """
    schema = StructType([*schemas.RSS_ITEM.fields, StructField(CORRUPT, StringType()), StructField("feed_source_id", IntegerType())])
    reader = spark.readStream.format("xml").schema(schema).option("rowTag", "item").option("columnNameOfCorruptRecord", CORRUPT)
    rows = (reader.option("maxFilesPerTrigger", str(max_files)) if max_files else reader).load(base)
    return _raw_items(rows.withColumn("path", F.col("_metadata.file_path")))


def rss_batch(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The items of a batch of ``stream_rss_items``, each once, and its unreadable records, all of them.

    Both are checkpointed together, so the files are read and copies dropped once for all that uses them.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    broken = F.col(CORRUPT).isNotNull()
    kept = rows.withColumn("_record", F.when(broken, F.monotonically_increasing_id()))
    kept = kept.dropDuplicates(["item_id", "_record"]).checkpoint()
    items = kept.where(~broken).drop(CORRUPT, "path", "_record")
    return items, kept.where(broken).select("feed_source_id", "path", F.col(CORRUPT).alias("record"))


def load_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """Distinct trimmed lines of a word list; a missing file gives no words."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "word string")
    return lines.select(T.trim_space(F.col("value")).alias("word")).where("word <> ''").distinct()


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("page_id", "url", "html")


def scan_table(
    spark: SparkSession, source: str, *, table: str | None = None, partition_column: str | None = None,
    lower: int | None = None, upper: int | None = None, partitions: int = 1,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A Parquet table by path, or a JDBC ``table`` read in parallel ranges of a column."""
    if table is None:
        return spark.read.parquet(source)
    if partition_column is None:
        return spark.read.jdbc(source, table, properties=properties)
    return spark.read.jdbc(
        source, table, column=partition_column, lowerBound=lower, upperBound=upper,
        numPartitions=partitions, properties=properties,
    )


def load_rewrite_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Tab separated pairs of old and new spelling."""
    return spark.read.csv(path, sep="\t", schema="old string, new string")


def load_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Word list from XML ``<w>`` elements; ``kind`` holds the ``msd`` attribute if present."""
    schema = "_VALUE string, _msd string"
    rows = spark.read.format("xml").option("rowTag", "w").schema(schema).load(path)
    return rows.select(T.collapse_space(F.col("_VALUE")).alias("word"), F.col("_msd").alias("kind"))
