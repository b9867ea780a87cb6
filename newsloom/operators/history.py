"""The index of stored keys: hash buckets of digests, and a Bloom filter for each bucket.

A key is kept as its MD5 digest in the bucket that its hash names; a bucket is a partition folder. The filter of a
bucket is ``SLICES`` bitmaps of Spark's bitmap functions; a key sets ``BITS`` bits of one of them. A batch first
asks the filters. Only the buckets that hold a key which passed are read, and there the digests
decide, so a bit that is set by chance costs a read and never an article. Two keys are confused where their
128-bit digests are equal.

For n stored keys take so many buckets that one is about 100 MB of digests (5 million keys), and slices so
that a bitmap holds about 4,000 keys: then a key that is not stored passes in 2 of 100 cases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

from newsloom.sources.parts import Parts, Table, Version

BUCKETS, SLICES = 16, 32
BITS = 4
MAP_BITS = 32768  # bits of one bitmap of Spark's bitmap functions
KEYS = StructType([StructField("digest", BinaryType()), StructField("bucket", IntegerType())])
FILTERS = StructType([StructField("bucket", IntegerType()), StructField("slice", IntegerType()), StructField("bits", BinaryType())])


def digest(kind: str, *values: Column) -> Column:
    """Digest of a key of some kind; null if a value is null."""
    sized = [F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")) for v in values]
    return F.unhex(F.md5(F.concat(F.lit(f"{kind}:"), *sized)))


def merge_filters(rows: DataFrame) -> DataFrame:
    return rows.groupBy("bucket", "slice").agg(F.bitmap_or_agg("bits").alias("bits"))


TABLES = {"keys": Table(KEYS, ("bucket",)), "filters": Table(FILTERS, merge=merge_filters)}


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int")


def _places(slices: int) -> list[Column]:
    """The slice of a digest and the bits it sets there."""
    spread = lambda seed: F.xxhash64("digest", F.lit(seed))
    bits = [F.pmod(F.shiftright(spread(2), 16 * i), F.lit(MAP_BITS)).cast("int") for i in range(BITS)]
    return [F.pmod(spread(1), F.lit(slices)).cast("int").alias("slice"), F.array(*bits).alias("places")]


def index_tables(digests: DataFrame, buckets: int = BUCKETS, slices: int = SLICES) -> dict[str, DataFrame]:
    """The rows of ``keys`` and ``filters`` for a column ``digest``."""
    keys = digests.where("digest is not null").select("digest", _bucket(buckets).alias("bucket")).distinct()
    bits = keys.select("bucket", *_places(slices)).select("bucket", "slice", F.explode("places").alias("place"))
    # the functions count bits from 1 and hold 32768 of them
    filters = bits.groupBy("bucket", "slice").agg(F.bitmap_construct_agg(F.col("place").cast("long")).alias("bits"))
    return {"keys": keys, "filters": filters}


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return F.pmod(F.floor(byte / F.pow(F.lit(2), place % 8)), F.lit(2)) == 1


def candidates(digests: DataFrame, filters: DataFrame, buckets: int = BUCKETS, slices: int = SLICES) -> DataFrame:
    """digest and bucket of the keys that the filters let pass; each key once."""
    keys = digests.where("digest is not null").select("digest").distinct()
    placed = keys.select("digest", _bucket(buckets).alias("bucket"), *_places(slices))
    met = placed.join(merge_filters(filters), ["bucket", "slice"])
    return met.where(F.forall("places", lambda place: _is_set(F.col("bits"), place))).select("digest", "bucket")


def known_digests(
    digests: DataFrame, store: Parts, version: Version | None = None, buckets: int = BUCKETS, slices: int = SLICES,
) -> DataFrame:
    """Those of the digests that are stored. Of the stored keys only buckets with candidates are read.

    The numbers of those buckets come to the driver; there are ``buckets`` at most.
    """
    version = version or store.version()
    maybe = candidates(digests, store.read("filters", version), buckets, slices).checkpoint()
    wanted = [r.bucket for r in maybe.select("bucket").distinct().collect()]
    if not wanted:
        return maybe.select("digest")
    stored = store.read("keys", version).where(F.col("bucket").isin(wanted))
    return maybe.join(stored.select("bucket", "digest"), ["bucket", "digest"], "left_semi").select("digest")
