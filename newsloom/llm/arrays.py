"""Vector helpers for the Arrow batches of the tasks, and the written tables between jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StructField, StructType

from newsloom.session import ship_package, work_folder

SLICE_BYTES = 1 << 20


def written(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """The rows as a table in the shared folder, so that later jobs do not compute them again."""
    folder = work_folder(spark, name)
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows at most while jobs run, for rows that hold long texts.

    Spark counts the rows of a batch, not its bytes, and holds a batch in the JVM and in the Python worker at once.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_of(name: str = "text") -> Column:
    """The text as a string, null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def schema_of(columns: str, **more: DataType) -> StructType:
    """Columns of given types, whatever the names inside them, then those of a schema text."""
    return StructType([*(StructField(n, t) for n, t in more.items()), *StructType.fromDDL(columns).fields])


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], dict | None], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` of a function from a batch to columns by name; large batches come in slices."""
    ship_package(df.sparkSession)
    schema = schema_of(schema) if isinstance(schema, str) else schema
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch):
                columns = work(part)
                if columns is not None:
                    yield pa.RecordBatch.from_arrays(
                        [_as(columns[f.name], f.type) for f in target], schema=target,
                    )

    return df.mapInArrow(run, schema)


def _as(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


BYTES = (pa.types.is_string, pa.types.is_binary, pa.types.is_large_string, pa.types.is_large_binary)


def byte_slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of about ``limit`` bytes; a longer row is alone."""
    if batch.nbytes <= limit:
        if batch.num_rows:
            yield batch
        return
    sizes = np.ones(batch.num_rows, np.int64)
    for column in batch.columns:
        if any(test(column.type) for test in BYTES):
            sizes += np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64)
        elif pa.types.is_list(column.type):
            sizes += 16 * np.asarray(pc.fill_null(pc.list_value_length(column), 0), np.int64)
    group = (np.cumsum(sizes) - sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        yield batch.slice(start, end - start)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows together and the n + 1 places where rows begin; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def binary(data: bytes | np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Rows of bytes cut from one buffer."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)],
    )


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each row's values; empty rows have 0."""
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def mix(x: np.ndarray) -> np.ndarray:
    """Finishes a 64-bit hash (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = 0x2545F4914F6CDD1D
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n."""
    known = _powers.get(base)
    if known is None or len(known[0]) < n:
        size = max(n, 1 << 16)
        inverse = pow(base, -1, 1 << 64)
        made = []
        for b in (base, inverse):
            out = np.full(size, b, np.uint64)
            out[0] = 1
            made.append(np.multiply.accumulate(out))
        known = (made[0], made[1])
        if size <= 2 * SLICE_BYTES:
            _powers[base] = known
    return known[0][:n], known[1][:n]


class Rolling:
    """Hashes of any substrings of one sequence of 64-bit codes."""

    def __init__(self, codes: np.ndarray, base: int = BASE):
        power, self.back = powers(len(codes) + 1, base)
        self.total = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * power[:-1], out=self.total[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.back[start] + (end - start).astype(np.uint64))

    def grams(self, size: int) -> np.ndarray:
        """Hashes of all substrings of one length, not finished by ``mix``."""
        count = max(0, len(self.total) - size)
        return (self.total[size:] - self.total[:count]) * self.back[:count]


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[48:58] = WORD_BYTES[97:123] = WORD_BYTES[128:] = True


class Words:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of texts with A-Z lowered: digits, a-z, all beyond ASCII."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        low = LOWER[data]
        inside = np.zeros(len(low) + 2, bool)
        inside[1:-1] = WORD_BYTES[low]
        begins, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        rows = offsets[:-1][np.diff(offsets) > 0]
        joined = rows[inside[rows] & inside[rows + 1]] if len(rows) else rows
        begins[joined] = True
        ends[joined - 1] = True
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.data = low
        self.hashes = Rolling(BYTE_CODES[low]).hash(self.starts, self.ends)
        self.rows = np.searchsorted(self.starts, offsets)

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each run of ``size`` words inside one row."""
        if len(self.hashes) < size:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        grams = mix(Rolling(self.hashes, 0x9E3779B97F4A7C15 | 1).grams(size))
        inside = np.zeros(len(self.hashes) + 1, np.int64)
        counts = np.maximum(np.diff(self.rows) - size + 1, 0)
        first = ranges(self.rows[:-1], counts)
        del inside
        return first, grams[first]
