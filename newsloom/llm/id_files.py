"""Operator 2: token ids in files of transposed and compressed blocks.

A file row is one chunk: the ids of whole documents, cut into blocks of ``BLOCK_IDS``.
Each block of 32-bit ids is turned into planes, either four byte planes or 32 bit planes,
so that the bytes of one significance lie together, and every plane is compressed with
zstandard. The chunk index beside the payload holds the documents (id, number of ids) and
the compressed size of every plane, so a reader finds any block without the others.
The chunks are the rows of Parquet files: Spark's commit protocol then holds for them,
a repeated task leaves no second copy, and they lie in any store that Spark writes.

Documents are in ascending ``doc_id`` order over all files (nulls first, equal ids by a hash
of the text). Edge cases: a null or empty text has only the end id; repeated rows
are written as often as they come; an empty table gives an empty set of files; other
columns are not read. A chunk holds about ``CHUNK_IDS`` ids, more only where one document does.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from array import array

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.llm.arrays import map_batches, text_of
from newsloom.llm.bpe import PieceCache, gathered, pieces_of, read_vocabulary

BLOCK_IDS = 1 << 16
CHUNK_IDS = 1 << 20
SORT_BYTES = 32 << 20

_workers: dict[str, PieceCache] = {}


def library_cache(data: bytes) -> PieceCache:
    """The tokenizers library's encoder in this worker process; ids as 32-bit little-endian bytes."""
    key = hashlib.md5(data).hexdigest()
    if key not in _workers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_str(data.decode())
        encoder.no_truncation()
        encoder.no_padding()

        def encode(pieces: list[str]) -> list[bytes]:
            found = encoder.encode_batch_fast(pieces, add_special_tokens=False)
            return [array("I", x.ids).tobytes() for x in found]

        _workers[key] = PieceCache(encode, 500_000)
    return _workers[key]


def to_planes(ids: np.ndarray, planes: str = "byte") -> np.ndarray:
    """The planes of a block, one row each: bytes of one place, or packed bits of one place."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        return np.ascontiguousarray(raw.T)
    return np.packbits(np.unpackbits(raw, axis=1, bitorder="little").T, axis=1)


def from_planes(rows: np.ndarray, count: int, planes: str = "byte") -> np.ndarray:
    if planes == "byte":
        return np.ascontiguousarray(rows.T).view("<u4").reshape(-1)
    bits = np.unpackbits(rows, axis=1, count=count)
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u4").reshape(-1)


def pack(ids: np.ndarray, planes: str = "byte", block: int = BLOCK_IDS) -> tuple[bytes, list[int]]:
    """Compressed planes of all blocks, and the size of each."""
    coder = zstandard.ZstdCompressor(level=3)
    parts = [coder.compress(p.tobytes()) for i in range(0, len(ids), block) for p in to_planes(ids[i : i + block], planes)]
    return b"".join(parts), [len(p) for p in parts]


def unpack(payload: bytes, sizes: list[int], count: int, planes: str = "byte", block: int = BLOCK_IDS) -> np.ndarray:
    coder, view = zstandard.ZstdDecompressor(), memoryview(payload)
    at, each, out = 0, 4 if planes == "byte" else 32, []
    for b in range(0, count, block):
        n, rows = min(block, count - b), []
        for size in sizes[b // block * each : (b // block + 1) * each]:
            rows.append(np.frombuffer(coder.decompress(view[at : at + size]), np.uint8))
            at += size
        out.append(from_planes(np.stack(rows), n, planes))
    return np.concatenate(out) if out else np.zeros(0, "<u4")


FILE_COLUMNS = "part int, first_doc long, doc_ids array<long>, n_tokens array<long>, n_ids long, plane_sizes array<int>, payload binary"


def write_ids(
    docs: DataFrame, path: str, folder: str, end_id: int = 1, planes: str = "byte", partitions: int | None = None,
) -> None:
    """Encode every document, append ``end_id`` and write the chunks to ``folder``.

    Documents are dealt by ranges of their id before they are encoded: the text that
    moves is smaller than the ids would be.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    end = np.array([end_id], "<u4").tobytes()

    def work(batch: pa.RecordBatch) -> dict:
        pieces, which, rows = pieces_of(batch.column("text"))
        found = library_cache(vocabulary.value).get(pieces)
        data, at = gathered([*found, end], *_with_end(which, rows, len(found)))
        ids, at = np.frombuffer(data, "<u4"), at // 4
        doc_ids = batch.column("doc_id")
        group = at[:-1] // CHUNK_IDS
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        out: dict[str, list] = {k: [] for k in ("part", "first_doc", "doc_ids", "n_tokens", "n_ids", "plane_sizes", "payload")}
        for a, b in zip(cuts, cuts[1:]):
            payload, sizes = pack(ids[at[a] : at[b]], planes)
            numbers = doc_ids.slice(a, b - a).to_pylist()
            for k, v in zip(out, (batch.column("part")[a].as_py(), numbers[0], numbers, np.diff(at[a : b + 1]).tolist(), int(at[b] - at[a]), sizes, payload)):
                out[k].append(v)
        return out

    keys = (F.col("doc_id"), F.xxhash64("text"))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    dealt = narrow.repartitionByRange(partitions, *keys) if partitions else narrow.repartitionByRange(*keys)
    ordered = dealt.sortWithinPartitions(*keys).select("*", F.spark_partition_id().alias("part"))
    chunks = map_batches(ordered, work, FILE_COLUMNS)
    chunks.write.options(compression="none", maxRecordsPerFile=0).parquet(folder)


def _with_end(which: np.ndarray, rows: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The occurrences with the end piece after each row."""
    n = len(rows) - 1
    return np.insert(which.astype(np.int64), rows[1:], end), rows + np.arange(n + 1)


def read_ids(spark: SparkSession, folder: str, planes: str = "byte") -> DataFrame:
    """Chunks decoded: part, first_doc, doc_ids, n_tokens and ids, a row each chunk."""

    def work(batch: pa.RecordBatch) -> dict:
        rows = batch.to_pylist()
        return {k: batch.column(k) for k in ("part", "first_doc", "doc_ids", "n_tokens")} | {
            "ids": [unpack(r["payload"], r["plane_sizes"], r["n_ids"], planes) for r in rows]}

    return map_batches(_files(spark, folder), work, "part int, first_doc long, doc_ids array<long>, n_tokens array<long>, ids array<long>")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """The schema is given, so that an empty set of files reads too."""
    return spark.read.schema(FILE_COLUMNS).parquet(folder)


def read_documents(spark: SparkSession, folder: str, planes: str = "byte") -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` adds the ids of earlier documents of the chunk, of earlier chunks of the
    part, and of earlier parts; only the totals of the parts, one row each, meet in one task.
    """

    def work(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("part", "chunk", "doc_id", "before", "n_tokens", "ids_crc32")}
        for r in batch.to_pylist():
            ids = unpack(r["payload"], r["plane_sizes"], r["n_ids"], planes)
            ends = np.cumsum(r["n_tokens"])
            for doc_id, n, e in zip(r["doc_ids"], r["n_tokens"], ends.tolist()):
                out["doc_id"].append(doc_id)
                out["before"].append(e - n)
                out["n_tokens"].append(n)
                out["ids_crc32"].append(zlib.crc32(ids[e - n : e]))
            out["part"] += [r["part"]] * len(ends)
            out["chunk"] += [r["chunk"]] * len(ends)
        return out

    files = _files(spark, folder).withColumn("chunk", F.col("_metadata.row_index"))
    rows = map_batches(files, work, "part int, chunk long, doc_id long, before long, n_tokens long, ids_crc32 long")
    index = _files(spark, folder).select("part", F.col("_metadata.row_index").alias("chunk"), "n_ids")
    parts = index.groupBy("part").agg(F.sum("n_ids").alias("in_part"))
    earlier = F.coalesce(F.sum("in_part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", earlier.alias("part_start"))
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("chunk")) - F.col("n_ids")
    places = index.select("part", "chunk", within.alias("chunk_start")).join(parts, "part")
    start = F.col("part_start") + F.col("chunk_start") + F.col("before")
    return rows.join(places, ["part", "chunk"]).select("doc_id", start.cast("long").alias("start"), "n_tokens", "ids_crc32")
