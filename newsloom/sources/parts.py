"""Tables that grow by one small part a batch: a manifest makes parts visible, merges keep them few.

A part is a folder of Parquet files. All parts of a batch are written first and then named together by a new
version of the manifest, one small file, which readers take their folders from. A batch that dies before has
left nothing that a reader sees, and one that was committed is not run again. Batches are told apart by the
run they belong to (see ``run_name``) and their number in it, so a stream that starts again without its
checkpoint replaces nothing.

Where a table has ``fan`` parts of one level, they are merged into one of the next level, after the batch and
with a manifest of its own. So a table of n batches has about ``fan * log(n)`` parts. Replaced parts are deleted
two versions later, so readers of the version before still find them. There is one writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from newsloom.sources.writers import table_of_none, table_or_empty

FAN = 8
KEPT_VERSIONS = 2
MANIFEST = "kind string, name string, level int, path string, last long, since long"


@dataclass(frozen=True)
class Table:
    """``merge`` sums up the rows of several parts, by default it keeps them all; of a ``replaced`` table only
    the last part counts."""

    schema: StructType
    partition_by: tuple[str, ...] = ()
    merge: Callable[[DataFrame], DataFrame] | None = None
    replaced: bool = False


@dataclass(frozen=True)
class Part:
    table: str
    path: str
    level: int = 0


@dataclass(frozen=True)
class Version:
    number: int
    parts: tuple[Part, ...]
    runs: dict[str, int]  # the last batch of each run
    last: int  # a number that goes on from batch to batch
    gone: tuple[tuple[str, int], ...]  # replaced folders, and since when


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark knows; a missing one is fine."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def run_name(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a stream's checkpoint: the same after a restart, another without the checkpoint."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first().id


class Parts:
    def __init__(self, spark: SparkSession, base: str, tables: dict[str, Table], fan: int = FAN):
        self.spark, self.base, self.tables, self.fan = spark, base.rstrip("/"), tables, fan

    def version(self) -> Version:
        """What the newest manifest says. Only the last few are kept, and each has few rows."""
        schema = StructType.fromDDL(f"{MANIFEST}, version long")
        rows = table_or_empty(self.spark, f"{self.base}/manifest", schema).collect()
        number = max((r.version for r in rows), default=0)
        rows = [r for r in rows if r.version == number]
        return Version(
            number, tuple(Part(r.name, r.path, r.level) for r in rows if r.kind == "part"),
            {r.name: r.last for r in rows if r.kind == "run"}, max((r.last for r in rows if r.kind == "last"), default=0),
            tuple((r.path, r.since) for r in rows if r.kind == "gone"),
        )

    def read(self, table: str, version: Version | None = None) -> DataFrame:
        """The committed rows of a table."""
        return self._rows(table, [p for p in (version or self.version()).parts if p.table == table])

    def _rows(self, table: str, parts: list[Part]) -> DataFrame:
        schema = self.tables[table].schema
        if not parts:
            return table_of_none(self.spark, schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.base}/{table}")
        return reader.parquet(*[p.path for p in parts]).select(*schema.names)

    def done(self, run: str, batch: int, version: Version | None = None) -> bool:
        return (version or self.version()).runs.get(run, -1) >= batch

    def write(self, table: str, rows: DataFrame, name: str, level: int = 0) -> Part:
        """Write a part, which no reader sees before ``publish`` names it."""
        known, path = self.tables[table], f"{self.base}/{table}/part={name}"
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in known.schema])
        writer = rows.hint("rebalance", *known.partition_by).write.mode("overwrite")
        (writer.partitionBy(*known.partition_by) if known.partition_by else writer).parquet(path)
        return Part(table, path, level)

    def publish(self, run: str, batch: int, parts: list[Part], last: int | None = None) -> None:
        """Make the parts of a batch visible, all at once, then merge what has become many."""
        old = self.version()
        fresh = {p.table for p in parts if self.tables[p.table].replaced}
        kept = tuple(p for p in old.parts if p.table not in fresh)
        gone = tuple((p.path, old.number + 1) for p in old.parts if p.table in fresh)
        self._store(Version(
            old.number + 1, kept + tuple(parts), {**old.runs, run: batch}, old.last if last is None else last, old.gone + gone,
        ))
        self._merge()

    def _store(self, new: Version) -> None:
        old = new.number - KEPT_VERSIONS
        expired = [path for path, since in new.gone if since <= old]
        rows = [("part", p.table, p.level, p.path, None, None) for p in new.parts]
        rows += [("run", name, None, None, batch, None) for name, batch in new.runs.items()] + [("last", None, None, None, new.last, None)]
        rows += [("gone", None, None, path, None, since) for path, since in new.gone if path not in expired]
        frame = self.spark.createDataFrame(rows, MANIFEST).coalesce(1)
        frame.write.mode("overwrite").parquet(f"{self.base}/manifest/version={new.number}")
        for path in [*expired, f"{self.base}/manifest/version={old - 1}"]:
            remove(self.spark, path)

    def _merge(self) -> None:
        while due := self._due(now := self.version()):
            table, level = due[0].table, due[0].level
            rows = self._rows(table, due)
            merge = self.tables[table].merge
            part = self.write(table, merge(rows) if merge else rows, f"merged-{now.number + 1}", level + 1)
            gone = tuple((p.path, now.number + 1) for p in due)
            kept = tuple(p for p in now.parts if p not in due)
            self._store(Version(now.number + 1, (*kept, part), now.runs, now.last, now.gone + gone))

    def _due(self, version: Version) -> list[Part]:
        groups: dict[tuple[str, int], list[Part]] = {}
        for part in version.parts:
            groups.setdefault((part.table, part.level), []).append(part)
        return next((parts for parts in groups.values() if len(parts) >= self.fan), [])
