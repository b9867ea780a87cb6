"""Operator 11: the prefix trie of conversations, by a van Emde Boas recursion.

Sequences are cut at half depth, again and again, all at once:

1. ``blocks`` names, from the bottom up, the two halves of every aligned block of 2, 4, 8, ... turns of
   a conversation; equal blocks get equal names, and ``halves`` keeps once what each name consists of.
2. From the top down, a piece is a block below a cut prefix: (``root``, ``name``). It is cut into its first half,
   which belongs to the upper trie, and the second, below the prefix ``cut`` that ends at half depth and is
   named there; the second halves below one ``cut`` are a lower forest. Equal pieces are one row with the
   number of their conversations and the smallest of them, so copies fall together at the first step, and all
   upper tries and lower forests of a level are built in one job. Pieces of one turn are the nodes.
3. From the bottom up, the forest below each cut prefix is summed within its block: that of the upper
   half, and what hangs below the prefixes at half depth.
4. From the top down, those totals are grafted: what lies below a prefix at half depth is its own forest
   and what lies below the prefixes at the end of its block, known from the level before.

The number of jobs grows with the logarithm of the longest conversation, and rows with the number of turns:
no level has more pieces than turns. A conversation or a first turn may hold any share of the rows: places
in a conversation come from range partitions and their counts, pieces are counted map-side, and joins have one
side with unique keys. Conversations that end at one node are packed in range order into strings and
hashed as a stream, so they are never held together. Text is read once, for its hash and length.

Turns and pieces are named by MD5 hashes of 128 bits: for n of them the chance that two are confused is
about n²/2¹²⁹.

Edge cases: a null role or text is empty; a null turn comes first; turns of one number are ordered by their
hashes; repeated rows are turns of their own; rows without a conversation id belong to none and give no node;
``%`` is the remainder with the sign of the id, as in SQL; an empty table gives no node, not even the
root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.arrays import text_of, written
from newsloom.session import ship_package

GROUP = 5  # conversations that share the beginning of one
SHARED = 9  # one more than the most turns that are shared
TOTALS = ["leaves", "saved"]


def _name(*parts: Column | str) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv, place (from 1), symbol and bytes of every turn, in the order of the conversation.

    Rows are range partitioned by conversation and turn, so a long conversation has many partitions; a turn's
    place is its place in the partition and the conversation's turns in the partitions before.
    """
    spark, role, text = conversations.sparkSession, text_of("role"), text_of("text")
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"),
        _name(F.octet_length(role).cast("string"), F.lit(":"), role, text).alias("symbol"), F.octet_length(text).cast("long").alias("bytes"),
    )
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("symbol")]
    placed = turns.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = written(placed.drop("turn").withColumn("part", F.shiftright("at", 33)), spark, "turns")
    starts = placed.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("conv", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = (F.col("at") - F.col("first") + F.col("before") + 1).alias("place")
    return written(placed.join(starts, ["conv", "part"]).select("conv", place, "symbol", "bytes"), spark, "numbered")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations (conv, n turns) with the shared beginnings, and their turns (conv, place, symbol, bytes)."""
    spark = turns.sparkSession
    convs = turns.groupBy("conv").agg(F.max("place").alias("n")).withColumns({
        "head": F.crc32(F.col("conv").cast("string")) % SHARED, "base": F.col("conv") - F.col("conv") % GROUP,
    })
    lengths = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    taken = F.least("head", F.coalesce("base_n", F.lit(0)))
    convs = written(convs.join(lengths, "base", "left").select("conv", "base", "head", taken.alias("taken"), "n"), spark, "conversations")
    own = turns.join(convs.select("conv", "head", "taken"), "conv").where("place > head")
    own = own.select("conv", (F.col("place") - F.col("head") + F.col("taken")).alias("place"), "symbol", "bytes")
    heads = turns.where(F.col("place") < SHARED).withColumnRenamed("conv", "base")
    shared = heads.join(convs.select("conv", "base", "taken"), "base").where("place <= taken").select("conv", "place", "symbol", "bytes")
    total = F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0))
    return convs.select("conv", total.alias("n")), written(own.unionByName(shared), spark, "rebuilt")


def blocks(turns: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """For each level above turns, the halves of its names; and conv with the name and number of all its turns."""
    spark = turns.sparkSession
    level = turns.select("conv", (F.col("place") - 1).alias("block"), F.col("symbol").alias("name"), F.lit(1).cast("long").alias("n"))
    side = lambda name, odd: F.max(F.when(F.col("block") % 2 == odd, F.col(name)))
    halves = []
    for _ in range(levels):
        pairs = level.groupBy("conv", F.shiftright("block", 1).alias("pair")).agg(
            side("name", 0).alias("left"), side("name", 1).alias("right"), side("n", 0).alias("left_n"), side("n", 1).alias("right_n"),
        )
        name = _name("left", F.coalesce("right", F.lit(b"")))
        pairs = written(pairs.withColumn("name", name), spark, "blocks")
        halves.append(pairs.select("name", "left", "right", "left_n", "right_n").dropDuplicates(["name"]))
        level = pairs.select("conv", F.col("pair").alias("block"), "name", (F.col("left_n") + F.coalesce("right_n", F.lit(0))).alias("n"))
    return halves, level.select("conv", "name", "n")


def pieces(whole: DataFrame, halves: list[DataFrame]) -> list[DataFrame]:
    """The different pieces of every level, that of single turns first.

    ``start`` is the depth of ``root``. ``end`` names the prefix at the end of a piece that is not cut short,
    as the level names it at which that depth was cut. ``n`` conversations hold the piece, ``conv`` is
    the smallest, and ``whole`` names the sequence that ends with it, at most one.
    """
    spark, root = whole.sparkSession, F.lit(b"")
    full = F.when(F.col("size") == F.lit(1 << len(halves)), _name(root, "name"))
    level = whole.groupBy("name").agg(F.count("*").alias("n"), F.min("conv").alias("conv"), F.max("n").alias("size")).select(
        root.alias("root"), "name", full.alias("end"), F.lit(0).cast("long").alias("start"), "n", "conv", F.col("name").alias("whole"),
    )
    out = [level := written(level, spark, "pieces")]
    for k in range(len(halves) - 1, -1, -1):
        cut = level.join(halves[k], "name").withColumn("cut", F.when(F.col("left_n") == F.lit(1 << k), _name("root", "left")))
        last = F.col("right").isNull()
        upper = F.struct("root", F.col("left").alias("name"), F.col("cut").alias("end"), "start", F.when(last, F.col("whole")).alias("whole"))
        lower = F.struct(
            F.col("cut").alias("root"), F.col("right").alias("name"), F.when(F.col("right_n") == F.lit(1 << k), F.col("end")).alias("end"),
            (F.col("start") + F.lit(1 << k)).alias("start"), "whole",
        )
        both = cut.select("n", "conv", F.explode(F.filter(F.array(upper, F.when(~last, lower)), lambda p: p.isNotNull())).alias("p"))
        level = both.select("p.*", "n", "conv").groupBy("root", "name").agg(
            F.max("end").alias("end"), F.max("start").alias("start"), F.sum("n").alias("n"), F.min("conv").alias("conv"), F.max("whole").alias("whole"),
        )
        out.append(level := written(level, spark, "pieces"))
    return out[::-1]


def _totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("root").agg(F.max("start").alias("start"), *[F.sum(c).alias(c) for c in TOTALS])


def _hung(level: DataFrame, totals: DataFrame) -> DataFrame:
    """The totals below the ends of pieces, as those of the pieces' roots."""
    ends = totals.select(F.col("root").alias("end"), *TOTALS)
    return level.where("end is not null").select("root", "end", "start").join(ends, "end").select("root", "start", *TOTALS)


def _cut(k: int) -> Column:
    """Whether a depth is that of a cut at level k, where no block of the level above begins."""
    return F.col("start") % F.lit(2 << k) != 0


def forests(nodes: DataFrame, levels: list[DataFrame]) -> list[DataFrame]:
    """Totals of what lies below each prefix (``root``) within its block of a level, single turns first."""
    spark = nodes.sparkSession
    out = [written(_totals(nodes.select("root", (F.col("depth") - 1).alias("start"), *TOTALS)), spark, "forests")]
    for k, level in enumerate(levels[:-1]):
        lower = _hung(level.where(~_cut(k)), out[k])
        out.append(written(_totals(out[k].where(~_cut(k)).unionByName(lower)), spark, "forests"))
    return out


def grafted(levels: list[DataFrame], within: list[DataFrame]) -> DataFrame:
    """Totals of all that lies below each prefix (``root``), from those within its block."""
    below = within[-1]  # the block of the top level is the whole trie
    for k in range(len(levels) - 2, -1, -1):
        found = _totals(within[k].where(_cut(k)).unionByName(_hung(levels[k].where(_cut(k)), below)))
        below = written(below.unionByName(found), below.sparkSession, "grafted")
    return below


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The decimal ids of each run of rows with one name as a string; a batch bounds its length."""
    for batch in batches:
        convs = np.asarray(batch.column("conv"))
        names = batch.column("whole").to_pylist()
        cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)] if names else [0]
        spans = list(zip(cuts, cuts[1:]))
        yield pa.RecordBatch.from_pydict({
            "whole": pa.array([names[i] for i, _ in spans], pa.binary()), "first": pa.array([int(convs[i]) for i, _ in spans], pa.int64()),
            "ids": pa.array([",".join(map(str, convs[i:j].tolist())) for i, j in spans], pa.string()),
        })


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each name, over rows in order of name and first id."""
    rows = lambda done: pa.RecordBatch.from_pydict({
        "whole": pa.array([n for n, _ in done], pa.binary()), "ends_sha256": pa.array([s.hexdigest() for _, s in done], pa.string()),
    })
    name, sha = None, None
    for batch in batches:
        done = []
        for whole, ids in zip(batch.column("whole").to_pylist(), batch.column("ids").to_pylist()):
            if sha is not None and whole == name:
                sha.update(b"," + ids.encode())
                continue
            if sha is not None:
                done.append((name, sha))
            name, sha = whole, hashlib.sha256(ids.encode())
        yield rows(done)
    if sha is not None:
        yield rows([(name, sha)])


def ends_of(members: DataFrame) -> DataFrame:
    """whole and ends_sha256, from conv and whole: the ids of one name in order, joined by commas."""
    ship_package(members.sparkSession)
    ordered = members.select("whole", "conv").repartitionByRange("whole", "conv").sortWithinPartitions("whole", "conv")
    packed = ordered.mapInArrow(_pack, "whole binary, first long, ids string")
    packed = packed.repartition("whole").sortWithinPartitions("whole", "first")
    return packed.mapInArrow(_digest, "whole binary, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, and ``node`` and ``parent``, their names."""
    spark = conversations.sparkSession
    convs, turns = rebuilt(numbered_turns(conversations))
    longest = turns.agg(F.max("place")).first()[0] or 0
    halves, named = blocks(turns, max(longest - 1, 0).bit_length())
    levels = pieces(named, halves)
    sizes = turns.groupBy(F.col("symbol").alias("name")).agg(F.max("bytes").alias("bytes"))
    children = levels[0].groupBy("root").agg(F.count("*").alias("n_children"))
    nodes = levels[0].join(sizes, "name").join(children.withColumnRenamed("root", "end"), "end", "left").select(
        "root", F.col("end").alias("node"), (F.col("start") + 1).alias("depth"), "n", "conv", "whole",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), ((F.col("n") - 1) * F.col("bytes")).alias("saved"),
    )
    nodes = written(nodes.withColumn("leaves", (F.col("n_children") == 0).cast("long")), spark, "nodes")
    below = grafted(levels, forests(nodes, levels))
    # every conversation is a member of the root; those without turns end there
    root, nothing = F.lit(b""), hashlib.sha256(b"").hexdigest()
    first = F.coalesce(nodes.where("depth = 1").agg(F.count("*")).scalar(), F.lit(0)).cast("long")
    top = convs.agg(F.count("*").alias("n"), F.min("conv").alias("conv")).where("n > 0").select(
        F.lit(None).cast("binary").alias("root"), root.alias("node"), F.lit(0).cast("long").alias("depth"), "n", "conv",
        root.alias("whole"), first.alias("n_children"), F.lit(0).cast("long").alias("saved"),
    ).withColumn("leaves", (F.col("n_children") == 0).cast("long"))
    every = nodes.unionByName(top)
    parents = every.select(F.col("node").alias("root"), F.col("conv").alias("parent_conv_id"))
    silent = convs.where("n = 0").select("conv", root.alias("whole"))
    ends = ends_of(named.select("conv", F.col("name").alias("whole")).unionByName(silent))
    # nodes where none ends stay out of the join: their nulls would meet in one task
    ending = every.where("whole is not null").join(ends, "whole", "left")
    every = ending.unionByName(every.where("whole is null").withColumn("ends_sha256", F.lit(None).cast("string")))
    totals = below.select(F.col("root").alias("node"), *(F.col(c).alias(f"below_{c}") for c in TOTALS))
    found = every.join(totals, "node", "left").join(parents, "root", "left")
    return found.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
        (F.col("leaves") + F.coalesce("below_leaves", F.lit(0))).alias("n_leaves"),
        (F.col("saved") + F.coalesce("below_saved", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"), "node", F.col("root").alias("parent"),
    )


def trie_report(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie without their names."""
    return trie(conversations).drop("node", "parent")
