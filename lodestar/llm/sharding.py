"""Consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of a ring; a row goes to the first point
clockwise of its key's hash.  No shard takes more than its share: the rows of an
arc beyond what its shard has room for continue clockwise to the next point
whose shard has room.  With ``slack = 0`` every shard takes exactly its quota
(counts differ by one at most); with more slack fewer rows leave their arc.

Everything is DataFrame operations.  Rows are counted per arc and per cell (a
finer hash), arcs (``shards * vnodes`` counts, a bound set by the parameters)
are filled on the driver, and every row finds its shard and slot from its rank
within its arc.  The rank comes from ``CELLS`` separately sorted cells per arc,
so a key that holds a third of all rows is ranked by many tasks.

Defined cases: a null text has no bytes; a null ``doc_id`` is a key like any
other; repeated rows are separate rows of one key; an empty table gives an
empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import json
from hashlib import blake2b

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import checkpointed

CELLS = 256
SLICES = 4096
_RING = 1 << 62  # 4096 slices of 2^50 places


def ring_points(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(place on the ring, shard) of every virtual node, clockwise.  A shard's
    points depend on its number alone, so more shards leave them where they are."""
    def place(shard, v):
        return int.from_bytes(blake2b(f"{shard}/{v}".encode(), digest_size=8).digest(), "big") % _RING

    return sorted((place(s, v), s) for s in range(shards) for v in range(vnodes))


def quotas(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Most rows of each shard: its exact part, or ``1 + slack`` times the mean."""
    if slack > 0:
        return [int(-(-rows * (1 + slack) // shards))] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def fill(points: list[tuple[int, int]], counts: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot) of every run of rows.

    ``counts[a]`` rows lie on arc a.  Each shard first takes the rows of its own
    arcs, then what overflows continues clockwise.
    """
    left, used, runs, over = list(room), [0] * len(room), [], []

    def take(arc, first, n, shard):
        runs.append((arc, first, first + n, shard, used[shard]))
        used[shard] += n
        left[shard] -= n

    for arc, (_, shard) in enumerate(points):
        n = min(counts[arc], left[shard])
        if n:
            take(arc, 0, n, shard)
        if n < counts[arc]:
            over.append((arc, n))
    for arc, first in over:
        at = arc
        while first < counts[arc]:
            at = (at + 1) % len(points)
            shard = points[at][1]
            n = min(counts[arc] - first, left[shard])
            if n:
                take(arc, first, n, shard)
                first += n
    return runs


def small_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A few rows known to the driver as a DataFrame, without Python workers."""
    names = [f.split()[0] for f in ddl.split(", ")]
    text = json.dumps([dict(zip(names, r, strict=True)) for r in rows])
    kind = ", ".join(f.replace(" ", ": ") for f in ddl.split(", "))
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{kind}>>")))


def arc_ranges(points: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """(slice, after, upto, arc): the part of every arc inside each of the
    ``SLICES`` equal slices of the ring, so that rows find their arc by an equi-join."""
    width, rows = _RING // SLICES, []
    ends = [-1, *(p for p, _ in points), _RING - 1]
    for i, (after, upto) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
        for s in range((after + 1) // width, upto // width + 1) if upto > after else ():
            rows.append((s, max(after, s * width - 1), min(upto, (s + 1) * width - 1), i % len(points)))
    return rows


def ring_shards(docs: DataFrame, shards: int, vnodes: int = 16, slack: float = 0.0) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row of ``docs``."""
    spark = docs.sparkSession
    points = ring_points(shards, vnodes)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    columns = ["doc_id", "size", "text_crc32"]
    # both small tables are bounded by the parameters (points and slices of the ring)
    arcs = F.broadcast(small_table(spark, arc_ranges(points), "slice int, after long, upto long, arc int"))
    rows = checkpointed(docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.pmod(F.xxhash64(F.lit("ring"), "doc_id"), F.lit(_RING)).alias("place"),
        F.pmod(F.xxhash64(F.lit("cell"), F.monotonically_increasing_id()), F.lit(CELLS)).cast("int").alias("cell"))
        .withColumn("slice", F.shiftright("place", 50).cast("int")).join(arcs, "slice")
        .where("place > after and place <= upto").select(*columns, "place", "arc", "cell"))
    cells = checkpointed(rows.groupBy("arc", "cell").agg(F.count(F.lit(1)).alias("n")))
    counts = [0] * len(points)
    for arc, n in cells.groupBy("arc").agg(F.sum("n")).collect():
        counts[arc] = n
    runs = F.broadcast(small_table(spark, fill(points, counts, quotas(sum(counts), shards, slack)),
                                   "arc int, first long, end long, shard int, base long"))
    earlier = cells.select("arc", "cell", (F.sum("n").over(Window.partitionBy("arc").orderBy("cell")) - F.col("n")).alias("earlier"))
    in_cell = F.row_number().over(Window.partitionBy("arc", "cell").orderBy("place", *columns)) - 1
    return rows.withColumn("in_cell", in_cell).join(earlier, ["arc", "cell"]).withColumn(
        "rank", F.col("earlier") + F.col("in_cell")).join(runs, "arc").where("rank >= first and rank < end").select(
        *columns, "shard", (F.col("base") + F.col("rank") - F.col("first")).alias("slot"))
