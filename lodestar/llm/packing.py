"""Best-fit packing by patterns.

Every text becomes pieces of at most ``capacity`` tokens.  Piece lengths are
counted in classes of ``grain`` tokens; all patterns of at most ``most`` classes
that fill a sequence are enumerated, non-negative least squares says how often
to use each so that they use up the histogram, the counts are rounded down to
what is there, and the pieces that remain are packed best-fit, longest first,
in groups of bounded size.

Only the histogram (at most ``capacity / grain`` rows) reaches the driver.  A
piece finds its place by its rank in its length class; ranks are counted in
``CELLS`` parts per class, so a class that holds most pieces is spread over as
many tasks.

Defined cases: a null or empty text is the single end token; a null ``doc_id``
is packed like any other; repeated rows are packed each on its own; an empty
table gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import checkpointed
from . import kernel as K
from .tokenize import chunks

CELLS = 256
GROUP = 50_000  # remaining pieces packed by one task


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) for every row of ``docs``."""
    width = 4 * capacity
    end = end_id.to_bytes(4, "little")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        ids_of = chunks(vocabulary).ids
        for b in batches:
            row, piece, length, crc = [], [], [], []
            for a, _, offs, data in K.text_slices(b.column(1)):
                whole = data.tobytes()
                for i, (s, e) in enumerate(zip(offs[:-1], offs[1:], strict=True), a):
                    ids = ids_of(whole[s:e]) + end
                    for p in range(0, len(ids), width):
                        part = ids[p:p + width]
                        row.append(i)
                        piece.append(p // width)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
            piece = np.array(piece, np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece), pa.array(piece.astype(np.int64) * capacity),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(
        K.tidy(run), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def patterns(classes: int, most: int) -> np.ndarray:
    """All multisets of at most ``most`` classes (1 to ``classes``) that sum to
    ``classes``, as rows of class numbers padded with 0."""
    def parts(total, count, least):
        if count == 1:
            yield (total,)
            return
        for first in range(least, total // count + 1):
            for rest in parts(total - first, count - 1, first):
                yield (first, *rest)

    rows = [p + (0,) * (most - n) for n in range(1, most + 1) for p in parts(classes, n, 1)]
    return np.array(rows, np.int64)


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """x >= 0 with least |a x - b|, by the active-set method: the column that
    lessens the residual most enters, columns that turn negative leave."""
    m, n = a.shape
    x, active = np.zeros(n), []
    scale = max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(rounds or 3 * m):
        gain = a.T @ (b - a @ x)
        gain[active] = -np.inf
        j = int(np.argmax(gain))
        if gain[j] <= 1e-9 * scale:
            break
        active.append(j)
        while active:
            cols = a[:, active]
            z = np.linalg.solve(cols.T @ cols + 1e-10 * np.eye(len(active)), cols.T @ b)
            if z.min() > 0:
                x[:] = 0
                x[active] = z
                break
            old = x[active]
            out = z <= 0
            step = float((old[out] / np.maximum(old[out] - z[out], 1e-300)).min())
            moved = old + step * (z - old)
            x[:] = 0
            x[active] = np.maximum(moved, 0)
            active = [c for c, v in zip(active, moved, strict=True) if v > 1e-9 * scale]
    return x


def pattern_counts(histogram: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(patterns in use, how often each) for the number of pieces in each class
    (``histogram[c - 1]``): fitted, rounded down, never more than there are."""
    classes = len(histogram)
    rows = patterns(classes, most)
    a = np.zeros((classes, len(rows)))
    for col in range(rows.shape[1]):
        has = rows[:, col] > 0
        np.add.at(a, (rows[has, col] - 1, np.flatnonzero(has)), 1)
    x = nonnegative_least_squares(a, histogram.astype(float))
    left, used, times = histogram.astype(np.int64), [], []
    for p in np.argsort(-x, kind="stable"):
        if x[p] < 0.5:
            break
        need = a[:, p].astype(np.int64)
        n = min(int(round(x[p])), int((left[need > 0] // need[need > 0]).min()))
        if n > 0:
            left = left - n * need
            used.append(rows[p])
            times.append(n)
    return np.array(used, np.int64).reshape(-1, most), np.array(times, np.int64)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each length, longest first into the fullest sequence with room."""
    order = np.argsort(-lengths, kind="stable")
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # sequences by free tokens
    sizes: list[int] = []  # free-token values in use, sorted
    opened = 0
    for i in order:
        n = int(lengths[i])
        at = bisect_left(sizes, n)
        if at < len(sizes):
            free = sizes[at]
            s = room[free].pop()
            if not room[free]:
                sizes.pop(at)
        else:
            s, free, opened = opened, capacity, opened + 1
        sequence[i], offset[i] = s, capacity - free
        if free > n:
            if not room[free - n]:
                insort(sizes, free - n)
            room[free - n].append(s)
    return sequence, offset


def pack(docs: DataFrame, vocabulary: str, capacity: int = 2048, grain: int = 8, most: int = 3) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every row of ``docs``."""
    spark = docs.sparkSession
    classes = -(-capacity // grain)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    pieces = checkpointed(token_pieces(docs, vocabulary, capacity).select(
        *columns, F.ceil(F.col("length") / grain).cast("int").alias("class"),
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(CELLS)).cast("int").alias("cell")))
    cells = checkpointed(pieces.groupBy("class", "cell").agg(F.count(F.lit(1)).alias("n")))
    histogram = np.zeros(classes, np.int64)
    for c, n in cells.groupBy("class").agg(F.sum("n")).collect():
        histogram[c - 1] = n
    used, times = pattern_counts(histogram, most)

    # each use of a class by a pattern takes the next ``times`` ranks of the class
    ranges, taken, base = [], np.zeros(classes, np.int64), 0
    for pattern, n in zip(used.tolist(), times.tolist(), strict=True):
        for slot, c in enumerate(c for c in pattern if c):
            ranges.append((c, int(taken[c - 1]), int(taken[c - 1] + n), base, slot))
            taken[c - 1] += n
        base += n
    rest = histogram - taken
    before_rest = np.cumsum(rest) - rest
    for c in np.flatnonzero(rest):
        ranges.append((int(c) + 1, int(taken[c]), int(histogram[c]), int(before_rest[c]), None))
    groups = max(1, -(-int(rest.sum()) // GROUP))
    # at most a few rows per pattern in use, and at most as many patterns as classes
    places = F.broadcast(spark.createDataFrame(ranges, "class int, lo long, hi long, base long, slot int"))

    earlier = cells.select("class", "cell", (F.sum("n").over(Window.partitionBy("class").orderBy("cell")) - F.col("n")).alias("earlier"))
    in_cell = F.row_number().over(Window.partitionBy("class", "cell").orderBy("length", "doc_id", "piece", "ids_crc32")) - 1
    placed = pieces.withColumn("in_cell", in_cell).join(earlier, ["class", "cell"]).withColumn(
        "rank", F.col("earlier") + F.col("in_cell")).join(places, "class").where("rank >= lo and rank < hi").withColumn(
        "at", F.col("base") + F.col("rank") - F.col("lo")).select(*columns, "slot", "at")
    placed = checkpointed(placed)

    inside = Window.partitionBy("at").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    by_pattern = placed.where("slot is not null").select(
        *columns, F.col("at").alias("sequence_id"), F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset"))

    def remaining(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        sequence, offset = best_fit(rows["length"].to_numpy(), capacity)
        first = base + rows["group"][0].as_py() * (GROUP + 1)
        return rows.select(columns).append_column("sequence_id", pa.array(first + sequence)).append_column("offset", pa.array(offset))

    left = placed.where("slot is null").select(*columns, (F.col("at") % groups).alias("group"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    best = left.groupBy("group").applyInArrow(
        remaining, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return by_pattern.unionByName(best)
