"""Range relations between two tables of ranges, as equi-joins on cells.

Two ranges that share a point are found by the lower bound of one of them, which
lies in the other one: so each pair is found once, by the later lower bound.  "A
point lies in a range" becomes an equality: a range is cut into the few cells of
a tree of cells (4 children each) that make it up exactly, a point is in one cell
of every level, and it lies in the range if and only if one of these is one of the
range's.  Only levels that occur are used.  No pair is formed that does not match
to the precision of the keys; the exact relation, open ends included, is checked
on what the cells bring together.

Keys are 64-bit integers in the order of the values (days, microseconds, the
integer part of a number); an unbounded end is the least or greatest key.

Defined cases: a null range meets nothing; an empty range intersects nothing and
holds only empty ranges, and every range holds it (by definition a row per range,
so these pairs are as many as the ranges); repeated rows are paired each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions import ranges as R
from .joins import held

BITS = 2  # a cell has 4 children
LEVELS = 64 // BITS
LEAST, GREATEST = -(1 << 63), (1 << 63) - 1


def sort_key(value: Column, kind: str) -> Column:
    """A 64-bit integer that orders like the value (values of one key may differ)."""
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return value.cast("bigint")
    if kind == "date":
        return F.unix_date(value).cast("bigint")
    if kind == "timestamp":
        return F.unix_micros(value)
    if kind == "timestamp_ntz":
        return F.unix_micros(F.to_utc_timestamp(value.cast("timestamp"), F.current_timezone()))
    # numbers beyond 64 bits share the last key
    whole = F.floor(value.cast("decimal(38,9)")) if kind.startswith("decimal") else F.floor(value.cast("double"))
    return F.when(whole < F.lit(LEAST), LEAST).when(whole > F.lit(GREATEST), GREATEST).otherwise(whole).cast("bigint")


def _cell_list(lo: str, hi: str) -> Column:
    """array<struct<level, cell>>: the cells that make up the keys lo to hi (SQL names), both included."""
    last = LEVELS - 1
    cells = "transform(sequence({a}, {z}), c -> struct(l as level, c as cell))"
    none = "array_repeat(struct(0 as level, 0L as cell), 0)"
    left = f"if(s.a <= s.z and s.a & 3 <> 0 and l < {last}, {cells.format(a='s.a', z='least(s.z, s.a | 3)')}, {none})"
    # the first parent that the left part does not touch
    up = "(shiftright(s.a, 2) + if(s.a & 3 <> 0, 1, 0))"
    right = (f"if(s.a <= s.z and s.z & 3 <> 3 and l < {last} and shiftright(s.z, 2) >= {up}, "
             f"{cells.format(a='s.z & ~3L', z='s.z')}, {none})")
    top = f"if(s.a <= s.z and l = {last}, {cells.format(a='s.a', z='s.z')}, {none})"
    step = (f"named_struct('a', if(s.a > s.z, 1L, {up}), 'z', if(s.a > s.z, 0L, shiftright(s.z, 2) - if(s.z & 3 <> 3, 1, 0)), "
            f"'cells', concat(s.cells, {left}, {right}, {top}))")
    return F.expr(f"aggregate(sequence(0, {last}), named_struct('a', {lo}, 'z', {hi}, 'cells', {none}), (s, l) -> {step}, s -> s.cells)")


PAIRS = 1 << 20  # pairs of a batch that are formed at once


def _few_points(points: DataFrame, rows: pa.Table, ranges: DataFrame) -> DataFrame:
    """:func:`stab` where the driver knows the points: each range takes its stretch of the sorted points."""
    shared = ranges.sparkSession.sparkContext.broadcast(np.unique(rows["point"].to_numpy()))

    def run(batches):
        for b in batches:
            at = shared.value
            first = np.searchsorted(at, b["lo"].to_numpy(), "left")
            n = np.maximum(np.searchsorted(at, b["hi"].to_numpy(), "right") - first, 0)
            sums = np.cumsum(n)
            start = 0
            while start < len(n):  # a few ranges at a time where they hold many points
                done = sums[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(sums, done + PAIRS, "right")))
                m = n[start:stop]
                where = np.repeat(np.arange(start, stop), m)
                place = np.arange(len(where)) - np.repeat(np.cumsum(m) - m, m) + first[where]
                if len(where):
                    yield pa.RecordBatch.from_arrays([*b.take(pa.array(where)).columns, pa.array(at[place])], [*b.schema.names, "point"])
                start = stop

    held_ranges = ranges.mapInArrow(run, StructType([*ranges.schema.fields, StructField("point", LongType())]))
    return held_ranges.join(F.broadcast(points), "point").select(*points.columns, *ranges.columns)


def stab(points: DataFrame, ranges: DataFrame) -> DataFrame:
    """``points`` (point, ...) joined with ``ranges`` (lo, hi, ...): pairs with lo <= point <= hi, each once.

    The side of few rows (``joins.held``) goes to the other one: few points are searched by
    every range, the cells of few ranges are broadcast; only two large sides are shuffled."""
    points = points.where(F.col("point").isNotNull())
    points, few = held(points)
    if few is not None:
        return _few_points(points, few, ranges)
    cut, rows = held(ranges.withColumn("cells", _cell_list("lo", "hi")).withColumn("cells", F.explode("cells")).select(
        *ranges.columns, "cells.level", "cells.cell"))
    if rows is not None:
        cut, levels = F.broadcast(cut), sorted(set(rows["level"].to_pylist()))
    else:
        levels = sorted(r["level"] for r in cut.select("level").distinct().collect())  # at most LEVELS numbers
    at = F.explode(F.array(*[F.struct(F.lit(n).alias("level"), F.shiftright("point", BITS * n).alias("cell")) for n in levels])
                   if levels else F.expr("array_repeat(struct(0 as level, 0L as cell), 0)"))
    return points.withColumn("at", at).select(*points.columns, "at.level", "at.cell").join(cut, ["level", "cell"]).drop("level", "cell")


def _side(table: DataFrame, key: str, rng: str, name: str) -> DataFrame:
    kind = table.schema[rng].dataType["lower"].dataType.simpleString()
    r = F.col(rng)

    def end(bound: str, unbounded: int) -> Column:
        return F.when(r[bound].isNull(), F.lit(unbounded)).otherwise(sort_key(r[bound], kind))

    return table.where(r.isNotNull()).select(
        F.col(key).alias(f"{name}_id"), r.alias(name), end("lower", LEAST).alias(f"{name}_lo"), end("upper", GREATEST).alias(f"{name}_hi"))


def _as_range(side: DataFrame, name: str) -> DataFrame:
    return side.withColumnsRenamed({f"{name}_lo": "lo", f"{name}_hi": "hi"})


def range_join(rows: DataFrame, queries: DataFrame, relation: str, key: str = "doc_id", rng: str = "range",
               query_rng: str = "range") -> DataFrame:
    """(query_id, doc_id): rows whose range ``Intersects`` a query's, ``Contains`` it or lies ``Within`` it.
    ``rows``: (key, rng); ``queries``: (query_id, query_rng), of one element type."""
    if relation not in R.RELATIONS:
        raise ValueError(f"relation must be one of {sorted(R.RELATIONS)}")
    holds = R.RELATIONS[relation](F.col("a"), F.col("b"))
    every_a, every_b = _side(rows, key, rng, "a"), _side(queries, "query_id", query_rng, "b")
    a, b = every_a.where(~R.is_empty(F.col("a"))), every_b.where(~R.is_empty(F.col("b")))
    pairs = []
    if relation in ("Intersects", "Contains"):  # the query's lower bound lies in the row's range
        met = stab(b.withColumn("point", F.col("b_lo")), _as_range(a, "a"))
        later = F.col("point") > F.col("lo") if relation == "Intersects" else F.lit(True)
        pairs.append(met.where(later & holds))
    if relation in ("Intersects", "Within"):  # the row's lower bound lies in the query's range
        pairs.append(stab(a.withColumn("point", F.col("a_lo")), _as_range(b, "b")).where(holds))
    if relation == "Contains":
        inner, outer = every_b.where(R.is_empty(F.col("b"))), every_a
    elif relation == "Within":
        inner, outer = every_a.where(R.is_empty(F.col("a"))), every_b
    if relation != "Intersects":  # an empty range lies in every range
        pairs.append(outer.withColumn("all", F.lit(0)).join(inner.withColumn("all", F.lit(0)), "all"))
    out = pairs[0].select("b_id", "a_id")
    for p in pairs[1:]:
        out = out.unionByName(p.select("b_id", "a_id"))
    return out.select(F.col("b_id").alias("query_id"), F.col("a_id").alias("doc_id"))


def range_contains_value(rows: DataFrame, values: DataFrame, key: str = "doc_id", rng: str = "range", value: str = "value") -> DataFrame:
    """(query_id, doc_id): rows whose range holds a query's value; ``values``: (query_id, value)."""
    kind = values.schema[value].dataType.simpleString()
    a = _side(rows, key, rng, "a").where(~R.is_empty(F.col("a")))
    points = values.where(F.col(value).isNotNull()).select("query_id", F.col(value).alias("b"), sort_key(F.col(value), kind).alias("point"))
    return stab(points, _as_range(a, "a")).where(R.contains_value(F.col("a"), F.col("b"))).select(
        "query_id", F.col("a_id").alias("doc_id"))
