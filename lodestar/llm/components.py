"""Connected components of an edge table, smallest id per component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """(id, component): for every id in ``edges`` (columns ``a``, ``b``) the
    smallest id it can reach.

    Alternates two moves until nothing changes, each a join of the edge table
    with one minimum per id (map-side combined; a hot id has one row on that
    side, so adaptive execution can split its edges): every id's larger
    neighbours are linked to its smallest neighbour, then every id and its
    smaller neighbours are.  The edge table never grows, and the number of
    rounds is logarithmic in the longest path.  Rounds run in as many tasks as the
    edges need (``tasks_for``), not in those of the widest shuffle of the session.
    An edge from an id to itself says nothing: an id without other edges has no row.
    """
    e = checkpointed(_downward(edges))
    state = _digest(e)
    few = tasks_for(state[0])
    while True:
        low = _smallest(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))).coalesce(few)
        # edge (a > b): the larger end is linked to the smallest neighbour of the smaller end
        far = e.select("a", F.col("b").alias("id")).join(low, "id").select("a", F.col("low").alias("b")).coalesce(few)
        e1 = _downward(far.unionByName(low.select(F.col("id").alias("a"), F.col("low").alias("b")))).coalesce(few)
        low1 = _smallest(e1).coalesce(few)
        near = e1.select("b", F.col("a").alias("id")).join(low1, "id").select(
            F.col("b").alias("a"), F.col("low").alias("b")).coalesce(few)
        e = checkpointed(_downward(near.unionByName(low1.select(F.col("id").alias("a"), F.col("low").alias("b")))).coalesce(few))
        new = _digest(e)
        if new == state:
            break
        state = new
    return e.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component")).unionByName(
        e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def tasks_for(rows: int) -> int:
    """Tasks for so many small rows: a few for a few, more in proportion."""
    return max(8, -(-rows // 50_000))


def _downward(edges: DataFrame) -> DataFrame:
    """Each distinct edge once, from the larger to the smaller id."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()


def _smallest(edges: DataFrame) -> DataFrame:
    """(id, low): the smallest of an id and its neighbours ``b``."""
    return edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("n")).select(
        "id", F.least("id", "n").alias("low"))


def _digest(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return r[0], r[1]
