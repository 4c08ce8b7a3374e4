"""Aggregations over matched rows: value_count, avg, terms, range, filter, over.

Metric aggregations are one ``agg`` (map-side partial aggregates); range
buckets are conditional counts in the same single pass, unpivoted with
``stack`` so empty buckets appear too; ``over()`` attaches a one-row
aggregate to every row with a broadcast (one row, bounded), never an
unpartitioned window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def metric(kind: str, col: str | Column, where: Column | None = None) -> Column:
    """One metric aggregate; ``where`` is the ``.filter()`` of the reference."""
    c = F.col(col) if isinstance(col, str) else col
    if where is not None:
        c = F.when(where, c)
    if kind == "value_count":
        return F.count(c)
    if kind == "avg":
        return F.avg(c.cast("double"))
    raise ValueError(f"metric kind must be value_count or avg, got {kind!r}")


def aggregate(df: DataFrame, spec: dict, exact: bool = True, by: str | None = None) -> DataFrame:
    """``{"name": ("value_count"|"avg", column[, where])}`` → one row (one per value of ``by``).

    ``exact=False`` permits an estimate; these kinds are exact at no extra
    cost in Spark, so the result is the exact one either way.
    """
    cols = []
    for name, s in spec.items():
        kind, col = s[0], s[1]
        where = s[2] if len(s) > 2 else None
        cols.append(metric(kind, col, where).alias(name))
    return df.groupBy(by).agg(*cols) if by else df.agg(*cols)


def terms_buckets(df: DataFrame, col: str | Column, size: int | None = None, group: str | None = None) -> DataFrame:
    """(key, doc_count) ordered by count descending then key; NULL keys left out."""
    c = F.col(col) if isinstance(col, str) else col
    keys = ([group] if group else [])
    g = df.select(*keys, c.alias("key")).where(F.col("key").isNotNull()).groupBy(*keys, "key").agg(
        F.count("*").alias("doc_count"))
    if size is not None:
        if not keys:
            # global top-n: Spark plans sort + limit as TakeOrderedAndProject
            return g.orderBy(F.col("doc_count").desc(), F.col("key")).limit(size)
        w = Window.partitionBy(*keys).orderBy(F.col("doc_count").desc(), F.col("key"))
        g = g.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= size).drop("rn")
    return g


def json_path(col: str, path: str) -> Column:
    """``metadata.color`` style access → ``get_json_object(col, '$.color')``."""
    return F.get_json_object(F.col(col), "$." + path)


def range_buckets(df: DataFrame, col: str | Column, ranges: list, where: Column | None = None,
                  group: str | None = None) -> DataFrame:
    """(idx, key, from, to, doc_count) for every range, empty ones too (per value of ``group``).

    ``from`` inclusive, ``to`` exclusive, either may be None (open).
    """
    c = F.col(col) if isinstance(col, str) else col
    aggs = []
    for i, (lo, hi) in enumerate(ranges):
        cond = F.lit(True)
        if lo is not None:
            cond &= c >= F.lit(lo)
        if hi is not None:
            cond &= c < F.lit(hi)
        if where is not None:
            cond &= where
        aggs.append(F.count(F.when(cond & c.isNotNull(), 1)).alias(f"b{i}"))
    keep = [group] if group else []
    one = df.groupBy(*keep).agg(*aggs)
    keys = [_range_key(lo, hi) for lo, hi in ranges]
    stack = ", ".join(f"{i}, '{k}', b{i}" for i, k in enumerate(keys))
    out = one.selectExpr(*keep, f"stack({len(ranges)}, {stack}) as (idx, key, doc_count)")
    bounds = df.sparkSession.createDataFrame(
        [(i, None if lo is None else float(lo), None if hi is None else float(hi)) for i, (lo, hi) in enumerate(ranges)],
        "idx int, `from` double, `to` double")
    return out.join(F.broadcast(bounds), "idx").select(  # the caller's bucket list
        *keep, "idx", "key", "from", "to", "doc_count")


def _range_key(lo, hi) -> str:
    f = "*" if lo is None else _num(lo)
    t = "*" if hi is None else _num(hi)
    return f"{f}-{t}"


def _num(v):
    return str(int(v)) if float(v).is_integer() else str(v)


def over(df: DataFrame, spec: dict, by: str | None = None) -> DataFrame:
    """Attach aggregates over **all** rows of ``df`` (of its value of ``by``) to
    each row (``OVER ()``).

    ``("terms", column, size)`` attaches the ``size`` largest buckets as an
    array of (key, doc_count), largest first, ties by key; null where there are none.
    """
    metrics = {n: s for n, s in spec.items() if s[0] != "terms"}
    if metrics:
        one = aggregate(df, metrics, by=by)
        attached = df.join(one, by) if by else df.crossJoin(F.broadcast(one))  # one row
    else:
        attached = df
    for name, s in spec.items():
        if s[0] == "terms":
            b = terms_buckets(df, s[1], size=s[2], group=by)
            entry = F.struct((-F.col("doc_count")).alias("o"), "key", "doc_count")
            listed = F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.struct(e["key"], e["doc_count"]))
            lists = (b.groupBy(by) if by else b.groupBy()).agg(F.when(F.count("key") > 0, listed).alias(name))
            attached = attached.join(lists, by, "left") if by else attached.crossJoin(F.broadcast(lists))  # one row
    return attached
