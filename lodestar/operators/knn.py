"""Exact and clustered vector top-k.

Bulk exact top-k is a ``mapInPandas`` over the vector table: every Arrow
batch becomes one NumPy matrix, distances to the (broadcast, size-checked)
query matrix are taken in one vectorised pass, and each partition emits only
its own k best rows per query.  A final per-query window keeps the global k.
So the output of the map side is (partitions × queries × k) rows whatever
the table size, and no query × row product ever reaches a shuffle.  Query
batches above the broadcast budget are split into several passes.

Distances: l2 = √Σ(a−b)², cosine = 1 − cos, ip = −Σab (ascending = best).
Ties break on the rounded distance, then key.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import checkpointed

DIST_DECIMALS = 6
QUERY_BUDGET_FLOATS = 8_000_000  # query vectors sent to every task per pass (64 MB of doubles)


def distance_expr(a: Column, b: Column, metric: str) -> Column:
    """Built-in distance of two array columns (used on candidate pairs)."""
    prod = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                       lambda s, v: s + v)
    if metric == "l2":
        return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) *
                                             (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, v: s + v))
    if metric == "ip":
        return -prod
    if metric == "cosine":
        na = F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
        nb = F.sqrt(F.aggregate(b, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
        return 1 - F.try_divide(prod, na * nb)  # a zero vector has no cosine distance
    raise ValueError(metric)


def _np_dist(X: np.ndarray, q: np.ndarray, metric: str) -> np.ndarray:
    if metric == "l2":
        return np.sqrt(((X - q) ** 2).sum(axis=1))
    if metric == "ip":
        return -(X @ q)
    if metric == "cosine":
        den = np.linalg.norm(X, axis=1) * np.linalg.norm(q)
        with np.errstate(invalid="ignore", divide="ignore"):
            return 1 - (X @ q) / den
    raise ValueError(metric)


def _partition_topk(qids, Q, k, metric, key_col, vec_col):
    def run(batches):
        none = np.zeros(0, np.int64), np.zeros(0)
        best = [none] * len(qids)  # (keys, distances) so far, nearest first
        for pdf in batches:
            if pdf.empty:
                continue
            keys = pdf[key_col].to_numpy()
            X = np.stack(pdf[vec_col].to_numpy()).astype(np.float64)
            for qi, (had, dist) in enumerate(best):
                d = np.round(_np_dist(X, Q[qi], metric), DIST_DECIMALS)
                # a zero vector has no cosine distance; a full list only takes what is no farther
                near = np.flatnonzero(d <= dist[-1] if len(dist) == k else ~np.isnan(d))
                if len(near):
                    had, dist = np.concatenate((had, keys[near])), np.concatenate((dist, d[near]))
                    order = np.lexsort((had, dist))[:k]
                    best[qi] = had[order], dist[order]
        for qid, (had, dist) in zip(qids, best, strict=True):
            if len(had):
                yield pd.DataFrame({"query_id": qid, "doc_id": had, "distance": dist})
    return run


def knn(rows: DataFrame, key: str, vec: str, queries: DataFrame, k: int, metric: str = "l2",
        qvec: str = "vector") -> DataFrame:
    """(query_id, doc_id, distance, rank) — the k nearest rows per query.

    ``queries`` (query_id, vector) is brought to the driver in chunks whose
    size is checked against ``QUERY_BUDGET_FLOATS``; each chunk is one pass.
    """
    spark = rows.sparkSession
    qn = queries.select("query_id", F.size(qvec).alias("dim"))
    stats = qn.agg(F.count("*").alias("n"), F.max("dim").alias("dim")).first()
    n, dim = stats["n"], stats["dim"] or 1
    if n == 0:
        return spark.createDataFrame([], "query_id bigint, doc_id bigint, distance double, rank int")
    per_pass = max(1, QUERY_BUDGET_FLOATS // dim)
    passes = math.ceil(n / per_pass)
    src = rows.select(F.col(key).alias("doc_id"), F.col(vec).alias("vec")).where(F.col("vec").isNotNull())
    outs = []
    qb = queries.select("query_id", qvec).withColumn("__pass", F.pmod(F.xxhash64("query_id"), F.lit(passes)))
    for p in range(passes):
        chunk = qb.where(F.col("__pass") == p)
        got = chunk.select("query_id", qvec).collect()  # bounded: ≤ per_pass vectors
        qids = [int(r[0]) for r in got]
        Q = np.array([np.asarray(r[1], dtype=np.float64) for r in got])
        fn = _partition_topk(qids, Q, k, metric, "doc_id", "vec")
        out = src.mapInPandas(fn, "query_id long, doc_id long, distance double")
        # one pass after the other: the driver holds the vectors of one pass only
        outs.append(checkpointed(out) if passes > 1 else out)
    allc = outs[0]
    for o in outs[1:]:
        allc = allc.unionByName(o)
    w = Window.partitionBy("query_id").orderBy("distance", "doc_id")
    return allc.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def knn_pairs(pairs: DataFrame, rows: DataFrame, key: str, vec: str, queries: DataFrame, k: int,
              metric: str = "l2", qvec: str = "vector") -> DataFrame:
    """Top-k among per-query candidate rows (query_id, doc_id), e.g. text matches."""
    j = (pairs.select("query_id", "doc_id")
         .join(rows.select(F.col(key).alias("doc_id"), F.col(vec).alias("vec")), "doc_id")
         .join(queries.select("query_id", F.col(qvec).alias("qv")), "query_id"))
    d = j.select("query_id", "doc_id", F.round(distance_expr(F.col("vec"), F.col("qv"), metric),
                                               DIST_DECIMALS).alias("distance")).where(F.col("distance").isNotNull())
    w = Window.partitionBy("query_id").orderBy("distance", "doc_id")
    return d.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# ---------------------------------------------------------------------------
# clustered lists
# ---------------------------------------------------------------------------

def build_clusters(rows: DataFrame, key: str, vec: str, centroid_ratio: float = 0.01,
                   training_samples_per_centroid: int = 32, cluster_replication: int = 1):
    """(centroids, lists) of a table without an index: every vector with its nearest
    ``cluster_replication`` centroids, trained and assigned in two levels (see :mod:`.vector_lists`)."""
    from .vector_lists import Clusters, assign, train

    src = rows.select(F.col(key).alias("doc_id"), F.transform(vec, lambda x: x.cast("double")).alias("vec")).where(F.col("vec").isNotNull())
    trained = train(src, Clusters(centroid_ratio, training_samples_per_centroid, cluster_replication))
    if trained is None:
        none = src.select(F.lit(0).cast("bigint").alias("centroid_id"), "doc_id", F.col("vec").alias("embedding"))
        return none.select("centroid_id", F.col("embedding").alias("centroid")), none
    coarse, _, fine = trained
    lists = assign(src, coarse, fine, cluster_replication)
    return (fine.select(F.col("list_id").alias("centroid_id"), "centroid"),
            lists.select(F.col("list_id").alias("centroid_id"), "doc_id", "embedding"))


def knn_clustered(centroids: DataFrame, lists: DataFrame, queries: DataFrame, k: int, nprobe: int = 2,
                  metric: str = "l2", qvec: str = "vector") -> DataFrame:
    """Probe the ``nprobe`` nearest centroids per query, re-rank exactly, drop replicas."""
    cq = knn(centroids, "centroid_id", "centroid", queries, nprobe, metric, qvec)
    cand = (cq.select("query_id", F.col("doc_id").alias("centroid_id"))
            .join(lists, "centroid_id").select("query_id", "doc_id", "embedding")
            .dropDuplicates(["query_id", "doc_id"]))
    d = (cand.join(queries.select("query_id", F.col(qvec).alias("qv")), "query_id")
         .select("query_id", "doc_id",
                 F.round(distance_expr(F.col("embedding"), F.col("qv"), metric), DIST_DECIMALS).alias("distance"))
         .where(F.col("distance").isNotNull()))
    w = Window.partitionBy("query_id").orderBy("distance", "doc_id")
    return d.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
