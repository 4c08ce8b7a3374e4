"""Hybrid retrieval: reciprocal rank fusion, retrieval context, autocomplete."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RRF_K = 60


def rank_by(df: DataFrame, order, k: int | None = None, part: str = "query_id") -> DataFrame:
    """``row_number() over (partition by query_id order by …)``, optionally ≤ k."""
    w = Window.partitionBy(part).orderBy(*order)
    out = df.withColumn("rank", F.row_number().over(w))
    return out.where(F.col("rank") <= k) if k is not None else out


def rrf(rankings: list, k: int = RRF_K, top: int | None = 5) -> DataFrame:
    """Fuse ranked lists (query_id, doc_id, rank): Σ 1/(k + rank) per document."""
    u = rankings[0].select("query_id", "doc_id", "rank")
    for r in rankings[1:]:
        u = u.unionByName(r.select("query_id", "doc_id", "rank"))
    fused = u.groupBy("query_id", "doc_id").agg(F.sum(1.0 / (k + F.col("rank"))).alias("rrf_score"))
    fused = fused.withColumn("rrf_score", F.round("rrf_score", 6))
    if top is None:
        return fused
    return rank_by(fused, [F.col("rrf_score").desc(), F.col("doc_id")], top).withColumnRenamed("rank", "fused_rank")


def context(hits: DataFrame, text_cols: list, rank_col: str = "rank",
            empty_text: str = "No relevant context found.", queries: DataFrame | None = None) -> DataFrame:
    """(query_id, context): the hits' text, in rank order, one block per query.

    ``listagg … within group (order by rank)``; queries without hits get the
    fixed text (left join from ``queries``).
    """
    line = F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in text_cols])
    per = hits.select("query_id", F.col(rank_col).alias("r"), line.alias("line"))
    agg = per.groupBy("query_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "line"))), lambda x: x["line"]),
                     "\n").alias("context"))
    if queries is not None:
        agg = queries.select("query_id").join(agg, "query_id", "left").select(
            "query_id", F.coalesce("context", F.lit(empty_text)).alias("context"))
    return agg
