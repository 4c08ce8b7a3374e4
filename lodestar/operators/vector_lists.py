"""Clustered vector lists in two levels, stored with an index.

Centroids are trained in two steps, so neither training nor assignment holds
all of them in one place: about sqrt(k) *coarse* centroids on a sample, then
the *fine* ones of every coarse cell on the cell's part of the sample.  Vectors
are dealt to (cell, block) groups, a block holding about ``BLOCK_ROWS`` vectors,
and meet only the fine centroids of their cell there; a crowded cell has more
blocks, never a larger group.  Lists are written partitioned by cell and sorted
by list, so a search that probes a few lists reads the folders of their cells
only and trains nothing.

Samples (the only things not taken from all rows): ``samples_per_centroid``
rows per centroid, chosen by a hash of the key; at most ``COARSE_SAMPLE`` rows
for the coarse step and ``CELL_SAMPLE`` rows and ``CELL_CENTROIDS`` centroids
for a cell.  Every vector is stored in its nearest ``replication`` lists.

Defined cases: null vectors are not stored; no vectors give no centroids and
an empty result; a zero vector has no cosine distance and is stored but never
found under that metric; equal vectors share their lists.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import checkpointed, held, join_held, join_small
from .knn import DIST_DECIMALS, distance_expr, knn

COARSE_SAMPLE = 100_000
CELL_SAMPLE = 50_000
CELL_CENTROIDS = 1024
BLOCK_ROWS = 50_000
ROUNDS = 12  # of Lloyd's iteration


@dataclass(frozen=True)
class Clusters:
    """Build options: centroids per row, training rows per centroid, lists per vector."""

    centroid_ratio: float = 0.01
    samples_per_centroid: int = 32
    replication: int = 1


def _matrix(column) -> np.ndarray:
    """The vectors of an Arrow list column as rows."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), np.float64).reshape(len(flat), -1)


def nearest(x: np.ndarray, centroids: np.ndarray, n: int = 1) -> np.ndarray:
    """(rows, n): numbers of the nearest centroids, nearest first; ties by number."""
    out = np.empty((len(x), n), np.int64)
    half = (centroids ** 2).sum(axis=1) / 2
    step = max(1, 4_000_000 // len(centroids))
    for a in range(0, len(x), step):
        far = half - x[a:a + step] @ centroids.T
        if n == 1:
            out[a:a + step, 0] = far.argmin(axis=1)
        else:
            out[a:a + step] = np.argsort(far, axis=1, kind="stable")[:, :n]
    return out


def lloyd(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """At most ``k`` centroids of the rows of ``x``."""
    x = x[np.lexsort(x.T[::-1])]  # whatever order the rows came in
    distinct = np.unique(x, axis=0)
    if len(distinct) <= k:
        return distinct
    rng = np.random.Generator(np.random.PCG64(seed))
    c = distinct[rng.permutation(len(distinct))[:k]]
    for _ in range(ROUNDS):
        own = nearest(x, c)[:, 0]
        size = np.bincount(own, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        new = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], c)
        if np.allclose(new, c, atol=1e-9):
            break
        c = new
    return c


def _celled(rows: DataFrame, coarse: np.ndarray) -> DataFrame:
    """``rows`` (doc_id, vec) with their nearest coarse cell."""
    ddl = f"cell int, doc_id {dict(rows.dtypes)['doc_id']}, vec array<double>"

    def run(batches):
        for b in batches:
            if len(b):
                cell = nearest(_matrix(b.column(1)), coarse)[:, 0].astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(cell), b.column(0), b.column(1)], ["cell", "doc_id", "vec"])

    return rows.select("doc_id", "vec").mapInArrow(run, ddl)


def _chosen(rows: DataFrame, share: float) -> DataFrame:
    """About this share of the rows, by a hash of the key."""
    return rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30)))


def train(rows: DataFrame, how: Clusters = Clusters()) -> tuple[np.ndarray, DataFrame, DataFrame] | None:
    """(coarse matrix, coarse centroids, fine centroids) of ``rows`` (doc_id, vec): the tables have
    (cell, centroid) and (cell, list_id, centroid), lists numbered without gaps."""
    spark, n = rows.sparkSession, rows.count()
    if not n:
        return None
    k = max(1, math.ceil(how.centroid_ratio * n))
    cells = math.ceil(math.sqrt(k))
    first = _chosen(rows, COARSE_SAMPLE / n).select("vec").limit(2 * COARSE_SAMPLE).toArrow()
    if not first.num_rows:  # a few rows, none chosen
        first = rows.select("vec").limit(COARSE_SAMPLE).toArrow()
    coarse = lloyd(_matrix(first["vec"]), cells, 7)
    share = how.samples_per_centroid * k / n
    sample = checkpointed(_celled(_chosen(rows, share), coarse))
    counts = {r["cell"]: r["count"] for r in sample.groupBy("cell").count().collect()}  # about sqrt(k) rows
    total = max(1, sum(counts.values()))
    quota = {c: min(CELL_CENTROIDS, max(1, math.ceil(k * m / total))) for c, m in counts.items()}
    # a crowded cell is trained on a hash sample of its rows
    most = spark.createDataFrame([(c, min(1.0, CELL_SAMPLE / m)) for c, m in counts.items()], "cell int, part double")
    few = sample.join(F.broadcast(most), "cell").where(  # a row per cell
        F.pmod(F.xxhash64(F.lit("cell"), "doc_id"), F.lit(1 << 30)) < F.col("part") * (1 << 30)).select("cell", "vec")

    def fine_of(t: pa.Table) -> pa.Table:
        cell = t["cell"][0].as_py()
        c = lloyd(_matrix(t["vec"]), quota[cell], 11 + cell)
        return pa.table({"cell": pa.array([cell] * len(c), pa.int32()), "at": pa.array(range(len(c)), pa.int32()),
                         "centroid": pa.array(c.tolist(), pa.list_(pa.float64()))})

    fine = checkpointed(few.groupBy("cell").applyInArrow(fine_of, "cell int, at int, centroid array<double>"))
    # a cell without training rows keeps its coarse centroid as its only list
    bare = [(c, 0, v.tolist()) for c, v in enumerate(coarse) if c not in counts]
    if bare:
        fine = fine.unionByName(spark.createDataFrame(bare, "cell int, at int, centroid array<double>"))
    sizes = fine.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))  # about sqrt(k) rows in one window
    base = sizes.withColumn("base", F.sum("n").over(Window.orderBy("cell")) - F.col("n")).select("cell", "base")
    fine = checkpointed(fine.join(F.broadcast(base), "cell").select(
        "cell", (F.col("base") + F.col("at")).cast("long").alias("list_id"), "centroid"))
    tops = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(coarse)], "cell int, centroid array<double>")
    return coarse, tops, fine


def assign(rows: DataFrame, coarse: np.ndarray, fine: DataFrame, replication: int = 1) -> DataFrame:
    """(cell, list_id, doc_id, embedding): every row of ``rows`` (doc_id, vec) in its nearest lists."""
    placed = checkpointed(_celled(rows, coarse))
    blocks = checkpointed(placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks")))
    # a row per cell: about sqrt(k)
    dealt = placed.join(F.broadcast(blocks), "cell").withColumn(
        "block", F.pmod(F.xxhash64(F.lit("block"), "doc_id"), "blocks").cast("int")).select("cell", "block", "doc_id", "vec")
    lists = fine.join(F.broadcast(blocks), "cell").select(
        "cell", "list_id", "centroid", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    kind = dict(rows.dtypes)["doc_id"]

    def run(vectors: pa.Table, centroids: pa.Table) -> pa.Table:
        order = np.argsort(centroids["list_id"].to_numpy(), kind="stable")
        ids, n = centroids["list_id"].to_numpy()[order], min(replication, len(order))
        if not vectors.num_rows:
            return pa.table({c: pa.array([], t) for c, t in (
                ("cell", pa.int32()), ("list_id", pa.int64()), ("doc_id", vectors.schema.field("doc_id").type),
                ("embedding", pa.list_(pa.float64())))})
        near = nearest(_matrix(vectors["vec"]), _matrix(centroids["centroid"])[order], n)
        at = pa.array(np.repeat(np.arange(vectors.num_rows), n))
        return pa.table({"cell": vectors["cell"].take(at), "list_id": pa.array(ids[near.ravel()]),
                         "doc_id": vectors["doc_id"].take(at), "embedding": vectors["vec"].take(at)})

    return dealt.groupBy("cell", "block").cogroup(lists.groupBy("cell", "block")).applyInArrow(
        run, f"cell int, list_id long, doc_id {kind}, embedding array<double>")


def save_lists(vectors: DataFrame, path: str, how: Clusters) -> None:
    """Train on ``vectors`` (doc_id, embedding) and write centroids and lists under ``path``."""
    rows = vectors.select("doc_id", F.col("embedding").alias("vec")).where(F.col("vec").isNotNull())
    spark, trained = rows.sparkSession, train(rows, how)
    if trained is None:
        tops = spark.createDataFrame([], "cell int, centroid array<double>")
        fine = spark.createDataFrame([], "cell int, list_id long, centroid array<double>")
        lists = rows.select(F.lit(0).alias("cell"), F.lit(0).cast("long").alias("list_id"), "doc_id", F.col("vec").alias("embedding"))
    else:
        coarse, tops, fine = trained
        lists = assign(rows, coarse, fine, how.replication)
    tops.coalesce(1).write.mode("overwrite").parquet(f"{path}/coarse")
    fine.write.mode("overwrite").parquet(f"{path}/fine")
    _write(lists, f"{path}/lists")


def _write(lists: DataFrame, path: str) -> None:
    """Sorted by list inside a file; a crowded cell may span several files."""
    part = F.pmod(F.xxhash64("list_id"), F.lit(16))
    lists.withColumn("part", part).repartition("cell", "part").drop("part").sortWithinPartitions("cell", "list_id").write.mode(
        "overwrite").partitionBy("cell").parquet(path)


def append_lists(vectors: DataFrame, stored: VectorLists, path: str, how: Clusters) -> None:
    """Write the lists of more ``vectors`` (doc_id, embedding) under ``path``, by the stored centroids."""
    rows = vectors.select("doc_id", F.col("embedding").alias("vec")).where(F.col("vec").isNotNull())
    tops = sorted(stored.coarse.collect(), key=lambda r: r["cell"])  # about the square root of the number of lists
    if not tops:
        raise ValueError("the index was built without vectors, so it has no centroids; build it again")
    lists = assign(rows, np.array([r["centroid"] for r in tops]), stored.fine, how.replication)
    _write(lists, path)


class VectorLists:
    """Stored lists of one vector field, and its metric."""

    def __init__(self, spark, path: str, metric: str, key_type: str = "bigint", appended=()):
        self.metric = metric
        self.coarse = spark.read.schema("cell int, centroid array<double>").parquet(f"{path}/coarse")
        self.fine = spark.read.schema("cell int, list_id bigint, centroid array<double>").parquet(f"{path}/fine")
        read = spark.read.schema(f"list_id bigint, doc_id {key_type}, embedding array<double>, cell int")
        self.lists = read.parquet(f"{path}/lists")
        for more in appended:
            self.lists = self.lists.unionByName(read.parquet(more))

    def probed(self, queries: DataFrame, nprobe: int, cells: int) -> DataFrame:
        """(query_id, cell, list_id): the lists each query looks into: the nearest of its ``cells`` nearest cells."""
        near = knn(self.coarse, "cell", "centroid", queries.select("query_id", "vector"), cells, "l2").select(
            "query_id", F.col("doc_id").cast("int").alias("cell"))
        side, rows = held(near.join(queries.select("query_id", "vector"), "query_id"))
        fine = join_held(self.fine, side, rows, "cell")
        order = Window.partitionBy("query_id").orderBy(distance_expr(F.col("centroid"), F.col("vector"), "l2"), "list_id")
        return fine.withColumn("r", F.row_number().over(order)).where(F.col("r") <= nprobe).select("query_id", "cell", "list_id")

    def top(self, queries: DataFrame, k: int, nprobe: int = 8, cells: int | None = None) -> DataFrame:
        """(query_id, doc_id, distance, rank): the k nearest vectors in the ``nprobe`` nearest
        lists of every query (query_id, vector), exactly ranked by the field's metric."""
        q = queries.select("query_id", F.transform("vector", lambda x: x.cast("double")).alias("vector"))
        if self.metric == "cosine":  # the stored vectors have length one
            norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
            q = q.withColumn("vector", F.when(norm > 0, F.transform("vector", lambda x: x / norm)).otherwise(F.col("vector")))
        q, _ = held(q)
        probes, rows = held(self.probed(q, nprobe, cells or nprobe))
        lists = self.lists
        if rows is not None:  # folders of other cells are not listed, other lists are not decoded
            lists = lists.where(F.col("cell").isin(sorted(set(rows["cell"].to_pylist()))))
            if len(ids := set(rows["list_id"].to_pylist())) <= 1000:
                lists = lists.where(F.col("list_id").isin(sorted(ids)))
        found = join_held(lists, probes, rows, ["cell", "list_id"])
        d = F.round(distance_expr(F.col("embedding"), F.col("vector"), self.metric), DIST_DECIMALS)
        # replicas of a vector are one row
        near = join_small(found, q, "query_id").select("query_id", "doc_id", d.alias("distance")).where(
            F.col("distance").isNotNull()).distinct()
        order = Window.partitionBy("query_id").orderBy("distance", "doc_id")
        return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
