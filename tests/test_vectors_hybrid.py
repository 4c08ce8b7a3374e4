import numpy as np
from pyspark.sql import functions as F

from lodestar.operators import hybrid as HY
from lodestar.operators import knn as K
from lodestar.operators.index import VectorField, build_index
from tests.conftest import rows


def _vecs(spark, n=60, dim=4, seed=3):
    rng = np.random.default_rng(seed)
    data = [(i, [float(x) for x in rng.normal(size=dim)]) for i in range(n)]
    data.append((n, [0.0] * dim))  # zero vector: cosine undefined, skipped
    return spark.createDataFrame(data, "id bigint, emb array<float>"), data


def test_knn_matches_brute_force(spark):
    df, data = _vecs(spark)
    qv = [[0.5, -1.0, 0.2, 0.0], [1.0, 1.0, 1.0, 1.0]]
    q = spark.createDataFrame([(i + 10, v) for i, v in enumerate(qv)], "query_id bigint, vector array<double>")
    X = np.array([np.asarray(v, dtype=np.float32).astype(np.float64) for _, v in data])
    for metric in ("l2", "ip", "cosine"):
        got = {(r.query_id, r.rank): r.doc_id for r in K.knn(df.repartition(3), "id", "emb", q, 4, metric).collect()}
        for qi, v in enumerate(qv):
            v = np.array(v)
            if metric == "l2":
                d = np.sqrt(((X - v) ** 2).sum(1))
            elif metric == "ip":
                d = -(X @ v)
            else:
                with np.errstate(invalid="ignore", divide="ignore"):
                    d = 1 - (X @ v) / (np.linalg.norm(X, axis=1) * np.linalg.norm(v))
            d = np.round(d, 6)
            order = sorted((x, i) for i, x in enumerate(d) if not np.isnan(x))[:4]
            assert [got[(qi + 10, r + 1)] for r in range(4)] == [i for _, i in order], metric


def test_pairs_and_clusters_match_exact(spark):
    df, _ = _vecs(spark)
    q = spark.createDataFrame([(1, [0.1, 0.2, 0.3, 0.4])], "query_id bigint, vector array<double>")
    exact = rows(K.knn(df, "id", "emb", q, 5, "l2"), "doc_id")
    pairs = df.select(F.lit(1).cast("bigint").alias("query_id"), F.col("id").alias("doc_id"))
    assert rows(K.knn_pairs(pairs, df, "id", "emb", q, 5, "l2"), "doc_id") == exact
    c, lists = K.build_clusters(df, "id", "emb", centroid_ratio=0.1, training_samples_per_centroid=8)
    k = c.count()
    assert lists.count() == 61
    # probing every cluster is exact
    assert rows(K.knn_clustered(c, lists, q, 5, nprobe=k), "doc_id") == exact


def test_cosine_field_normalised(spark):
    df, _ = _vecs(spark, n=5)
    idx = build_index(df, "id", [], [VectorField("emb", "cosine")])
    norms = [float(np.linalg.norm(r.embedding)) for r in idx.vectors.collect() if any(r.embedding)]
    assert all(abs(n - 1) < 1e-9 for n in norms)


def test_rrf_independent_of_partitions(spark):
    a = spark.createDataFrame([(1, d, r) for r, d in enumerate([5, 3, 9, 1], 1)], "query_id bigint, doc_id bigint, rank int")
    b = spark.createDataFrame([(1, d, r) for r, d in enumerate([3, 7, 5], 1)], "query_id bigint, doc_id bigint, rank int")
    r1 = rows(HY.rrf([a, b], top=3), "doc_id", "rrf_score")
    r2 = rows(HY.rrf([a.repartition(3), b.repartition(2)], top=3), "doc_id", "rrf_score")
    assert r1 == r2
    assert [d for d, _ in sorted(r1, key=lambda x: -x[1])][:2] == [3, 5]


def test_context_fixed_text(spark):
    hits = spark.createDataFrame([(1, 2, "b"), (1, 1, "a")], "query_id bigint, rank int, t string")
    qs = spark.createDataFrame([(1,), (2,)], "query_id bigint")
    out = dict(rows(HY.context(hits, ["t"], queries=qs, empty_text="none"), "query_id", "context"))
    assert out == {1: "a\nb", 2: "none"}
