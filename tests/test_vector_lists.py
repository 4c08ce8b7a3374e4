"""Clustered vector lists stored with an index."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.operators import knn as K
from lodestar.operators import vector_lists as V
from lodestar.operators.index import VectorField, build_index
from lodestar.streaming.append import append
from tests.conftest import rows

DDL = "id bigint, emb array<double>"


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(25, 8)) * 4
    x = np.concatenate([c + rng.normal(size=(60, 8)) for c in centres] + [np.tile(centres[0], (700, 1))])  # a crowded spot
    return [(i, v.tolist()) for i, v in enumerate(x)] + [(5000, None), (5001, [0.0] * 8)]


@pytest.fixture(scope="module")
def index(spark, data, tmp_path_factory):
    docs = spark.createDataFrame(data, DDL).repartition(4)
    fields = [VectorField("emb", m, m, V.Clusters(0.02, 16, 2 if m == "ip" else 1)) for m in ("l2", "cosine", "ip")]
    return build_index(docs, "id", [], fields).save(str(tmp_path_factory.mktemp("lists")))


@pytest.fixture(scope="module")
def queries(spark, data):
    rng = np.random.default_rng(8)
    return spark.createDataFrame([(i, (np.array(data[i * 30][1]) + rng.normal(size=8) * .3).tolist()) for i in range(50)],
                                 "query_id bigint, vector array<double>")


def _files_of(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def test_every_vector_is_listed(index, data):
    for name, lists in index.lists.items():
        per = lists.lists.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("list_id").alias("d"))
        assert per.count() == len(data) - 1 and per.where("n <> d or n > 2").count() == 0
        assert lists.metric == name and lists.fine.select("list_id").distinct().count() == lists.fine.count()


def test_all_probes_are_exact(index, data, queries, spark):
    docs = spark.createDataFrame([d for d in data if d[1]], DDL)
    for name, lists in index.lists.items():
        n = lists.fine.count()
        got = rows(lists.top(queries, 6, nprobe=n), "query_id", "rank", "distance")
        assert got == rows(K.knn(docs, "id", "emb", queries, 6, name), "query_id", "rank", "distance"), name


def test_recall_with_few_probes(index, data, queries, spark):
    docs = spark.createDataFrame([d for d in data if d[1]], DDL)
    exact = set(rows(K.knn(docs, "id", "emb", queries, 10), "query_id", "doc_id"))
    found = set(rows(index.lists["l2"].top(queries, 10, nprobe=8), "query_id", "doc_id"))
    assert len(exact & found) >= 0.9 * len(exact)


def test_only_probed_folders_are_read(index, queries):
    lists = index.lists["l2"]
    top = lists.top(queries.where("query_id = 3"), 5, nprobe=2)
    scan = [x for x in top._jdf.queryExecution().executedPlan().toString().split("\n") if "list_id" in x and "PartitionFilters" in x]
    assert scan and all("cell" in x.split("PartitionFilters")[1].split("]")[0] for x in scan)
    assert lists.fine.count() >= 20 and top.count() == 5


def test_equal_under_other_partitions(spark, data, tmp_path):
    fields = [VectorField("emb", clusters=V.Clusters(0.02, 16))]
    got = []
    for n in (1, 5):
        docs = spark.createDataFrame(data[:400], DDL).repartition(n)
        got.append(rows(build_index(docs, "id", [], fields).save(f"{tmp_path}/{n}").lists["emb"].lists, "doc_id", "list_id"))
    assert got[0] == got[1]


def test_appended_vectors_are_found(spark, tmp_path):
    rng = np.random.default_rng(1)
    x = [(i, rng.normal(size=4).tolist()) for i in range(120)]
    build_index(spark.createDataFrame(x[:100], DDL), "id", [], [VectorField("emb", clusters=V.Clusters(0.1, 8))]).save(str(tmp_path))
    idx = append(spark, str(tmp_path), spark.createDataFrame(x[100:], DDL), 1)
    q = spark.createDataFrame([(i, x[i][1]) for i in (3, 117)], "query_id bigint, vector array<double>")
    assert rows(idx.lists["emb"].top(q, 1, nprobe=4), "query_id", "doc_id") == [(3, 3), (117, 117)]


def test_no_vectors(spark, tmp_path):
    none = spark.createDataFrame([(1, None)], DDL)
    idx = build_index(none, "id", [], [VectorField("emb", clusters=V.Clusters())]).save(str(tmp_path))
    q = spark.createDataFrame([(1, [1.0, 2.0])], "query_id bigint, vector array<double>")
    assert idx.lists["emb"].top(q, 3).count() == 0
