"""Cases with a defined result: unmatched phrase slots, range text, zero vectors,
names that match no index, bucket bound."""

import tempfile

import pytest
from pyspark.sql import functions as F

from lodestar.functions import analysis as A
from lodestar.functions import ranges as R
from lodestar.operators import audit, index, joins, knn
from lodestar.operators import querystring as QS
from lodestar.operators import search as S
from lodestar.operators.index import Field, SearchIndex, VectorField, build_index
from lodestar.streaming.append import append, stream_append


def ids(df):
    return sorted(r["doc_id"] for r in df.collect())


def test_phrase_prefix_counts_slots_from_the_query(spark, index):
    q = spark.createDataFrame([(1, ["running", "zzzq"])], "query_id bigint, query array<string>")
    assert ids(S.phrase_prefix(index, q, "description")) == []
    q = spark.createDataFrame([(1, ["running", "sho"])], "query_id bigint, query array<string>")
    assert ids(S.phrase_prefix(index, q, "description")) == [1, 2]


def test_regex_phrase_counts_slots_from_the_query(index):
    assert ids(S.regex_phrase(index, "description", {1: ["running", "zzz.*"]})) == []
    assert ids(S.regex_phrase(index, "description", {1: ["run.*", "sh.*"]})) == [1, 2]


def test_range_text(spark):
    df = spark.createDataFrame([("[1,5)",), ("empty",), ('["2","7"]',)], "t string")
    got = [r["r"] for r in df.select(R.parse_range(F.col("t"), "int4range").alias("r")).collect()]
    assert got[0]["lower"] == 1 and got[1] is None or got[1]["lower"] is None
    assert got[2]["lower"] == 2
    with pytest.raises(Exception, match="not a range"):
        spark.createDataFrame([("junk",)], "t string").select(R.parse_range(F.col("t"), "int4range").alias("r")).collect()


def test_cosine_of_a_zero_vector_is_null(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    assert df.select(knn.distance_expr(F.col("a"), F.col("b"), "cosine").alias("d")).first()["d"] is None


def test_no_index_matches(index):
    assert audit.verify_all_indexes({"docs": index}, index_pattern="other%").count() == 0


def test_bucket_count_stays_within_sparks_limit(spark, docs, monkeypatch):
    monkeypatch.setattr(index_module(), "BUCKET_TARGET_BYTES", 1)
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert index_module().default_buckets(spark, table) <= 100_000


def index_module():
    return index


def folder():
    return tempfile.mkdtemp(prefix="lodestar-cases-")


def test_vector_only_index_is_saved(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id bigint, v array<double>")
    idx = build_index(rows, "id", [], [VectorField("v")]).save(folder())
    assert idx.vectors.count() == 2 and idx.terms.count() == 0


def test_phrase_on_edge_ngrams(spark):
    df = spark.createDataFrame([(1, "red wine"), (2, "wine red")], "id bigint, t string")
    idx = build_index(df, "id", [Field("t", A.edge_ngram(1, 5))]).save(folder())
    q = spark.createDataFrame([(1, "red wine")], "query_id bigint, query string")
    assert ids(S.phrase(idx, q, "t")) == [1]
    with pytest.raises(ValueError, match="slop"):
        S.phrase(idx, q, "t", q=S.Query(slop=1))


def test_query_string_precedence_phrase_and_not(spark, docs, index):
    idx = index
    idx.docs = docs
    run = lambda text, **kw: ids(QS.query_string(idx, {1: text}, **kw))
    assert run("sleek OR season AND nothing") == [2]
    assert run("(sleek OR season) AND nothing") == []
    assert run('"white running"') == [2] and run('"running white"') == []
    assert run("shoes AND NOT sleek") == [1, 3]
    assert 4 in run("NOT shoes")  # a row without text
    with pytest.raises(QS.QueryStringError):
        QS.query_string(idx, {1: "rating:>3"}, numeric_fields=["rating"])


def test_append_keeps_predicate_expression_and_vectors(spark):
    df = spark.createDataFrame([(1, "Red", "x", 5, [1.0]), (2, "Blue", "y", 1, [2.0]), (3, "Green", "z", 7, [3.0]),
                                (4, "Pink", "w", 1, [4.0])], "id bigint, a string, b string, n int, v array<double>")
    path = folder()
    fields = [Field("concat(a, ' ', b)", name="ab", is_expr=True)]
    build_index(df.where("id <= 2"), "id", fields, [VectorField("v")], where="n > 2").save(path)
    append(spark, path, df.where("id > 2"), 1)
    idx = SearchIndex.open(spark, path)
    assert sorted(r["term"] for r in idx.terms.collect()) == ["green", "red", "x", "z"]
    assert idx.vectors.count() == 2
    q = spark.createDataFrame([(1, "green")], "query_id bigint, query string")
    assert ids(S.match_any(idx, q, "ab")) == [3]
    with pytest.raises(ValueError, match="other rows"):
        append(spark, path, df.where("id = 1"), 1)
    columns = folder()
    build_index(df, "id", [Field(F.col("a"), name="a")]).save(columns)
    with pytest.raises(ValueError, match="SQL text"):
        append(spark, columns, df, 1)


def test_two_streams_do_not_overwrite_each_other(spark):
    df = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "id bigint, t string")
    base = folder()
    build_index(df.where("id = 1"), "id", [Field("t")]).save(f"{base}/idx")
    for k in (2, 3):
        df.where(F.col("id") == k).write.parquet(f"{base}/in{k}")
        stream_append(spark.readStream.schema(df.schema).parquet(f"{base}/in{k}"), f"{base}/idx", f"{base}/ckpt{k}").awaitTermination(120)
    assert sorted(r["term"] for r in SearchIndex.open(spark, f"{base}/idx").terms.collect()) == ["one", "three", "two"]


def test_audits_on_string_keys_and_partial_index(spark):
    df = spark.createDataFrame([("a", "red", 1), ("b", "blue", 5)], "id string, t string, n int")
    idx = build_index(df, "id", [Field("t")], where="n > 2").save(folder())
    idx.docs = df
    got = {r["check_name"]: r for r in audit.verify_index(idx, heap_all_indexed=True).collect()}
    assert got["all_rows_indexed"]["details"] == "0 violations in 1 rows"
    assert audit.verify_index(idx, segment_ids=list(range(8))).count() == 3
    assert audit.index_segments(idx).count() == 1 and audit.indexes({"i": idx}).first()["total_docs"] == 1
    idx.postings = idx.postings.withColumn("tf", F.col("tf") + 1)
    assert [r["passed"] for r in audit.verify_index(idx, on_error_stop=True).collect()] == [True, False]


def test_broadcast_is_decided_on_measured_bytes(spark):
    long = spark.range(1).select(F.repeat(F.lit("x"), 1 << 20).alias("s"), F.array_repeat(F.lit(1.0), 100).alias("v"))
    assert joins.measured_bytes(long) >= (1 << 20) + 800
    assert not joins.fits_broadcast(long, 1000)
