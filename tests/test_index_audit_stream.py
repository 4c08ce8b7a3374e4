import tempfile

from pyspark.sql import functions as F

from lodestar.functions import analysis as A
from lodestar.operators import audit as D
from lodestar.operators import search as S
from lodestar.operators.index import Field, build_index
from lodestar.streaming.append import append, compact, open_appended, stream_append
from tests.conftest import DOC_ROWS, rows


def test_postings_and_manifest(index):
    p = {(r.term, r.doc_id): (r.tf, list(r.positions)) for r in index.postings.collect()}
    assert p[("running", 1)] == (2, [0, 4])
    assert p[("the", 8)] == (3, [0, 6, 9])
    assert index.manifest().count() == 1


def test_array_field_gap_and_partial(spark):
    df = spark.createDataFrame([(1, ["red shoes", "blue"], 5), (2, None, 1), (3, [], 9)],
                               "id bigint, tags array<string>, n int")
    idx = build_index(df, "id", [Field("tags", is_array=True)])
    pos = {(r.term, r.doc_id): list(r.positions) for r in idx.postings.collect()}
    assert pos[("blue", 1)] == [102]
    part = build_index(df, "id", [Field("tags", is_array=True)], where=F.col("n") > 4)
    assert rows(part.doclens, "doc_id", "dl") == [(1, 3), (3, 0)]


def test_verify_passes_and_catalogue(index):
    v = rows(D.verify_index(index, heap_all_indexed=True), "check_name", "passed")
    assert all(p for _, p in v) and len(v) == 5
    segs = D.index_segments(index).collect()
    assert sum(r.num_docs for r in segs) == 7
    cat = D.indexes({"idx": index}).first()
    assert cat.total_docs == 7


def test_verify_detects_bad_index(spark, index):
    bad = build_index(spark.createDataFrame(DOC_ROWS, "id bigint, description string"), "id", [Field("description")])
    bad.postings = bad.postings.withColumn("tf", F.col("tf") + 1)
    v = dict(rows(D.verify_index(bad), "check_name", "passed"))
    assert v["positions_length"] is False and v["doc_length"] is False
    stop = rows(D.verify_index(bad, on_error_stop=True), "check_name")
    assert ("unique_postings",) not in stop


def test_append_equals_rebuild(spark):
    df = spark.createDataFrame(DOC_ROWS, "id bigint, description string")
    first, rest = df.where("id <= 4"), df.where("id > 4")
    path = tempfile.mkdtemp(prefix="lodestar-append-")
    build_index(first, "id", [Field("description")]).save(path)
    append(spark, path, rest, 7)
    idx = append(spark, path, rest, 7)  # re-delivered
    full = build_index(df, "id", [Field("description")])
    assert rows(idx.terms, "term", "df", "cf") == rows(full.terms, "term", "df", "cf")
    assert rows(idx.stats, "n_docs", "total_tokens") == rows(full.stats, "n_docs", "total_tokens")


def test_append_reads_its_own_rows_only(spark, tmp_path):
    """The stored tables of the base are unreadable while a batch arrives; afterwards its words are found."""
    import pathlib

    df = spark.createDataFrame(DOC_ROWS, "id bigint, description string")
    path = f"{tmp_path}/idx"
    build_index(df.where("id <= 4"), "id", [Field("description")]).save(path)
    files = [f for t in ("postings", "terms", "doclens", "fields", "grams", "rare") for f in pathlib.Path(path, t).rglob("*.parquet")]
    kept = {f: f.read_bytes() for f in files}
    for f in files:
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
        f.write_bytes(b"unreadable")
    append(spark, path, df.where("id > 4"), 1)
    for f, b in kept.items():
        f.write_bytes(b)
    spark.catalog.clearCache()
    idx = open_appended(spark, path)
    q = spark.createDataFrame([(1, "quick"), (2, "shoes"), (3, "the end")], "query_id bigint, query string")
    full = build_index(df, "id", [Field("description")])
    assert rows(S.rounded(S.match_all(idx, q, "description")), "query_id", "doc_id", "score") == rows(
        S.rounded(S.match_all(full, q, "description")), "query_id", "doc_id", "score")
    assert rows(S.regex(idx, "description", {1: "qu.*", 2: "sh.*"}), "query_id", "doc_id") == [(1, 8), (2, 1), (2, 2), (2, 3)]
    one = compact(spark, path, f"{tmp_path}/one")
    assert one.appended is None and rows(one.terms, "term", "df", "cf") == rows(full.terms, "term", "df", "cf")
    assert rows(S.rounded(S.match_any(one, q, "description")), "query_id", "doc_id", "score") == rows(
        S.rounded(S.match_any(idx, q, "description")), "query_id", "doc_id", "score")
    assert all(p for _, p in rows(D.verify_index(one), "check_name", "passed"))


def test_stream_append(spark):
    df = spark.createDataFrame(DOC_ROWS, "id bigint, description string")
    base = tempfile.mkdtemp(prefix="lodestar-stream-")
    build_index(df.where("id <= 3"), "id", [Field("description")]).save(f"{base}/idx")
    src = f"{base}/incoming"
    df.where("id > 3").write.parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    q = stream_append(stream, f"{base}/idx", f"{base}/ckpt")
    q.awaitTermination(120)
    idx = open_appended(spark, f"{base}/idx")
    full = build_index(df, "id", [Field("description")])
    assert rows(idx.terms, "term", "df") == rows(full.terms, "term", "df")
