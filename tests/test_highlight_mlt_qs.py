from lodestar.operators import highlight as H
from lodestar.operators import mlt as M
from lodestar.operators import search as S
from lodestar.operators.querystring import QueryStringError, parse, query_string
from tests.conftest import rows
import pytest


def qdf(spark, *texts):
    return spark.createDataFrame([(i + 1, t) for i, t in enumerate(texts)], "query_id bigint, query string")


def test_snippet_positions_and_fragments(spark, index):
    qs = qdf(spark, "running")
    m = S.match_any(index, qs, "description")
    qt = S.query_terms(index, qs, "description")
    pos = rows(H.snippet_positions(index, "description", m, qt), "doc_id", "start", "end")
    assert pos == [(1, 0, 7), (1, 22, 29), (2, 12, 19)]
    sn = {r.doc_id: r.snippet for r in H.snippet(index, "description", m, qt).collect()}
    assert sn[1] == "<b>Running</b> shoes for the <b>running</b> season"
    frs = H.snippets(index, "description", m, qt, "[", "]", max_num_chars=10, limit=5, sort_by="position")
    got = [(r.rank, r.snippet) for r in frs.where("doc_id = 1").orderBy("rank").collect()]
    assert got == [(1, "[Running] sh"), (2, "[running] se")]


def test_more_like_this(spark, index):
    src = spark.createDataFrame([(1, 2)], "query_id bigint, src_id bigint")
    out = rows(M.more_like_this_id(index, src), "doc_id")
    assert (2,) in out and (1,) in out and (8,) not in out
    ex = rows(M.more_like_this_id(index, src, exclude_sources=True), "doc_id")
    assert (2,) not in ex
    o = M.MltOptions(stopwords=("running", "shoes"), min_word_length=5)
    assert rows(M.more_like_this_id(index, src, o), "doc_id") == [(2,)]
    doc = spark.createDataFrame([(1, "lazy dog")], "query_id bigint, description string")
    assert rows(M.more_like_this_document(index, doc), "doc_id") == [(8,)]


def test_query_string(spark, index):
    assert parse("a AND b", ["t"]).op == "and"
    with pytest.raises(QueryStringError):
        parse("nosuch:x", ["description"])
    assert parse("nosuch:x y", ["description"], lenient=True).value == "y"
    out = rows(query_string(index, {1: "description:running AND NOT sleek", 2: "description:(lazy OR sleek)"}),
               "query_id", "doc_id")
    assert out == [(1, 1), (2, 2), (2, 8)]
    conj = rows(query_string(index, {1: "running shoes sleek"}, conjunction_mode=True), "doc_id")
    assert conj == [(2,)]
