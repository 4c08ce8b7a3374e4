import math

from pyspark.sql import functions as F

from lodestar.operators import search as S
from lodestar.operators import proximity as P
from tests.conftest import rows


def q(spark, *texts, vtype="string"):
    return spark.createDataFrame([(i + 1, t) for i, t in enumerate(texts)], f"query_id bigint, query {vtype}")


def bm25(tf, dl, df, n, avgdl):
    idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
    return idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))


def test_stats_count_empty_rows(index):
    st = index.stats.first()
    # 7 non-NULL rows (the empty one too); tokens: 6+4+1+0+4+5+10 = 30
    assert st.n_docs == 7 and st.total_tokens == 30


def test_match_any_bm25_by_hand(spark, index):
    out = {r.doc_id: r.score for r in S.match_any(index, q(spark, "shoes"), "description").collect()}
    n, avgdl = 7, 30 / 7
    assert set(out) == {1, 2, 3}
    assert abs(out[3] - bm25(1, 1, 3, n, avgdl)) < 1e-9
    assert abs(out[1] - bm25(1, 6, 3, n, avgdl)) < 1e-9


def test_match_all_subset_of_any(spark, index):
    qs = q(spark, "running shoes", "the dog", "zzz")
    a = set(rows(S.match_all(index, qs, "description"), "query_id", "doc_id"))
    b = set(rows(S.match_any(index, qs, "description"), "query_id", "doc_id"))
    assert a <= b and a == {(1, 1), (1, 2), (2, 8)}


def test_repeated_query_terms_count_once(spark, index):
    a = rows(S.match_any(index, q(spark, "shoes"), "description"))
    b = rows(S.match_any(index, q(spark, "shoes shoes"), "description"))
    assert a == b


def test_array_value_not_analysed(spark, index):
    qs = q(spark, ["Shoes"], ["shoes"], vtype="array<string>")
    assert rows(S.match_any(index, qs, "description"), "query_id", "doc_id") == [(2, 1), (2, 2), (2, 3)]


def test_phrase_and_slop(spark, index):
    qs = q(spark, "running shoes", "white shoes", "the the")
    ph = set(rows(S.phrase(index, qs, "description"), "query_id", "doc_id"))
    assert ph == {(1, 1), (1, 2)}
    s1 = set(rows(S.phrase(index, qs, "description", q=S.Query(slop=1)), "query_id", "doc_id"))
    assert s1 == ph | {(2, 2)}
    s6 = set(rows(S.phrase(index, qs, "description", q=S.Query(slop=6)), "query_id", "doc_id"))
    # "the the": two distinct positions of 'the' within slop 6 in doc 8 (positions 0, 6, 9)
    assert (3, 8) in s6 and (3, 8) not in s1 and s1 <= s6


def test_term_regex_exists_fuzzy(spark, index):
    assert rows(S.term(index, q(spark, "Shoes", "shoes"), "description"), "query_id", "doc_id") == \
        [(2, 1), (2, 2), (2, 3)]
    assert rows(S.regex(index, "description", {1: "ru.*"}), "doc_id") == [(1,), (2,)]
    assert rows(S.exists(index, "description"), "doc_id") == [(1,), (2,), (3,), (5,), (6,), (7,), (8,)]
    fz = rows(S.match_any(index, q(spark, "shose", "rnuning"), "description", q=S.Query(fuzzy=1)),
              "query_id", "doc_id")
    assert fz == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2)]
    zero = rows(S.match_any(index, q(spark, "shoes"), "description", q=S.Query(fuzzy=0)), "doc_id")
    assert zero == rows(S.match_any(index, q(spark, "shoes"), "description"), "doc_id")
    nos = rows(S.match_any(index, q(spark, "rnuning"), "description",
                           q=S.Query(fuzzy=1, transposition=False)), "doc_id")
    assert nos == []


def test_fuzzy_prefix(spark, index):
    out = rows(S.match_any(index, q(spark, "runx"), "description", q=S.Query(fuzzy=1, prefix=True)), "doc_id")
    assert out == [(1,), (2,)]


def test_boost_const(spark, index):
    base = {r.doc_id: r.score for r in S.match_any(index, q(spark, "shoes"), "description").collect()}
    b = {r.doc_id: r.score for r in S.match_any(index, q(spark, "shoes"), "description", q=S.Query(boost=2)).collect()}
    c = {r.doc_id: r.score for r in S.match_any(index, q(spark, "shoes"), "description", q=S.Query(const=1.5)).collect()}
    assert all(abs(b[k] - 2 * base[k]) < 1e-12 for k in base) and set(c.values()) == {1.5}


def test_phrase_prefix_and_regex_phrase(spark, index):
    qs = q(spark, ["running", "sh"], vtype="array<string>")
    assert rows(S.phrase_prefix(index, qs, "description"), "doc_id") == [(1,), (2,)]
    assert rows(S.regex_phrase(index, "description", {1: ["wh.*", "run.*"]}), "doc_id") == [(2,)]


def test_proximity(spark, index):
    near = P.prox_str("sleek").within(1, "running")
    assert rows(P.proximity(index, "description", {1: near}), "doc_id") == [(2,)]
    rev = P.prox_str("running").within(1, "sleek", True)
    assert rows(P.proximity(index, "description", {1: rev}), "doc_id") == []
    chain = P.prox_str("quick").within(0, "brown").within(1, P.prox_regex("ju.*"))
    assert rows(P.proximity(index, "description", {1: chain}), "doc_id") == [(8,)]
    arr = P.prox_array(P.prox_regex("la.y"), "xyz").within(0, "dog")
    assert rows(P.proximity(index, "description", {1: arr}), "doc_id") == [(8,)]


def test_unicode_rows_searchable(spark, index):
    assert rows(S.match_any(index, q(spark, "CAFÉ", "😀", "中文"), "description"), "query_id", "doc_id") == \
        [(1, 6), (2, 7), (3, 7)]


def test_top_k(spark, index):
    m = S.rounded(S.match_any(index, q(spark, "running shoes the"), "description"))
    top = S.top_k(m, 2).orderBy("rank").collect()
    assert [r.rank for r in top] == [1, 2]
