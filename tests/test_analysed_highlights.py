"""Snippets of analysed fields, offsets after letters that grow when lower-cased,
distinct positions of expanded slots, attached facets, checked scans."""

import tempfile

import pytest
from pyspark.sql import functions as F

from lodestar.functions import analysis as A
from lodestar.operators import facets as FA
from lodestar.operators import highlight as H
from lodestar.operators import search as S
from lodestar.operators.index import Field, build_index
from lodestar.sources.tables import read_table

ROWS = [(1, "İ Shoes are red"), (2, "one shoe, İİ two SHOES"), (3, "parseHTTPRequest2 parse"), (4, None), (5, ""),
        (6, "中文 shoe")]


def marked(spark, tok, word, start="[", end="]"):
    docs = spark.createDataFrame(ROWS, "id bigint, text string")
    index = build_index(docs, "id", [Field("text", tok)]).save(tempfile.mkdtemp(prefix="lodestar-test-idx-"))
    q = spark.createDataFrame([(1, word)], "query_id bigint, query string")
    got = H.snippet(index, "text", S.match_any(index, q, "text"), S.query_terms(index, q, "text"), start, end)
    return {r["doc_id"]: r["snippet"] for r in got.collect()}


def test_stemmed_field_marks_the_whole_word(spark):
    got = marked(spark, A.unicode_words(stemmer="english"), "shoes")
    assert got == {1: "[Shoes] are red", 2: "[shoe], İİ two [SHOES]", 6: "[shoe]"}


def test_source_code_marks_parts_of_words(spark):
    got = marked(spark, A.source_code(), "parse")
    assert got == {3: "[parse]HTTPRequest2 [parse]"}
    assert marked(spark, A.source_code(), "2") == {3: "[2] parse"}


def test_chinese_compatible_marks_single_characters(spark):
    assert marked(spark, A.chinese_compatible(), "文") == {6: "[文] shoe"}


def test_edge_ngram_marks_the_longest_head(spark):
    assert marked(spark, A.edge_ngram(2, 4), "shoe")[2] == "[shoe], İİ two [SHOE]S"


def test_offsets_are_places_in_the_text(spark):
    docs = spark.createDataFrame([(i, t) for i, t in ROWS if t], "doc_id bigint, text string")
    for tok in (A.unicode_words(), A.simple(stemmer="english"), A.source_code(), A.chinese_compatible(),
                A.whitespace(lowercase=False), A.edge_ngram(1, 3)):
        for r in A.token_offsets(docs, "text", tok).collect():
            part = r["text"][r["start"]:r["end"]]
            low = part.lower() if tok.lowercase else part
            assert low.startswith(r["term"][:1]) and len(part) <= len(r["term"]) + 1, (tok.describe(), r)


def test_one_token_fills_one_slot(index):
    def ids(*pats, slop=1):
        return sorted(r["doc_id"] for r in S.regex_phrase(index, "description", {1: list(pats)}, slop=slop).collect())

    assert ids("shoes", "sho.*") == []
    assert ids("th.*", "th.*", slop=8) == [8]
    assert ids("run.*", "(shoes|running)") == [1, 2]


def test_positions_are_assigned_by_augmenting_paths():
    assert S._all_placed([0, 0, 1], [1, 2, 1])
    assert not S._all_placed([0, 1], [1, 1])
    assert S._all_placed([0, 0, 1, 1, 2], [1, 2, 2, 3, 1])
    assert not S._all_placed([0, 0, 1, 1, 2, 2], [1, 2, 1, 2, 1, 2])


def test_a_boost_multiplies_a_constant(spark, index):
    q = spark.createDataFrame([(1, "sleek")], "query_id bigint, query string")
    assert [r["score"] for r in S.match_any(index, q, "description", q=S.Query(const=2, boost=3)).collect()] == [6.0]


def test_facets_attached_to_rows(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 3.0), (1, "a", 2.0), (2, None, 4.0)], "g int, k string, v double")
    spec = {"n": ("value_count", "v"), "top": ("terms", "k", 1)}
    got = {(r["g"], r["v"]): (r["n"], r["top"]) for r in FA.over(df, spec, by="g").collect()}
    assert len(got) == 4 and got[1, 3.0] == (3, [("a", 2)]) and got[2, 4.0] == (1, None)
    assert {(r["n"], tuple(r["top"])) for r in FA.over(df, spec).collect()} == {(4, (("a", 2),))}
    b = FA.range_buckets(df, "v", [(None, 2.0), (2.0, None)], group="g")
    assert sorted((r["g"], r["key"], r["doc_count"]) for r in b.collect()) == [
        (1, "*-2", 1), (1, "2-*", 2), (2, "*-2", 0), (2, "2-*", 1)]


def test_a_fraction_is_not_cut_to_an_integer(spark):
    path = tempfile.mkdtemp(prefix="lodestar-test-scan-") + "/t"
    spark.createDataFrame([(3.7,), (None,)], "x double").write.parquet(path)
    with pytest.raises(Exception, match="not whole"):
        read_table(spark, path, "x int").collect()
    assert read_table(spark, path, "x double").where(F.col("x").isNotNull()).count() == 1
