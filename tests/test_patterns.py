"""Patterns by character grams and proximity trees as tables, against plain versions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lodestar.operators import patterns as PT
from lodestar.operators import proximity as P
from lodestar.operators import search as S
from lodestar.operators.index import Field, build_index
from tests.conftest import rows

PATTERNS = ["ab.*", ".*ba", "a[bc]+a", "abc", "(abc)+", "ab?c", "(ab|bc).*", "a|b", "", ".*", "x.*", "(?i)AB.*", "a{2,}b.*", "b(ca)c?.*",
            "(a)(b)(c).*", "[a-c]{3}", "ab(?:ca)*", "\\w+ab", "a\\.b", "a.c.*b", "c*", "abcab+c"]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rng = random.Random(6)
    texts = [(i, " ".join("".join(rng.choices("abc", k=rng.randrange(1, 8))) for _ in range(rng.randrange(1, 40)))) for i in range(150)]
    texts += [(200, None), (201, ""), (202, "a b c a b c")]
    docs = spark.createDataFrame(texts, "id bigint, description string")
    return build_index(docs, "id", [Field("description")], hot_df=40).save(str(tmp_path_factory.mktemp("patterns")))


def test_matching_terms_are_those_of_a_scan(spark, index):
    vocabulary = [r[0] for r in index.terms.select("term").collect()]
    asked = spark.createDataFrame([(i, p) for i, p in enumerate([*PATTERNS, PATTERNS[0], None])], "query_id bigint, pattern string")
    got = rows(S.regex_terms(index, "description", asked), "query_id", "term")
    want = sorted((i, t) for i, p in enumerate([*PATTERNS, PATTERNS[0]]) for t in vocabulary if re.fullmatch(p, t))
    assert got == want
    few = rows(S.regex_terms(index, "description", asked, 2), "query_id", "term")
    assert few == [w for k, w in enumerate(want) if sum(x[0] == w[0] for x in want[:k]) < 2]


def test_required_grams_are_in_every_match():
    rng = random.Random(2)
    words = ["".join(rng.choices("abc", k=rng.randrange(0, 9))) for _ in range(4000)]
    for p in PATTERNS:
        grams = PT.required_grams(p)
        for w in words:
            if re.fullmatch(p, w):
                whole = PT.START + w + PT.END
                assert all(g in whole for g in grams), (p, w, grams)
    assert PT.required_grams("abcd") and not PT.required_grams("\\p{L}+") and not PT.required_grams("a|b") and not PT.required_grams("(?i)abc")


def test_plan_does_not_grow_with_the_patterns(spark, index):
    def size(n):
        asked = spark.createDataFrame([(i, f"ab{'c' * (i % 5)}.*") for i in range(n)], "query_id bigint, pattern string")
        return len(S.regex(index, "description", asked)._jdf.queryExecution().optimizedPlan().toString().split("\n"))

    assert size(3) == size(300)


def test_regex_and_regex_phrase_from_tables(spark, index):
    one = spark.createDataFrame([(1, "ab.*"), (2, ".*ba")], "query_id bigint, pattern string")
    assert rows(S.regex(index, "description", one), "query_id", "doc_id") == rows(
        S.regex(index, "description", {1: "ab.*", 2: ".*ba"}), "query_id", "doc_id")
    lists = {1: ["a.*", "b.*"], 2: ["c", "a"]}
    table = spark.createDataFrame(list(lists.items()), "query_id bigint, patterns array<string>")
    want = rows(S.regex_phrase(index, "description", lists, 1), "query_id", "doc_id")
    assert rows(S.regex_phrase(index, "description", table, 1), "query_id", "doc_id") == want and want


def _spans(expr, words):
    """All (first, last) places where an expression holds in a list of words."""
    if isinstance(expr, P.Leaf):
        if expr.kind == "array":
            return {s for part in expr.value for s in _spans(part, words)}
        test = (lambda w: w == expr.value) if expr.kind == "str" else (lambda w: re.fullmatch(expr.value, w) is not None)
        return {(i, i) for i, w in enumerate(words) if test(w)}
    out = set()
    for s, e in _spans(expr.left, words):
        for rs, re_ in _spans(expr.right, words):
            if e < rs <= e + 1 + expr.distance:
                out.add((s, re_))
            if not expr.ordered and s - 1 - expr.distance <= re_ < s:
                out.add((rs, e))
    return out


def _tree(rng, depth):
    if depth == 0 or rng.random() < .3:
        word = rng.choice(["a", "b", "c", "ab", "ca", "bc"])
        return rng.choice([P.prox_str(word), P.prox_regex(word + ".?"), P.prox_array(word, P.prox_regex("c.a"))])
    return P.Pair(_tree(rng, depth - 1), rng.randrange(4), _tree(rng, depth - 1), rng.random() < .4)


def test_random_trees_are_the_plain_ones(index):
    rng = random.Random(12)
    exprs = {i: _tree(rng, 1 + i % 3) for i in range(25)}
    texts = {r["id"]: (r["description"] or "").split() for r in index.docs.collect()}
    want = sorted((q, d) for q, e in exprs.items() for d, words in texts.items() if _spans(e, words))
    assert rows(P.proximity(index, "description", exprs), "query_id", "doc_id") == want and len(want) > 200


def test_proximity_plan_depends_on_depth_only(index):
    def size(n):
        exprs = {i: P.prox_str("abc"[i % 3]).within(1 + i % 4, P.prox_regex("a.*"), i % 2 == 0) for i in range(n)}
        return len(P.proximity(index, "description", exprs)._jdf.queryExecution().optimizedPlan().toString().split("\n"))

    assert size(2) == size(60)
    assert P.proximity(index, "description", {}).count() == 0
