"""Phrase slop against an exhaustive search on random small documents.

Contract: every query slot i takes a distinct position p_i holding its term,
and max(p_i − i) − min(p_i − i) ≤ slop.  Repeated terms are included, so the
greedy distinct-position path is exercised as well as the bit-mask path.
"""

import itertools
import random
import tempfile

from lodestar.operators import search as S
from lodestar.operators.index import Field, build_index


def brute(doc, phrase, slop):
    pos = {}
    for i, t in enumerate(doc):
        pos.setdefault(t, []).append(i)
    choices = [pos.get(t, []) for t in phrase]
    for combo in itertools.product(*choices):
        if len(set(combo)) < len(combo):
            continue
        shifts = [p - i for i, p in enumerate(combo)]
        if max(shifts) - min(shifts) <= slop:
            return True
    return False


def test_slop_matches_exhaustive_search(spark):
    rnd = random.Random(11)
    words = ["a", "b", "c"]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 10)))) for i in range(40)]
    phrases = [(q, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 3)))) for q in range(25)]
    df = spark.createDataFrame(docs, "id bigint, t string")
    idx = build_index(df, "id", [Field("t")]).save(tempfile.mkdtemp(prefix="lodestar-slop-"))
    qs = spark.createDataFrame(phrases, "query_id bigint, query string")
    for slop in range(4):
        got = {(r.query_id, r.doc_id) for r in S.phrase(idx, qs, "t", q=S.Query(slop=slop)).collect()}
        want = {(q, d) for q, p in phrases for d, text in docs if brute(text.split(), p.split(), slop)}
        assert got == want, (slop, sorted(got ^ want)[:5])


def test_proximity_pairs_match_exhaustive_search(spark):
    from lodestar.operators import proximity as P

    rnd = random.Random(5)
    words = ["a", "b", "c", "d"]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 12)))) for i in range(40)]
    df = spark.createDataFrame(docs, "id bigint, t string")
    idx = build_index(df, "id", [Field("t")]).save(tempfile.mkdtemp(prefix="lodestar-prox-"))
    cases = [(x, y, d, o) for x in "ab" for y in "bc" for d in (0, 2) for o in (False, True)]
    exprs = {i: P.prox_str(x).within(d, y, o) for i, (x, y, d, o) in enumerate(cases)}
    got = {(r.query_id, r.doc_id) for r in P.proximity(idx, "t", exprs).collect()}
    want = set()
    for i, (x, y, d, o) in enumerate(cases):
        for doc_id, text in docs:
            toks = text.split()
            px = [k for k, t in enumerate(toks) if t == x]
            py = [k for k, t in enumerate(toks) if t == y]
            if any(p != q and abs(p - q) - 1 <= d and (q > p or not o) for p in px for q in py):
                want.add((i, doc_id))
    assert got == want, sorted(got ^ want)[:5]
