"""Many more-like-this sources: frequent terms are looked up instead of walked, postings come packed, passes are few."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestar.operators import joins as J
from lodestar.operators import mlt as M
from lodestar.operators import search as S
from lodestar.operators import topk as T
from lodestar.operators.index import Field, build_index
from tests.conftest import rows

RANKED = ("query_id", "rank", "doc_id", "score")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rng = np.random.default_rng(3)
    texts = [(i, " ".join(f"w{int(x)}" for x in 300 ** rng.random(rng.integers(1, 50)))) for i in range(400)]
    texts += [(400, None), (401, ""), (402, texts[7][1]), (403, texts[7][1])]
    docs = spark.createDataFrame(texts, "id bigint, a string").withColumn("b", F.substring("a", 1, 30))
    return build_index(docs, "id", [Field("a"), Field("b")], hot_df=20, buckets=3).save(str(tmp_path_factory.mktemp("many")))


@pytest.fixture(scope="module")
def sources(spark):
    return spark.createDataFrame([(i // 2, i * 3) for i in range(130)] + [(70, 7), (71, 999)], "query_id bigint, src_id bigint")


def _scored(batch, postings):
    term, doc, length, weight = (np.array(x) for x in zip(*postings, strict=True))
    (query, at, score), docs, scored = batch.best(term.astype(np.int64), pa.array(doc.astype(np.int64)), length, weight)
    got = {}
    for q, d, s in zip(batch.query_ids.take(pa.array(query)).to_pylist(), docs.take(pa.array(at)).to_pylist(), score, strict=True):
        got.setdefault(q, []).append((d, round(float(s), 6)))
    return {q: sorted(b, key=lambda x: (-x[1], x[0]))[:batch.k] for q, b in got.items()}, scored


def test_frequent_terms_are_looked_up_not_walked(monkeypatch):
    """Every block holds documents of a query's telling term, so none is skipped as a whole."""
    monkeypatch.setattr(T, "BLOCK", 250)
    rng, n, k = np.random.default_rng(1), 4000, 5
    queries = [(q, f"t{t}", idf) for q in range(30) for t, idf in ((q, 6.0), (100, 0.3), (101, 0.2), (102, 0.1))]
    batch = T.Batch(pa.table(dict(zip(("query_id", "field", "term", "idf"), zip(*[(q, "a", t, i) for q, t, i in queries]), strict=True))), k)
    postings = [(batch.number["a", f"t{t}"], int(d), 10, float(rng.random() + 0.5))
                for t in (*range(30), 100, 101, 102) for d in (range(n) if t >= 100 else rng.choice(n, 200, replace=False))]
    weight = {}
    for t, d, _, w in postings:
        weight.setdefault(t, {})[d] = w
    want = {}
    for q in range(30):
        sums = {}
        for _, t, idf in (x for x in queries if x[0] == q):
            for d, w in weight[batch.number["a", t]].items():
                sums[d] = sums.get(d, 0) + idf * w
        want[q] = sorted(((d, round(s, 6)) for d, s in sums.items()), key=lambda x: (-x[1], x[0]))[:k]
    got, scored = _scored(batch, postings)
    every = sum(len(weight[batch.number["a", t]]) for _, t, _ in queries)
    assert got == want and scored < 0.3 * every


@pytest.mark.parametrize("parts", [{}, {"BLOCK": 16}, {"CHUNK": 50, "SLICE": 30}, {"TASK_POSTINGS": 40}, {"CELLS": 20, "BLOCK": 16},
                                   {"MUCH": 0, "LEAD": 3}, {"MUCH": 0, "LEAD": 1}, {"MUCH": 0, "PASS_ROWS": 400, "LEAD": 4}])
def test_same_rows_however_the_work_is_cut(stored, sources, monkeypatch, parts):
    want = rows(S.top_k(S.rounded(M.more_like_this_id(stored, sources)), 5), *RANKED)
    for name, value in parts.items():
        monkeypatch.setattr(T, name, value)
    assert rows(M.most_like_this_id(stored, sources, 5), *RANKED) == want != []


def test_kept_and_left_out_documents_with_a_lead(spark, stored, sources, monkeypatch):
    monkeypatch.setattr(T, "MUCH", 0)
    monkeypatch.setattr(T, "LEAD", 3)
    keep = stored.docs.where("id % 3 < 2").select(F.col("id").alias("doc_id"))
    every = M.more_like_this_id(stored, sources, exclude_sources=True).join(keep, "doc_id", "left_semi")
    want = rows(S.top_k(S.rounded(every), 4), *RANKED)
    assert rows(M.most_like_this_id(stored, sources, 4, exclude_sources=True, keep=keep), *RANKED) == want != []


def test_postings_of_many_terms_are_not_shuffled(stored, sources, monkeypatch):
    monkeypatch.setattr(S, "LITERAL_TERMS", 10)
    found = M.most_like_this_id(stored, sources, 5, M.MltOptions(fields=("a",)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "hashpartitioning(doc_id" not in plan


def test_passes_are_nearly_full(stored, sources, monkeypatch):
    total = sum(t.count() for t in M.source_terms(stored, sources).values())
    monkeypatch.setattr(T, "PASS_ROWS", total // 3)
    held, passes = T._held_matches, []
    monkeypatch.setattr(T, "_held_matches", lambda index, terms, known, *a: (passes.append(known.num_rows), held(index, terms, known, *a))[1])
    M.most_like_this_id(stored, sources, 5)
    assert sum(passes) == total and max(passes) <= total // 3 and len(passes) < 6


def test_documents_to_keep_are_computed_once(spark, stored, sources, monkeypatch):
    """The kept documents of a filtered search are held once, not once per pass."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    keep = spark.range(0, 300, 1, 1).withColumnRenamed("id", "doc_id").mapInArrow(count, "doc_id bigint")
    monkeypatch.setattr(T, "PASS_ROWS", 400)
    assert rows(M.most_like_this_id(stored, sources, 5, keep=keep)) and seen.value == 300


def test_a_vocabulary_beyond_the_broadcast_is_hashed(stored, sources, monkeypatch):
    monkeypatch.setattr(M, "FEW_SOURCES", 0)
    want = {f: rows(t) for f, t in M.source_terms(stored, sources).items()}
    monkeypatch.setattr(J, "BROADCAST_MAX_BYTES", 3000)
    terms = M.source_terms(stored, sources)
    assert {f: rows(t) for f, t in terms.items()} == want
    big, small = stored.terms.select("term", "df"), stored.terms.select("term", "cf")
    size = J.measured_bytes(small)
    for most, kind in ((size, "BroadcastHashJoin"), (size - 1, "ShuffledHashJoin"), (size // 100, "SortMergeJoin")):
        monkeypatch.setattr(J, "BROADCAST_MAX_BYTES", most)
        assert kind in J.join_hashed(big.hint("merge") if kind == "SortMergeJoin" else big, small, "term")._jdf.queryExecution().executedPlan().toString()
