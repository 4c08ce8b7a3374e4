"""The pipeline's stages, each judged on its own input, and the whole run over planted documents."""

import random

import pytest

import corpus_pipeline
from lodestar.llm import decontaminate, language_id, packing, quality_rules

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = {"en": "the and of to in is that it was for on are with as his they at be this have".split(),
         "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split()}


def _prose(rng, lang, n=80):
    own = [f"{w}{rng.choice('aeiou')}{rng.choice('nrst')}" for w in WORDS[lang]]
    lines = []
    while n > 0:
        k = rng.randrange(6, 12)
        lines.append(" ".join(rng.choice(WORDS[lang] + own) + (str(rng.randrange(90)) if rng.random() < .1 else "") for _ in range(k)).capitalize() + ".")
        n -= k
    return "\n".join(lines)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(2)
    rows = [(i, _prose(rng, "en" if i % 3 else "de"), "en" if i % 3 else "de") for i in range(240)]
    passage = _prose(rng, "en", 40).replace("\n", " ")
    rows += [(300 + i, rows[i][1], rows[i][2]) for i in range(20)]  # exact copies
    rows += [(400 + i, rows[i][1] + " tail", rows[i][2]) for i in range(20, 40)]  # near copies
    rows += [(500 + i, _prose(rng, "en") + "\n" + passage, "en") for i in range(10)]  # benchmark passages
    rows += [(600 + i, t, None) for i, t in enumerate([None, "", "12 34 !!", "short text"])]  # nothing to keep
    rows += [(700 + i, "spam buy now " * 60, "en") for i in range(5)]  # repeated words
    path = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], SCHEMA).repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, passage), (2, "never seen words stand here " * 3)], "item_id bigint, text string").write.parquet(
        f"{path}/benchmark.parquet")
    return str(path)


def _ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_and_run(spark, folder):
    """Every stage keeps what its operator says of its own input; run() is the chain of them."""
    docs, said = spark.read.parquet(f"{folder}/documents.parquet"), {}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "quality_rules", "near_dedup", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, before, folder).checkpoint()
        assert docs.columns == before.columns
        said[name] = set(_ids(before)) - set(_ids(docs))
        kept = set(_ids(docs))
        if name == "language_id":
            found = language_id.predict(before, language_id.fit(before)).select("row.doc_id", "lang_pred", "score").collect()
            assert kept == {r["doc_id"] for r in found if r["lang_pred"] != "und" and r["score"] >= 0.5}
            assert {600, 601, 602} <= said[name]
        elif name == "quality_rules":
            assert kept == {r["doc_id"] for r in quality_rules.judged(before).where("kept").collect()}
            assert {700 + i for i in range(5)} <= said[name]
        elif name == "near_dedup":
            there = set(_ids(before))
            copies = {300 + i for i in range(20) if {i, 300 + i} <= there} | {400 + i for i in range(20, 40) if {i, 400 + i} <= there}
            assert said[name] == copies and len(copies) > 20
        else:
            assert said[name] == {500 + i for i in range(10)} & set(_ids(before))
            assert kept == set(_ids(decontaminate.keep_clean(before, spark.read.parquet(f"{folder}/benchmark.parquet"))))
    clean = set(range(240)) - set().union(*said.values())
    assert len(clean) > 200  # clean documents are left alone
    pieces = corpus_pipeline.run(spark, folder).collect()
    want = packing.pack(docs, corpus_pipeline.vocabulary_path()).select("doc_id", "piece", "length", "ids_crc32").collect()
    assert sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in pieces) == sorted(map(tuple, want))
    fill = {}
    for r in pieces:
        fill.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
