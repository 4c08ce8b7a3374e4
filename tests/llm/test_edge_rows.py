"""Every operator and stage on the awkward rows: nulls, empty and very long
texts, ties, repeated rows, empty tables, extra columns with clashing names."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lodestar.llm import (
    decontaminate,
    language_id,
    license_scan,
    near_dedup,
    packing,
    quality_rules,
    resampling,
    sharding,
    token_counts,
)

PROSE = " ".join(f"word{i % 97} stands{i % 31} here." for i in range(40))
LONG = " ".join(f"tok{i}" for i in range(60_000)) + " " + "x" * 3_000_000
ROWS = [
    (1, PROSE, "en", "a", 1),
    (2, PROSE, "en", "a", 1),
    (2, PROSE, "en", "a", 1),
    (3, "", "en", "a", 0),
    (4, None, None, None, None),
    (None, "no id at all", "en", "a", 12),
    (5, LONG, "de", "b", len(LONG)),
    (6, " \n\t ", "de", "b", 4),
    (7, "Größe 中文 😀 naïve", "de", "b", 1),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# names the operators use themselves
CLASHES = ["row", "n_words", "kept", "id", "hits", "items", "cell", "rank", "tokens", "component", "score", "gone", "node"]


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    return d.select("*", *[F.lit("clash").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, PROSE), (1, PROSE), (2, None), (3, ""), (None, "größe 中文"), (4, "absent words")],
                                 "item_id bigint, text string")


def by_id(df, column):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(r[column])
    return out


def test_language(docs):
    net = language_id.fit(docs, language_id.Training(epochs=1, steps=1))
    got = by_id(language_id.predict(docs, net).select("row.doc_id", "lang_pred"), "lang_pred")
    assert got[3] == got[4] == got[6] == ["und"] and got[2][0] == got[2][1] != "und"
    kept = language_id.keep_known(docs, least=0.0, how=language_id.Training(epochs=1, steps=1))
    assert kept.columns == docs.columns and kept.count() == 6


def test_language_without_labels(docs):
    net = language_id.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert language_id.predict(docs, net).where("lang_pred <> 'und' or score <> 0").count() == 0


def test_quality(docs):
    got = quality_rules.judged(docs)
    assert got.count() == len(ROWS)
    r = {x["doc_id"]: x for x in got.collect()}
    for empty in (3, 4, 6):
        assert r[empty]["n_words"] == 0 and r[empty]["base_failed"] and not r[empty]["kept"]
    assert r[5]["n_words"] == 60_001 and r[7]["word_chars"] == 13
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted(x["doc_id"] for x in got.where("kept").collect())


def test_near_dedup(docs):
    got = near_dedup.near_duplicates(docs)
    assert got.count() == len(ROWS)
    comp = by_id(got, "component_id")
    assert comp[1] == [1] and comp[2] == [1, 1] and comp[3] == [3] and comp[4] == [4] and comp[None] == [None]
    assert by_id(got, "n_shingles")[4] == [0]
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 3, 4, 5, 6, 7, None}


def test_decontamination(docs, benchmark):
    got = {r["doc_id"]: r for r in decontaminate.digest(decontaminate.contamination(docs, benchmark)).collect()}
    assert got[1]["n_items"] == 1 and got[1]["n_hit"] == got[1]["n_words"] and got[7]["n_hit"] == 2
    assert got[4]["n_words"] == 0 and not got[5]["contaminated"]
    kept = decontaminate.keep_clean(docs, benchmark)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {3, 4, 5, 6, None}


def test_packing(docs):
    got = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    rows = got.collect()
    by_row = [r for r in rows if r["doc_id"] in (3, 4, 6)]
    assert [r["length"] for r in by_row] == [1, 1, 1]
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(r["doc_id"] == 2 and r["piece"] == 0 for r in rows) == 2


def test_sharding(docs):
    rows = sharding.ring_shards(docs, 4).collect()
    sizes = {}
    for r in rows:
        sizes.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(map(len, sizes.values())) == [2, 2, 2, 3]
    assert all(sorted(s) == list(range(len(s))) for s in sizes.values())
    assert {r["doc_id"]: r["size"] for r in rows}[4] == 8


def test_license(docs):
    got = license_scan.scan(docs)
    assert got.count() == len(ROWS) and got.where("score > 0").count() == 0


def test_tokens(docs):
    got = by_id(token_counts.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model")), "n_tokens")
    assert got[3] == got[4] == got[6] == [0] and got[2][0] == got[2][1] > 0


def test_resampling(docs):
    got = resampling.resample(docs, docs.where("doc_id = 1").select("doc_id"), share=0.5)
    assert got.count() == len(ROWS) and got.where("selected").count() >= 5
    assert set(by_id(got.where("doc_id in (3, 4)"), "log_weight")[3]) == {0.0}


def test_empty_tables(spark, docs, benchmark):
    none = docs.limit(0)
    words = public_tokenizers.path("word_bpe_49k.json")
    for df in (language_id.keep_known(none), quality_rules.keep_good(none), near_dedup.keep_one(none),
               decontaminate.keep_clean(none, benchmark), packing.pack(none, words), sharding.ring_shards(none, 4),
               license_scan.scan(none), resampling.resample(none, none.select("doc_id")),
               quality_rules.judged(none), near_dedup.near_duplicates(none)):
        assert df.count() == 0
    assert decontaminate.keep_clean(docs, benchmark.limit(0)).count() == len(ROWS)
