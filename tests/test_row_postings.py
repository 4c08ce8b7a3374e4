"""Postings and term statistics made document by document."""

import re

from pyspark.sql import functions as F

from lodestar.functions import analysis as A
from lodestar.operators import index as I
from lodestar.operators.index import Field, build_index
from tests.conftest import rows


def plan(df):
    return df._jdf.queryExecution().toString()


def _grouped(docs, key, field):
    return (I.token_rows(docs, key, [field]).groupBy("field", "term", "doc_id")
            .agg(F.count("*").cast("int").alias("tf"), F.max("dl").alias("dl"), F.sort_array(F.collect_list("pos")).alias("positions")))


def _rows(df):
    return sorted(((r["field"], r["term"], r["doc_id"], r["tf"], r["dl"], r["positions"]) for r in df.collect()), key=repr)


ODD = [(1, "b a b"), (1, "a"), (None, "x a"), (None, "x"), (2, None), (3, ""), (4, "the end"), (4, "the end"), (5, "é 中文 😀 é")] + [
    (6, f"w{i % 3} w") for i in range(25)] + [(i, f"w{i} w w{i % 5}") for i in range(10, 40)]


def test_postings_of_repeated_and_null_keys(spark, monkeypatch):
    monkeypatch.setattr(I, "TOKENS", 7)
    docs = spark.createDataFrame(ODD, "id bigint, text string").withColumn("tags", F.array("text", F.lit("a b"), F.lit(None)))
    try:
        for size in ("4", "10000"):  # the rows of a key may cross batches
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            for field in (Field("text"), Field("text", A.ngram(2, 3)), Field("text", A.edge_ngram(1, 3)), Field("tags", is_array=True)):
                got = I.row_postings(docs.repartition(3, "id"), "id", [field])
                assert _rows(got) == _rows(_grouped(docs, "id", field))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_postings_are_made_without_sorting_tokens(spark):
    docs = spark.createDataFrame(ODD, "id bigint, text string")
    made = plan(build_index(docs, "id", [Field("text")]).postings)
    assert "Aggregate" not in made and "Generate" not in made


def test_term_statistics_group_by_term_only(spark):
    from lodestar.plans.text_queries import term_stats

    docs = spark.createDataFrame(ODD, "id bigint, text string")
    for tok in (A.unicode_words(), A.ngram(2, 4), A.literal()):
        toks = docs.select(F.col("id").alias("doc_id"), F.inline(tok.tokens("text")))
        old = toks.groupBy("term").agg(F.countDistinct("doc_id").alias("df"), F.count("*").alias("cf"))
        assert rows(term_stats(docs, "id", "text", tok), "term", "df", "cf") == rows(old, "term", "df", "cf")
    keys = re.findall(r"Aggregate\(keys=\[(.*?)\]", plan(term_stats(docs, "id", "text", A.ngram(2, 4))))
    assert keys and not [k for k in keys if "doc_id" in k]
