"""Plan shape: the properties the scale design relies on."""

import os

from pyspark.sql import functions as F

from lodestar.operators import search as S
from lodestar.operators.index import Field, build_index
from lodestar.operators.joins import join_small
from lodestar.streaming.append import append


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_small_broadcasts_only_under_the_bound(spark):
    big = spark.range(1000).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in _plan(join_small(big, small, "k"))
    # above the bound no hint is given: with Spark's own size-based broadcast
    # switched off the join is a shuffled one
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        over = join_small(big, small, "k", max_bytes=16)
        assert "BroadcastExchange" not in _plan(over)
        assert over.count() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_match_of_hot_terms_has_no_shuffle(spark, docs, tmp_path):
    index = build_index(docs, "id", [Field("description")], hot_df=1).save(str(tmp_path))
    q = spark.createDataFrame([(1, "running shoes")], "query_id bigint, query string")
    plan = _plan(S.match_any(index, q, "description"))
    assert "Bucketed: true" in plan or "bucketed" in plan.lower()
    assert "Exchange hashpartitioning" not in plan


def test_per_query_top_k_limits_before_shuffle(spark, index):
    q = spark.createDataFrame([(1, "running shoes the")], "query_id bigint, query string")
    plan = S.top_k(S.match_any(index, q, "description"), 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_bucket_count_follows_input_size(spark, tmp_path):
    from lodestar.operators import index as I

    p = str(tmp_path / "t")
    spark.range(1000).write.parquet(p)
    df = spark.read.parquet(p)
    par = spark.sparkContext.defaultParallelism
    assert I.default_buckets(spark, df) == par
    old = I.BUCKET_TARGET_BYTES
    try:
        I.BUCKET_TARGET_BYTES = 64  # tiny target: many buckets
        assert I.default_buckets(spark, df) > par
    finally:
        I.BUCKET_TARGET_BYTES = old


def test_bucket_count_follows_the_values_not_their_files(spark, tmp_path, monkeypatch):
    from lodestar.operators import index as I

    p, text = str(tmp_path / "t"), "repeated words of one text " * 40
    spark.range(3000).select("id", F.lit(text).alias("text")).coalesce(1).write.parquet(p)
    df = spark.read.parquet(p)
    monkeypatch.setattr(I, "BUCKET_TARGET_BYTES", 1 << 18)
    assert sum(os.path.getsize(f"{p}/{f}") for f in os.listdir(p)) < 1 << 18 < 3000 * len(text) // 8
    assert I.build_index(df, "id", [I.Field("text")]).buckets >= 3000 * len(text) >> 18


def _files(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def _files_opened(df):
    """Rows of ``df`` and how many files its scans opened."""
    n, leaves = len(df.collect()), df._jdf.queryExecution().executedPlan().collectLeaves()
    return n, sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def _words(spark, *words):
    return spark.createDataFrame([(w,) for w in words], "term string")


def test_term_lookup_reads_only_its_parts(spark, docs, tmp_path):
    """One hot word: a partition filter on one term part, the word pushed to the scan, few of the files."""
    index = build_index(docs, "id", [Field("description")], hot_df=1).save(str(tmp_path))
    q = spark.createDataFrame([(1, "sleek")], "query_id bigint, query string")
    plan = _plan(S.term(index, q, "description"))
    assert "tpart" in plan.split("PartitionFilters")[1].split("]")[0] and "EqualTo(term,sleek)" in plan
    p = S.field_postings(index, "description")
    assert len(_files(S.pruned_postings(index, "description", _words(spark, "sleek")))) < len(_files(p)) / 2


def test_rare_word_opens_one_file(spark, tmp_path):
    """An index of 64 buckets: a rare word is read from its part, a frequent one from the buckets."""
    rows = [(i, f"every word{i % 40} once{i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "id bigint, description string")
    index = build_index(docs, "id", [Field("description")], buckets=64, hot_df=100).save(str(tmp_path))
    assert index.terms.where("hot").select("term").collect()[0][0] == "every" and index.hot_df == 100
    assert index.rare.where("term = 'every'").count() == 0
    for word, n in (("once7", 1), ("word9", 10)):
        found = S.pruned_postings(index, "description", _words(spark, word))
        assert _files_opened(found) == (n, 1)
        q = spark.createDataFrame([(1, word)], "query_id bigint, query string")
        assert "rpart" in _plan(S.term(index, q, "description")) and S.term(index, q, "description").count() == n
    assert _files_opened(S.pruned_postings(index, "description", _words(spark, "every")))[1] > 30
    both = S.pruned_postings(index, "description", _words(spark, "every", "once7", "absent"))
    assert both.count() == 401
    whole = S.field_postings(index, "description")
    many = _words(spark, *[f"once{i}" for i in range(S.LITERAL_TERMS + 1)])
    assert S.pruned_postings(index, "description", many).columns == whole.columns
    q = many.select(F.lit(1).alias("query_id"), F.array("term").alias("query"))
    assert S.match_any(index, q, "description").count() == S.LITERAL_TERMS + 1


def test_appended_rows_are_found_in_both_layouts(spark, tmp_path):
    ddl = "id bigint, description string"
    first = spark.createDataFrame([(i, f"every word{i % 5}") for i in range(50)], ddl)
    build_index(first, "id", [Field("description")], buckets=4, hot_df=20).save(str(tmp_path))
    index = append(spark, str(tmp_path), spark.createDataFrame([(100, "every word1 fresh"), (101, "fresh every")], ddl), 1)
    q = spark.createDataFrame([(1, "every"), (2, "word1"), (3, "fresh")], "query_id bigint, query string")
    got = S.match_any(index, q, "description").groupBy("query_id").count()
    assert {r["query_id"]: r["count"] for r in got.collect()} == {1: 52, 2: 11, 3: 2}
    assert {r["term"]: r["hot"] for r in index.terms.collect()}["every"]
