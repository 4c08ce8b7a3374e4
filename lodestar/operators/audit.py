"""Index audits: consistency checks, segment listing, index catalogue.

Each check is a distributed count of violations; all checks of an index are
one ``union`` of one-row aggregates, so they run as a single job.
A segment is ``pmod(xxhash64(doc_id), SEGMENTS)`` — a stable hash bucket of
the key, computed on the fly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .index import SearchIndex

SEGMENTS = 8


def _integral(df: DataFrame) -> bool:
    return dict(df.dtypes)["doc_id"] in ("tinyint", "smallint", "int", "bigint")


def segment_of(doc_id, integral: bool = True) -> F.Column:
    """Segment of a key: ``pmod(key, SEGMENTS)`` for integer keys, else of its xxhash64."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(c.cast("bigint") if integral else F.xxhash64(c), F.lit(SEGMENTS)).cast("int")


def _keep(df: DataFrame, sample_rate: float | None, segment_ids) -> DataFrame:
    if sample_rate is not None:
        df = df.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(sample_rate * 1_000_000))
    if segment_ids is not None:
        df = df.where(segment_of("doc_id", _integral(df)).isin(list(segment_ids)))
    return df


def _row(name: str, bad: F.Column, total: F.Column) -> list:
    return [F.lit(name).alias("check_name"), (bad == 0).alias("passed"),
            F.format_string("%d violations in %d rows", bad, total).alias("details")]


def verify_index(index: SearchIndex, heap_all_indexed: bool = False, sample_rate: float | None = None,
                 on_error_stop: bool = False, segment_ids=None, source: DataFrame | None = None) -> DataFrame:
    """(check_name, passed, details) per check."""
    p = _keep(index.postings, sample_rate, segment_ids)
    dl = _keep(index.doclens, sample_rate, segment_ids)
    checks = []
    # df in the vocabulary = distinct documents in postings
    dfp = p.groupBy("field", "term").agg(F.countDistinct("doc_id").alias("n"))
    if sample_rate is None and segment_ids is None:
        j = dfp.join(index.terms, ["field", "term"], "full")
        bad = F.sum(F.when(F.coalesce(F.col("n"), F.lit(-1)) != F.coalesce(F.col("df"), F.lit(-2)), 1).otherwise(0))
        checks.append(j.agg(*_row("doc_frequency", F.coalesce(bad, F.lit(0)), F.count("*"))))
    # dl = Σ tf over the document's postings
    s = p.groupBy("field", "doc_id").agg(F.sum("tf").alias("s"), F.max("dl").alias("pdl"))
    j = s.join(dl, ["field", "doc_id"], "left")
    bad = F.sum(F.when((F.col("s") != F.col("pdl")) | F.col("dl").isNull() | (F.col("dl") != F.col("s")), 1).otherwise(0))
    checks.append(j.agg(*_row("doc_length", F.coalesce(bad, F.lit(0)), F.count("*"))))
    bad = F.sum(F.when(F.size("positions") != F.col("tf"), 1).otherwise(0))
    checks.append(p.agg(*_row("positions_length", F.coalesce(bad, F.lit(0)), F.count("*"))))
    dup = p.groupBy("field", "term", "doc_id").count()
    bad = F.sum(F.when(F.col("count") > 1, 1).otherwise(0))
    checks.append(dup.agg(*_row("unique_postings", F.coalesce(bad, F.lit(0)), F.count("*"))))
    if heap_all_indexed:
        if source is None:
            source = index.docs
        if index.where is not None:
            source = source.where(index.where)
        parts = []
        for name, f in index.fields.items():
            col = f.column()
            keys = _keep(source.where(col.isNotNull()).select(F.col(index.key).alias("doc_id")), sample_rate, segment_ids)
            there = dl.where(F.col("field") == name).select("doc_id", F.lit(0).alias("x")).distinct()
            parts.append(keys.join(there, "doc_id", "left").select(F.coalesce("x", F.lit(1)).alias("x")))
        miss = parts[0]
        for q in parts[1:]:
            miss = miss.unionByName(q)
        checks.append(miss.agg(*_row("all_rows_indexed", F.coalesce(F.sum("x"), F.lit(0)), F.count("*"))))
    if on_error_stop:  # one check after the other; the first that fails is the last that runs
        done = []
        for c in checks:
            done.append(c.first())
            if not done[-1]["passed"]:
                break
        return index.spark.createDataFrame(done, "check_name string, passed boolean, details string")
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out.select("check_name", "passed", "details")


def verify_all_indexes(indexes: dict, schema_pattern: str | None = None, index_pattern: str | None = None,
                       schema: str = "public", **kw) -> DataFrame:
    """Checks of every index whose name is LIKE ``index_pattern`` (and schema LIKE ``schema_pattern``)."""
    spark = next(iter(indexes.values())).spark
    names = spark.createDataFrame([(schema, n) for n in indexes], "schemaname string, indexname string")
    if schema_pattern:
        names = names.where(F.col("schemaname").like(schema_pattern))
    if index_pattern:
        names = names.where(F.col("indexname").like(index_pattern))
    keep = [r[0] for r in names.select("indexname").collect()]  # catalogue rows, not data
    parts = [verify_index(indexes[n], **kw).select(F.lit(n).alias("indexname"), "*") for n in keep]
    if not parts:
        return spark.createDataFrame([], "indexname string, check_name string, passed boolean, details string")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def index_segments(index: SearchIndex) -> DataFrame:
    """(partition_name, segment_idx, segment_id, num_docs, num_deleted, max_doc)."""
    d = index.doclens.select("doc_id").distinct()
    d = d.withColumn("seg", segment_of("doc_id", _integral(d)))
    g = d.groupBy("seg").agg(F.count("*").alias("num_docs"))
    return g.select(F.lit(index.name).alias("partition_name"), F.col("seg").alias("segment_idx"),
                    F.format_string("%s-%04d", F.lit(index.name), F.col("seg")).alias("segment_id"),
                    F.col("num_docs").cast("bigint"), F.lit(0).cast("bigint").alias("num_deleted"),
                    F.col("num_docs").cast("bigint").alias("max_doc"))


def indexes(catalogue: dict, schema: str = "public", tables: dict | None = None) -> DataFrame:
    """(schemaname, tablename, indexname, indexrelid, num_segments, total_docs)."""
    parts = []
    for name, idx in sorted(catalogue.items()):
        d = idx.doclens.select("doc_id").distinct()
        parts.append(d.agg(F.count("*").alias("total_docs"),
                           F.countDistinct(segment_of("doc_id", _integral(d))).alias("num_segments"))
                     .select(F.lit(schema).alias("schemaname"),
                             F.lit((tables or {}).get(name, name)).alias("tablename"),
                             F.lit(name).alias("indexname"), "num_segments", "total_docs"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    ids = idx.spark.createDataFrame([(n, i + 1) for i, n in enumerate(sorted(catalogue))],
                                    "indexname string, indexrelid bigint")
    return out.join(F.broadcast(ids), "indexname").select(  # one row per catalogued index
        "schemaname", "tablename", "indexname", "indexrelid", F.col("num_segments").cast("int"),
        F.col("total_docs").cast("bigint"))
