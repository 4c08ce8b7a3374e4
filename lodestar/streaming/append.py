"""Append rows to a stored index, in batches or from a stream.

A batch writes its own postings, document lengths and vectors under
``appends/<batch>/`` with overwrite mode, so a re-delivered batch replaces
itself instead of doubling rows.  Batches of a stream are named by the stream's
checkpoint and its micro-batch id, so two streams never share a name; a name
that comes back with other rows is refused.  Vocabulary, field statistics and
grams are written per batch too and added up where they are read, so an append
reads its own rows only; the ``_meta`` pointer is rewritten last.
``SearchIndex.open`` returns the index with every batch.  ``compact`` folds the
batches into a new index, whose lookups read one vocabulary and bucketed rows again.

The rows are indexed as the index was built: same fields, expressions,
predicate and vector fields.  An index whose predicate or expressions were
given as Columns cannot store them; appending to it raises.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.index import SearchIndex, _field_stats, build_index, save_grams, term_statistics
from ..operators.vector_lists import append_lists


def _read_meta(spark, path):
    return json.loads(spark.read.text(f"{path}/_meta").first()[0])


def content_mark(rows: DataFrame) -> str:
    """Row count and an order-free checksum of the rows."""
    r = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(F.to_json(F.struct("*"))).cast("decimal(38,0)")).alias("h")).first()
    return f"{r['n']}-{r['h']}"


def append(spark: SparkSession, path: str, rows: DataFrame, batch_id: int | str) -> SearchIndex:
    """Add ``rows`` as batch ``batch_id`` and return the index with them."""
    batch = f"b{batch_id:012d}" if isinstance(batch_id, int) else batch_id
    idx = SearchIndex.open(spark, path)
    meta = _read_meta(spark, path)
    unstored = [f["name"] for f in meta["fields"] if f["is_column"]]
    if unstored or (idx.partial and idx.where is None):
        raise ValueError(f"fields {unstored} or the predicate of the index are not stored as SQL text")
    batches = dict(meta.get("batches", {}))
    mark = content_mark(rows)
    if batches.get(batch, mark) != mark:
        raise ValueError(f"batch {batch!r} was appended before with other rows")
    new = build_index(rows, idx.key, list(idx.fields.values()), list(idx.vector_fields.values()),
                      idx.search_tokenizer, idx.where, buckets=idx.buckets, term_parts=idx.term_parts)
    folder = f"{path}/appends/{batch}"
    if idx.fields:
        new.postings.write.mode("overwrite").parquet(f"{folder}/postings")
        new.doclens.write.mode("overwrite").parquet(f"{folder}/doclens")
    if new.vectors is not None:
        new.vectors.write.mode("overwrite").parquet(f"{folder}/vectors")
        vectors = spark.read.schema(new.vectors.schema).parquet(f"{folder}/vectors")
        for name, lists in idx.lists.items():
            append_lists(vectors.where(F.col("field") == name), lists, f"{folder}/lists/{name}", idx.vector_fields[name].clusters)
    if idx.fields:
        own = spark.read.schema(new.postings.schema).parquet(f"{folder}/postings")
        lens = spark.read.schema(new.doclens.schema).parquet(f"{folder}/doclens")
        _field_stats(lens).coalesce(1).write.mode("overwrite").parquet(f"{folder}/fields")
        # where the base keeps a term's postings does not change: a batch makes no term hot
        term_statistics(own).withColumn("hot", F.lit(False)).write.mode("overwrite").parquet(f"{folder}/terms")
        save_grams(spark.read.parquet(f"{folder}/terms"), folder)
    batches[batch] = mark
    meta["batches"] = batches
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(
        f"{path}/_meta")
    return SearchIndex.open(spark, path)


def compact(spark: SparkSession, path: str, target: str) -> SearchIndex:
    """Write the index under ``path`` with all its batches as one index under ``target`` (readers of
    ``path`` go on), and return it.  Vector lists are trained again."""
    idx = SearchIndex.open(spark, path)
    postings = idx.postings.repartition(idx.buckets, "doc_id") if idx.fields else idx.postings
    whole = SearchIndex(spark, idx.key, list(idx.fields.values()), list(idx.vector_fields.values()), postings, idx.terms,
                        idx.stats, idx.doclens, idx.vectors, search_tokenizer=idx.search_tokenizer, name=idx.name)
    whole.buckets, whole.term_parts, whole.hot_df, whole.rare_parts = idx.buckets, idx.term_parts, idx.hot_df, idx.rare_parts
    whole.where, whole.partial = idx.where, idx.partial
    return whole.save(target)


def open_appended(spark: SparkSession, path: str) -> SearchIndex:
    """The stored index with every appended batch (what ``SearchIndex.open`` returns)."""
    return SearchIndex.open(spark, path)


def stream_append(stream: DataFrame, path: str, checkpoint: str, trigger_once: bool = True):
    """Start a streaming query that appends every micro-batch to the index."""
    spark = stream.sparkSession
    name = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]

    def each(batch_df, epoch_id):
        if not batch_df.isEmpty():
            append(spark, path, batch_df, f"s{name}-{epoch_id:012d}")

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
