"""Search index build: postings, vocabulary, field statistics, manifest.

An index is a handful of ordinary tables (see SURVEY §1.3):

* ``postings``  field, term, doc_id, tf, dl, positions — one row per
  (field, term, document); a table partitioned by field and by ``tpart``, a
  hash part of the term, hash-bucketed by doc_id and sorted by term inside
  each file.  A lookup reads only the parts of its terms; its (broadcast, size
  checked) terms join the buckets and aggregate per (query, document) with no
  shuffle, because the bucketing already clusters by document; a hot term is
  spread over every bucket instead of one task.
* ``rare``      the postings of rare terms once more, partitioned by field and by
  ``rpart`` (a hash part of the term; parts grow with the index) in one file per
  part, sorted by term: a lookup of a rare word opens one file, where ``postings``
  would open one per bucket
* ``terms``     field, term, df, cf, hot — ``hot`` terms have at least ``hot_df``
  documents (stored in the manifest) and are looked up in the buckets only
* ``grams``, ``gram_counts``  the vocabulary by three characters (see :mod:`.patterns`)
* ``fields``    field, n_docs, avgdl, total_tokens
* ``doclens``   field, doc_id, dl — every non-NULL row, also empty ones
* ``vectors``   field, doc_id, embedding (double, cosine rows normalised)
* ``clusters``  per vector field with :class:`Clusters`: coarse and fine centroids
  and the lists, partitioned by cell (see :mod:`.vector_lists`)
* ``manifest``  one row per field with its tokenizer, source and metric.

Build: the source rows are hash-partitioned by key into the bucket count
(the only shuffle, of raw rows), then tokenising, the per-(field, term, doc)
aggregate and the bucketed write all run inside those partitions.
"""

from __future__ import annotations

import hashlib
import json
import threading
import uuid
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.analysis import ARRAY_POSITION_GAP, DEFAULT, Tokenizer
from ..session import path_exists, work_dir
from .joins import join_small, measured_bytes
from .patterns import term_grams
from .vector_lists import Clusters, VectorLists, save_lists

VECTOR_METRICS = ("l2", "cosine", "ip")
K1, B = 1.2, 0.75  # BM25


def term_weight(tf: Column | str, dl: Column | str, avgdl: Column | str) -> Column:
    """BM25 of a posting without its idf."""
    tf, dl, avgdl = (F.col(c) if isinstance(c, str) else c for c in (tf, dl, avgdl))
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / avgdl))


def term_statistics(postings: DataFrame) -> DataFrame:
    """(field, term, df, cf) of postings."""
    return postings.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def merged_terms(tables: list[DataFrame], by=("field", "term")) -> DataFrame:
    """The vocabulary of a base and its appended batches: their statistics added up."""
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    return every.groupBy(*by).agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"), F.bool_or("hot").alias("hot"))


@dataclass(frozen=True)
class Field:
    """One indexed field: a column or expression, a tokenizer, a name."""

    source: str | Column
    tokenizer: Tokenizer = DEFAULT
    name: str | None = None
    is_array: bool = False
    is_expr: bool = False  # ``source`` is SQL text, which an index can store and append by

    def column(self) -> Column:
        if not isinstance(self.source, str):
            return self.source
        return F.expr(self.source) if self.is_expr else F.col(self.source)

    @property
    def field_name(self) -> str:
        if self.name:
            return self.name
        if self.tokenizer.alias:
            return str(self.tokenizer.alias)
        if isinstance(self.source, str) and not self.is_expr:
            return self.source
        raise ValueError("an expression field needs a name (alias)")

    def source_text(self) -> str:
        return self.source if isinstance(self.source, str) else str(self.source)


@dataclass(frozen=True)
class VectorField:
    source: str
    metric: str = "l2"
    name: str | None = None
    clusters: Clusters | None = None  # store clustered lists, searched by ``SearchIndex.lists``

    def __post_init__(self):
        if self.metric not in VECTOR_METRICS:
            raise ValueError(f"metric must be one of {VECTOR_METRICS}")

    @property
    def field_name(self) -> str:
        return self.name or self.source


def field_tokens(f: Field) -> Column:
    """``array<struct<term, pos>>`` for one field of a row."""
    col = f.column()
    tok = f.tokenizer
    if not f.is_array:
        return tok.tokens(col)
    # Each element is analysed alone; element k starts after the tokens of the
    # previous elements plus a gap, so phrases cannot span two elements.
    per_elem = F.transform(col, lambda e: F.coalesce(tok.tokens(e), F.array().cast("array<struct<term:string,pos:int>>")))
    sizes = F.transform(per_elem, lambda a: F.size(a))
    shifted = F.transform(per_elem, lambda a, k: F.transform(
        a, lambda t: F.struct(t["term"].alias("term"),
                              (t["pos"] + F.aggregate(F.slice(sizes, 1, k), F.lit(0), lambda x, y: x + y)
                               + k * ARRAY_POSITION_GAP).cast("int").alias("pos"))))
    return F.when(col.isNotNull(), F.flatten(F.when(F.size(col) > 0, shifted).otherwise(F.array().cast(
        "array<array<struct<term:string,pos:int>>>"))))


def token_rows(docs: DataFrame, key: str, fields: list[Field]) -> DataFrame:
    """(field, doc_id, dl, pos, term): one row per token of every field."""
    parts = []
    for f in fields:
        col = f.column()
        plain = None if f.is_array else f.tokenizer.plain_terms(col)
        if plain is not None:
            arr = docs.select(F.lit(f.field_name).alias("field"), F.col(key).alias("doc_id"), plain.alias("a"))
            parts.append(arr.select("field", "doc_id", F.size("a").cast("int").alias("dl"),
                                    F.posexplode("a").alias("pos", "term")))
        else:
            arr = docs.select(F.lit(f.field_name).alias("field"), F.col(key).alias("doc_id"), field_tokens(f).alias("a"))
            parts.append(arr.select("field", "doc_id", F.size("a").cast("int").alias("dl"), F.inline("a"))
                         .select("field", "doc_id", "dl", "pos", "term"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


TOKENS = 1 << 19  # tokens of whole documents that are grouped at once


def _grouped(rows: pa.RecordBatch, doc: np.ndarray, field: str) -> pa.RecordBatch:
    """Postings of rows (doc_id, terms, at); ``doc`` numbers their documents, rows of one stand together."""
    n = rows["terms"].value_lengths().fill_null(0).to_numpy()
    row = np.repeat(np.arange(len(n)), n)
    codes = rows["terms"].flatten().dictionary_encode(null_encoding="encode")
    number = codes.indices.to_numpy().astype(np.int64)
    if pa.types.is_null(rows["at"].type) or rows["at"].null_count == len(n):  # a token's place is its position
        at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    else:
        at = rows["at"].flatten().to_numpy()
    key = doc[row] * max(1, len(codes.dictionary)) + number
    order = np.lexsort((at, key))
    key = key[order]
    start = np.flatnonzero(np.concatenate((np.ones(min(1, len(key)), bool), key[1:] != key[:-1])))
    tf = np.diff(np.concatenate((start, [len(key)])))
    positions = pa.ListArray.from_arrays(pa.array(np.concatenate((start, [len(key)])), pa.int32()), pa.array(at[order], pa.int32()))
    dl = np.maximum.reduceat(n[row[order]], start) if len(start) else start
    return pa.RecordBatch.from_arrays(
        [pa.array([field], pa.string()).take(pa.array(np.zeros(len(start), np.int64))), codes.dictionary.take(pa.array(number[order[start]])),
         rows["doc_id"].take(pa.array(row[order[start]])), pa.array(tf, pa.int32()), pa.array(dl, pa.int32()), positions],
        ["field", "term", "doc_id", "tf", "dl", "positions"])


def _postings_of(batches, field: str):
    """Postings of rows (doc_id, terms, at) that come in the order of doc_id, its rows taken together."""
    kept = []  # rows of the last document so far

    def whole(parts):
        rows = pa.concat_batches(parts)
        codes = rows["doc_id"].dictionary_encode(null_encoding="encode").indices.to_numpy()
        doc = np.cumsum(np.concatenate(([0], (codes[1:] != codes[:-1]).astype(np.int64))))
        tokens = np.cumsum(rows["terms"].value_lengths().fill_null(0).to_numpy())
        first = np.concatenate((np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1]))), [len(rows)]))
        a = 0
        while a < len(first) - 1:
            done = tokens[first[a] - 1] if first[a] else 0
            z = max(a + 1, int(np.searchsorted(tokens[first[a + 1:] - 1], done + TOKENS, "right")) + a)
            yield _grouped(rows.slice(first[a], first[z] - first[a]), doc[first[a]:first[z]] - doc[first[a]], field)
            a = z

    for b in batches:
        if not len(b):
            continue
        ids = b["doc_id"]
        if kept and kept[-1]["doc_id"][0].as_py() == ids[0].as_py() == ids[len(b) - 1].as_py():
            kept.append(b)  # nothing but the last document
            continue
        codes = ids.dictionary_encode(null_encoding="encode").indices.to_numpy()
        last = len(b) - int(np.argmin(np.concatenate(((codes == codes[-1])[::-1], [False]))))
        if kept or last:
            yield from whole([*kept, b.slice(0, last)] if last else kept)
        kept = [b.slice(last)]
    if kept:
        yield from whole(kept)


def row_postings(docs: DataFrame, key: str, fields: list[Field]) -> DataFrame:
    """(field, term, doc_id, tf, dl, positions) of ``docs``, whose rows of one key must be in one
    partition: the rows are sorted by key, tokens are grouped document by document and never sorted."""
    docs = docs.sortWithinPartitions(F.col(key))
    parts = []
    for f in fields:
        plain = None if f.is_array else f.tokenizer.plain_terms(f.column())
        if plain is not None:
            rows = docs.select(F.col(key).alias("doc_id"), plain.alias("terms"), F.lit(None).cast("array<int>").alias("at"))
        else:
            rows = docs.select(F.col(key).alias("doc_id"), field_tokens(f).alias("a")).select(
                "doc_id", F.col("a.term").alias("terms"), F.col("a.pos").alias("at"))
        kind = dict(rows.dtypes)["doc_id"]
        parts.append(rows.mapInArrow(
            lambda batches, name=f.field_name: _postings_of(batches, name),
            f"field string, term string, doc_id {kind}, tf int, dl int, positions array<int>"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def doc_lengths(docs: DataFrame, key: str, fields: list[Field]) -> DataFrame:
    """(field, doc_id, dl) for every non-NULL field value, empty ones included."""
    parts = []
    for f in fields:
        col = f.column()
        plain = None if f.is_array else f.tokenizer.plain_terms(col)
        arr = plain if plain is not None else field_tokens(f)
        parts.append(docs.select(F.lit(f.field_name).alias("field"), F.col(key).alias("doc_id"),
                                 F.size(arr).cast("int").alias("dl"), arr.isNull().alias("isnull"))
                     .where(~F.col("isnull")).drop("isnull"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def empty_values(docs: DataFrame, key: str, fields: list[Field]) -> DataFrame:
    """(field, doc_id, dl=0) for non-NULL values without tokens (a cheap scan)."""
    parts = []
    for f in fields:
        col = f.column()
        if f.is_array:
            cond = col.isNotNull() & (F.size(field_tokens(f)) == 0)
        else:
            cond = col.isNotNull() & f.tokenizer.is_empty(col)
        parts.append(docs.where(cond).select(F.lit(f.field_name).alias("field"), F.col(key).alias("doc_id"),
                                             F.lit(0).alias("dl")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class SearchIndex:
    """Lazy or stored tables of one index."""

    def __init__(self, spark, key, fields, vector_fields, postings, terms, stats, doclens, vectors,
                 docs=None, search_tokenizer=None, name="index", path=None, manifest=None):
        self.spark = spark
        self.key = key
        self.fields = {f.field_name: f for f in fields}
        self.vector_fields = {v.field_name: v for v in vector_fields}
        self.postings = postings
        self.terms = terms
        self.stats = stats
        self.doclens = doclens
        self.vectors = vectors
        self.docs = docs
        self.search_tokenizer = search_tokenizer
        self.name = name
        self.path = path
        self._manifest = manifest
        self._src = None
        self.buckets = None
        self.term_parts = None
        self.rare = None  # stored postings of rare terms, clustered by term
        self.rare_parts = None
        self.hot_df = None
        self.appended = None  # postings of appended batches, where there are any
        self.lists = {}  # vector field → its stored lists
        self.grams = self.gram_counts = None  # character grams of the vocabulary
        self.term_tables = []  # stored vocabularies of the base and of every batch
        self.where = None  # SQL text of a partial index's predicate
        self.partial = False

    # -- tokenizer used on the query side --------------------------------------
    def query_tokenizer(self, field: str) -> Tokenizer:
        if self.search_tokenizer is not None:
            return self.search_tokenizer
        if field not in self.fields:
            raise KeyError(f"field {field!r} is not indexed; have {sorted(self.fields)}")
        return self.fields[field].tokenizer

    def text_fields(self) -> list[str]:
        return list(self.fields)

    def manifest(self) -> DataFrame:
        if self._manifest is not None:
            return self._manifest
        rows = [(self.name, self.key, f.field_name, "text", f.tokenizer.describe(), f.source_text(),
                 self.search_tokenizer.describe() if self.search_tokenizer else None, None)
                for f in self.fields.values()]
        rows += [(self.name, self.key, v.field_name, "vector", None, v.source, None, v.metric)
                 for v in self.vector_fields.values()]
        return self.spark.createDataFrame(
            rows, "index string, key string, field string, kind string, tokenizer string, "
                  "source string, search_tokenizer string, metric string")

    def save(self, path: str) -> "SearchIndex":
        """Write every table under ``path`` and return the index read back."""
        nb = self.buckets or default_buckets(self.spark)
        if self.fields:
            self._save_text(path, nb)
        if self.vectors is not None:
            self.vectors.write.mode("overwrite").parquet(f"{path}/vectors")
            stored = self.spark.read.parquet(f"{path}/vectors")
            for v in self.vector_fields.values():
                if v.clusters:
                    save_lists(stored.where(F.col("field") == v.field_name), f"{path}/clusters/{v.field_name}", v.clusters)
        self.manifest().coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")
        meta = {"name": self.name, "key": self.key, "buckets": nb, "term_parts": self.term_parts,
                "hot_df": self.hot_df, "rare_parts": self.rare_parts,
                "key_type": dict(self.postings.dtypes)["doc_id"] if self.fields else None,
                "where": self.where, "partial": self.partial,
                "search_tokenizer": _tok_json(self.search_tokenizer),
                "fields": [{"name": f.field_name, "source": f.source_text(), "is_array": f.is_array,
                            "is_expr": f.is_expr, "is_column": not isinstance(f.source, str),
                            "tokenizer": _tok_json(f.tokenizer)} for f in self.fields.values()],
                "vectors": [{"name": v.field_name, "source": v.source, "metric": v.metric,
                             "clusters": v.clusters and asdict(v.clusters)}
                            for v in self.vector_fields.values()]}
        self.spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode(
            "overwrite").text(f"{path}/_meta")
        out = SearchIndex.open(self.spark, path)
        out.docs = self.docs
        return out

    def _save_text(self, path: str, nb: int):
        table = _postings_table(path)
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        # the bucketed writer sorts each task's rows by (field, tpart, bucket, term) itself
        (self.postings
         .write.mode("overwrite").partitionBy("field", "tpart").bucketBy(nb, "doc_id").sortBy("term")
         .option("path", f"{path}/postings").saveAsTable(table))
        p = self.spark.table(table)
        # document lengths from the written postings (no second tokenising
        # pass) plus the non-NULL values that have no tokens at all
        dls = p.groupBy("field", "doc_id").agg(F.max("dl").alias("dl"))
        if self.docs is not None and self._src is not None:
            dls = dls.unionByName(empty_values(self._src, self.key, list(self.fields.values())))
        else:
            dls = self.doclens
        dls.write.mode("overwrite").partitionBy("field").parquet(f"{path}/doclens")
        dl = self.spark.read.schema(dls.schema).parquet(f"{path}/doclens")  # an empty table has no files
        _field_stats(dl).coalesce(1).write.mode("overwrite").parquet(f"{path}/fields")
        self.hot_df = self.hot_df or HOT_ROWS_PER_BUCKET * nb
        self.rare_parts = self.rare_parts or min(MAX_RARE_PARTS, nb)
        (term_statistics(p).withColumn("hot", F.col("df") >= self.hot_df)
         .repartitionByRange(nb, "field", "term").write.mode("overwrite").parquet(f"{path}/terms"))
        save_grams(self.spark.read.parquet(f"{path}/terms"), path)
        # hot terms are few (each has many postings); without them, every part of the terms becomes one file
        hot = self.spark.read.parquet(f"{path}/terms").where("hot").select("field", "term")
        rare = join_small(p, hot, ["field", "term"], "left_anti", materialize=False)
        # what is shuffled is lean: most rare terms stand once in a document, tf is the number of positions
        once = F.size("positions") == 1
        lean = rare.select("term", "doc_id", "dl", F.when(once, F.col("positions")[0]).alias("at"),
                           F.when(~once, F.col("positions")).alias("more"), "field")
        rpart = term_part("term", self.rare_parts)
        (lean.repartition(self.rare_parts, F.col("field"), rpart)
         .withColumn("positions", F.coalesce("more", F.array("at")))
         .select("term", "doc_id", F.size("positions").alias("tf"), "dl", "positions", "field", rpart.alias("rpart"))
         .sortWithinPartitions("field", "rpart", "term")
         .write.mode("overwrite").partitionBy("field", "rpart").parquet(f"{path}/rare"))

    @staticmethod
    def open(spark: SparkSession, path: str) -> "SearchIndex":
        meta = json.loads(spark.read.text(f"{path}/_meta").first()[0])
        fields = [Field(f["source"], _tok_from(f["tokenizer"]), f["name"], f["is_array"], f["is_expr"])
                  for f in meta["fields"]]
        vfs = [VectorField(v["source"], v["metric"], v["name"], Clusters(**v["clusters"]) if v["clusters"] else None)
               for v in meta["vectors"]]
        batches = [f"{path}/appends/{b}" for b in sorted(meta.get("batches", {}))]

        def whole(base: DataFrame, name: str) -> DataFrame:
            return base.unionByName(spark.read.schema(base.schema).parquet(*[f"{b}/{name}" for b in batches])) if batches else base

        def stored(name: str, ddl: str) -> DataFrame:  # an index of vectors only has empty text tables
            return whole(spark.read.schema(ddl).parquet(f"{path}/{name}"), name) if fields else spark.createDataFrame([], ddl)

        vectors = whole(spark.read.parquet(f"{path}/vectors"), "vectors") if vfs else None
        kind = meta["key_type"]
        doclens = spark.read.schema(f"doc_id {kind}, dl int, field string").parquet(f"{path}/doclens") if fields \
            else spark.createDataFrame([], "doc_id bigint, dl int, field string")
        if fields:
            postings = whole(_attach_postings(spark, path, meta["buckets"], kind), "postings")
            doclens = whole(doclens, "doclens")
        else:
            postings = spark.createDataFrame([], "term string, doc_id bigint, tf int, dl int, positions array<int>, "
                                                 "field string, tpart int")
        ddl = "field string, term string, df bigint, cf bigint, hot boolean"
        # of the base and of every batch: added up where they are read
        terms = [spark.read.schema(ddl).parquet(f"{p}/terms") for p in [path, *batches]] if fields else [spark.createDataFrame([], ddl)]
        stats = stored("fields", "field string, n_docs bigint, avgdl double, total_tokens bigint")
        if batches:
            stats = stats.groupBy("field").agg(F.sum("n_docs").alias("n_docs"), F.sum("total_tokens").alias("total_tokens")).select(
                "field", "n_docs", (F.col("total_tokens") / F.col("n_docs")).alias("avgdl"), "total_tokens")
        idx = SearchIndex(spark, meta["key"], fields, vfs, postings, merged_terms(terms) if batches else terms[0], stats,
                          doclens, vectors, search_tokenizer=_tok_from(meta["search_tokenizer"]), name=meta["name"],
                          path=path, manifest=spark.read.parquet(f"{path}/manifest"))
        idx.buckets, idx.term_parts = meta["buckets"], meta["term_parts"]
        idx.where, idx.partial = meta["where"], meta["partial"]
        idx.hot_df, idx.rare_parts = meta["hot_df"], meta["rare_parts"]
        if fields:
            # folders of partitions: Spark reads one base at a time
            ddl = "gram string, term string, field string, gpart int"
            idx.grams = spark.read.schema(ddl).parquet(f"{path}/grams")
            for b in batches:
                idx.grams = idx.grams.unionByName(spark.read.schema(ddl).parquet(f"{b}/grams"))
            idx.gram_counts = stored("gram_counts", "field string, gram string, n bigint")
            idx.term_tables = terms
        idx.lists = {v.field_name: VectorLists(
            spark, f"{path}/clusters/{v.field_name}", v.metric, dict(vectors.dtypes)["doc_id"],
            [f"{b}/lists/{v.field_name}" for b in batches]) for v in vfs if v.clusters}
        if fields:
            rare_ddl = f"term string, doc_id {kind}, tf int, dl int, positions array<int>, field string, rpart int"
            idx.rare = spark.read.schema(rare_ddl).parquet(f"{path}/rare")
            if batches:  # appended rows of rare and hot terms alike
                more = spark.read.schema(postings.schema).parquet(*[f"{b}/postings" for b in batches])
                idx.appended = more.select("term", "doc_id", "tf", "dl", "positions", "field")
        return idx


def save_grams(terms: DataFrame, path: str) -> None:
    """Write the character grams of a stored vocabulary, and how many terms hold each.  Grams
    are many times as much as their terms and are not shuffled: each task writes those of
    some files of terms, so a part of the grams is about a file per ``GRAM_TERMS`` terms."""
    parts = max(1, -(-terms.count() // GRAM_TERMS))
    grams = term_grams(terms.select("field", "term").coalesce(parts))
    (grams.sortWithinPartitions("field", "gpart", "gram", "term")
     .write.mode("overwrite").partitionBy("field", "gpart").parquet(f"{path}/grams"))
    stored = terms.sparkSession.read.schema("gram string, term string, field string, gpart int").parquet(f"{path}/grams")
    stored.groupBy("field", "gram").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/gram_counts")


def _postings_table(path: str) -> str:
    return "lodestar_postings_" + hashlib.sha1(path.encode()).hexdigest()[:16]


def _attach_postings(spark: SparkSession, path: str, buckets: int, key_type: str) -> DataFrame:
    """The stored postings as a bucketed table of this session's catalog.

    The files carry their bucket ids; declaring the table over the folder
    (external, nothing is copied) lets the planner use the bucketing.
    """
    table = _postings_table(path)
    if not spark.catalog.tableExists(table):
        cols = f"term string, doc_id {key_type}, tf int, dl int, positions array<int>"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}, field string, tpart int) USING parquet PARTITIONED BY (field, tpart) "
                  f"CLUSTERED BY (doc_id) SORTED BY (term) INTO {int(buckets)} BUCKETS LOCATION '{path}/postings'")
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return spark.table(table)


def _tok_json(t: Tokenizer | None):
    return None if t is None else {"name": t.name, "args": list(t.args), "options": [list(o) for o in t.options]}


def _tok_from(d) -> Tokenizer | None:
    if d is None:
        return None
    return Tokenizer(d["name"], tuple(d["args"]), tuple(tuple(o) for o in d["options"]))


def _field_stats(doclens: DataFrame) -> DataFrame:
    return doclens.groupBy("field").agg(F.count("*").alias("n_docs"), F.avg("dl").alias("avgdl"),
                                        F.sum("dl").alias("total_tokens"))


BUCKET_TARGET_BYTES = 16 << 20  # indexed values per postings bucket
TERM_PARTS = 8  # hash parts of the terms of a field; a lookup reads only the parts of its terms
HOT_ROWS_PER_BUCKET = 32  # a term with so many postings per bucket is hot
GRAM_TERMS = 1 << 17  # terms whose grams one task sorts
MAX_RARE_PARTS = 8192  # folders of rare terms; beyond it their files grow instead


def term_part(term: Column | str, parts: int) -> Column:
    return F.pmod(F.hash(term), F.lit(parts)).cast("int")


def default_buckets(spark: SparkSession, values: DataFrame | None = None) -> int:
    """About 16 MB of the values to index per bucket, never fewer buckets than the cluster's
    default parallelism.  The values are measured: files say little of them, as
    repeated texts take next to no room there."""
    par = spark.sparkContext.defaultParallelism
    if values is None:
        return max(int(spark.conf.get("spark.sql.shuffle.partitions")), par)
    # Spark refuses a table of more buckets than this; beyond it buckets grow instead
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    return min(most, max(par, -(-measured_bytes(values) // BUCKET_TARGET_BYTES)))


def build_index(docs: DataFrame, key: str, fields: list[Field | str], vector_fields: list[VectorField] = (),
                search_tokenizer: Tokenizer | None = None, where: Column | str | None = None,
                name: str = "index", buckets: int | None = None, term_parts: int = TERM_PARTS,
                hot_df: int | None = None, rare_parts: int | None = None) -> SearchIndex:
    """Declare the index tables over ``docs`` (lazy; ``.save(path)`` writes them).

    ``where`` makes a partial index (rows meeting the predicate only).  Given as
    SQL text it is stored, as is a ``Field`` with ``is_expr``; rows can be
    appended only to an index whose predicate and expressions are SQL text.
    ``hot_df``: documents from which a term is hot; ``rare_parts``: files of rare terms
    per field (both grow with the bucket count by default).
    """
    spark = docs.sparkSession
    fields = [Field(f) if isinstance(f, str) else f for f in fields]
    names = [f.field_name for f in fields] + [v.field_name for v in vector_fields]
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate field names {names}")
    src = docs.where(where) if where is not None else docs
    nb = buckets or default_buckets(spark, src.select(*[f.column().alias(f"v{i}") for i, f in enumerate(fields)]) if fields else None)
    postings = doclens = terms = stats = None
    if fields:
        # rows of one key land in one bucket partition: everything after is local
        doclens = doc_lengths(src, key, fields)
        postings = row_postings(src.repartition(nb, F.col(key)), key, fields).withColumn("tpart", term_part("term", term_parts))
        stats = _field_stats(doclens)
        terms = term_statistics(postings).withColumn("hot", F.lit(True))
    vectors = None
    if vector_fields:
        parts = []
        for v in vector_fields:
            e = F.transform(F.col(v.source), lambda x: x.cast("double"))
            if v.metric == "cosine":
                norm = F.sqrt(F.aggregate(e, F.lit(0.0), lambda a, x: a + x * x))
                e = F.when(norm > 0, F.transform(e, lambda x: x / norm)).otherwise(e)
            parts.append(src.select(F.lit(v.field_name).alias("field"), F.col(key).alias("doc_id"),
                                    e.alias("embedding")).where(F.col("embedding").isNotNull()))
        vectors = parts[0]
        for p in parts[1:]:
            vectors = vectors.unionByName(p)
    idx = SearchIndex(spark, key, fields, list(vector_fields), postings, terms, stats, doclens, vectors,
                      docs=docs, search_tokenizer=search_tokenizer, name=name)
    idx._src = src
    idx.buckets, idx.term_parts = nb, term_parts
    idx.hot_df, idx.rare_parts = hot_df, rare_parts
    idx.where, idx.partial = where if isinstance(where, str) else None, where is not None
    return idx


_OPENED: dict = {}
_BUILD_LOCK = threading.Lock()


def cached_index(spark: SparkSession, name: str, signature: str, build) -> SearchIndex:
    """Open the index stored for ``signature`` in the shared work folder, or build it.

    ``build()`` returns a lazy :class:`SearchIndex`; it is written once to
    ``<spark.checkpoint.dir>/lodestar/index/<name>-<hash>`` (marker file last)
    and every later call reads the stored tables.
    """
    h = hashlib.sha1(signature.encode()).hexdigest()[:16]
    path = f"{work_dir(spark)}/lodestar/index/{name}-{h}"
    memo_key = (spark.sparkContext.applicationId, path)
    with _BUILD_LOCK:  # one builder per index within a driver
        if memo_key in _OPENED:  # stored indexes are immutable: reuse the opened tables
            return _OPENED[memo_key]
        if path_exists(spark, f"{path}/_DONE"):
            idx = SearchIndex.open(spark, path)
        else:
            idx = build().save(path)
            spark.createDataFrame([(uuid.uuid4().hex,)], "v string").coalesce(1).write.mode("overwrite").text(
                f"{path}/_DONE")
        _OPENED[memo_key] = idx
    return idx
