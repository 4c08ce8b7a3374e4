"""Registry of named queries: a Spark plan and (where expressible) its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, FloatType, IntegerType, ShortType

from ..functions.analysis import DEFAULT
from ..operators.index import Field, SearchIndex, build_index, cached_index
from ..session import file_signature

QUERIES: dict = {}
ORACLE: dict = {}
# part of every stored-index signature; a caller (the bench) may set a fresh
# value to force cold builds without touching the session's settings
INDEX_NAMESPACE = ""


def reg(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return normalize(fn(spark, sf.rstrip("/")))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def normalize(df: DataFrame) -> DataFrame:
    """Integers as bigint, floats as double: one schema for both engines."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (IntegerType, ShortType, ByteType)):
            cols.append(F.col(f"`{f.name}`").cast("bigint").alias(f.name))
        elif isinstance(f.dataType, FloatType):
            cols.append(F.col(f"`{f.name}`").cast("double").alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stored_index(spark: SparkSession, sf: str, name: str, source: str, key: str, fields: list,
                 vector_fields=(), search_tokenizer=None, where=None, where_text: str = "",
                 docs: DataFrame | None = None) -> SearchIndex:
    """Index over one TESTDATA table, written once to the shared work folder."""
    src = docs if docs is not None else table(spark, sf, source)
    spec = repr([(f.field_name, f.tokenizer, f.source_text(), f.is_array) for f in fields]) + repr(
        [(v.field_name, v.metric, v.source, v.clusters) for v in vector_fields]) + repr(search_tokenizer) + where_text
    sig = (f"{sf}/{source}|{file_signature(spark, f'{sf}/{source}.parquet')}|{key}|{spec}|v12"
           f"|{INDEX_NAMESPACE}")
    idx = cached_index(spark, name, sig, lambda: build_index(src, key, fields, list(vector_fields),
                                                             search_tokenizer, where, name=name))
    idx.docs = src
    return idx


def documents_index(spark, sf) -> SearchIndex:
    return stored_index(spark, sf, "documents_text", "documents", "doc_id", [Field("text", DEFAULT)])
