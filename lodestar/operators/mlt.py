"""More-like-this: pick the telling terms of source rows, then search them.

Source terms pass the tuning filters, are ranked per (query, field) by
``tf * idf`` descending then term, and the first ``max_query_terms`` are kept.
A row matches when it has any of them (per field); its score is the BM25 sum.
All sources of a batch are handled by one job: the ranking is a window
partitioned by (query_id, field), never a driver loop.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .index import SearchIndex
from .joins import held, join_hashed, join_held, join_small
from .search import _union, idf_terms, term_scores, with_constants
from .topk import known_terms, top_matches


@dataclass(frozen=True)
class MltOptions:
    fields: tuple | None = None
    min_term_frequency: int = 1
    min_doc_frequency: int = 1
    max_doc_frequency: int | None = None
    max_query_terms: int = 25
    min_word_length: int | None = None
    max_word_length: int | None = None
    stopwords: tuple = ()


FEW_SOURCES = 100  # so many sources are the smaller side of the vocabulary; of more, the vocabulary is


def _select_terms(index: SearchIndex, src: DataFrame, field: str, o: MltOptions, by: tuple = ("query_id",),
                  few: bool = True) -> DataFrame:
    """src: (query_id, term, tf, ...) of one field → the kept rows with the columns of ``search.idf_terms``."""
    vocabulary = idf_terms(index, field, src if few else None)
    # rows of many sources are shuffled twice: they carry what ranks them only
    t = join_small(vocabulary, src, "term") if few else join_hashed(
        src, vocabulary.select("term", "df", "hot", "idf"), "term")
    c = (F.col("tf") >= o.min_term_frequency) & (F.col("df") >= o.min_doc_frequency)
    if o.max_doc_frequency is not None:
        c &= F.col("df") <= o.max_doc_frequency
    if o.min_word_length is not None:
        c &= F.length("term") >= o.min_word_length
    if o.max_word_length is not None:
        c &= F.length("term") <= o.max_word_length
    if o.stopwords:
        c &= ~F.col("term").isin(list(o.stopwords))
    w = Window.partitionBy(*by).orderBy((F.col("tf") * F.col("idf")).desc(), F.col("term"))
    kept = t.where(c).withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= o.max_query_terms)
    return (kept if few else with_constants(index, kept, field)).select("query_id", *vocabulary.columns)


def _search_terms(index: SearchIndex, per_field: dict) -> DataFrame:
    parts = []
    for field, qt in per_field.items():
        ex = qt.select("query_id", F.col("term").alias("qterm"), "term").distinct()
        parts.append(term_scores(index, ex, field, expanded=False))
    u = _union(parts, "query_id bigint, doc_id bigint, qterm string, score double")
    return u.groupBy("query_id", "doc_id").agg(F.sum("score").alias("score"))


def _bounded(per_field: dict) -> DataFrame:
    return _union([known_terms(t, field) for field, t in per_field.items()], "")


def _fields(index: SearchIndex, o: MltOptions):
    fs = list(o.fields) if o.fields else index.text_fields()
    bad = [f for f in fs if f not in index.fields]
    if bad:
        raise ValueError(f"more-like-this fields {bad} are not text fields of the index")
    return fs


def source_terms(index: SearchIndex, sources: DataFrame, o: MltOptions = MltOptions()) -> dict:
    """field → (query_id, term, ...): the telling terms of stored rows."""
    per_field = {}
    sources, rows = held(sources.select("query_id", "src_id"))
    few = rows is not None and rows.num_rows <= FEW_SOURCES
    for field in _fields(index, o):
        p = index.postings.where(F.col("field") == field).select(F.col("doc_id").alias("src_id"), "term", "tf")
        src = join_held(p, sources, rows, "src_id")
        # each source ranks its own terms; a query's term set is their union
        per_field[field] = _select_terms(index, src, field, o, ("src_id", "query_id"), few).dropDuplicates(["query_id", "term"])
    return per_field


def more_like_this_id(index: SearchIndex, sources: DataFrame, o: MltOptions = MltOptions(),
                      exclude_sources: bool = False) -> DataFrame:
    """sources: (query_id, src_id) — several rows per query make q_mlt_many."""
    out = _search_terms(index, source_terms(index, sources, o))
    if exclude_sources:
        out = out.join(sources.select("query_id", F.col("src_id").alias("doc_id")), ["query_id", "doc_id"], "left_anti")
    return out


def most_like_this_id(index: SearchIndex, sources: DataFrame, k: int, o: MltOptions = MltOptions(),
                      exclude_sources: bool = False, keep: DataFrame | None = None) -> DataFrame:
    """The k best rows of ``more_like_this_id`` per query (of the documents in ``keep``),
    with bounded scores: what cannot be among them is not scored."""
    without = sources.select("query_id", F.col("src_id").alias("doc_id")) if exclude_sources else None
    return top_matches(index, _bounded(source_terms(index, sources, o)), k, keep, without, costly=True)


def document_terms(index: SearchIndex, documents: DataFrame, o: MltOptions = MltOptions()) -> dict:
    """field → (query_id, term, ...): the telling terms of given values."""
    per_field = {}
    for field in _fields(index, o):
        if field not in documents.columns:
            continue
        tok = index.query_tokenizer(field)
        src = (documents.select("query_id", F.explode(tok.terms(F.col(field))).alias("term"))
               .groupBy("query_id", "term").agg(F.count("*").alias("tf")))
        per_field[field] = _select_terms(index, src, field, o)
    return per_field


def more_like_this_document(index: SearchIndex, documents: DataFrame, o: MltOptions = MltOptions()) -> DataFrame:
    """documents: (query_id, <field columns>) — the values are analysed with the
    fields' tokenizers and searched like a stored row."""
    return _search_terms(index, document_terms(index, documents, o))


def most_like_this_document(index: SearchIndex, documents: DataFrame, k: int, o: MltOptions = MltOptions()) -> DataFrame:
    """The k best rows of ``more_like_this_document`` per query, with bounded scores."""
    return top_matches(index, _bounded(document_terms(index, documents, o)), k)
