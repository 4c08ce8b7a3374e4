"""Snippets and highlight positions for matched documents.

Offsets are computed for matched (query, document) pairs only: the text is
exploded to tokens with code-point offsets (running window sum), filtered to
the query's terms, and folded per pair into fragments.

Fragment contract (SURVEY §2.7): walk the matched tokens left to right; a
fragment opens at the first unassigned one (start offset s) and takes every
following matched token with end ≤ s + max_chars (at least the first).  Its
text is ``substring(text, s, max_chars)`` with each matched token wrapped in
the tags; its score is the number of matched tokens, ties to the earlier.

Texts are analysed as the field is: a stemmed term marks the whole word, an
edge n-gram the longest matching head of its word, and the parts that
``source_code`` and ``chinese_compatible`` break a word into are marked alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.analysis import token_offsets
from .index import SearchIndex
from .joins import join_small


def matched_docs(index: SearchIndex, field: str, matches: DataFrame) -> DataFrame:
    """(doc_id, text) of the matched documents, hash-partitioned by doc_id.

    Only matched rows are shuffled (their ids are broadcast after a size
    check); everything downstream — token offsets, the per-(query, document)
    fold, the text lookup — then runs inside these partitions.
    """
    f = index.fields[field]
    if f.tokenizer.word_pattern() is None or not isinstance(f.source, str):
        raise ValueError("highlighting needs a word tokenizer on a plain text column")
    docs = index.docs.select(F.col(index.key).alias("doc_id"), F.col(f.source).alias("text"))
    ids = matches.select("doc_id").distinct()
    return join_small(docs, ids, "doc_id", "left_semi").repartition("doc_id")


def matched_tokens(index: SearchIndex, field: str, matches: DataFrame, qterms: DataFrame,
                   md: DataFrame | None = None) -> DataFrame:
    """(query_id, doc_id, start, end) of the tokens of matched documents that
    are query terms.  ``qterms``: (query_id, term)."""
    f = index.fields[field]
    md = md if md is not None else matched_docs(index, field, matches)
    pairs = matches.select("query_id", "doc_id").distinct()
    # each matched document is tokenised once, whatever the number of queries
    toks = token_offsets(md, "text", f.tokenizer).select("doc_id", "term", "start", "end")
    want = pairs.join(qterms.select("query_id", "term").distinct(), "query_id")
    found = join_small(toks, want, ["doc_id", "term"]).select("query_id", "doc_id", "start", "end")
    if f.tokenizer.name == "edge_ngram":  # of the grams of a word that are query terms, the longest
        found = found.groupBy("query_id", "doc_id", "start").agg(F.max("end").alias("end"))
    return found


def snippet_positions(index, field, matches, qterms) -> DataFrame:
    """(query_id, doc_id, start, end): one row per highlighted token."""
    return matched_tokens(index, field, matches, qterms)


def fragments(index: SearchIndex, field: str, matches: DataFrame, qterms: DataFrame,
              start_tag: str = "<b>", end_tag: str = "</b>", max_num_chars: int = 150) -> DataFrame:
    """(query_id, doc_id, frag_idx, frag_start, score, snippet) per fragment."""
    md = matched_docs(index, field, matches)
    mt = matched_tokens(index, field, matches, qterms, md)
    per = mt.groupBy("query_id", "doc_id").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("toks"))
    m = max_num_chars
    # fragment first indices, by a fold over the doc's matched tokens
    idxd = F.transform(F.col("toks"), lambda t, i: F.struct(t["start"].alias("start"), t["end"].alias("end"),
                                                            i.alias("i")))

    def step(acc, t):
        new = (acc["s"] < 0) | (t["end"] > acc["s"] + m)
        return F.struct(F.when(new, t["start"]).otherwise(acc["s"]).alias("s"),
                        F.when(new, F.concat(acc["firsts"], F.array(t["i"]))).otherwise(acc["firsts"]).alias("firsts"))

    firsts = F.aggregate(idxd, F.struct(F.lit(-1).alias("s"), F.array().cast("array<int>").alias("firsts")),
                         step, lambda acc: acc["firsts"])
    per = per.withColumn("firsts", firsts)
    fr = per.select("query_id", "doc_id", "toks", "firsts",
                    F.posexplode("firsts").alias("frag_idx", "first"))
    nxt = F.when(F.col("frag_idx") + 1 < F.size("firsts"),
                 F.element_at("firsts", F.col("frag_idx") + 2)).otherwise(F.size("toks"))
    fr = fr.select("query_id", "doc_id", "frag_idx",
                   F.slice("toks", F.col("first") + 1, nxt - F.col("first")).alias("ft"))
    fr = fr.join(md, "doc_id")
    s = F.element_at("ft", 1)["start"]
    fe = F.least(s + m, F.length("text"))
    fr = fr.withColumn("fs", s).withColumn("fe", fe)
    # pieces: gap before each token, tagged token (clipped to the fragment), tail
    prev_end = lambda k: F.when(k == 0, F.col("fs")).otherwise(F.element_at("ft", k)["end"])
    pieces = F.transform("ft", lambda t, k: F.concat(
        F.substring("text", prev_end(k) + 1, t["start"] - prev_end(k)),
        F.lit(start_tag),
        F.substring("text", t["start"] + 1, F.least(t["end"], F.col("fe")) - t["start"]),
        F.lit(end_tag)))
    last_end = F.least(F.element_at("ft", -1)["end"], F.col("fe"))
    tail = F.substring("text", last_end + 1, F.greatest(F.col("fe") - last_end, F.lit(0)))
    return fr.select("query_id", "doc_id", "frag_idx", F.col("fs").alias("frag_start"),
                     F.size("ft").cast("bigint").alias("score"),
                     F.concat(F.array_join(pieces, ""), tail).alias("snippet"))


def snippets(index, field, matches, qterms, start_tag="<b>", end_tag="</b>", max_num_chars=150,
             limit: int = 5, offset: int = 0, sort_by: str = "score") -> DataFrame:
    """(query_id, doc_id, rank, frag_start, score, snippet): fragments ordered by
    score (ties to the earlier) or by position, then offset and limit."""
    fr = fragments(index, field, matches, qterms, start_tag, end_tag, max_num_chars)
    if sort_by == "score":
        order = [F.col("score").desc(), F.col("frag_idx").asc()]
    elif sort_by == "position":
        order = [F.col("frag_idx").asc()]
    else:
        raise ValueError("sort_by must be 'score' or 'position'")
    w = Window.partitionBy("query_id", "doc_id").orderBy(*order)
    r = fr.withColumn("rank", F.row_number().over(w))
    r = r.where((F.col("rank") > offset) & (F.col("rank") <= offset + limit))
    return r.select("query_id", "doc_id", (F.col("rank") - offset).cast("int").alias("rank"), "frag_start",
                    "score", "snippet")


def snippet(index, field, matches, qterms, start_tag="<b>", end_tag="</b>", max_num_chars=150) -> DataFrame:
    """(query_id, doc_id, snippet, score): the best fragment of each match."""
    s = snippets(index, field, matches, qterms, start_tag, end_tag, max_num_chars, limit=1)
    return s.select("query_id", "doc_id", "snippet", "score")
