"""Text predicates over an index, in batch form.

Every operator takes a :class:`SearchIndex`, a queries DataFrame
(``query_id`` plus a value column) and a field, and returns
``(query_id, doc_id, score)`` — one row per matching document per query.
Query terms are joined to the vocabulary (``terms``) first, which is small
per query, then to ``postings`` on (field, term).  That second join
broadcasts the query side only after a count proves it small
(:func:`lodestar.operators.joins.join_small`), so postings are not shuffled
for ordinary query batches; bigger batches take a shuffled join where AQE
splits hot terms instead of sending them to one task.

Scoring follows SURVEY §2.1: BM25 (k1 = 1.2, b = 0.75) summed over matched
distinct query terms; fuzzy terms score the maximum over the vocabulary terms
they reach; prefix, regex and proximity parts score 1.0.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..functions.analysis import Tokenizer
from ..functions.fuzzy import deletion_variants, within_distance
from .index import K1, B, SearchIndex, merged_terms, term_part
from .joins import checkpointed, fits_broadcast, held, join_held, join_small
from .patterns import pattern_terms

SCORE_DECIMALS = 6


@dataclass(frozen=True)
class Query:
    """Modifiers of a query value (they compose, like chained casts)."""

    tokenizer: Tokenizer | None = None
    boost: float | None = None
    const: float | None = None
    slop: int = 0
    fuzzy: int | None = None
    prefix: bool = False
    transposition: bool = True

    def with_(self, **kw) -> "Query":
        return replace(self, **kw)


NOQ = Query()


# ---------------------------------------------------------------------------
# query side
# ---------------------------------------------------------------------------

def query_terms(index: SearchIndex, queries: DataFrame, field: str, value: str = "query",
                q: Query = NOQ) -> DataFrame:
    """(query_id, qpos, term): a string value is analysed with the field's
    (or the search / modifier) tokenizer, an array value is taken as terms."""
    dtype = queries.schema[value].dataType
    if isinstance(dtype, ArrayType):
        return (queries.select("query_id", F.posexplode(value).alias("qpos", "term"))
                .where(F.col("term").isNotNull()))
    tok = q.tokenizer or index.query_tokenizer(field)
    return (queries.select("query_id", F.inline(tok.tokens(F.col(value))))
            .select("query_id", F.col("pos").alias("qpos"), "term"))


def field_postings(index: SearchIndex, field: str) -> DataFrame:
    return index.postings.where(F.col("field") == field)


LITERAL_TERMS = 256  # up to so many looked-up terms are pushed to the scans as literals


def vocabulary(index: SearchIndex, field: str, wanted: DataFrame | None = None) -> DataFrame:
    """(term, df, hot, tpart, rpart) of one field: what a lookup has to know of its terms.
    ``wanted`` (term): all that is asked for; appended batches are then added up for these only."""
    if wanted is not None and len(index.term_tables) > 1:
        side, rows = held(wanted.select("term").distinct())
        t = merged_terms([join_held(x.where(F.col("field") == field), side, rows, "term", "left_semi").select("term", "df", "cf", "hot")
                          for x in index.term_tables], ("term",))
    else:
        t = index.terms.where(F.col("field") == field)
    return t.select("term", "df", "hot", *_parts(index))


def _parts(index: SearchIndex) -> list[Column]:
    """The parts that hold a ``term``."""
    return [term_part("term", n or 1).alias(c) for c, n in (("tpart", index.term_parts), ("rpart", index.rare_parts))]


def pruned_postings(index: SearchIndex, field: str, wanted: DataFrame, rows: pa.Table | None = None) -> DataFrame:
    """Postings of one field that a join with the terms of ``wanted`` can meet.

    Few terms: hot ones are read from the buckets (a partition filter on their
    parts, and the terms as a pushed filter), rare ones from their parts of the rare
    postings, one file each.  Many terms: the buckets, cut to the parts of the terms.
    ``rows``: the rows of ``wanted`` where they are known, with the columns of
    :func:`vocabulary`.
    """
    p = field_postings(index, field)
    if index.rare is None:  # not stored
        return p
    if rows is None:
        terms = join_small(vocabulary(index, field, wanted), wanted.select("term").distinct(), "term")
        rows = held(terms.select("term", "hot", "tpart", "rpart"))[1]
        if rows is None:
            return p

    def one_of(column: str, values) -> Column:
        return F.col(column).isin(sorted(set(values)))

    if pa.compute.count_distinct(rows["term"]).as_py() > LITERAL_TERMS:
        return p.where(one_of("tpart", pa.compute.unique(rows["tpart"]).to_pylist()))
    known = {r["term"]: r for r in rows.select(["term", "hot", "tpart", "rpart"]).to_pylist()}
    hot = [r for r in known.values() if r["hot"]]
    rare = [r for r in known.values() if not r["hot"]]
    columns = ["field", "term", "doc_id", "tf", "dl", "positions"]
    parts = []
    if hot or not rare:
        parts.append(p.where(one_of("tpart", (r["tpart"] for r in hot)) & one_of("term", (r["term"] for r in hot))))
    if rare:
        terms = one_of("term", (r["term"] for r in rare))
        parts.append(index.rare.where((F.col("field") == field) & one_of("rpart", (r["rpart"] for r in rare)) & terms))
        if index.appended is not None:
            parts.append(index.appended.where((F.col("field") == field) & terms))
    return _union([x.select(columns) for x in parts], "")


def idf_terms(index: SearchIndex, field: str, wanted: DataFrame | None = None) -> DataFrame:
    """(term, df, idf, ...) of one field (see :func:`vocabulary`); N comes from a one-row stats table."""
    st = index.stats.where(F.col("field") == field).select("n_docs", "avgdl")
    return (vocabulary(index, field, wanted).crossJoin(F.broadcast(st))  # one row: bounded by the number of fields
            .withColumn("idf", F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))))


def with_constants(index: SearchIndex, terms: DataFrame, field: str) -> DataFrame:
    """Rows of terms with what :func:`idf_terms` knows of a term without looking it up."""
    st = index.stats.where(F.col("field") == field).select("n_docs", "avgdl")
    return terms.crossJoin(F.broadcast(st)).select("*", *_parts(index))  # one row: bounded by the number of fields


def bm25(idf: Column, tf: Column, dl: Column, avgdl: Column) -> Column:
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / avgdl))


def expand(index: SearchIndex, qt: DataFrame, field: str, q: Query = NOQ) -> DataFrame:
    """(query_id, qterm, term): query terms to vocabulary terms (fuzzy aware)."""
    qd = qt.select("query_id", F.col("term").alias("qterm")).distinct()
    if not q.fuzzy:
        return qd.withColumn("term", F.col("qterm"))
    return fuzzy_expand(index, qd, field, q.fuzzy, q.prefix, q.transposition)


def fuzzy_expand(index: SearchIndex, qd: DataFrame, field: str, d: int, prefix: bool,
                 transposition: bool) -> DataFrame:
    """Vocabulary terms within edit distance ``d`` of each query term.

    Candidates come from an equi-join on shared deletion variants (every
    pair within distance d shares a string reached by at most d deletions on
    each side), so no query × vocabulary product is formed; the exact
    distance is then checked with built-in ``levenshtein`` and adjacent
    swaps.  With ``prefix`` the vocabulary side is the set of term prefixes
    with lengths len(q) ± d, joined back to their terms.
    """
    if d < 0 or d > 2:
        raise ValueError("fuzzy distance must be 0, 1 or 2")
    vocab = index.terms.where(F.col("field") == field).select("term")
    lens = qd.select(F.min(F.length("qterm")).alias("lo"), F.max(F.length("qterm")).alias("hi"))
    if not prefix:
        # only terms whose length can be within d of some query term
        vocab = (vocab.crossJoin(F.broadcast(lens))  # one-row table
                 .where((F.length("term") >= F.col("lo") - d) & (F.length("term") <= F.col("hi") + d))
                 .select("term"))
    if prefix:
        vocab = (vocab.crossJoin(F.broadcast(lens))  # one-row table
                 .select("term", F.explode(F.sequence(F.greatest(F.col("lo") - d, F.lit(1)),
                                                      F.least(F.col("hi") + d, F.length("term")))).alias("n"))
                 .where(F.col("n") <= F.length("term"))
                 .select("term", F.substring("term", 1, F.col("n")).alias("cand")))
    else:
        vocab = vocab.withColumn("cand", F.col("term"))
    qv = qd.select("query_id", "qterm", F.explode(deletion_variants(F.col("qterm"), d)).alias("key"))
    cv = vocab.select("term", "cand", F.explode(deletion_variants(F.col("cand"), d)).alias("key"))
    pairs = (join_small(cv, qv, "key").select("query_id", "qterm", "cand", "term").distinct()
             .where(F.abs(F.length("qterm") - F.length("cand")) <= d)
             .where(within_distance(F.col("qterm"), F.col("cand"), d, transposition)))
    return pairs.select("query_id", "qterm", "term").distinct()


def term_scores(index: SearchIndex, ex: DataFrame, field: str, expanded: bool = True) -> DataFrame:
    """(query_id, doc_id, qterm, score): BM25 per matched original query term.

    ``expanded``: a query term may stand for several vocabulary terms (fuzzy),
    so the best of them is kept; otherwise each row is already one term.
    """
    idf = idf_terms(index, field, ex)
    # query terms look up the vocabulary, then the postings; both lookups
    # broadcast the (measured) query side, so neither index table is shuffled
    qside, rows = held(join_small(idf, ex, "term"))
    p = pruned_postings(index, field, qside, rows).select("term", "doc_id", "tf", "dl")
    j = join_held(p, qside, rows, "term")
    s = bm25(F.col("idf"), F.col("tf"), F.col("dl"), F.col("avgdl"))
    if not expanded:
        return j.select("query_id", "doc_id", "qterm", s.alias("score"))
    return (j.groupBy("query_id", "doc_id", "qterm").agg(F.max(s).alias("score")))


def _finish(df: DataFrame, q: Query) -> DataFrame:
    s = F.col("score")
    if q.const is not None:
        s = F.lit(float(q.const))
    if q.boost is not None:  # also of a constant score
        s = s * F.lit(float(q.boost))
    return df.select("query_id", "doc_id", s.cast("double").alias("score"))


def match(index: SearchIndex, queries: DataFrame, field: str, mode: str = "any", value: str = "query",
          q: Query = NOQ) -> DataFrame:
    """``matchAny`` / ``matchAll``: documents with any / all distinct query terms."""
    qt = query_terms(index, queries, field, value, q)
    ex = expand(index, qt, field, q)
    if mode == "all" and not q.fuzzy:
        return _finish(intersection(index, field, ex), q)
    ts = term_scores(index, ex, field, expanded=bool(q.fuzzy))
    g = ts.groupBy("query_id", "doc_id").agg(F.sum("score").alias("score"), F.count("*").alias("n"))
    if mode == "all":
        need = qt.groupBy("query_id").agg(F.countDistinct("term").alias("need"))
        g = g.join(need, "query_id").where(F.col("n") == F.col("need"))
    elif mode != "any":
        raise ValueError(mode)
    return _finish(g, q)


RAREST = 2  # terms of a query whose documents are intersected first


def intersection(index: SearchIndex, field: str, ex: DataFrame) -> DataFrame:
    """(query_id, doc_id, score): documents that hold every term of a query (query_id, term).

    The documents of each query's ``RAREST`` rarest terms are found first; of the
    other terms only the postings of these documents are scored, so what a frequent
    word has elsewhere is dropped by a join before it is aggregated.  A query with a
    term that is nowhere has no rows."""
    ex = checkpointed(ex.select("query_id", "term").distinct())
    need = ex.groupBy("query_id").agg(F.count(F.lit(1)).alias("need"))
    known = join_small(idf_terms(index, field, ex), ex, "term")
    # a query's terms are a short list: its order is taken per query
    first = Window.partitionBy("query_id").orderBy("df", "term")
    terms = known.withColumn("r", F.row_number().over(first)).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("query_id")))
    terms = join_small(terms, need, "query_id").where(F.col("n") == F.col("need"))
    terms, rows = held(terms.select("query_id", "term", "idf", "avgdl", "hot", "tpart", "rpart", "r", "need"))

    def scored(side: DataFrame, own: pa.Table | None, on: list) -> DataFrame:
        p = pruned_postings(index, field, side, own).select("term", "doc_id", "tf", "dl")
        j = join_held(p, side, own, on) if on == ["term"] else join_small(p, side, on)
        return j.select("query_id", "doc_id", "need", bm25(F.col("idf"), F.col("tf"), F.col("dl"), F.col("avgdl")).alias("score"))

    def summed(parts: DataFrame, n) -> DataFrame:
        g = parts.groupBy("query_id", "doc_id").agg(F.sum("score").alias("score"), F.count(F.lit(1)).alias("n"), F.first("need").alias("need"))
        return g.where(F.col("n") == n).select("query_id", "doc_id", "need", "score")

    few = None if rows is None else rows.filter(pa.compute.less_equal(rows["r"], RAREST))
    found = summed(scored(terms.where(F.col("r") <= RAREST), few, ["term"]), F.least(F.col("need"), F.lit(RAREST)))
    if rows is not None and not pa.compute.any(pa.compute.greater(rows["r"], RAREST)).as_py():
        return found.select("query_id", "doc_id", "score")
    found, _ = held(found)
    others = terms.where(F.col("r") > RAREST).drop("need", "r")
    wanted = found.select("query_id", "doc_id", "need").join(others, "query_id")
    more = scored(wanted, None, ["term", "doc_id"])
    # the first terms' sum counts for as many rows as there are such terms
    every = found.select("query_id", "doc_id", "need", "score", F.least(F.col("need"), F.lit(RAREST)).alias("k")).unionByName(
        more.withColumn("k", F.lit(1).cast("bigint")))
    return every.groupBy("query_id", "doc_id").agg(F.sum("score").alias("score"), F.sum("k").alias("k"), F.first("need").alias("need")).where(
        F.col("k") == F.col("need")).select("query_id", "doc_id", "score")


def match_any(index, queries, field, value="query", q: Query = NOQ):
    return match(index, queries, field, "any", value, q)


def match_all(index, queries, field, value="query", q: Query = NOQ):
    return match(index, queries, field, "all", value, q)


def term(index: SearchIndex, queries: DataFrame, field: str, value: str = "query", q: Query = NOQ) -> DataFrame:
    """Exact token equality, value not analysed; an array means any of."""
    dtype = queries.schema[value].dataType
    arr = F.col(value) if isinstance(dtype, ArrayType) else F.array(F.col(value))
    qq = queries.select("query_id", arr.alias("__terms"))
    return match(index, qq, field, "any", "__terms", q)


def pattern_rows(index: SearchIndex, patterns: dict | DataFrame) -> DataFrame:
    """(query_id, pattern) of a table of patterns, or of a few given as query id → pattern."""
    if isinstance(patterns, DataFrame):
        return patterns.select("query_id", "pattern")
    return index.spark.createDataFrame(list(patterns.items()), "query_id bigint, pattern string")


def regex_terms(index: SearchIndex, field: str, patterns: dict | DataFrame, max_expansions: int | None = None) -> DataFrame:
    """(query_id, term): vocabulary terms that full-match each pattern (see :mod:`.patterns`);
    ``max_expansions`` keeps the first terms in term order."""
    found = pattern_terms(index, field, pattern_rows(index, patterns).distinct(), max_expansions)
    return found.select("query_id", "term").distinct()


def prefix_terms(index: SearchIndex, field: str, prefixes: DataFrame, max_expansions: int | None = 50) -> DataFrame:
    """(query_id, term): vocabulary terms starting with each query's prefix.

    An equi-join on the term's leading characters, one join per distinct
    prefix length (a short list, taken to the driver as scalars).
    """
    vocab = index.terms.where(F.col("field") == field).select("term")
    lengths = [r[0] for r in prefixes.select(F.length("prefix").alias("n")).distinct().collect() if r[0]]
    parts = []
    for n in sorted(lengths):
        pq = prefixes.where(F.length("prefix") == n)
        heads = vocab.where(F.length("term") >= n).withColumn("prefix", F.substring("term", 1, n))
        parts.append(join_small(heads, pq, "prefix").select("query_id", "term"))
    out = _union(parts, "query_id bigint, term string")
    if max_expansions is not None:
        w = Window.partitionBy("query_id").orderBy("term")
        out = out.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= max_expansions).drop("rn")
    return out


def _union(parts, schema):
    if not parts:
        from pyspark.sql import SparkSession
        return SparkSession.getActiveSession().createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def regex(index: SearchIndex, field: str, patterns: dict | DataFrame, q: Query = NOQ) -> DataFrame:
    """``regex``: documents with a token that full-matches the pattern (score 1).
    ``patterns``: a table (query_id, pattern), or query id → pattern."""
    t, rows = held(regex_terms(index, field, patterns))
    p = pruned_postings(index, field, t).select("term", "doc_id")
    out = join_held(p, t, rows, "term").select("query_id", "doc_id").distinct().withColumn("score", F.lit(1.0))
    return _finish(out, q)


def exists(index: SearchIndex, field: str, q: Query = NOQ) -> DataFrame:
    """Rows whose field has a value (empty text included), score 1."""
    d = index.doclens.where(F.col("field") == field)
    return _finish(d.select(F.lit(0).cast("bigint").alias("query_id"), "doc_id", F.lit(1.0).alias("score")), q)


def all_rows(docs: DataFrame, key: str) -> DataFrame:
    """``all``: every row, score 1."""
    return docs.select(F.lit(0).cast("bigint").alias("query_id"), F.col(key).alias("doc_id"),
                       F.lit(1.0).alias("score"))


# ---------------------------------------------------------------------------
# positions: phrase, slop, phrase prefix, regex phrase
# ---------------------------------------------------------------------------

def occurrences(index: SearchIndex, qterms: DataFrame, field: str, docs: DataFrame | None = None) -> DataFrame:
    """(query_id, doc_id, qpos, p): each query slot's term at each position.

    ``qterms`` has (query_id, qpos, term); a slot may carry several terms
    (prefix / regex expansion).  With ``docs`` (query_id, doc_id candidates)
    the postings of the terms are cut to the candidates: documents and terms
    never multiply, a row is a posting of a slot's term.
    """
    p = pruned_postings(index, field, qterms).select("term", "doc_id", "positions")
    j = join_small(p, qterms.select("query_id", "qpos", "term"), "term")
    if docs is not None:
        j = join_small(j, docs.select("query_id", "doc_id"), ["query_id", "doc_id"], "left_semi")
    return j.select("query_id", "doc_id", "qpos", F.explode("positions").alias("p"))


def _windows(s: DataFrame, slop: int) -> DataFrame:
    """Rows of ``s`` (query_id, doc_id, qpos, p, s) under every anchor ``a`` of
    their document with a ≤ s ≤ a + slop: a band join on position buckets."""
    w = slop + 1
    s = checkpointed(s)  # read as anchors and as members of the windows
    anchors = s.select("query_id", "doc_id", F.col("s").alias("a")).distinct()
    ab = anchors.withColumn("b", F.explode(F.array(F.floor(F.col("a") / w), F.floor(F.col("a") / w) + 1)))
    sb = s.withColumn("b", F.floor(F.col("s") / w))
    return (ab.join(sb, ["query_id", "doc_id", "b"])
            .where((F.col("s") >= F.col("a")) & (F.col("s") <= F.col("a") + slop)))


def _all_placed(slots, positions) -> bool:
    """True if every slot can take a position of its own (augmenting paths)."""
    options, holder = {}, {}
    for slot, p in zip(slots, positions, strict=True):
        options.setdefault(slot, []).append(p)

    def place(slot, tried):
        for p in options[slot]:
            if p not in tried:
                tried.add(p)
                if p not in holder or place(holder[p], tried):
                    holder[p] = slot
                    return True
        return False

    return all(place(slot, set()) for slot in options)


def shared_slot_match(occ: DataFrame, nslots: DataFrame, slop: int) -> DataFrame:
    """``slot_match`` for slots that may hold the same term: each window with all
    slots (at most slots × (slop + 1) rows) is searched for distinct positions."""
    full = (_windows(occ.withColumn("s", F.col("p") - F.col("qpos")), slop)
            .groupBy("query_id", "doc_id", "a")
            .agg(F.collect_list(F.struct("qpos", "p")).alias("w"), F.countDistinct("qpos").alias("c"))
            .join(nslots, "query_id").where(F.col("c") == F.col("n"))
            .select("query_id", "doc_id", F.col("w.qpos").alias("slots"), F.col("w.p").alias("places")))

    def run(batches):
        for pdf in batches:
            ok = [_all_placed(s, p) for s, p in zip(pdf["slots"], pdf["places"], strict=True)]
            yield pdf.loc[ok, ["query_id", "doc_id"]]

    kinds = {f.name: f.dataType.simpleString() for f in full.schema.fields}
    return full.mapInPandas(run, f"query_id {kinds['query_id']}, doc_id {kinds['doc_id']}").distinct()


def slot_match(occ: DataFrame, slots: DataFrame, slop: int) -> DataFrame:
    """(query_id, doc_id) where every slot takes a distinct position p_i with
    max(p_i − i) − min(p_i − i) ≤ slop.

    ``occ``: (query_id, doc_id, qpos, p); ``slots``: (query_id, qpos, slot_key)
    where equal slot_keys (repeated terms) compete for positions.
    """
    s = occ.withColumn("s", F.col("p") - F.col("qpos"))
    n = slots.groupBy("query_id").agg(F.countDistinct("qpos", *([] if slop else ["slot_key"])).alias("n"))
    if slop == 0:
        # p = s + qpos: one occurrence row per (s, qpos, slot_key) at most, so a
        # plain count is the number of distinct slots (of terms, where the
        # tokenizer puts several at one position)
        g = (s.groupBy("query_id", "doc_id", "s").agg(F.count("*").alias("c"))
             .join(n, "query_id").where(F.col("c") == F.col("n")))
        return g.select("query_id", "doc_id").distinct()
    j = _windows(s, slop)
    # queries whose slots are all different terms: distinct positions are
    # automatic, a window holding every slot is enough
    keys = checkpointed(slots.groupBy("query_id").agg(F.countDistinct("slot_key").alias("nk"),
                                                      F.countDistinct("qpos").alias("n")))
    # one size check for the per-query tables below (all are subsets of keys)
    bc = F.broadcast if fits_broadcast(keys) else (lambda d: d)
    # (slots seen in a window as a bit mask when a query has ≤ 62 slots,
    # else a distinct count)
    simple_q = keys.where((F.col("nk") == F.col("n")) & (F.col("n") <= 62)).select("query_id", "n")
    wide_q = keys.where((F.col("nk") == F.col("n")) & (F.col("n") > 62)).select("query_id")
    repeat_q = keys.where(F.col("nk") < F.col("n")).select("query_id")
    bit = F.expr("shiftleft(CAST(1 AS BIGINT), qpos)")
    simple = (j.join(bc(simple_q), "query_id")
              .groupBy("query_id", "doc_id", "a").agg(F.bit_or(bit).alias("m"), F.max("n").alias("n"))
              .where(F.col("m") == F.expr("shiftleft(CAST(1 AS BIGINT), n) - 1"))
              .select("query_id", "doc_id").distinct())
    wide = (j.join(bc(wide_q), "query_id", "left_semi")
            .select("query_id", "doc_id", "a", "qpos").distinct()
            .groupBy("query_id", "doc_id", "a").agg(F.count("*").alias("c"))
            .join(n, "query_id").where(F.col("c") == F.col("n")).select("query_id", "doc_id").distinct())
    # which paths are needed at all: one summary row
    flags = keys.agg(F.max(F.col("n") > 62).alias("wide"), F.max(F.col("nk") < F.col("n")).alias("rep")).first()
    if flags["wide"]:
        simple = simple.unionByName(wide)
    if not flags["rep"]:
        return simple
    j = j.join(bc(repeat_q), "query_id", "left_semi")
    # repeated terms compete for positions: greedy assignment in slot order
    jk = j.join(slots, ["query_id", "qpos"])
    per_key = jk.groupBy("query_id", "doc_id", "a", "slot_key").agg(
        F.array_sort(F.collect_set("p")).alias("ps"))
    need = slots.groupBy("query_id", "slot_key").agg(F.array_sort(F.collect_set("qpos")).alias("qs"))
    per_key = per_key.join(need, ["query_id", "slot_key"])

    def step(acc, i):
        cands = F.filter(F.col("ps"), lambda p: (p > acc["last"]) & (p >= F.col("a") + i) & (p <= F.col("a") + i + slop))
        ok = acc["ok"] & (F.size(cands) > 0)
        return F.struct(F.when(F.size(cands) > 0, F.element_at(cands, 1)).otherwise(acc["last"]).alias("last"),
                        ok.alias("ok"))

    ok = F.aggregate(F.col("qs"), F.struct(F.lit(-1).cast("int").alias("last"), F.lit(True).alias("ok")), step,
                     lambda acc: acc["ok"])
    good = (per_key.where(ok).groupBy("query_id", "doc_id", "a").agg(F.count("*").alias("k"))
            .join(keys, "query_id").where(F.col("k") == F.col("nk")))
    return simple.unionByName(good.select("query_id", "doc_id").distinct())


def phrase(index: SearchIndex, queries: DataFrame, field: str, value: str = "query", q: Query = NOQ) -> DataFrame:
    """``phrase``: query terms at consecutive positions (``q.slop`` relaxes it).

    Documents are first cut to those containing all terms (scored by the
    BM25 sum of the terms), then only their positions are exploded.
    """
    tok = q.tokenizer or index.query_tokenizer(field)
    if not tok.has_positions:
        raise ValueError(f"field {field!r} has no positions (tokenizer {tok.describe()})")
    if q.slop and tok.name == "edge_ngram":
        raise ValueError("slop is not defined where a position holds several terms (edge_ngram)")
    if q.fuzzy:
        raise ValueError("a phrase takes no fuzzy modifier")
    qt = query_terms(index, queries, field, value, q)
    # candidates (documents with every term, BM25-scored) are used twice:
    # written once to the checkpoint folder instead of computed twice
    cand = checkpointed(match(index, queries, field, "all", value, q.with_(boost=None, const=None, fuzzy=None)))
    occ = occurrences(index, qt, field, cand)
    slots = qt.select("query_id", "qpos", F.col("term").alias("slot_key"))
    hit = slot_match(occ, slots, q.slop)
    return _finish(cand.join(hit, ["query_id", "doc_id"], "left_semi"), q)


def expanded_phrase(index: SearchIndex, slot_terms: DataFrame, nslots: DataFrame, field: str, slop: int = 0) -> DataFrame:
    """Phrase over slots that each stand for a set of vocabulary terms.

    ``slot_terms``: (query_id, qpos, term); ``nslots``: (query_id, n), the slots
    the query asks for, so one without any term leaves the query unmatched.
    Score 1.0 (prefix / regex parts).
    """
    slot_terms = checkpointed(slot_terms)
    p = pruned_postings(index, field, slot_terms).select("term", "doc_id")
    # documents having some term of every slot
    have = (join_small(p, slot_terms, "term").select("query_id", "doc_id", "qpos").distinct()
            .groupBy("query_id", "doc_id").agg(F.count("*").alias("c"))
            .join(nslots, "query_id").where(F.col("c") == F.col("n")).select("query_id", "doc_id"))
    occ = occurrences(index, slot_terms, field, have)
    occ = occ.select("query_id", "doc_id", "qpos", "p").distinct()
    slots = slot_terms.select("query_id", "qpos", F.col("qpos").cast("string").alias("slot_key")).distinct()
    # slots compete for a position only if they can hold the same term
    rivals = slot_terms.groupBy("query_id", "term").agg(F.countDistinct("qpos").alias("c")).where("c > 1")
    rivals = checkpointed(rivals.select("query_id").distinct())
    if slop and not rivals.isEmpty():
        hit = slot_match(occ.join(rivals, "query_id", "left_anti"), slots.join(rivals, "query_id", "left_anti"), slop)
        hit = hit.unionByName(shared_slot_match(occ.join(rivals, "query_id", "left_semi"), nslots, slop))
    else:
        hit = slot_match(occ, slots, slop)
    return hit.withColumn("score", F.lit(1.0))


def phrase_prefix(index: SearchIndex, queries: DataFrame, field: str, value: str = "query",
                  max_expansions: int = 50) -> DataFrame:
    """``phrasePrefix``: words of the array in order, the last one a prefix."""
    qt = query_terms(index, queries, field, value)
    last = qt.groupBy("query_id").agg(F.max("qpos").alias("lastpos"))
    qt = qt.join(last, "query_id")
    fixed = qt.where(F.col("qpos") < F.col("lastpos")).select("query_id", "qpos", "term")
    pref = qt.where(F.col("qpos") == F.col("lastpos")).select("query_id", F.col("qpos"), F.col("term").alias("prefix"))
    exp = prefix_terms(index, field, pref.select("query_id", "prefix"), max_expansions)
    exp = exp.join(pref.select("query_id", "qpos"), "query_id").select("query_id", "qpos", "term")
    nslots = qt.groupBy("query_id").agg(F.countDistinct("qpos").alias("n"))
    return expanded_phrase(index, fixed.unionByName(exp), nslots, field, 0)


def regex_phrase(index: SearchIndex, field: str, phrases: dict | DataFrame, slop: int = 0,
                 max_expansions: int | None = None) -> DataFrame:
    """``regexPhrase``: element i of the list is a pattern for position i.
    ``phrases``: a table (query_id, patterns), or query id → list."""
    if not isinstance(phrases, DataFrame):
        phrases = index.spark.createDataFrame(list(phrases.items()), "query_id bigint, patterns array<string>")
    slots = phrases.select("query_id", F.posexplode("patterns").alias("qpos", "pattern"))
    slot_terms = pattern_terms(index, field, slots, max_expansions).select("query_id", "term", "qpos")
    return expanded_phrase(index, slot_terms, phrases.select("query_id", F.size("patterns").cast("bigint").alias("n")), field, slop)


# ---------------------------------------------------------------------------
# combinators
# ---------------------------------------------------------------------------

def both(a: DataFrame, b: DataFrame) -> DataFrame:
    """AND: documents in both, scores added."""
    return (a.join(b.withColumnRenamed("score", "s2"), ["query_id", "doc_id"])
            .select("query_id", "doc_id", (F.col("score") + F.col("s2")).alias("score")))


def either(a: DataFrame, b: DataFrame) -> DataFrame:
    """OR: documents in either, scores of the matching parts added."""
    return a.unionByName(b).groupBy("query_id", "doc_id").agg(F.sum("score").alias("score"))


def without(a: DataFrame, b: DataFrame) -> DataFrame:
    """AND NOT: documents of ``a`` not in ``b``."""
    return a.join(b.select("query_id", "doc_id"), ["query_id", "doc_id"], "left_anti")


def as_filter(a: DataFrame) -> DataFrame:
    """A part used as a filter: it contributes no score."""
    return a.withColumn("score", F.lit(0.0))


def rounded(df: DataFrame, col: str = "score") -> DataFrame:
    return df.withColumn(col, F.round(F.col(col), SCORE_DECIMALS))


def top_k(df: DataFrame, k: int, order=None, part: str = "query_id") -> DataFrame:
    """Per-query top-k (row_number ≤ k) with a ``rank`` column; Spark plans it
    as a partial per-partition limit (WindowGroupLimit) before the shuffle."""
    order = order or [F.col("score").desc(), F.col("doc_id").asc()]
    w = Window.partitionBy(part).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
