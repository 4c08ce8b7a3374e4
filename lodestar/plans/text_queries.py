"""Registered text-search queries (tokenizers, index, predicates, modifiers,
highlights) with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import analysis as A
from ..operators import highlight as H
from ..operators import mlt as M
from ..operators import proximity as P
from ..operators import search as S
from ..operators import topk as T
from ..operators.index import Field, row_postings
from ..operators.querystring import query_string
from . import oracle as O
from .registry import documents_index, reg, stored_index, table

# ---------------------------------------------------------------------------
# query inputs (fixed query texts; they run over the whole tables)
# ---------------------------------------------------------------------------
WORD_QUERIES = [(1, "the"), (2, "thha reea"), (3, "ingat and"), (4, "aile queque"), (5, "zzzzq")]
HIGHLIGHT_QUERIES = [(1, "thha reea"), (2, "ingat"), (3, "aile queque")]
TERM_QUERIES = [(1, "the"), (2, "thha"), (3, "Thha")]
ARRAY_QUERIES = [(1, ["thha", "reea"]), (2, ["the", "of", "and"]), (3, ["ingat"])]
SLOP_PHRASES = [(1, "of the"), (2, "the and"), (3, "thha reea"), (4, "is the of")]
REGEXES = {1: "th[a-z]a", 2: "re+a", 3: "ing.t"}
FUZZY_QUERIES = [(1, "thha"), (2, "reeaa"), (3, "ingta")]
PREFIX_FUZZY_QUERIES = [(1, "thh"), (2, "ingt")]
NOSWAP_FUZZY_QUERIES = [(1, "thah"), (2, "ingat")]
PHRASE_PREFIXES = [(1, ["of", "th"]), (2, ["thha", "re"]), (3, ["the", "a"])]
REGEX_PHRASES = {1: ["th.*", "an."], 2: ["re+a", "th.a"]}


def _q(spark, rows, vtype="string"):
    return spark.createDataFrame(rows, f"query_id bigint, query {vtype}")


def _bench(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def _qv(rows):
    return f"q AS (SELECT query_id::BIGINT AS query_id, query FROM {O.values(rows, 'query_id, query')})"


QB_SQL = "q AS (SELECT item_id AS query_id, text AS query FROM benchmark)"
DOCS = O.index_ctes("d", "documents", "doc_id", "text")


def _match_oracle(qcte, mode, extra=""):
    ctes, body = O.match_sql("d", "qt", mode)
    return (f"WITH {DOCS},\n{qcte},\n{O.query_terms('qt', 'q')},\n{ctes}{extra}\n"
            f"SELECT query_id, doc_id, round(score, 6) AS score FROM ({body})")


# ---------------------------------------------------------------------------
# tokenizers: corpus term statistics (term, df, cf)
# ---------------------------------------------------------------------------

def term_stats(df, key, col, tok):
    # a document's tokens are counted where it is, so what is aggregated is the vocabulary
    source = F.col(col) if isinstance(col, str) else col
    counted = row_postings(df.repartition(F.col(key)), key, [Field(source, tok, name="text")])
    return counted.groupBy("term").agg(F.count("doc_id").alias("df"), F.sum("tf").alias("cf"))


def token_table(df, key, col, tok):
    return df.select(F.col(key).alias("doc_id"), F.inline(tok.tokens(col)))


def _stats_sql(table_, key, expr, list_expr):
    return (f"WITH {O.tok_rows('t', table_, key, expr, list_expr=list_expr)}\n"
            f"SELECT term, count(DISTINCT doc_id) AS df, count(*) AS cf FROM t GROUP BY term")


def _tok_query(name, table_, key, col, tok, list_expr, expr=None):
    reg(name, _stats_sql(table_, key, expr or col, list_expr))(
        lambda spark, sf: term_stats(table(spark, sf, table_), key, F.expr(expr) if expr else col, tok))


_tok_query("tk_unicode_words", "documents", "doc_id", "text", A.unicode_words(), O.toks("text"))
_tok_query("tk_remove_emojis", "documents", "doc_id", "text", A.unicode_words(remove_emojis=True),
           O.toks("text", O.PLAIN))
_tok_query("tk_simple", "documents", "doc_id", "text", A.simple(), O.toks("text", O.PLAIN))
_tok_query("tk_lowercase_off", "documents", "doc_id", "text", A.unicode_words(lowercase=False),
           O.toks("text", lower=False))
_tok_query("tk_stemmer_english", "documents", "doc_id", "text", A.simple(stemmer="english"),
           f"list_transform({O.toks('text', O.PLAIN)}, lambda w: {O.stem_sql('w')})")
_tok_query("tk_whitespace", "documents", "doc_id", "text", A.whitespace(), O.toks("text", r"\S+"))
_tok_query("tk_literal", "part", "p_partkey", "p_type", A.literal(), "[p_type]")
_tok_query("tk_literal_normalized", "part", "p_partkey", "p_type", A.literal_normalized(), "[lower(p_type)]")
_tok_query("tk_trim", "part", "p_partkey", "p_name", A.literal_normalized(trim=True),
           "[lower(trim(concat('  ', p_name, ' ')))]", expr="concat('  ', p_name, ' ')")


def _ngram_sql(c, lo, hi):
    s = f"lower({c})"
    return (f"flatten(list_transform(range(0, greatest(length({s}) - {lo} + 1, 0)), lambda st: "
            f"list_transform(list_filter(range({lo}, {hi} + 1), lambda ln: st + ln <= length({s})), "
            f"lambda ln: substring({s}, st + 1, ln))))")


_tok_query("tk_ngram", "part", "p_partkey", "p_name", A.ngram(2, 4), _ngram_sql("p_name", 2, 4))


def _edge_sql(c, lo, hi, pat):
    return (f"flatten(list_transform(regexp_extract_all(lower({c}), '{pat}'), lambda w: "
            f"list_transform(list_filter(range({lo}, {hi} + 1), lambda ln: ln <= length(w)), "
            f"lambda ln: substring(w, 1, ln))))")


_tok_query("tk_edge_ngram", "part", "p_partkey", "p_name", A.edge_ngram(2, 5), _edge_sql("p_name", 2, 5, O.PLAIN))
_tok_query("tk_token_chars", "part", "p_partkey", "p_brand",
           A.edge_ngram(2, 5, token_chars="letter,digit,punctuation"),
           _edge_sql("p_brand", 2, 5, r"[\p{L}\p{N}\p{P}]+"))
_tok_query("tk_regex_pattern", "documents", "doc_id", "text", A.regex_pattern("[a-z]+"), O.toks("text", "[a-z]+"))
_SRC_SQL = (r"regexp_extract_all(lower(regexp_replace(regexp_replace(regexp_replace(html, '(\p{Ll})(\p{Lu})', "
            r"'\1 \2', 'g'), '(\p{L})(\p{N})', '\1 \2', 'g'), '(\p{N})(\p{L})', '\1 \2', 'g')), '[\p{L}\p{N}]+')")
_tok_query("tk_source_code", "pages", "page_id", "html", A.source_code(), _SRC_SQL)
_tok_query("tk_chinese_compatible", "documents", "doc_id", "text", A.chinese_compatible(),
           r"regexp_extract_all(lower(regexp_replace(text, '(\p{Han})', ' \1 ', 'g')), '[\p{L}\p{N}]+')")


@reg("tk_ngram_positions",
     f"WITH {O.tok_rows('t', 'part', 'p_partkey', 'p_name', list_expr=_ngram_sql('p_name', 3, 3))}\n"
     "SELECT doc_id, term, pos FROM t")
def tk_ngram_positions(spark, sf):
    """3-grams of the part name with their start offsets as positions."""
    return token_table(table(spark, sf, "part"), "p_partkey", "p_name", A.ngram(3, 3, positions=True)).select(
        "doc_id", "term", "pos")


@reg("tk_ngram_prefix_only",
     "SELECT p_partkey AS doc_id, substring(lower(p_name), 1, 3) AS term, 0::BIGINT AS pos FROM part "
     "WHERE p_name IS NOT NULL AND length(p_name) >= 3")
def tk_ngram_prefix_only(spark, sf):
    return token_table(table(spark, sf, "part"), "p_partkey", "p_name",
                       A.ngram(3, 3, positions=True, prefix_only=True)).select("doc_id", "term", "pos")


@reg("tk_alias",
     f"WITH {O.index_ctes('d', 'documents', 'doc_id', 'text', O.PLAIN)}\n"
     "SELECT 'simple_text' AS field, term, df, cf FROM d_idf")
def tk_alias(spark, sf):
    """A tokenizer's ``alias`` option names the indexed field."""
    idx = stored_index(spark, sf, "documents_simple_alias", "documents", "doc_id",
                       [Field("text", A.simple(alias="simple_text"))])
    return idx.terms.select("field", "term", "df", "cf")


# ---------------------------------------------------------------------------
# index build
# ---------------------------------------------------------------------------

@reg("ix_build", f"WITH {DOCS}\nSELECT 'text' AS field, term, df, cf FROM d_idf")
def ix_build(spark, sf):
    """Vocabulary of the stored documents index (postings → terms)."""
    return documents_index(spark, sf).terms.select("field", "term", "df", "cf")


def _part_index(spark, sf):
    return stored_index(spark, sf, "part_fields", "part", "p_partkey",
                        [Field("p_name"), Field("p_type", A.literal())])


@reg("ix_field_tokenizer",
     f"WITH {O.tok_rows('a', 'part', 'p_partkey', 'p_name')}, {O.tok_rows('b', 'part', 'p_partkey', 'p_type', list_expr='[p_type]')}\n"
     "SELECT 'p_name' AS field, term, count(DISTINCT doc_id) AS df, count(*) AS cf FROM a GROUP BY term "
     "UNION ALL SELECT 'p_type', term, count(DISTINCT doc_id), count(*) FROM b GROUP BY term")
def ix_field_tokenizer(spark, sf):
    """Each field has its own tokenizer (words for the name, literal for the type)."""
    return _part_index(spark, sf).terms.select("field", "term", "df", "cf")


@reg("ix_multi_field",
     f"WITH {O.tok_rows('a', 'part', 'p_partkey', 'p_name')}, "
     f"{O.tok_rows('b', 'part', 'p_partkey', 'p_name', list_expr=_ngram_sql('p_name', 3, 8))}\n"
     "SELECT 'p_name' AS field, term, count(DISTINCT doc_id) AS df FROM a GROUP BY term "
     "UNION ALL SELECT 'p_name_ngram', term, count(DISTINCT doc_id) FROM b GROUP BY term")
def ix_multi_field(spark, sf):
    """One column indexed twice under two names."""
    idx = stored_index(spark, sf, "part_multi", "part", "p_partkey",
                       [Field("p_name"), Field("p_name", A.ngram(3, 8), name="p_name_ngram")])
    return idx.terms.select("field", "term", "df")


@reg("ix_alias", f"WITH {DOCS}\nSELECT 'body' AS field, term, df FROM d_idf")
def ix_alias(spark, sf):
    idx = stored_index(spark, sf, "documents_body", "documents", "doc_id", [Field("text", name="body")])
    return idx.terms.select("field", "term", "df")


@reg("ix_expression",
     f"WITH {O.tok_rows('a', 'part', 'p_partkey', "concat(p_name, ' ', p_type)")}, "
     f"{O.tok_rows('b', 'part', 'p_partkey', '(p_size + 1)', list_expr='[CAST(p_size + 1 AS VARCHAR)]')}\n"
     "SELECT 'name_type' AS field, term, count(DISTINCT doc_id) AS df FROM a GROUP BY term "
     "UNION ALL SELECT 'size_plus_one', term, count(DISTINCT doc_id) FROM b GROUP BY term")
def ix_expression(spark, sf):
    """Indexed expressions: ``name || ' ' || type`` and ``size + 1``."""
    idx = stored_index(spark, sf, "part_expr", "part", "p_partkey",
                       [Field("concat(p_name, ' ', p_type)", name="name_type", is_expr=True),
                        Field("cast(p_size + 1 as string)", A.literal(), name="size_plus_one", is_expr=True)])
    return idx.terms.select("field", "term", "df")


@reg("ix_array_field",
     "WITH e AS (SELECT p_partkey AS doc_id, unnest(range(2)) AS k, "
     "unnest([regexp_extract_all(lower(p_brand), '" + O.WORDS + "'), regexp_extract_all(lower(p_type), '" + O.WORDS +
     "')]) AS t, len(regexp_extract_all(lower(p_brand), '" + O.WORDS + "')) AS n0 FROM part), "
     "x AS (SELECT doc_id, k, n0, unnest(range(len(t))) AS i, unnest(t) AS term FROM e)\n"
     "SELECT doc_id, term, CASE WHEN k = 0 THEN i ELSE n0 + 100 + i END AS pos FROM x")
def ix_array_field(spark, sf):
    """``array(brand, type)`` indexed element by element with a position gap."""
    docs = table(spark, sf, "part").withColumn("tags", F.array("p_brand", "p_type"))
    idx = stored_index(spark, sf, "part_tags", "part", "p_partkey", [Field("tags", is_array=True)], docs=docs)
    return idx.postings.select("doc_id", "term", F.explode("positions").alias("pos"))


@reg("ix_json_text",
     f"WITH {O.tok_rows('t', 'events', 'event_id', 'props', list_expr=O.toks(chr(34) + 'props' + chr(34) + '->>' + chr(39) + 'k' + chr(39)))}\n"
     "SELECT 'props_k' AS field, term, count(DISTINCT doc_id) AS df FROM t GROUP BY term")
def ix_json_text(spark, sf):
    """One JSON key indexed as text."""
    idx = stored_index(spark, sf, "events_json", "events", "event_id",
                       [Field("get_json_object(props, '$.k')", name="props_k", is_expr=True)])
    return idx.terms.select("field", "term", "df")


@reg("ix_json_path",
     "WITH t AS (SELECT event_id, json_extract_string(props, '$.k') AS v FROM events)\n"
     "SELECT 'props.k' AS field, v AS term, count(*) AS df FROM t WHERE v IS NOT NULL GROUP BY v")
def ix_json_path(spark, sf):
    """A JSON path ``props.k`` addressed like a field (literal tokens)."""
    idx = stored_index(spark, sf, "events_json_path", "events", "event_id",
                       [Field("get_json_object(props, '$.k')", A.literal(), name="props.k", is_expr=True)])
    return idx.terms.select("field", "term", "df")


@reg("ix_partial",
     f"WITH {O.index_ctes('d', 'documents', 'doc_id', 'text', where=chr(39).join(['lang = ', 'en', '']))}\n"
     "SELECT term, df, cf, (SELECT n FROM d_st) AS n_docs FROM d_idf")
def ix_partial(spark, sf):
    """Partial index: English rows only."""
    idx = stored_index(spark, sf, "documents_en", "documents", "doc_id", [Field("text")],
                       where="lang = 'en'", where_text="lang = 'en'")
    return idx.terms.join(idx.stats.select("field", "n_docs"), "field").select("term", "df", "cf", "n_docs")


PREFIX_TYPED = [(1, "sma"), (2, "red"), (3, "blu"), (4, "ho"), (5, "gear"), (6, "wid")]


@reg("ix_search_tokenizer",
     f"WITH {O.index_ctes('d', 'part', 'p_partkey', 'p_name', list_expr=_edge_sql('p_name', 2, 5, O.PLAIN))},\n"
     f"{_qv(PREFIX_TYPED)},\n{O.query_terms('qt', 'q')},\n" + ",\n".join(O.match_sql("d", "qt", "any")[:1]) +
     "\nSELECT query_id, doc_id, round(score, 6) AS score FROM (" + O.match_sql("d", "qt", "any")[1] + ")")
def ix_search_tokenizer(spark, sf):
    """Edge n-grams at index time, plain words at query time."""
    idx = stored_index(spark, sf, "part_edge", "part", "p_partkey", [Field("p_name", A.edge_ngram(2, 5))],
                       search_tokenizer=A.unicode_words())
    return S.rounded(S.match_any(idx, _q(spark, PREFIX_TYPED), "p_name"))


# ---------------------------------------------------------------------------
# predicates
# ---------------------------------------------------------------------------

@reg("q_match_all", _match_oracle(QB_SQL, "all"))
def q_match_all(spark, sf):
    """Documents holding every term of a benchmark passage."""
    return S.rounded(S.match_all(documents_index(spark, sf), _bench(spark, sf), "text"))


@reg("q_match_all_array",
     f"WITH {DOCS},\nq AS (SELECT query_id::BIGINT AS query_id, query FROM {O.values(ARRAY_QUERIES, 'query_id, query')}),\n"
     "qt AS (SELECT query_id, unnest(range(len(query))) AS qpos, unnest(query) AS term FROM q),\n"
     + O.match_sql("d", "qt", "all")[0] + "\nSELECT query_id, doc_id, round(score, 6) AS score FROM ("
     + O.match_sql("d", "qt", "all")[1] + ")")
def q_match_all_array(spark, sf):
    """matchAll with arrays of finished terms (not analysed)."""
    return S.rounded(S.match_all(documents_index(spark, sf), _q(spark, ARRAY_QUERIES, "array<string>"), "text"))


@reg("q_match_expr", _match_oracle(
    "q AS (SELECT item_id AS query_id, concat(text, ' ', lower(text)) AS query FROM benchmark)", "all"))
def q_match_expr(spark, sf):
    """The query value is an expression over a column (``text || ' ' || lower(text)``)."""
    q = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"),
                                             F.concat("text", F.lit(" "), F.lower("text")).alias("query"))
    return S.rounded(S.match_all(documents_index(spark, sf), q, "text"))


@reg("q_match_any", _match_oracle(QB_SQL, "any"))
def q_match_any(spark, sf):
    """Documents holding any term of a benchmark passage, BM25 scored."""
    return S.rounded(S.match_any(documents_index(spark, sf), _bench(spark, sf), "text"))


@reg("q_match_alias", _match_oracle(_qv(WORD_QUERIES), "any"))
def q_match_alias(spark, sf):
    """Match on the aliased field ``body``."""
    idx = stored_index(spark, sf, "documents_body", "documents", "doc_id", [Field("text", name="body")])
    return S.rounded(S.match_any(idx, _q(spark, WORD_QUERIES), "body"))


def _phrase_oracle(qcte, slop_sql=None):
    ctes, body = O.match_sql("d", "qt", "all")
    hit = ("hit AS (SELECT DISTINCT o.query_id, o.doc_id FROM (SELECT qt.query_id, t.doc_id, qt.qpos, t.pos - qt.qpos AS s "
           "FROM qt JOIN d_tok t ON t.term = qt.term) o JOIN (SELECT query_id, count(*) AS n FROM qt GROUP BY query_id) c "
           "ON c.query_id = o.query_id GROUP BY o.query_id, o.doc_id, o.s, c.n HAVING count(DISTINCT o.qpos) = c.n)")
    return (f"WITH {DOCS},\n{qcte},\n{O.query_terms('qt', 'q')},\n{ctes},\n{slop_sql or hit}\n"
            f"SELECT m.query_id, m.doc_id, round(m.score, 6) AS score FROM ({body}) m "
            f"JOIN hit h ON h.query_id = m.query_id AND h.doc_id = m.doc_id")


@reg("q_phrase", _phrase_oracle(QB_SQL))
def q_phrase(spark, sf):
    """Documents containing a benchmark passage as consecutive tokens."""
    return S.rounded(S.phrase(documents_index(spark, sf), _bench(spark, sf), "text"))


def _slop_hits(phrases, slop, name="hit"):
    parts = []
    for qid, text in phrases:
        ws = text.split()
        js = [f"JOIN d_tok a{i} ON a{i}.doc_id = a0.doc_id AND a{i}.term = '{w}' "
              f"AND abs((a{i}.pos - {i}) - a0.pos) <= {slop}" for i, w in enumerate(ws) if i]
        shifts = ", ".join(f"a{i}.pos - {i}" for i in range(len(ws)))
        rng = f"greatest({shifts}) - least({shifts}) <= {slop}" if len(ws) > 1 else "true"
        parts.append(f"SELECT DISTINCT {qid}::BIGINT AS query_id, a0.doc_id FROM d_tok a0 {' '.join(js)} "
                     f"WHERE a0.term = '{ws[0]}' AND {rng}")
    return f"{name} AS ({' UNION ALL '.join(parts)})"


@reg("q_phrase_slop", _phrase_oracle(_qv(SLOP_PHRASES), _slop_hits(SLOP_PHRASES, 2)))
def q_phrase_slop(spark, sf):
    """Phrases with slop 2 (shifts p_i − i within 2, distinct positions)."""
    return S.rounded(S.phrase(documents_index(spark, sf), _q(spark, SLOP_PHRASES), "text", q=S.Query(slop=2)))


def _expanded_phrase_sql(slot_sql, slop=0):
    # slot_sql: CTE st(query_id, qpos, term)
    if slop == 0:
        hit = ("SELECT DISTINCT o.query_id, o.doc_id FROM (SELECT st.query_id, t.doc_id, st.qpos, t.pos - st.qpos AS s "
               "FROM st JOIN d_tok t ON t.term = st.term) o JOIN (SELECT query_id, count(DISTINCT qpos) AS n FROM st "
               "GROUP BY query_id) c ON c.query_id = o.query_id GROUP BY o.query_id, o.doc_id, o.s, c.n "
               "HAVING count(DISTINCT o.qpos) = c.n")
    else:  # two slots
        hit = ("SELECT DISTINCT a.query_id, x.doc_id FROM st a JOIN d_tok x ON x.term = a.term AND a.qpos = 0 "
               "JOIN st b ON b.query_id = a.query_id AND b.qpos = 1 JOIN d_tok y ON y.term = b.term "
               f"AND y.doc_id = x.doc_id AND y.pos <> x.pos AND abs((y.pos - 1) - x.pos) <= {slop}")
    return (f"WITH {DOCS},\n{slot_sql}\nSELECT query_id, doc_id, 1.0::DOUBLE AS score FROM ({hit})")


_PP_SLOTS = (f"q AS (SELECT query_id::BIGINT AS query_id, query FROM {O.values(PHRASE_PREFIXES, 'query_id, query')}),\n"
             "qa AS (SELECT query_id, unnest(range(len(query))) AS qpos, unnest(query) AS w, len(query) - 1 AS lastpos FROM q),\n"
             "ex AS (SELECT query_id, qpos, term FROM (SELECT qa.query_id, qa.qpos, i.term, row_number() OVER "
             "(PARTITION BY qa.query_id ORDER BY i.term) AS rn FROM qa JOIN d_idf i ON starts_with(i.term, qa.w) "
             "WHERE qa.qpos = qa.lastpos) WHERE rn <= 50),\n"
             "st AS (SELECT query_id, qpos, w AS term FROM qa WHERE qpos < lastpos UNION ALL SELECT * FROM ex)")


@reg("q_phrase_prefix", _expanded_phrase_sql(_PP_SLOTS))
def q_phrase_prefix(spark, sf):
    """Phrase whose last word is a prefix (first 50 expansions in term order)."""
    return S.phrase_prefix(documents_index(spark, sf), _q(spark, PHRASE_PREFIXES, "array<string>"), "text")


_RP_SLOTS = ("st AS (" + " UNION ALL ".join(
    f"SELECT {qid}::BIGINT AS query_id, {i}::BIGINT AS qpos, term FROM d_idf WHERE regexp_full_match(term, '{p}')"
    for qid, pats in REGEX_PHRASES.items() for i, p in enumerate(pats)) + ")")


@reg("q_regex_phrase", _expanded_phrase_sql(_RP_SLOTS, slop=1))
def q_regex_phrase(spark, sf):
    """Each element a pattern over the vocabulary, slop 1."""
    return S.regex_phrase(documents_index(spark, sf), "text", REGEX_PHRASES, slop=1)


def _exact_oracle(qcte):
    ex = "ex AS (SELECT DISTINCT query_id, query AS qterm, query AS term FROM q)"
    return (f"WITH {DOCS},\n{qcte},\n{ex},\n{O.bm25_cte('bm', 'd', 'ex')}\n"
            "SELECT query_id, doc_id, round(sum(score), 6) AS score FROM bm GROUP BY query_id, doc_id")


@reg("q_term", _exact_oracle(_qv(TERM_QUERIES)))
def q_term(spark, sf):
    """Exact token, not analysed (``Thha`` finds nothing)."""
    return S.rounded(S.term(documents_index(spark, sf), _q(spark, TERM_QUERIES), "text"))


@reg("q_term_set",
     _exact_oracle(f"q AS (SELECT 1::BIGINT AS query_id, unnest(['thha', 'reea', 'ingat']) AS query)"))
def q_term_set(spark, sf):
    """``term`` with an array: any of the exact tokens."""
    return S.rounded(S.term(documents_index(spark, sf), _q(spark, [(1, ["thha", "reea", "ingat"])], "array<string>"),
                            "text"))


@reg("q_regex",
     f"WITH {DOCS}\n" + " UNION ALL ".join(
         f"SELECT DISTINCT {qid}::BIGINT AS query_id, p.doc_id, 1.0::DOUBLE AS score FROM d_post p "
         f"WHERE regexp_full_match(p.term, '{pat}')" for qid, pat in REGEXES.items()))
def q_regex(spark, sf):
    """A token full-matches the pattern."""
    return S.regex(documents_index(spark, sf), "text", REGEXES)


# ---------------------------------------------------------------------------
# proximity
# ---------------------------------------------------------------------------

def _prox_pair_sql(a_cond, b_cond, d, ordered):
    gap = "b.pos > a.pos" if ordered else "b.pos <> a.pos"
    return (f"SELECT DISTINCT a.doc_id FROM d_tok a JOIN d_tok b ON b.doc_id = a.doc_id AND {gap} "
            f"AND abs(a.pos - b.pos) - 1 <= {d} WHERE {a_cond} AND {b_cond}")


def _prox_oracle(sel):
    return f"WITH {DOCS}\nSELECT 1::BIGINT AS query_id, doc_id, 1.0::DOUBLE AS score FROM ({sel})"


@reg("q_prox", _prox_oracle(_prox_pair_sql("a.term = 'thha'", "b.term = 'reea'", 3, False)))
def q_prox(spark, sf):
    """``thha`` within 3 tokens of ``reea``, either order."""
    return P.proximity(documents_index(spark, sf), "text", {1: P.prox_str("thha").within(3, "reea")})


@reg("q_prox_ordered", _prox_oracle(_prox_pair_sql("a.term = 'thha'", "b.term = 'reea'", 3, True)))
def q_prox_ordered(spark, sf):
    return P.proximity(documents_index(spark, sf), "text", {1: P.prox_str("thha").within(3, "reea", True)})


@reg("q_prox_regex", _prox_oracle(_prox_pair_sql("regexp_full_match(a.term, 'th.a')", "b.term = 'and'", 2, False)))
def q_prox_regex(spark, sf):
    return P.proximity(documents_index(spark, sf), "text", {1: P.prox_regex("th.a").within(2, "and")})


@reg("q_prox_array", _prox_oracle(_prox_pair_sql("(regexp_full_match(a.term, 're.a') OR a.term = 'thha')",
                                                 "b.term = 'and'", 1, False)))
def q_prox_array(spark, sf):
    return P.proximity(documents_index(spark, sf), "text",
                       {1: P.prox_array(P.prox_regex("re.a"), "thha").within(1, "and")})


def _span_join(span, leaf_cond, d):
    return (f"SELECT DISTINCT s.doc_id FROM ({span}) s JOIN d_tok c ON c.doc_id = s.doc_id AND {leaf_cond} AND "
            f"((c.pos > s.e AND c.pos - s.e - 1 <= {d}) OR (c.pos < s.s AND s.s - c.pos - 1 <= {d}))")


def _pair_span(a_cond, b_cond, d):
    return (f"SELECT DISTINCT a.doc_id, least(a.pos, b.pos) AS s, greatest(a.pos, b.pos) AS e FROM d_tok a "
            f"JOIN d_tok b ON b.doc_id = a.doc_id AND b.pos <> a.pos AND abs(a.pos - b.pos) - 1 <= {d} "
            f"WHERE {a_cond} AND {b_cond}")


@reg("q_prox_chained", _prox_oracle(_span_join(_pair_span("a.term = 'the'", "b.term = 'and'", 1),
                                               "(c.term = 'of' OR regexp_full_match(c.term, 'th.a'))", 2)))
def q_prox_chained(spark, sf):
    """(the ~1 and) ~2 (of | /th.a/): left-nested chain of spans."""
    e = P.prox_str("the").within(1, "and").within(2, P.prox_array("of", P.prox_regex("th.a")))
    return P.proximity(documents_index(spark, sf), "text", {1: e})


@reg("q_prox_nested", _prox_oracle(_span_join(_pair_span("a.term = 'of'", "b.term = 'and'", 1), "c.term = 'the'", 1)))
def q_prox_nested(spark, sf):
    """the ~1 (of ~1 and): right-nested."""
    e = P.prox_str("the").within(1, P.prox_str("of").within(1, "and"))
    return P.proximity(documents_index(spark, sf), "text", {1: e})


@reg("q_all", "SELECT 0::BIGINT AS query_id, doc_id, 1.0::DOUBLE AS score FROM documents")
def q_all(spark, sf):
    return S.all_rows(table(spark, sf, "documents"), "doc_id")


@reg("q_exists", "SELECT 0::BIGINT AS query_id, doc_id, 1.0::DOUBLE AS score FROM documents WHERE text IS NOT NULL")
def q_exists(spark, sf):
    return S.exists(documents_index(spark, sf), "text")


# ---------------------------------------------------------------------------
# query strings
# ---------------------------------------------------------------------------

QS = {1: "text:thha AND text:reea", 2: "text:(thha reea)", 3: "thha OR ingat", 4: "text:thha AND NOT text:reea",
      5: "n_chars:>5000 AND text:reea"}
QS_LENIENT = {1: "thha AND nosuchfield:zz", 2: "reea ) ingat", 3: "text:ingat & aile"}
QS_CONJ = {1: "thha reea", 2: "the and ingat"}


def _qs_index(spark, sf):
    return documents_index(spark, sf)


def _w(qid, word):
    return (f"(SELECT {qid}::BIGINT AS query_id, p.doc_id, {O.BM25} AS score FROM d_post p JOIN d_idf i ON i.term = p.term "
            f"JOIN d_dl d ON d.doc_id = p.doc_id CROSS JOIN d_st st WHERE p.term = '{word}')")


def _and(a, b):
    return (f"(SELECT x.query_id, x.doc_id, x.score + y.score AS score FROM {a} x JOIN {b} y "
            f"ON x.doc_id = y.doc_id)")


def _or(a, b):
    return f"(SELECT query_id, doc_id, sum(score) AS score FROM (SELECT * FROM {a} UNION ALL SELECT * FROM {b}) GROUP BY ALL)"


def _not(a, qid):
    return (f"(SELECT {qid}::BIGINT AS query_id, doc_id, 0.0::DOUBLE AS score FROM d_dl WHERE doc_id NOT IN "
            f"(SELECT doc_id FROM {a}))")


def _cmp(qid, cond):
    return f"(SELECT {qid}::BIGINT AS query_id, doc_id, 0.0::DOUBLE AS score FROM documents WHERE {cond})"


def _qs_sql(parts):
    return (f"WITH {DOCS}\nSELECT query_id, doc_id, round(score, 6) AS score FROM ("
            + " UNION ALL ".join(f"SELECT * FROM {p}" for p in parts) + ")")


@reg("q_query_string", _qs_sql([
    _and(_w(1, "thha"), _w(1, "reea")),
    _or(_w(2, "thha"), _w(2, "reea")),
    _or(_w(3, "thha"), _w(3, "ingat")),
    _and(_w(4, "thha"), _not(_w(4, "reea"), 4)),
    _and(_cmp(5, "n_chars > 5000"), _w(5, "reea"))]))
def q_query_string(spark, sf):
    """field:term, field:(a b), OR, AND NOT, field:>n."""
    return S.rounded(query_string(_qs_index(spark, sf), QS, table(spark, sf, "documents"), ["n_chars"]))


@reg("q_query_string_lenient", _qs_sql([_w(1, "thha"), _or(_w(2, "reea"), _w(2, "ingat")),
                                        _or(_w(3, "ingat"), _w(3, "aile"))]))
def q_query_string_lenient(spark, sf):
    """Unknown fields and stray punctuation are dropped."""
    return S.rounded(query_string(_qs_index(spark, sf), QS_LENIENT, lenient=True))


@reg("q_query_string_conj", _qs_sql([_and(_w(1, "thha"), _w(1, "reea")),
                                     _and(_and(_w(2, "the"), _w(2, "and")), _w(2, "ingat"))]))
def q_query_string_conj(spark, sf):
    """Bare terms joined by AND (conjunction mode)."""
    return S.rounded(query_string(_qs_index(spark, sf), QS_CONJ, conjunction_mode=True))


# ---------------------------------------------------------------------------
# more like this
# ---------------------------------------------------------------------------

def _mlt_sql(src_cte, opts=None, top=10, exclude=False, filt=None, field_sql="d"):
    o = opts or {}
    conds = [f"s.tf >= {o.get('min_tf', 1)}", f"i.df >= {o.get('min_df', 1)}"]
    if o.get("max_df") is not None:
        conds.append(f"i.df <= {o['max_df']}")
    if o.get("min_len") is not None:
        conds.append(f"length(s.term) >= {o['min_len']}")
    if o.get("max_len") is not None:
        conds.append(f"length(s.term) <= {o['max_len']}")
    if o.get("stop"):
        conds.append("s.term NOT IN (" + ", ".join(f"'{w}'" for w in o["stop"]) + ")")
    mq = o.get("max_terms", 25)
    kept = ("kept AS (SELECT DISTINCT query_id, term FROM (SELECT s.query_id, s.src, s.term, row_number() OVER "
            "(PARTITION BY s.query_id, s.src ORDER BY s.tf * i.idf DESC, s.term) AS rn FROM src s JOIN d_idf i "
            f"ON i.term = s.term WHERE {' AND '.join(conds)}) WHERE rn <= {mq})")
    ex = "ex AS (SELECT query_id, term AS qterm, term FROM kept)"
    res = "SELECT query_id, doc_id, round(sum(score), 6) AS score FROM bm GROUP BY query_id, doc_id"
    if exclude:
        res = (f"SELECT * FROM ({res}) r WHERE NOT EXISTS (SELECT 1 FROM srcids x WHERE x.query_id = r.query_id "
               "AND x.src = r.doc_id)")
    if filt:
        res = f"SELECT r.* FROM ({res}) r JOIN documents f ON f.doc_id = r.doc_id WHERE {filt}"
    return (f"WITH {DOCS},\n{src_cte},\n{kept},\n{ex},\n{O.bm25_cte('bm', 'd', 'ex')}\n"
            f"SELECT query_id, doc_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id "
            f"ORDER BY score DESC, doc_id) AS rank FROM ({res})) WHERE rank <= {top}")


_MLT_DOC_SRC = ("src AS (SELECT query_id, 0 AS src, term, count(*) AS tf FROM (SELECT item_id AS query_id, "
                f"unnest({O.toks('text')}) AS term FROM benchmark) GROUP BY query_id, term)")
_MLT_ID_SRC = ("srcids AS (SELECT doc_id AS query_id, doc_id AS src FROM labels),\n"
               "src AS (SELECT x.query_id, x.src, p.term, p.tf FROM srcids x JOIN d_post p ON p.doc_id = x.src)")


@reg("q_mlt_doc", _mlt_sql(_MLT_DOC_SRC))
def q_mlt_doc(spark, sf):
    """Rows like a given document (each benchmark passage as the text field)."""
    docs = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return M.most_like_this_document(documents_index(spark, sf), docs, 10)


def _labels_src(spark, sf):
    return table(spark, sf, "labels").select(F.col("doc_id").alias("query_id"), F.col("doc_id").alias("src_id"))


@reg("q_mlt_id", _mlt_sql(_MLT_ID_SRC))
def q_mlt_id(spark, sf):
    """Rows like each labelled document, all sources in one job."""
    return M.most_like_this_id(documents_index(spark, sf), _labels_src(spark, sf), 10)


@reg("q_mlt_fields", _mlt_sql(_MLT_ID_SRC))
def q_mlt_fields(spark, sf):
    """``fields`` restricts source and target to the text field of a two-field index."""
    idx = stored_index(spark, sf, "documents_text_source", "documents", "doc_id",
                       [Field("text"), Field("source", A.literal())])
    return M.most_like_this_id(idx, _labels_src(spark, sf), 10, M.MltOptions(fields=("text",)))


_TUNE = dict(min_tf=2, min_df=2, max_df=300, max_terms=10, min_len=3, max_len=12, stop=("the", "and"))


@reg("q_mlt_tuning", _mlt_sql(_MLT_ID_SRC, _TUNE))
def q_mlt_tuning(spark, sf):
    o = M.MltOptions(min_term_frequency=2, min_doc_frequency=2, max_doc_frequency=300, max_query_terms=10,
                     min_word_length=3, max_word_length=12, stopwords=("the", "and"))
    return M.most_like_this_id(documents_index(spark, sf), _labels_src(spark, sf), 10, o)


_MLT_MANY_SRC = ("srcids AS (SELECT (quality * 2 + toxic)::BIGINT AS query_id, doc_id AS src FROM labels),\n"
                 "src AS (SELECT x.query_id, x.src, p.term, p.tf FROM srcids x JOIN d_post p ON p.doc_id = x.src)")


@reg("q_mlt_many", _mlt_sql(_MLT_MANY_SRC, top=20, exclude=True))
def q_mlt_many(spark, sf):
    """Like any of a label group's documents, the group itself excluded."""
    src = table(spark, sf, "labels").select((F.col("quality") * 2 + F.col("toxic")).cast("bigint").alias("query_id"),
                                            F.col("doc_id").alias("src_id"))
    return M.most_like_this_id(documents_index(spark, sf), src, 20, exclude_sources=True)


@reg("h_mlt_filtered", _mlt_sql(_MLT_ID_SRC.replace("FROM labels", "FROM labels WHERE quality = 1"),
                                filt="f.lang = 'en' AND f.n_chars > 1000"))
def h_mlt_filtered(spark, sf):
    """More-like-this of good documents, kept to long English ones."""
    src = _labels_src(spark, sf).join(table(spark, sf, "labels").where("quality = 1").select(
        F.col("doc_id").alias("src_id")), "src_id")
    keep = table(spark, sf, "documents").where("lang = 'en' AND n_chars > 1000").select("doc_id")
    return M.most_like_this_id(documents_index(spark, sf), src, 10, keep=keep)


# ---------------------------------------------------------------------------
# modifiers
# ---------------------------------------------------------------------------

@reg("m_boost", _match_oracle(_qv(WORD_QUERIES), "any").replace("round(score, 6)", "round(score * 2.0, 6)"))
def m_boost(spark, sf):
    return S.rounded(S.match_any(documents_index(spark, sf), _q(spark, WORD_QUERIES), "text", q=S.Query(boost=2.0)))


@reg("m_boost_pred", _phrase_oracle(_qv(SLOP_PHRASES)).replace("round(m.score, 6)", "round(m.score * 1.5, 6)"))
def m_boost_pred(spark, sf):
    """Boost on a whole phrase predicate."""
    return S.rounded(S.phrase(documents_index(spark, sf), _q(spark, SLOP_PHRASES), "text", q=S.Query(boost=1.5)))


@reg("m_const", _match_oracle(_qv(WORD_QUERIES), "any").replace("round(score, 6)", "1.0::DOUBLE"))
def m_const(spark, sf):
    return S.match_any(documents_index(spark, sf), _q(spark, WORD_QUERIES), "text", q=S.Query(const=1.0))


def _fuzzy_oracle(rows, d, prefix=False, swap=True):
    dist = "damerau_levenshtein" if swap else "levenshtein"
    if prefix:
        cond = (f"EXISTS (SELECT 1 FROM range(greatest(length(qt.term) - {d}, 1), least(length(qt.term) + {d}, "
                f"length(i.term)) + 1) r(n) WHERE {dist}(qt.term, left(i.term, r.n::INTEGER)) <= {d})")
    else:
        cond = f"abs(length(qt.term) - length(i.term)) <= {d} AND {dist}(qt.term, i.term) <= {d}"
    ex = f"ex AS (SELECT DISTINCT qt.query_id, qt.term AS qterm, i.term FROM qt JOIN d_idf i ON {cond})"
    return (f"WITH {DOCS},\n{_qv(rows)},\n{O.query_terms('qt', 'q')},\n{ex},\n{O.bm25_cte('bm', 'd', 'ex')}\n"
            "SELECT query_id, doc_id, round(sum(score), 6) AS score FROM bm GROUP BY query_id, doc_id")


@reg("m_fuzzy", _fuzzy_oracle(FUZZY_QUERIES, 1))
def m_fuzzy(spark, sf):
    """Terms within one edit (adjacent swap = 1) of each query word."""
    return S.rounded(S.match_any(documents_index(spark, sf), _q(spark, FUZZY_QUERIES), "text", q=S.Query(fuzzy=1)))


@reg("m_fuzzy_prefix", _fuzzy_oracle(PREFIX_FUZZY_QUERIES, 1, prefix=True))
def m_fuzzy_prefix(spark, sf):
    return S.rounded(S.match_any(documents_index(spark, sf), _q(spark, PREFIX_FUZZY_QUERIES), "text",
                                 q=S.Query(fuzzy=1, prefix=True)))


@reg("m_fuzzy_transposition", _fuzzy_oracle(NOSWAP_FUZZY_QUERIES, 1, swap=False))
def m_fuzzy_transposition(spark, sf):
    """transpositionCostOne = false: plain Levenshtein."""
    return S.rounded(S.match_any(documents_index(spark, sf), _q(spark, NOSWAP_FUZZY_QUERIES), "text",
                                 q=S.Query(fuzzy=1, transposition=False)))


def _tok_oracle(qcte, pat, score="round(score, 6)"):
    ctes, body = O.match_sql("d", "qt", "any")
    return (f"WITH {DOCS},\n{qcte},\n{O.query_terms('qt', 'q', pat)},\n{ctes}\n"
            f"SELECT query_id, doc_id, {score} AS score FROM ({body})")


@reg("m_tokenize", _tok_oracle(QB_SQL, "[a-z]+"))
def m_tokenize(spark, sf):
    """The query analysed with ``regex_pattern('[a-z]+')`` instead of the field's tokenizer."""
    return S.rounded(S.match_any(documents_index(spark, sf), _bench(spark, sf), "text",
                                 q=S.Query(tokenizer=A.regex_pattern("[a-z]+"))))


@reg("m_compose", _tok_oracle(QB_SQL, "[a-z]+", "3.0::DOUBLE"))
def m_compose(spark, sf):
    """Tokenizer then constant score, chained."""
    return S.match_any(documents_index(spark, sf), _bench(spark, sf), "text",
                       q=S.Query(tokenizer=A.regex_pattern("[a-z]+"), const=3.0))


# ---------------------------------------------------------------------------
# projections: score and highlights
# ---------------------------------------------------------------------------

@reg("p_score", _match_oracle(QB_SQL, "any").replace(
    "SELECT query_id, doc_id, round(score, 6) AS score FROM (",
    "SELECT query_id, doc_id, score, rank FROM (SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY "
    "query_id ORDER BY score DESC, doc_id) AS rank FROM (SELECT query_id, doc_id, round(score, 6) AS score FROM (") +
    ")) WHERE rank <= 10")
def p_score(spark, sf):
    """Top 10 documents per benchmark passage by BM25."""
    idx = documents_index(spark, sf)
    return T.top_matches(idx, T.search_terms(idx, "text", S.query_terms(idx, _bench(spark, sf), "text")), 10)


def _hl_matches(spark, sf):
    idx = documents_index(spark, sf)
    q = _q(spark, HIGHLIGHT_QUERIES)
    m = S.match_any(idx, q, "text")
    qt = S.query_terms(idx, q, "text").select("query_id", "term")
    return idx, m, qt


_HL_BASE = (f"WITH {DOCS},\n{_qv(HIGHLIGHT_QUERIES)},\n{O.query_terms('qt', 'q')},\n"
            "m AS (SELECT DISTINCT qt.query_id, p.doc_id FROM qt JOIN d_post p ON p.term = qt.term),\n"
            "md AS (SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT doc_id FROM m)),\n"
            f"tk AS (SELECT doc_id, unnest(range(len(t))) AS pos, unnest(t) AS term, unnest(s[1:len(t)]) AS sep FROM "
            f"(SELECT doc_id, {O.toks('text')} AS t, string_split_regex(lower(text), '{O.WORDS}') AS s FROM md)),\n"
            "off AS (SELECT doc_id, pos, term, CAST(sum(length(sep) + length(term)) OVER (PARTITION BY doc_id ORDER BY pos "
            "ROWS UNBOUNDED PRECEDING) AS BIGINT) AS e FROM tk),\n"
            "mt AS (SELECT m.query_id, o.doc_id, o.e - length(o.term) AS start, o.e AS \"end\" FROM off o JOIN m "
            "ON m.doc_id = o.doc_id JOIN (SELECT DISTINCT query_id, term FROM qt) w ON w.query_id = m.query_id "
            "AND w.term = o.term)")


@reg("p_snippet_positions", _HL_BASE + "\nSELECT query_id, doc_id, start, \"end\" FROM mt")
def p_snippet_positions(spark, sf):
    """(start, end) offsets of every highlighted token."""
    idx, m, qt = _hl_matches(spark, sf)
    return H.snippet_positions(idx, "text", m, qt)


def _frag_sql(maxc, start_tag, end_tag):
    return (",\nmi AS (SELECT *, row_number() OVER (PARTITION BY query_id, doc_id ORDER BY start) - 1 AS i FROM mt),\n"
            "fr AS (WITH RECURSIVE w(query_id, doc_id, i, fs, fidx) AS (SELECT query_id, doc_id, i, start, 0 FROM mi "
            "WHERE i = 0 UNION ALL SELECT m.query_id, m.doc_id, m.i, CASE WHEN m.\"end\" > w.fs + " + str(maxc) +
            " THEN m.start ELSE w.fs END, CASE WHEN m.\"end\" > w.fs + " + str(maxc) + " THEN w.fidx + 1 ELSE w.fidx END "
            "FROM w JOIN mi m ON m.query_id = w.query_id AND m.doc_id = w.doc_id AND m.i = w.i + 1) SELECT * FROM w),\n"
            "ft AS (SELECT f.query_id, f.doc_id, f.fidx, f.fs, m.i, m.start, m.\"end\", least(f.fs + " + str(maxc) +
            ", length(d.text)) AS fe, d.text FROM fr f JOIN mi m ON m.query_id = f.query_id AND m.doc_id = f.doc_id "
            "AND m.i = f.i JOIN md d ON d.doc_id = f.doc_id),\n"
            "pc AS (SELECT *, coalesce(lag(\"end\") OVER (PARTITION BY query_id, doc_id, fidx ORDER BY i), fs) AS pe FROM ft),\n"
            "frags AS (SELECT query_id, doc_id, fidx, min(fs) AS frag_start, count(*) AS score, "
            "string_agg(substring(text, pe + 1, start - pe) || '" + start_tag + "' || substring(text, start + 1, "
            "least(\"end\", fe) - start) || '" + end_tag + "', '' ORDER BY i) || substring(any_value(text), "
            "least(max(\"end\"), any_value(fe)) + 1, greatest(any_value(fe) - least(max(\"end\"), any_value(fe)), 0)) "
            "AS snippet FROM pc GROUP BY query_id, doc_id, fidx)")


@reg("p_snippet", _HL_BASE + _frag_sql(150, "<b>", "</b>") +
     "\nSELECT query_id, doc_id, snippet, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id, doc_id "
     "ORDER BY score DESC, fidx) AS rn FROM frags) WHERE rn = 1")
def p_snippet(spark, sf):
    """Best fragment per match, default tags and 150 characters."""
    idx, m, qt = _hl_matches(spark, sf)
    return H.snippet(idx, "text", m, qt)


@reg("p_snippets", _HL_BASE + _frag_sql(80, "<em>", "</em>") +
     "\nSELECT query_id, doc_id, rn - 1 AS rank, frag_start, score, snippet FROM (SELECT *, row_number() OVER "
     "(PARTITION BY query_id, doc_id ORDER BY score DESC, fidx) AS rn FROM frags) WHERE rn > 1 AND rn <= 4")
def p_snippets(spark, sf):
    """All fragments by score, offset 1, limit 3, custom tags, 80 characters."""
    idx, m, qt = _hl_matches(spark, sf)
    return H.snippets(idx, "text", m, qt, "<em>", "</em>", 80, limit=3, offset=1, sort_by="score")
