"""DuckDB SQL builders for the oracle side of every registered query.

These spell each contract a second time in plain SQL over the raw tables
(tokens by ``regexp_extract_all``, BM25 from raw counts), independent of the
Spark plans.  Kept as text fragments (CTEs) so one analyzer definition is
shared by all oracle queries.
"""

from __future__ import annotations

# The analyzer patterns (RE2 spelling of the Java ones).
WORDS = r"[\p{L}\p{N}]+|[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}]"
PLAIN = r"[\p{L}\p{N}]+"


def toks(expr: str, pat: str = WORDS, lower: bool = True) -> str:
    e = f"lower({expr})" if lower else expr
    return f"regexp_extract_all({e}, '{pat}')"


def tok_rows(name: str, table: str, key: str, expr: str, pat: str = WORDS, lower: bool = True,
             list_expr: str | None = None) -> str:
    """CTE ``name``(doc_id, pos, term)."""
    le = list_expr or toks(expr, pat, lower)
    return (f"{name} AS (SELECT doc_id, unnest(range(len(t))) AS pos, unnest(t) AS term FROM "
            f"(SELECT {key} AS doc_id, {le} AS t FROM {table} WHERE {expr} IS NOT NULL))")


def index_ctes(p: str, table: str, key: str, expr: str, pat: str = WORDS, lower: bool = True,
               list_expr: str | None = None, where: str | None = None) -> str:
    """CTEs {p}_tok, {p}_post(term, doc_id, tf), {p}_dl(doc_id, dl), {p}_st(n, avgdl), {p}_idf(term, df, cf, idf)."""
    src = f"(SELECT * FROM {table} WHERE {where})" if where else table
    le = list_expr or toks(expr, pat, lower)
    return ",\n".join([
        tok_rows(f"{p}_tok", src, key, expr, pat, lower, le),
        f"{p}_post AS (SELECT term, doc_id, count(*) AS tf, list(pos ORDER BY pos) AS positions "
        f"FROM {p}_tok GROUP BY term, doc_id)",
        f"{p}_dl AS (SELECT {key} AS doc_id, len({le}) AS dl FROM {src} WHERE {expr} IS NOT NULL)",
        f"{p}_st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM {p}_dl)",
        f"{p}_idf AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf, "
        f"ln(1 + (st.n - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)) AS idf "
        f"FROM {p}_post, {p}_st st GROUP BY term, st.n)",
    ])


def query_terms(name: str, qcte: str, pat: str = WORDS, lower: bool = True, col: str = "query",
                list_expr: str | None = None) -> str:
    """CTE ``name``(query_id, qpos, term) from a queries CTE (query_id, query)."""
    le = list_expr or toks(col, pat, lower)
    return (f"{name} AS (SELECT query_id, unnest(range(len(t))) AS qpos, unnest(t) AS term FROM "
            f"(SELECT query_id, {le} AS t FROM {qcte}))")


BM25 = ("((i.idf * p.tf) * 2.2::DOUBLE) / (p.tf + (1.2::DOUBLE * (0.25::DOUBLE + "
        "((0.75::DOUBLE * d.dl) / st.avgdl))))")


def bm25_cte(name: str, p: str, ex: str) -> str:
    """CTE ``name``(query_id, doc_id, qterm, score) from ex(query_id, qterm, term)."""
    return (f"{name} AS (SELECT e.query_id, p.doc_id, e.qterm, max({BM25}) AS score "
            f"FROM {ex} e JOIN {p}_idf i ON i.term = e.term JOIN {p}_post p ON p.term = e.term "
            f"JOIN {p}_dl d ON d.doc_id = p.doc_id CROSS JOIN {p}_st st GROUP BY e.query_id, p.doc_id, e.qterm)")


def match_sql(p: str, qt: str, mode: str, ex: str | None = None, score: str = "sum(score)") -> str:
    """SELECT-able CTE body: (query_id, doc_id, score) for any / all."""
    ex_name = ex or f"{qt}_ex"
    parts = []
    if ex is None:
        parts.append(f"{ex_name} AS (SELECT DISTINCT query_id, term AS qterm, term FROM {qt})")
    parts.append(bm25_cte(f"{qt}_bm", p, ex_name))
    if mode == "any":
        body = f"SELECT query_id, doc_id, {score} AS score FROM {qt}_bm GROUP BY query_id, doc_id"
    else:
        body = (f"SELECT b.query_id, b.doc_id, {score.replace('score', 'b.score')} AS score FROM {qt}_bm b "
                f"JOIN (SELECT query_id, count(DISTINCT term) AS need FROM {qt} GROUP BY query_id) n "
                f"ON n.query_id = b.query_id GROUP BY b.query_id, b.doc_id, n.need HAVING count(*) = n.need")
    return ",\n".join(parts), body


def values(rows, cols: str) -> str:
    """``(VALUES …) v(cols)`` with SQL-quoted literals."""
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        if isinstance(v, (list, tuple)):
            return "[" + ", ".join(lit(x) for x in v) + "]"
        return str(v)
    body = ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in rows)
    return f"(VALUES {body}) v({cols})"


def stem_sql(w: str) -> str:
    """The English S-stemmer as a CASE on one term."""
    return (f"CASE WHEN {w} LIKE '%ies' AND NOT ({w} LIKE '%eies' OR {w} LIKE '%aies') "
            f"THEN left({w}, length({w}) - 3) || 'y' "
            f"WHEN {w} LIKE '%es' AND NOT ({w} LIKE '%aes' OR {w} LIKE '%ees' OR {w} LIKE '%oes') "
            f"THEN left({w}, length({w}) - 2) || 'e' "
            f"WHEN {w} LIKE '%s' AND NOT ({w} LIKE '%us' OR {w} LIKE '%ss') "
            f"THEN left({w}, length({w}) - 1) ELSE {w} END")
