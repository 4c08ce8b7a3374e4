"""Registered queries: ranges, aggregations, vectors, hybrid, relational, audits, I/O."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import analysis as A
from ..functions import ranges as R
from ..operators import audit as D
from ..operators import facets as FA
from ..operators import hybrid as HY
from ..operators import knn as K
from ..operators import range_join as RJ
from ..operators import search as S
from ..operators.index import Field, VectorField, build_index
from ..operators.vector_lists import Clusters
from ..operators.joins import checkpointed
from ..operators.querystring import query_string
from ..sources.tables import create_table_as, read_table
from ..streaming.append import append
from ..session import work_dir
from . import oracle as O
from .registry import documents_index, reg, stored_index, table
from .text_queries import DOCS, _bench, _q, _qv

# ---------------------------------------------------------------------------
# ranges over part: [p_size, p_size + 10)
# ---------------------------------------------------------------------------
RANGE_VALUES = [(1, 10), (2, 25), (3, 50)]
INTERSECT_RANGES = [(1, "(10, 12]"), (2, "[45,)"), (3, "[0,1)")]
CONTAIN_RANGES = [(1, "[12,14)"), (2, "(20,25]")]
WITHIN_RANGES = [(1, "[10,30)"), (2, "(0,15]"), (3, "(,8]")]


def _part_ranges(spark, sf):
    """Every part with its range of sizes."""
    return table(spark, sf, "part").select(F.col("p_partkey").alias("doc_id"), R.make_range(
        F.col("p_size"), F.col("p_size") + 10, True, False).alias("range"))


def _range_query(spark, sf, rows, relation):
    """A table of range texts against the parts' ranges."""
    asked = _q(spark, rows).select("query_id", R.parse_range(F.col("query"), "int4range").alias("range"))
    return RJ.range_join(_part_ranges(spark, sf), asked, relation)


def _norm_bounds(text):
    inner = text.strip()
    lo_inc, hi_inc = inner[0] == "[", inner[-1] == "]"
    lo, hi = [s.strip() for s in inner[1:-1].split(",")]
    lo = None if lo == "" else int(lo) + (0 if lo_inc else 1)
    hi = None if hi == "" else int(hi) + (1 if hi_inc else 0)
    return lo, hi


def _range_sql(rows, cond):
    vals = [(q, *_norm_bounds(t)) for q, t in rows]
    return ("SELECT query_id::BIGINT AS query_id, p_partkey AS doc_id FROM part, "
            f"{O.values(vals, 'query_id, lo, hi')} WHERE {cond}")


@reg("q_range_contains_value",
     "SELECT query_id::BIGINT AS query_id, p_partkey AS doc_id FROM part, "
     f"{O.values(RANGE_VALUES, 'query_id, v')} WHERE p_size <= v AND v < p_size + 10")
def q_range_contains_value(spark, sf):
    return RJ.range_contains_value(_part_ranges(spark, sf), _q(spark, RANGE_VALUES, "int"), value="query")


@reg("q_range_intersects", _range_sql(
    INTERSECT_RANGES, "(hi IS NULL OR p_size < hi) AND (lo IS NULL OR lo < p_size + 10) AND (lo IS NULL OR hi IS NULL OR lo < hi)"))
def q_range_intersects(spark, sf):
    return _range_query(spark, sf, INTERSECT_RANGES, "Intersects")


@reg("q_range_contains", _range_sql(
    CONTAIN_RANGES, "(lo IS NOT NULL AND p_size <= lo) AND (hi IS NOT NULL AND hi <= p_size + 10)"))
def q_range_contains(spark, sf):
    return _range_query(spark, sf, CONTAIN_RANGES, "Contains")


@reg("q_range_within", _range_sql(
    WITHIN_RANGES, "(lo IS NULL OR lo <= p_size) AND (hi IS NULL OR p_size + 10 <= hi)"))
def q_range_within(spark, sf):
    return _range_query(spark, sf, WITHIN_RANGES, "Within")


@reg("q_range_types",
     "WITH u AS (SELECT user_id, min(ts) AS t0, max(ts) AS t1, min(value) AS v0, max(value) AS v1 FROM events "
     "GROUP BY user_id)\n"
     "SELECT 1::BIGINT AS query_id, user_id FROM u WHERE t0 <= TIMESTAMP '2024-01-15 00:00:00' AND "
     "TIMESTAMP '2024-01-15 00:00:00' <= t1 "
     "UNION ALL SELECT 2::BIGINT, user_id FROM u WHERE CAST(t0 AS DATE) <= DATE '2024-01-30' AND "
     "DATE '2024-01-30' < CAST(t1 AS DATE) + 1 "
     "UNION ALL SELECT 3::BIGINT, user_id FROM u WHERE CAST(v0 AS DECIMAL(38,9)) <= 40.5 AND "
     "40.5 <= CAST(v1 AS DECIMAL(38,9)) "
     "UNION ALL SELECT 4::BIGINT, user_id FROM u WHERE user_id * 1000000000000 <= 70000000000007 AND "
     "70000000000007 < user_id * 1000000000000 + 30000000000000 "
     "UNION ALL SELECT 5::BIGINT, user_id FROM u WHERE t0 <= TIMESTAMP '2024-01-20 12:00:00' AND "
     "TIMESTAMP '2024-01-20 12:00:00' < t1 "
     "UNION ALL SELECT 6::BIGINT, user_id FROM u WHERE CAST(user_id AS INT) <= 90 AND 90 < CAST(user_id AS INT) + 20")
def q_range_types(spark, sf):
    """All six element types, built per user from events: tsrange, daterange (normalised to [lo, hi)),
    numrange, int8range, tstzrange and int4range, each asked for a value by a join on cells."""
    u = table(spark, sf, "events").groupBy("user_id").agg(F.min("ts").alias("t0"), F.max("ts").alias("t1"),
                                                          F.min("value").alias("v0"), F.max("value").alias("v1"))
    wide = F.col("user_id").cast("bigint") * 1_000_000_000_000
    asked = [  # query, range type, lower, upper, upper included, value
        (1, "tsrange", F.col("t0"), F.col("t1"), True, "2024-01-15 00:00:00"),
        (2, "daterange", F.to_date("t0"), F.to_date("t1"), True, "2024-01-30"),
        (3, "numrange", F.col("v0"), F.col("v1"), True, "40.5"),
        (4, "int8range", wide, wide + 30_000_000_000_000, False, "70000000000007"),
        (5, "tstzrange", F.col("t0"), F.col("t1"), False, "2024-01-20 12:00:00"),
        (6, "int4range", F.col("user_id"), F.col("user_id") + 20, False, "90")]
    parts = []
    for qid, kind, lower, upper, closed, value in asked:
        et = R.RANGE_ELEMENT_TYPES[kind]
        rows = u.select("user_id", R.normalize(R.make_range(lower.cast(et), upper.cast(et), True, closed), kind).alias("range"))
        values = spark.range(1).select(F.lit(qid).cast("bigint").alias("query_id"), F.lit(value).cast(et).alias("value"))
        parts.append(RJ.range_contains_value(rows, values, "user_id").withColumnRenamed("doc_id", "user_id"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------------------
# aggregations over part matches
# ---------------------------------------------------------------------------
PART_QUERIES = [(1, "red"), (2, "blue bolt"), (3, "small gizmo"), (4, "hot")]
PART = O.index_ctes("p", "part", "p_partkey", "p_name")
_PM_CTES, _PM_BODY = O.match_sql("p", "qt", "any")
PM_SQL = (f"WITH {PART},\n{_qv(PART_QUERIES)},\n{O.query_terms('qt', 'q')},\n{_PM_CTES},\n"
          f"pm AS (SELECT m.query_id, m.doc_id, round(m.score, 6) AS score, x.* FROM ({_PM_BODY}) m "
          "JOIN part x ON x.p_partkey = m.doc_id)\n")


def _part_matches(spark, sf):
    idx = stored_index(spark, sf, "part_fields", "part", "p_partkey", [Field("p_name"), Field("p_type", A.literal())])
    m = S.rounded(S.match_any(idx, _q(spark, PART_QUERIES), "p_name"))
    return m.join(table(spark, sf, "part").withColumnRenamed("p_partkey", "doc_id"), "doc_id")


@reg("a_value_count", PM_SQL + "SELECT query_id, count(p_size) AS n FROM pm GROUP BY query_id")
def a_value_count(spark, sf):
    return _part_matches(spark, sf).groupBy("query_id").agg(FA.metric("value_count", "p_size").alias("n"))


@reg("a_avg", PM_SQL + "SELECT query_id, round(avg(p_retailprice), 6) AS avg_price FROM pm GROUP BY query_id")
def a_avg(spark, sf):
    return _part_matches(spark, sf).groupBy("query_id").agg(F.round(FA.metric("avg", "p_retailprice"), 6).alias("avg_price"))


@reg("a_multi", PM_SQL + "SELECT query_id, count(p_size) AS n, round(avg(p_size), 6) AS avg_size, "
     "round(avg(p_retailprice), 6) AS avg_price FROM pm GROUP BY query_id")
def a_multi(spark, sf):
    return _part_matches(spark, sf).groupBy("query_id").agg(
        FA.metric("value_count", "p_size").alias("n"), F.round(FA.metric("avg", "p_size"), 6).alias("avg_size"),
        F.round(FA.metric("avg", "p_retailprice"), 6).alias("avg_price"))


PRICE_BUCKETS = [(None, 950.0), (950.0, 1000.0), (1000.0, 1500.0), (1500.0, None)]


@reg("a_range", PM_SQL + "SELECT q.query_id, b.idx::BIGINT AS idx, count(pm.p_retailprice) AS doc_count FROM "
     "(SELECT DISTINCT query_id FROM pm) q CROSS JOIN "
     f"(SELECT * FROM {O.values([(i, lo, hi) for i, (lo, hi) in enumerate(PRICE_BUCKETS)], 'idx, lo, hi')}) b LEFT JOIN pm "
     "ON pm.query_id = q.query_id AND (b.lo IS NULL OR pm.p_retailprice >= b.lo) AND (b.hi IS NULL OR "
     "pm.p_retailprice < b.hi) GROUP BY q.query_id, b.idx")
def a_range(spark, sf):
    """Price buckets per query; empty buckets are reported with 0."""
    b = FA.range_buckets(_part_matches(spark, sf), "p_retailprice", PRICE_BUCKETS, group="query_id")
    return b.select("query_id", F.col("idx").cast("bigint").alias("idx"), "doc_count")


@reg("a_terms", PM_SQL + "SELECT query_id, key, doc_count FROM (SELECT query_id, p_type AS key, count(*) AS doc_count, "
     "row_number() OVER (PARTITION BY query_id ORDER BY count(*) DESC, p_type) AS rn FROM pm GROUP BY query_id, p_type) "
     "WHERE rn <= 3")
def a_terms(spark, sf):
    """Top 3 categories per query by count, then key."""
    return FA.terms_buckets(_part_matches(spark, sf), "p_type", size=3, group="query_id")


@reg("a_terms_json",
     "SELECT event_type, key, doc_count FROM (SELECT event_type, props->>'k' AS key, count(*) AS doc_count, "
     "row_number() OVER (PARTITION BY event_type ORDER BY count(*) DESC, props->>'k') AS rn FROM events "
     "WHERE props->>'k' IS NOT NULL GROUP BY event_type, props->>'k') WHERE rn <= 5")
def a_terms_json(spark, sf):
    """Top 5 values of the JSON path ``props.k`` per event type."""
    return FA.terms_buckets(table(spark, sf, "events"), FA.json_path("props", "k"), size=5, group="event_type")


@reg("a_filter", PM_SQL + "SELECT query_id, count(p_size) FILTER (WHERE p_size > 25) AS n_big, "
     "round(avg(p_retailprice) FILTER (WHERE p_type = 'SMALL'), 6) AS avg_small FROM pm GROUP BY query_id")
def a_filter(spark, sf):
    """Aggregates with their own filter; the second one a search predicate (literal term)."""
    m = _part_matches(spark, sf)
    idx = stored_index(spark, sf, "part_fields", "part", "p_partkey", [Field("p_name"), Field("p_type", A.literal())])
    small = S.term(idx, _q(spark, [(0, "SMALL")]), "p_type").select("doc_id", F.lit(True).alias("is_small"))
    m = m.join(small, "doc_id", "left")
    return m.groupBy("query_id").agg(
        FA.metric("value_count", "p_size", F.col("p_size") > 25).alias("n_big"),
        F.round(FA.metric("avg", "p_retailprice", F.col("is_small").isNotNull()), 6).alias("avg_small"))


@reg("a_over", PM_SQL + "SELECT query_id, doc_id, score, count(*) OVER (PARTITION BY query_id) AS total, "
     "round(avg(p_retailprice) OVER (PARTITION BY query_id), 6) AS avg_price FROM pm")
def a_over(spark, sf):
    """Each match with aggregates over all matches of its query (before any limit)."""
    m = FA.over(checkpointed(_part_matches(spark, sf)),
                {"total": ("value_count", "doc_id"), "avg_price": ("avg", "p_retailprice")}, by="query_id")
    return m.select("query_id", "doc_id", "score", "total", F.round("avg_price", 6).alias("avg_price"))


@reg("a_facets_topk", PM_SQL +
     "SELECT query_id, 'hit' AS kind, CAST(doc_id AS VARCHAR) AS key, score AS value FROM (SELECT *, row_number() OVER "
     "(PARTITION BY query_id ORDER BY score DESC, doc_id) AS rn FROM pm) WHERE rn <= 5 "
     "UNION ALL SELECT query_id, 'facet', p_type, count(*)::DOUBLE FROM pm GROUP BY query_id, p_type")
def a_facets_topk(spark, sf):
    """Top 5 rows and the category facet of all matches, in one answer."""
    m = checkpointed(_part_matches(spark, sf))  # the matches are read by both parts
    hits = S.top_k(m, 5).select("query_id", F.lit("hit").alias("kind"), F.col("doc_id").cast("string").alias("key"),
                                F.col("score").alias("value"))
    facet = FA.terms_buckets(m, "p_type", group="query_id").select(
        "query_id", F.lit("facet").alias("kind"), "key", F.col("doc_count").cast("double").alias("value"))
    return hits.unionByName(facet)


@reg("a_approx", PM_SQL + "SELECT query_id, count(p_size) AS n, round(avg(p_retailprice), 6) AS avg_price FROM pm "
     "GROUP BY query_id")
def a_approx(spark, sf):
    """exact = false: accepted; these kinds are exact at the same cost."""
    g = FA.aggregate(_part_matches(spark, sf), {"n": ("value_count", "p_size"), "avg_price": ("avg", "p_retailprice")},
                     exact=False, by="query_id")
    return g.select("query_id", "n", F.round("avg_price", 6).alias("avg_price"))


# ---------------------------------------------------------------------------
# vectors: query vectors are label centroids of the embeddings table
# ---------------------------------------------------------------------------
CENTROIDS_SQL = ("cen AS (SELECT label::BIGINT AS query_id, list(v ORDER BY i) AS vector FROM (SELECT label, i, avg(x) AS v "
                 "FROM (SELECT label, unnest(range(len(embedding))) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings) "
                 "GROUP BY label, i) GROUP BY label)")


def _centroids(spark, sf):
    e = table(spark, sf, "embeddings")
    x = e.select("label", F.posexplode("embedding").alias("i", "x"))
    g = x.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("v"))
    return g.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("s")).select(
        F.col("label").cast("bigint").alias("query_id"), F.transform("s", lambda t: t["v"]).alias("vector"))


_DIST = {"l2": "list_distance(e.embedding::DOUBLE[], c.vector)",
         "cosine": "1 - list_cosine_similarity(e.embedding::DOUBLE[], c.vector)",
         "ip": "-list_inner_product(e.embedding::DOUBLE[], c.vector)"}


def _knn_sql(metric, k=5, where="true"):
    return (f"WITH {CENTROIDS_SQL}\nSELECT query_id, doc_id, distance, rank FROM (SELECT *, row_number() OVER "
            "(PARTITION BY query_id ORDER BY distance, doc_id) AS rank FROM (SELECT c.query_id, e.vec_id AS doc_id, "
            f"round({_DIST[metric]}, 6) AS distance FROM embeddings e CROSS JOIN cen c WHERE {where})) WHERE rank <= {k}")


def _knn(metric):
    def run(spark, sf):
        return K.knn(table(spark, sf, "embeddings"), "vec_id", "embedding", _centroids(spark, sf), 5, metric)
    run.__doc__ = f"Top 5 vectors per label centroid by {metric}."
    return run


reg("v_l2", _knn_sql("l2"))(_knn("l2"))
reg("v_cosine", _knn_sql("cosine"))(_knn("cosine"))
reg("v_ip", _knn_sql("ip"))(_knn("ip"))


@reg("v_filtered_term", _knn_sql("l2", where="e.label = c.query_id"))
def v_filtered_term(spark, sf):
    """Top 5 within the query's own label (filter, then top-k)."""
    e = table(spark, sf, "embeddings")
    pairs = e.select(F.col("label").cast("bigint").alias("query_id"), F.col("vec_id").alias("doc_id"))
    return K.knn_pairs(pairs, e, "vec_id", "embedding", _centroids(spark, sf), 5, "l2")


@reg("v_distance_project",
     "WITH g AS (SELECT list(v ORDER BY i) AS vector FROM (SELECT i, avg(x) AS v FROM (SELECT unnest(range(len(embedding))) "
     "AS i, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY i))\n"
     "SELECT e.vec_id AS doc_id, round(list_distance(e.embedding::DOUBLE[], g.vector), 6) AS distance FROM embeddings e, g")
def v_distance_project(spark, sf):
    """Distance of every vector to the mean vector, projected as a double column."""
    e = table(spark, sf, "embeddings")
    x = e.select(F.posexplode("embedding").alias("i", "x")).groupBy("i").agg(F.avg(F.col("x").cast("double")).alias("v"))
    g = x.agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("s")).select(
        F.transform("s", lambda t: t["v"]).alias("g"))
    # one row (one vector of the table's dimension): broadcast is bounded
    return e.crossJoin(F.broadcast(g)).select(F.col("vec_id").alias("doc_id"), F.round(
        K.distance_expr(F.col("embedding"), F.col("g"), "l2"), 6).cast("double").alias("distance"))


def _hybrid_queries(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return _bench(spark, sf).join(e, "query_id")


HQ_SQL = ("q AS (SELECT b.item_id AS query_id, b.text AS query, e.embedding::DOUBLE[] AS vector FROM benchmark b "
          "JOIN embeddings e ON e.vec_id = b.item_id)")


@reg("v_filtered_text",
     f"WITH {DOCS},\n{HQ_SQL},\n{O.query_terms('qt', 'q')},\n"
     "m AS (SELECT DISTINCT qt.query_id, p.doc_id FROM qt JOIN d_post p ON p.term = qt.term)\n"
     "SELECT query_id, doc_id, distance, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY "
     "distance, doc_id) AS rank FROM (SELECT m.query_id, m.doc_id, round(list_distance(e.embedding::DOUBLE[], q.vector), 6) "
     "AS distance FROM m JOIN embeddings e ON e.vec_id = m.doc_id JOIN q ON q.query_id = m.query_id)) WHERE rank <= 5")
def v_filtered_text(spark, sf):
    """Top 5 by l2 among the documents matching the query text."""
    q = _hybrid_queries(spark, sf)
    m = S.match_any(documents_index(spark, sf), q.select("query_id", "query"), "text")
    return K.knn_pairs(m, table(spark, sf, "embeddings"), "vec_id", "embedding", q, 5, "l2")


@reg("ix_vector_field",
     "SELECT 'emb_l2' AS field, vec_id AS doc_id, round(list_sum(embedding::DOUBLE[]) * 2, 6) AS s FROM embeddings "
     "UNION ALL SELECT 'emb_cos', vec_id, round(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * 2 / "
     "sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda y: (y * 2) * (y * 2)))))), 6) FROM embeddings")
def ix_vector_field(spark, sf):
    """Vector fields with metrics; cosine rows are normalised at build (vectors doubled first)."""
    docs = table(spark, sf, "embeddings").withColumn("emb2", F.transform("embedding", lambda x: x.cast("double") * 2))
    idx = build_index(docs, "vec_id", [], [VectorField("emb2", "l2", "emb_l2"), VectorField("emb2", "cosine", "emb_cos")])
    return idx.vectors.select("field", "doc_id", F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x), 6)
                              .alias("s"))


def _listed_vectors(spark, sf):
    return stored_index(spark, sf, "embeddings_lists", "embeddings", "vec_id", [], [
        VectorField("embedding", "l2", clusters=Clusters(0.01, 32, 1))])


@reg("ix_vector_clusters")
def ix_vector_clusters(spark, sf):
    """Clustered lists stored with the index: every vector with its nearest centroid (rows-only check)."""
    return _listed_vectors(spark, sf).lists["embedding"].lists.select(F.col("list_id").alias("centroid_id"), "doc_id")


@reg("v_clustered")
def v_clustered(spark, sf):
    """Top 5 per label centroid through the stored lists (nprobe 8)."""
    return _listed_vectors(spark, sf).lists["embedding"].top(_centroids(spark, sf), 5, nprobe=8)


# ---------------------------------------------------------------------------
# hybrid
# ---------------------------------------------------------------------------
_LEX_SEM = (f"WITH {DOCS},\n{HQ_SQL},\n{O.query_terms('qt', 'q')},\n" + O.match_sql("d", "qt", "any")[0] + ",\n"
            "lex AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, doc_id) "
            "AS rank FROM (" + O.match_sql("d", "qt", "any")[1] + ") QUALIFY rank <= 20),\n"
            "sem AS (SELECT q.query_id, e.vec_id AS doc_id, row_number() OVER (PARTITION BY q.query_id ORDER BY "
            "round(1 - list_cosine_similarity(e.embedding::DOUBLE[], q.vector), 6), e.vec_id) AS rank FROM q "
            "CROSS JOIN embeddings e QUALIFY rank <= 20),\n"
            "fused AS (SELECT query_id, doc_id, round(sum(1.0::DOUBLE / (60 + rank)), 6) AS rrf_score FROM "
            "(SELECT * FROM lex UNION ALL SELECT * FROM sem) GROUP BY query_id, doc_id),\n"
            "top AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rrf_score DESC, doc_id) AS fused_rank "
            "FROM fused QUALIFY fused_rank <= 5)\n")


def _rrf(spark, sf):
    q = _hybrid_queries(spark, sf)
    idx = documents_index(spark, sf)
    lex = S.top_k(S.rounded(S.match_any(idx, q.select("query_id", "query"), "text")), 20)
    sem = K.knn(table(spark, sf, "embeddings"), "vec_id", "embedding", q.select("query_id", "vector"), 20, "cosine")
    return HY.rrf([lex, sem], top=5)


@reg("h_rrf", _LEX_SEM + "SELECT query_id, doc_id, rrf_score, fused_rank FROM top")
def h_rrf(spark, sf):
    """Reciprocal rank fusion of BM25 top 20 and cosine top 20, top 5."""
    return _rrf(spark, sf)


@reg("h_rrf_batch", _LEX_SEM + "SELECT t.query_id, t.doc_id, t.rrf_score, t.fused_rank, d.lang, d.n_chars FROM top t "
     "JOIN documents d ON d.doc_id = t.doc_id")
def h_rrf_batch(spark, sf):
    """The fused top 5 of every (text, vector) query, joined back to the table."""
    return _rrf(spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang", "n_chars"), "doc_id")


RAG = {1: "thha reea", 2: "ingat AND", 3: "aile ) queque", 4: "nosuch:word zzzzq"}
RAG_SQL = (f"WITH {DOCS},\n{HQ_SQL.replace('benchmark b', '(SELECT * FROM benchmark) b')},\n"
           "hits AS (SELECT DISTINCT v.query_id, p.doc_id FROM "
           f"{O.values([(1, 'thha'), (1, 'reea'), (2, 'ingat'), (3, 'aile'), (3, 'queque')], 'query_id, w')} "
           "JOIN d_post p ON p.term = v.w),\n"
           "ret AS (SELECT query_id, doc_id, distance, rank FROM (SELECT h.query_id, h.doc_id, "
           "round(1 - list_cosine_similarity(e.embedding::DOUBLE[], q.vector), 6) AS distance, row_number() OVER "
           "(PARTITION BY h.query_id ORDER BY round(1 - list_cosine_similarity(e.embedding::DOUBLE[], q.vector), 6), h.doc_id) "
           "AS rank FROM hits h JOIN embeddings e ON e.vec_id = h.doc_id JOIN q ON q.query_id = h.query_id) WHERE rank <= 3)\n")


def _retrieve(spark, sf):
    idx = documents_index(spark, sf)
    m = query_string(idx, RAG, lenient=True)
    q = _hybrid_queries(spark, sf).select("query_id", "vector")
    return K.knn_pairs(m, table(spark, sf, "embeddings"), "vec_id", "embedding", q, 3, "cosine")


@reg("h_retrieve", RAG_SQL + "SELECT query_id::BIGINT AS query_id, doc_id, distance, rank FROM ret")
def h_retrieve(spark, sf):
    """Lenient query string, then cosine order to the query vector, top 3."""
    return _retrieve(spark, sf)


@reg("h_context", RAG_SQL + "SELECT v.query_id::BIGINT AS query_id, coalesce(string_agg(CASE WHEN r.doc_id IS NOT NULL THEN "
     "concat_ws(' | ', r.doc_id, d.lang, d.source, d.text) END, chr(10) ORDER BY r.rank), 'No relevant context found.') AS context FROM "
     f"{O.values([(k,) for k in RAG], 'query_id')} LEFT JOIN ret r ON r.query_id = v.query_id LEFT JOIN documents d "
     "ON d.doc_id = r.doc_id GROUP BY v.query_id")
def h_context(spark, sf):
    """Context text per question from its hits, in rank order; fixed text when none."""
    hits = _retrieve(spark, sf).join(table(spark, sf, "documents"), "doc_id")
    qs = spark.createDataFrame([(k,) for k in RAG], "query_id bigint")
    return HY.context(hits, ["doc_id", "lang", "source", "text"], queries=qs)


TYPED = [(1, "sma"), (2, "smal"), (3, "red w"), (4, "blu"), (5, "gi"), (6, "hot g"), (7, "widg"), (8, "bol"),
         (9, "gea"), (10, "xyz")]


def _ng(c):
    s = f"lower({c})"
    return (f"flatten(list_transform(range(0, greatest(length({s}) - 3 + 1, 0)), lambda st: "
            f"list_transform(list_filter(range(3, 9), lambda ln: st + ln <= length({s})), "
            f"lambda ln: substring({s}, st + 1, ln))))")


@reg("h_autocomplete",
     f"WITH {O.index_ctes('p', 'part', 'p_partkey', 'p_name', list_expr=_ng('p_name'))},\n{_qv(TYPED)},\n"
     f"{O.query_terms('qt', 'q', list_expr=_ng('query'))},\n" + O.match_sql("p", "qt", "any")[0] +
     "\nSELECT query_id, doc_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, "
     "doc_id) AS rank FROM (SELECT query_id, doc_id, round(score, 6) AS score FROM (" + O.match_sql("p", "qt", "any")[1] +
     "))) WHERE rank <= 5")
def h_autocomplete(spark, sf):
    """As-you-type: n-gram(3,8) postings, typed text through the same tokenizer, BM25 top 5."""
    idx = stored_index(spark, sf, "part_ngram", "part", "p_partkey", [Field("p_name", A.ngram(3, 8), name="p_name_ngram")])
    return S.top_k(S.rounded(S.match_any(idx, _q(spark, TYPED), "p_name_ngram")), 5)


@reg("h_filtered_search", PM_SQL + "SELECT query_id, doc_id, score FROM pm WHERE p_size % 2 = 0 AND p_size >= 20")
def h_filtered_search(spark, sf):
    """Match + in-stock flag (even size) + rating (size) ≥ 20, by score."""
    m = _part_matches(spark, sf)
    return m.where((F.col("p_size") % 2 == 0) & (F.col("p_size") >= 20)).select("query_id", "doc_id", "score")


# ---------------------------------------------------------------------------
# relational operators around the search
# ---------------------------------------------------------------------------

@reg("r_project", "SELECT doc_id, upper(lang) AS lang_uc, n_chars + 1 AS n1 FROM documents")
def r_project(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.upper("lang").alias("lang_uc"), (F.col("n_chars") + 1).alias("n1"))


@reg("r_filter", "SELECT p_partkey FROM part WHERE p_size >= 20 AND p_type IN ('SMALL', 'ECONOMY') AND p_brand = 'Brand#2'")
def r_filter(spark, sf):
    p = table(spark, sf, "part")
    return p.where((F.col("p_size") >= 20) & F.col("p_type").isin("SMALL", "ECONOMY") & (F.col("p_brand") == "Brand#2")
                   ).select("p_partkey")


@reg("r_bool",
     f"WITH {DOCS}\nSELECT doc_id FROM documents WHERE (doc_id IN (SELECT doc_id FROM d_post WHERE term = 'thha') OR "
     "doc_id IN (SELECT doc_id FROM d_post WHERE term = 'reea')) AND doc_id NOT IN (SELECT doc_id FROM d_post WHERE "
     "term = 'ingat')")
def r_bool(spark, sf):
    """(thha OR reea) AND NOT ingat, as flags from left joins on the key."""
    idx = documents_index(spark, sf)
    docs = table(spark, sf, "documents").select("doc_id")
    for name, w in (("a", "thha"), ("b", "reea"), ("c", "ingat")):
        hit = S.term(idx, _q(spark, [(0, w)]), "text").select("doc_id", F.lit(True).alias(name))
        docs = docs.join(hit, "doc_id", "left")
    return docs.where((F.col("a").isNotNull() | F.col("b").isNotNull()) & F.col("c").isNull()).select("doc_id")


@reg("r_join_inner", "SELECT d.doc_id, d.lang, l.quality::BIGINT AS quality, l.toxic::BIGINT AS toxic FROM documents d "
     "JOIN labels l ON l.doc_id = d.doc_id")
def r_join_inner(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id")


@reg("r_union_all", PM_SQL + "SELECT query_id, doc_id, 'name' AS src FROM pm UNION ALL SELECT 0, p_partkey, 'type' "
     "FROM part WHERE p_type = 'PROMO'")
def r_union_all(spark, sf):
    m = _part_matches(spark, sf).select("query_id", "doc_id", F.lit("name").alias("src"))
    t = table(spark, sf, "part").where("p_type = 'PROMO'").select(F.lit(0).cast("bigint").alias("query_id"),
                                                                  F.col("p_partkey").alias("doc_id"), F.lit("type").alias("src"))
    return m.unionByName(t)


@reg("r_group_sum", "SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS DOUBLE) AS sum_qty, "
     "CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS sum_price_cents, count(*) AS n "
     "FROM lineitem GROUP BY l_returnflag, l_linestatus")
def r_group_sum(spark, sf):
    """group by + sum (prices summed as integer cents, exact in any order)."""
    li = table(spark, sf, "lineitem")
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").cast("double").alias("sum_qty"),
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("sum_price_cents"),
        F.count("*").alias("n"))


@reg("r_row_number", "SELECT lang, doc_id, rn FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY "
     "n_chars DESC, doc_id) AS rn FROM documents) WHERE rn <= 3")
def r_row_number(spark, sf):
    w = Window.partitionBy("lang").orderBy(F.col("n_chars").desc(), "doc_id")
    d = table(spark, sf, "documents").withColumn("rn", F.row_number().over(w))
    return d.where("rn <= 3").select("lang", "doc_id", "rn")


@reg("r_sort_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def r_sort_limit(spark, sf):
    """Global top 10 (planned as TakeOrderedAndProject)."""
    return table(spark, sf, "orders").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10).select(
        "o_orderkey", "o_totalprice")


@reg("r_cte", _LEX_SEM + "SELECT l.query_id, d.lang, count(*) AS n FROM lex l JOIN documents d ON d.doc_id = l.doc_id "
     "WHERE l.rank <= 5 GROUP BY l.query_id, d.lang")
def r_cte(spark, sf):
    """Named steps: ranked lexical hits → join → group."""
    q = _hybrid_queries(spark, sf)
    lex = S.top_k(S.rounded(S.match_any(documents_index(spark, sf), q.select("query_id", "query"), "text")), 5)
    return lex.join(table(spark, sf, "documents"), "doc_id").groupBy("query_id", "lang").agg(F.count("*").alias("n"))


@reg("r_scalar", "SELECT event_id, lower(event_type) || '-' || CAST(user_id AS VARCHAR) AS tag, value + 1 AS v1, "
     "props->>'k' AS k, CAST(value AS DOUBLE) AS v, round(1.0::DOUBLE / (60 + value), 6) AS rr FROM events")
def r_scalar(spark, sf):
    """lower, ||, +, ->>, ::float8 and 1.0 / (k + x) per row."""
    e = table(spark, sf, "events")
    return e.select("event_id", F.concat(F.lower("event_type"), F.lit("-"), F.col("user_id").cast("string")).alias("tag"),
                    (F.col("value") + 1).alias("v1"), F.get_json_object("props", "$.k").alias("k"),
                    F.col("value").cast("double").alias("v"), F.round(1.0 / (60 + F.col("value")), 6).alias("rr"))


# ---------------------------------------------------------------------------
# sources and sinks
# ---------------------------------------------------------------------------

@reg("io_scan_table", "SELECT p_partkey, p_name, p_type, p_size::BIGINT AS p_size, p_retailprice FROM part")
def io_scan_table(spark, sf):
    """Scan held to a declared schema (only the declared columns are read)."""
    return read_table(spark, f"{sf}/part.parquet",
                      "p_partkey bigint, p_name string, p_type string, p_size int, p_retailprice double")


@reg("io_ctas", "SELECT p_partkey AS id, p_name AS description, p_type AS category, p_size::BIGINT AS rating FROM part")
def io_ctas(spark, sf):
    """``INSERT … SELECT`` into a new table, read back."""
    src = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("description"),
                                          F.col("p_type").alias("category"), F.col("p_size").alias("rating"))
    return create_table_as(src, "autocomplete_items")


def _batches(spark, path):
    import json
    return sorted(json.loads(spark.read.text(f"{path}/_meta").first()[0]).get("batches", {}))


@reg("io_append", f"WITH {DOCS}\nSELECT term, df, cf FROM d_idf")
def io_append(spark, sf):
    """Index built on part of the table; the rest arrives through a Structured
    Streaming query whose foreachBatch appends each micro-batch; the batch is
    then delivered again.  The vocabulary equals a full build."""
    import uuid

    from ..streaming.append import stream_append

    docs = table(spark, sf, "documents")
    first = docs.where(F.col("source") < "src10")
    base = f"{work_dir(spark)}/lodestar/append-{uuid.uuid4().hex[:8]}"
    path = f"{base}/index"
    build_index(first, "doc_id", [Field("text")], name="documents_append").save(path)
    # a glob over the table's file (a streaming file source reads folders)
    stream = (spark.readStream.schema(docs.schema).option("basePath", sf).parquet(f"{sf}/documents.parque[t]")
              .where(~(F.col("source") < "src10") | F.col("source").isNull()))
    q = stream_append(stream, path, f"{base}/stream-checkpoint")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"append stream failed: {q.exception()}")
    if not _batches(spark, path):
        raise RuntimeError("the append stream delivered no batch")
    rest = docs.where(~(F.col("source") < "src10") | F.col("source").isNull())
    idx = append(spark, path, rest, _batches(spark, path)[-1])  # re-delivered batch: replaces itself
    return idx.terms.select("term", "df", "cf")


# ---------------------------------------------------------------------------
# audits
# ---------------------------------------------------------------------------

def _verify_sql(extra="", seg=None):
    segw = f"WHERE doc_id % 8 IN ({', '.join(map(str, seg))})" if seg else ""
    base = (f"WITH {DOCS},\npp AS (SELECT * FROM d_post {segw}), dd AS (SELECT * FROM d_dl {segw})\n")
    rows = []
    row = "SELECT '{}' AS check_name, true AS passed, '0 violations in ' || ({}) || ' rows' AS details"
    if not seg:
        rows.append(row.format("doc_frequency", "SELECT count(*) FROM d_idf"))
    rows += [row.format("doc_length", "SELECT count(DISTINCT doc_id) FROM pp"),
             row.format("positions_length", "SELECT count(*) FROM pp"),
             row.format("unique_postings", "SELECT count(*) FROM pp")]
    if extra:
        rows.append(extra)
    return base + " UNION ALL ".join(rows)


@reg("d_verify", _verify_sql())
def d_verify(spark, sf):
    """Consistency checks of the stored documents index."""
    return D.verify_index(documents_index(spark, sf))


@reg("d_verify_complete", _verify_sql("SELECT 'all_rows_indexed', true, '0 violations in ' || (SELECT count(*) FROM documents WHERE text IS NOT NULL) || ' rows'"))
def d_verify_complete(spark, sf):
    """heapAllIndexed: every non-NULL source row is in the index."""
    idx = documents_index(spark, sf)
    return D.verify_index(idx, heap_all_indexed=True, source=table(spark, sf, "documents"))


@reg("d_verify_sample")
def d_verify_sample(spark, sf):
    """sampleRate 0.5 by key hash (repeatable)."""
    return D.verify_index(documents_index(spark, sf), sample_rate=0.5)


@reg("d_verify_stop", _verify_sql())
def d_verify_stop(spark, sf):
    """onErrorStop: checks up to the first failure (all pass here)."""
    return D.verify_index(documents_index(spark, sf), on_error_stop=True)


@reg("d_verify_segments", _verify_sql(seg=[0, 3]))
def d_verify_segments(spark, sf):
    """Only segments 0 and 3."""
    return D.verify_index(documents_index(spark, sf), segment_ids=[0, 3])


@reg("d_verify_all", _verify_sql().replace("SELECT '", "SELECT 'documents_text' AS indexname, '"))
def d_verify_all(spark, sf):
    """Every catalogued index whose name is LIKE '%text%'."""
    cat = {"documents_text": documents_index(spark, sf),
           "part_fields": stored_index(spark, sf, "part_fields", "part", "p_partkey",
                                       [Field("p_name"), Field("p_type", A.literal())])}
    return D.verify_all_indexes(cat, index_pattern="%text%")


@reg("d_segments", "SELECT 'documents_text' AS partition_name, (doc_id % 8) AS segment_idx, 'documents_text-' || "
     "lpad(CAST(doc_id % 8 AS VARCHAR), 4, '0') AS segment_id, count(*) AS num_docs, 0::BIGINT AS num_deleted, "
     "count(*) AS max_doc FROM documents WHERE text IS NOT NULL GROUP BY doc_id % 8")
def d_segments(spark, sf):
    return D.index_segments(documents_index(spark, sf))


@reg("d_indexes", "SELECT 'public' AS schemaname, 'documents' AS tablename, 'documents_text' AS indexname, 1::BIGINT AS "
     "indexrelid, count(DISTINCT doc_id % 8) AS num_segments, count(*) AS total_docs FROM documents WHERE text IS NOT NULL "
     "UNION ALL SELECT 'public', 'part', 'part_fields', 2, count(DISTINCT p_partkey % 8), count(*) FROM part "
     "WHERE p_name IS NOT NULL OR p_type IS NOT NULL")
def d_indexes(spark, sf):
    cat = {"documents_text": documents_index(spark, sf),
           "part_fields": stored_index(spark, sf, "part_fields", "part", "p_partkey",
                                       [Field("p_name"), Field("p_type", A.literal())])}
    return D.indexes(cat, tables={"documents_text": "documents", "part_fields": "part"})
