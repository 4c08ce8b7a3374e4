"""Proximity search: leaves within a number of tokens of each other.

A leaf stands for a set of vocabulary terms (a literal word, a regex over the
vocabulary, or an array of leaves).  A pair ``within(d, other, ordered)``
matches spans [s1, e1] and [s2, e2] that do not overlap and have at most ``d``
tokens strictly between them; ``ordered`` asks for the right operand after
the left one.  The result of a pair is the span [min start, max end], so
chains fold left (or right, when the right operand is itself a pair).

The expressions of a batch are one table of nodes (query, node, operands,
distance, ordered, height): leaves are looked up for all queries at once, and
the pairs of one height are joined for all queries at once, so the plan grows
with the depth of the deepest expression, not with the queries.

Span pairs are found with a bucketed band join: the equi-key is
(query_id, node, doc_id, bucket of the position), so only spans of nearby
positions meet — never all pairs of occurrences within a document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .index import SearchIndex
from .joins import checkpointed, held, join_held, join_small
from .patterns import pattern_terms
from .search import NOQ, Query, _finish, pruned_postings


@dataclass(frozen=True)
class Leaf:
    kind: str  # "str" | "regex" | "array"
    value: object
    max_expansions: int | None = None

    def within(self, distance: int, other, ordered: bool = False) -> "Pair":
        return Pair(self, int(distance), _as_expr(other), ordered)


@dataclass(frozen=True)
class Pair:
    left: object
    distance: int
    right: object
    ordered: bool = False

    def within(self, distance: int, other, ordered: bool = False) -> "Pair":
        return Pair(self, int(distance), _as_expr(other), ordered)


def prox_str(value: str) -> Leaf:
    return Leaf("str", value)


def prox_regex(pattern: str, max_expansions: int | None = None) -> Leaf:
    return Leaf("regex", pattern, max_expansions)


def prox_array(*values) -> Leaf:
    return Leaf("array", tuple(_as_expr(v) for v in values))


def _as_expr(v):
    return prox_str(v) if isinstance(v, str) else v


_LEAF = "query_id bigint, node int, kind string, value string, max_expansions int"
_PAIR = "query_id bigint, node int, left int, right int, distance int, ordered boolean, height int"


def node_rows(exprs: dict) -> tuple[list[tuple], list[tuple], list[tuple]]:
    """(leaf rows, pair rows, root rows) of query id → expression; nodes are numbered per query from
    the left, an array's words and patterns share a node."""
    leaves, pairs, roots = [], [], []

    def walk(qid, expr, count) -> tuple[int, int]:
        """(node, height) of ``expr``."""
        if isinstance(expr, Leaf):
            node = count[0]
            count[0] += 1
            for part in expr.value if expr.kind == "array" else (expr,):
                _leaf_rows(qid, node, part)
            return node, 0
        left, h1 = walk(qid, expr.left, count)
        right, h2 = walk(qid, expr.right, count)
        node = count[0]
        count[0] += 1
        pairs.append((qid, node, left, right, expr.distance, expr.ordered, max(h1, h2) + 1))
        return node, max(h1, h2) + 1

    def _leaf_rows(qid, node, part):
        if isinstance(part, Pair):
            raise ValueError("prox_array takes words and regex leaves")
        if part.kind == "array":
            for sub in part.value:
                _leaf_rows(qid, node, sub)
        elif part.kind in ("str", "regex"):
            leaves.append((qid, node, part.kind, part.value, part.max_expansions))
        else:
            raise ValueError(part.kind)

    for qid, expr in exprs.items():
        roots.append((qid, walk(qid, expr, [0])[0], len(_leaves(expr))))
    return leaves, pairs, roots


def _leaves(expr) -> list:
    return [expr] if isinstance(expr, Leaf) else _leaves(expr.left) + _leaves(expr.right)


def _leaf_terms(index: SearchIndex, field: str, leaves: DataFrame) -> DataFrame:
    """(query_id, node, term): the vocabulary terms of every leaf."""
    tok = index.query_tokenizer(field)
    words = leaves.where("kind = 'str'").select("query_id", "node", F.explode(tok.terms(F.col("value"))).alias("term"))
    asked = leaves.where("kind = 'regex'").select("query_id", "node", F.col("value").alias("pattern"), "max_expansions")
    return words.unionByName(pattern_terms(index, field, asked).select("query_id", "node", "term")).distinct()


def _occurrences(index: SearchIndex, field: str, terms: DataFrame, roots: DataFrame) -> DataFrame:
    """(query_id, node, doc_id, s, e): positions of every leaf in the documents that hold all leaves of the query.

    One pass over term and document finds those documents; only their positions
    are exploded.  Both passes serve all queries of the batch.  Checkpointed.
    """
    t, rows = held(terms)
    postings = pruned_postings(index, field, t)
    there = join_held(postings.select("term", "doc_id"), t, rows, "term")
    docs = join_small(there.groupBy("query_id", "doc_id").agg(F.countDistinct("node").alias("c")), roots, "query_id").where(
        F.col("c") == F.col("leaves")).select("query_id", "doc_id")
    places = join_held(postings.select("term", "doc_id", "positions"), t, rows, "term")
    places = join_small(places, docs, ["query_id", "doc_id"], "left_semi")
    return checkpointed(places.select("query_id", "node", "doc_id", F.explode("positions").alias("s")).distinct().withColumn("e", F.col("s")))


def pair_spans(left: DataFrame, right: DataFrame) -> DataFrame:
    """(query_id, node, doc_id, s, e): spans of (left within ``distance`` of right).  Both sides have
    (query_id, node, doc_id, s, e, distance), node being the pair's, the left side also ``ordered``."""
    key, w = ["query_id", "node", "doc_id", "b"], F.col("distance") + 1
    r = right.select("query_id", "node", "doc_id", F.col("s").alias("rs"), F.col("e").alias("re"), "distance")

    def near(first):
        return F.explode(F.array(F.floor(first / w), F.floor(first / w) + 1))

    # right after left: rs in [e + 1, e + 1 + d]
    after = left.withColumn("b", near(F.col("e") + 1)).join(r.withColumn("b", F.floor(F.col("rs") / w)).drop("distance"), key).where(
        (F.col("rs") >= F.col("e") + 1) & (F.col("rs") <= F.col("e") + w))
    # right before left: re in [s - 1 - d, s - 1]
    before = left.where(~F.col("ordered")).withColumn("b", near(F.col("s") - w)).join(
        r.withColumn("b", F.floor(F.col("re") / w)).drop("distance"), key).where(
        (F.col("re") >= F.col("s") - w) & (F.col("re") <= F.col("s") - 1))
    return after.select("query_id", "node", "doc_id", "s", F.col("re").alias("e")).unionByName(
        before.select("query_id", "node", "doc_id", F.col("rs").alias("s"), "e")).distinct()


def proximity(index: SearchIndex, field: str, exprs: dict, q: Query = NOQ) -> DataFrame:
    """(query_id, doc_id, score=1.0) for each query id → proximity expression."""
    leaves, pairs, roots = node_rows({qid: _as_expr(e) for qid, e in exprs.items()})
    spark = index.spark
    asked = spark.createDataFrame(roots, "query_id bigint, node int, leaves bigint")
    spans = _occurrences(index, field, _leaf_terms(index, field, spark.createDataFrame(leaves, _LEAF)), asked)
    nodes = spark.createDataFrame(pairs, _PAIR)
    for height in range(1, max((p[-1] for p in pairs), default=0) + 1):
        level = nodes.where(F.col("height") == height)

        def operand(side: str, *more, level=level, spans=spans):
            """The spans of the pairs' left or right operands, under the pairs' nodes."""
            wanted = level.select("query_id", F.col(side).alias("node"), F.col("node").alias("pair"), "distance", *more)
            return join_small(spans, wanted, ["query_id", "node"]).drop("node").withColumnRenamed("pair", "node")

        found = pair_spans(operand("left", "ordered"), operand("right"))
        spans = checkpointed(spans.unionByName(found))
    out = join_small(spans, asked.select("query_id", "node"), ["query_id", "node"]).select("query_id", "doc_id").distinct()
    return _finish(out.withColumn("score", F.lit(1.0)), q)
