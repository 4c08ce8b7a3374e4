"""Query strings: ``field:term``, ``field:(a b)``, ``field:>n``, AND / OR / NOT,
parentheses and bare words (over every text field).

The string is read into a small tree on the driver (it is one short query
text, not data); the tree is then evaluated with the index operators, which
do all the work on Spark.  ``lenient`` drops unusable parts (unknown fields,
stray punctuation) instead of raising; ``conjunction_mode`` joins bare
neighbouring terms with AND instead of OR.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .index import SearchIndex
from .search import _union, as_filter, both, either, match, phrase, without

_TOKEN = re.compile(r'\s*(?:(\()|(\))|("[^"]*")|([A-Za-z_][\w.]*):(>=|<=|>|<)?|(AND|OR|NOT)\b|([^\s()":]+)|(\S))')


class QueryStringError(ValueError):
    pass


@dataclass
class Node:
    op: str  # term | and | or | not | cmp
    field: str | None = None
    value: object = None
    kids: tuple = ()
    cmp: str | None = None


def parse(text: str, fields: list, numeric: list = (), lenient: bool = False, conjunction_mode: bool = False) -> Node | None:
    toks = []
    for m in _TOKEN.finditer(text):
        lp, rp, quoted, fld, cmp, kw, word, junk = m.groups()
        if lp:
            toks.append(("(", None))
        elif rp:
            toks.append((")", None))
        elif quoted:
            toks.append(("phrase", quoted[1:-1]))
        elif fld:
            toks.append(("field", (fld, cmp)))
        elif kw:
            toks.append((kw, None))
        elif word:
            toks.append(("word", word))
        elif junk:
            if not lenient:
                raise QueryStringError(f"unexpected {junk!r} in query string")
    pos = [0]
    default_op = "and" if conjunction_mode else "or"

    def peek():
        return toks[pos[0]] if pos[0] < len(toks) else (None, None)

    def take():
        t = peek()
        pos[0] += 1
        return t

    def expr():
        left = conjunction()
        while peek()[0] == "OR" or (default_op == "or" and peek()[0] not in (None, ")")):
            if peek()[0] == "OR":
                take()
            left = _join("or", left, conjunction())
        return left

    def conjunction():  # AND binds tighter than OR
        left = unary()
        while peek()[0] == "AND" or (default_op == "and" and peek()[0] not in (None, ")", "OR")):
            if peek()[0] == "AND":
                take()
            left = _join("and", left, unary())
        return left

    def unary():
        kind, val = peek()
        if kind == "NOT":
            take()
            inner = unary()
            return Node("not", kids=(inner,)) if inner is not None else None
        return atom(None, None)

    def atom(field, cmp):
        kind, val = take()
        if kind == "(":
            inner = expr()
            if peek()[0] == ")":
                take()
            elif not lenient:
                raise QueryStringError("missing )")
            return _scope(inner, field)
        if kind == "field":
            fname, c = val
            ok = fname in fields or (c and fname in numeric) or (fname in numeric)
            if not ok and not lenient:
                raise QueryStringError(f"unknown field {fname!r}")
            sub = atom(fname, c)
            return sub if ok else None
        if kind == "phrase" and field not in numeric:
            return Node("phrase", field=field, value=val)
        if kind in ("word", "phrase"):
            if cmp or (field in numeric):
                try:
                    v = float(val)
                except ValueError:
                    if lenient:
                        return None
                    raise QueryStringError(f"{val!r} is not a number")
                return Node("cmp", field=field, value=v, cmp=cmp or "=")
            return Node("term", field=field, value=val)
        if kind is None or kind == ")":
            if kind == ")":
                pos[0] -= 1
            if lenient:
                return None
            raise QueryStringError("query string ends early")
        if lenient:
            return None
        raise QueryStringError(f"unexpected {kind}")

    node = expr()
    while pos[0] < len(toks):
        if not lenient:
            raise QueryStringError("trailing input in query string")
        take()  # a stray ')' is dropped; parsing goes on
        node = _join(default_op, node, expr())
    return node


def _join(op, a, b):
    if a is None:
        return b
    if b is None:
        return a
    return Node(op, kids=(a, b))


def _scope(node, field):
    if node is None or field is None:
        return node
    if node.op in ("term", "phrase") and node.field is None:
        return Node(node.op, field=field, value=node.value)
    if node.op in ("and", "or", "not"):
        return Node(node.op, kids=tuple(_scope(k, field) for k in node.kids))
    return node


def evaluate(index: SearchIndex, node: Node, qid: int, numeric_docs: DataFrame | None = None) -> DataFrame:
    """(query_id, doc_id, score) of one parsed query string."""
    spark = index.spark
    if node.op in ("term", "phrase"):
        fields = [node.field] if node.field else index.text_fields()
        q = spark.createDataFrame([(qid, node.value)], "query_id bigint, query string")
        # fields without positions (n-grams) take a quoted phrase as all of its terms
        parts = [match(index, q, f, "any") if node.op == "term"
                 else phrase(index, q, f) if index.query_tokenizer(f).has_positions
                 else match(index, q, f, "all") for f in fields]
        out = parts[0]
        for p in parts[1:]:
            out = either(out, p)
        return out
    if node.op == "cmp":
        if numeric_docs is None:
            raise QueryStringError(f"{node.field!r} is compared, but no table holds its numbers")
        c = F.col(node.field)
        cond = {">": c > node.value, ">=": c >= node.value, "<": c < node.value, "<=": c <= node.value,
                "=": c == node.value}[node.cmp]
        d = numeric_docs.where(cond).select(F.lit(qid).cast("bigint").alias("query_id"),
                                            F.col(index.key).alias("doc_id"), F.lit(1.0).alias("score"))
        return d
    if node.op == "and" and {k.op for k in node.kids} != {"not"} and "not" in {k.op for k in node.kids}:
        # a AND NOT b: an anti join, without the complement of b
        keep, drop = sorted(node.kids, key=lambda k: k.op == "not")
        a = evaluate(index, keep, qid, numeric_docs)
        return without(as_filter(a) if keep.op == "cmp" else a, evaluate(index, drop.kids[0], qid, numeric_docs))
    if node.op == "and":
        a, b = (evaluate(index, k, qid, numeric_docs) for k in node.kids)
        if node.kids[0].op == "cmp":
            a = as_filter(a)
        if node.kids[1].op == "cmp":
            b = as_filter(b)
        return both(a, b)
    if node.op == "or":
        a, b = (evaluate(index, k, qid, numeric_docs) for k in node.kids)
        if node.kids[0].op == "cmp":
            a = as_filter(a)
        if node.kids[1].op == "cmp":
            b = as_filter(b)
        return either(a, b)
    if node.op == "not":
        # every row of the table, also those without a value; the indexed ones where the table is not at hand
        every = index.doclens.select("doc_id").distinct() if index.docs is None or index.partial else \
            index.docs.select(F.col(index.key).alias("doc_id"))
        base = every.select(
            F.lit(qid).cast("bigint").alias("query_id"), "doc_id", F.lit(0.0).alias("score"))
        return without(base, evaluate(index, node.kids[0], qid, numeric_docs))
    raise ValueError(node.op)


def query_string(index: SearchIndex, queries: dict, numeric_docs: DataFrame | None = None,
                 numeric_fields: list = (), lenient: bool = False, conjunction_mode: bool = False) -> DataFrame:
    """Evaluate ``{query_id: text}`` → (query_id, doc_id, score)."""
    parts = []
    for qid, text in queries.items():
        node = parse(text, index.text_fields(), list(numeric_fields), lenient, conjunction_mode)
        if node is None:
            continue
        parts.append(evaluate(index, node, qid, numeric_docs))
    return _union(parts, "query_id bigint, doc_id bigint, score double")
