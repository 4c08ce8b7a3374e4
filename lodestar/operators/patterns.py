"""Patterns over the vocabulary by a stored table of its character grams.

A term must hold every piece of text that a pattern requires (``th[a-z]a+`` starts
with ``th``), so the terms that can match are those filed under the rarest three
characters the pattern requires; only these are compared with it.  The patterns of
a batch are rows: one plan whatever their number.  A pattern that requires no such
piece is compared with every term of the field.

``grams(field, gpart, gram, term)`` is written with the index, partitioned by a hash
part of the gram and sorted by gram, with ``gram_counts(field, gram, n)`` beside it.
A term is filed under every three characters in a row and under its first and last
character; ``START`` and ``END`` stand before and after it.

Defined cases: a null pattern matches nothing; an empty one matches an empty term
only (no analyzer makes one); a pattern Java refuses raises; text whose meaning is
not certain (classes, options, alternatives, control characters) is not required.
"""

from __future__ import annotations

import re
import re._constants as sre
import re._parser as parser

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import held, join_held, join_small

START, END = "\x02", "\x03"
GRAM = 3
GRAM_PARTS = 64


def term_grams(terms: DataFrame) -> DataFrame:
    """(field, gpart, gram, term) of a vocabulary (field, term)."""
    whole = F.concat(F.lit(START), F.col("term"), F.lit(END))
    inner = F.transform(F.sequence(F.lit(1), F.greatest(F.length(whole) - (GRAM - 1), F.lit(1))), lambda i: F.substr(whole, i, F.lit(GRAM)))
    edges = F.array(F.substr(whole, F.lit(1), F.lit(2)), F.substr(whole, F.length(whole) - 1, F.lit(2)))
    rows = terms.select("field", "term", F.explode(F.array_distinct(F.concat(inner, edges))).alias("gram"))
    return rows.select("field", gram_part().alias("gpart"), "gram", "term")


def gram_part():
    return F.pmod(F.hash("gram"), F.lit(GRAM_PARTS)).cast("int")


def _runs(items) -> list[str]:
    """Texts that any match of a parsed sequence holds; ``\\0`` marks where one ends."""
    out = []
    for op, value in items:
        if op is sre.LITERAL and value >= 32:
            out.append(chr(value))
        elif op is sre.SUBPATTERN and not value[1] and not value[2]:
            out += _runs(value[3])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[0] >= 1:
            out += ["\0", *_runs(value[2]), "\0"]
        else:
            out.append("\0")
    return out


def required_grams(pattern: str | None) -> list[str]:
    """Grams of every term that the pattern matches as a whole; empty if none is certain."""
    try:
        parsed = parser.parse(pattern or "")
    except (re.error, OverflowError, RecursionError):  # Java may know more than Python
        return []
    if parsed.state.flags & ~sre.SRE_FLAG_UNICODE:
        return []
    out = set()
    for text in (START + "".join(_runs(parsed)) + END).split("\0"):
        out |= {text[i:i + GRAM] for i in range(len(text) - GRAM + 1)}
        if len(text) > 1 and text[0] == START:
            out.add(text[:2])
        if len(text) > 1 and text[-1] == END:
            out.add(text[-2:])
    return sorted(out)


def matching_terms(index, field: str, patterns: DataFrame) -> DataFrame:
    """(pattern, term): the vocabulary terms of ``field`` that each distinct pattern of ``patterns`` matches as a whole."""
    vocabulary = index.terms.where(F.col("field") == field).select("term")
    fits = F.expr("term rlike concat('^(?:', pattern, ')$')")
    distinct = patterns.select("pattern").where(F.col("pattern").isNotNull()).distinct()

    def read(batches):
        for b in batches:
            grams = [required_grams(p) for p in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(grams, pa.list_(pa.string()))], ["pattern", "grams"])

    asked, rows = held(distinct.mapInArrow(read, "pattern string, grams array<string>"))
    free = asked.where(F.size("grams") == 0).select("pattern")
    if index.grams is None:  # not stored
        free, found = asked.select("pattern"), None
    else:
        wanted = asked.select("pattern", F.explode("grams").alias("gram"))
        counts = join_small(index.gram_counts.where(F.col("field") == field).select("gram", "n"), wanted.select("gram").distinct(), "gram")
        # a batch that was appended has counts of its own
        counted = wanted.join(counts.groupBy("gram").agg(F.sum("n").alias("n")), "gram", "left")
        # a gram no term has rules the pattern out
        rarest = counted.groupBy("pattern").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram"))
        rarest, few = held(rarest.withColumn("gpart", gram_part()))
        grams = index.grams.where(F.col("field") == field)
        if few is not None:
            grams = grams.where(F.col("gpart").isin(sorted(set(few["gpart"].to_pylist()))))
        found = join_held(grams, rarest.select("pattern", "gram"), few, "gram").where(fits).select("pattern", "term").distinct()
    if rows is not None and index.grams is not None and all(rows["grams"].to_pylist()):
        return found
    # every term has to be compared: one key, the patterns on the small side
    every = join_held(vocabulary.withColumn("all", F.lit(0)), free.withColumn("all", F.lit(0)), rows, "all")
    every = every.where(fits).select("pattern", "term")
    return every if found is None else found.unionByName(every)


def pattern_terms(index, field: str, patterns: DataFrame, max_expansions: int | None = None) -> DataFrame:
    """The rows of ``patterns`` (pattern, ...) with the terms each matches as ``term``; of a row
    at most the first ``max_expansions`` terms in term order (a column of that name counts per row)."""
    found = join_small(matching_terms(index, field, patterns), patterns, "pattern")
    own = "max_expansions" in patterns.columns
    if max_expansions is not None or own:
        first = Window.partitionBy(*patterns.columns).orderBy("term")
        most = F.col("max_expansions") if own else F.lit(max_expansions)
        found = found.withColumn("__n", F.row_number().over(first)).where(most.isNull() | (F.col("__n") <= most)).drop("__n")
    return found.select(*patterns.columns, "term")
