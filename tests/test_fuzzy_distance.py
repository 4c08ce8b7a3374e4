"""Bounded Damerau distance (adjacent swap = 1) from built-ins, checked
against DuckDB's ``damerau_levenshtein`` / ``levenshtein`` (the oracle's
functions) on every pair of short strings over a small alphabet."""

import itertools

from pyspark.sql import functions as F

from lodestar.functions.fuzzy import deletion_variants, within_distance


def _reference(pairs):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE TABLE p (a VARCHAR, b VARCHAR)")
    con.executemany("INSERT INTO p VALUES (?, ?)", pairs)
    return {(a, b): (dl, lv) for a, b, dl, lv in con.execute(
        "SELECT a, b, damerau_levenshtein(a, b), levenshtein(a, b) FROM p").fetchall()}


def test_within_distance_matches_reference(spark):
    words = ["".join(p) for n in range(1, 5) for p in itertools.product("abc", repeat=n)]
    pairs = [(a, b) for a in words for b in words if abs(len(a) - len(b)) <= 2]
    ref = _reference(pairs)
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select("a", "b", within_distance(F.col("a"), F.col("b"), 1).alias("d1"),
                    within_distance(F.col("a"), F.col("b"), 2).alias("d2"),
                    within_distance(F.col("a"), F.col("b"), 1, transposition=False).alias("l1")).collect()
    bad = [(r.a, r.b) for r in got
           if r.d1 != (ref[(r.a, r.b)][0] <= 1) or r.d2 != (ref[(r.a, r.b)][0] <= 2)
           or r.l1 != (ref[(r.a, r.b)][1] <= 1)]
    assert not bad, bad[:5]


def test_deletion_variants_block_every_close_pair(spark):
    words = ["".join(p) for n in range(1, 5) for p in itertools.product("ab", repeat=n)]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    var = {r.w: set(r.v) for r in df.select("w", deletion_variants(F.col("w"), 2).alias("v")).collect()}
    ref = _reference([(a, b) for a in words for b in words])
    for a in words:
        for b in words:
            if ref[(a, b)][0] <= 2:
                assert var[a] & var[b], (a, b)
