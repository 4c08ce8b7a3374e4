"""Bounded edit distance from built-in functions.

Spark has ``levenshtein(a, b, threshold)`` but no Damerau distance.  With
``S(x)`` = the strings made by swapping one adjacent pair of ``x``:

* d ≤ 1  ⇔  lev(a, b) ≤ 1  or  b ∈ S(a)
* d ≤ 2  ⇔  lev(a, b) ≤ 2  or  ∃v ∈ S(a): lev(v, b) ≤ 1
            or  ∃v ∈ S(b): lev(a, v) ≤ 1  or  S(a) ∩ S(b) ≠ ∅

(adjacent swaps cost 1, each character edited at most once).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def swaps(s: Column) -> Column:
    """All strings made by swapping one adjacent pair (array, may be empty)."""
    n = F.length(s)
    idx = F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1)))
    return F.filter(F.transform(idx, lambda i: F.when(
        i < n,
        F.concat(F.substring(s, 1, i - 1), F.substring(s, i + 1, 1), F.substring(s, i, 1),
                 F.substring(s, i + 2, 1 << 30)))), lambda x: x.isNotNull())


def within_distance(a: Column, b: Column, d: int, transposition: bool = True) -> Column:
    """True when the edit distance of ``a`` and ``b`` is at most ``d`` (0..2)."""
    if d == 0:
        return a == b
    lev = F.levenshtein(a, b, d) >= 0  # threshold form: -1 when above d
    if not transposition:
        return lev
    sa, sb = swaps(a), swaps(b)
    if d == 1:
        return lev | F.array_contains(sa, b)
    return (lev
            | F.exists(sa, lambda v: F.levenshtein(v, b, 1) >= 0)
            | F.exists(sb, lambda v: F.levenshtein(a, v, 1) >= 0)
            | F.arrays_overlap(sa, sb))


def deletion_variants(s: Column, d: int) -> Column:
    """The string and every string reached from it by at most ``d`` deletions."""
    out = F.array(s)
    for _ in range(d):
        out = F.array_distinct(F.concat(out, F.flatten(F.transform(out, _delete_one))))
    return out


def _delete_one(s: Column) -> Column:
    n = F.length(s)
    return F.transform(F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: i <= n),
                       lambda i: F.concat(F.substring(s, 1, i - 1), F.substring(s, i + 1, 1 << 30)))
