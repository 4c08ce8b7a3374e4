"""Ranges of few and of many rows: the pairs and how they are joined."""

from pyspark.sql import functions as F

from lodestar.functions import ranges as R
from lodestar.operators import joins as J
from lodestar.operators import range_join as RJ
from tests.conftest import rows


def plan(df):
    return df._jdf.queryExecution().toString()


def _ranges(spark, some, key):
    return spark.createDataFrame(some, f"{key} bigint, lo int, hi int").select(
        key, R.make_range(F.col("lo"), F.col("hi"), True, False).alias("range"))


A_ROWS = [(i, None if i % 7 == 0 else i % 13, None if i % 5 == 0 else i % 13 + i % 4) for i in range(40)]
B_ROWS = [(100 + i, None if i % 6 == 0 else i, None if i % 4 == 1 else i + 3) for i in range(12)] + [(100, 2, 4)]


def _expected(relation):
    out = []
    for a, alo, ahi in A_ROWS:
        for b, blo, bhi in B_ROWS:
            empty_a = alo is not None and ahi is not None and alo >= ahi
            empty_b = blo is not None and bhi is not None and blo >= bhi
            before = lambda x, y: x is None or y is None or x < y
            if relation == "Intersects":
                ok = not empty_a and not empty_b and before(alo, bhi) and before(blo, ahi)
            else:
                ok = empty_b or ((alo is None or (blo is not None and alo <= blo)) and (ahi is None or (bhi is not None and ahi >= bhi)))
                ok = ok and (empty_b or not empty_a)
            if ok:
                out.append((b, a))
    return sorted(out)


def test_range_join_of_few_and_many_rows(spark, monkeypatch):
    a, b = _ranges(spark, A_ROWS, "doc_id"), _ranges(spark, B_ROWS, "query_id")
    for relation in ("Intersects", "Contains"):
        for most, pairs in ((100_000, 1 << 20), (100_000, 3), (20, 1 << 20), (0, 1 << 20)):
            monkeypatch.setattr(J, "HELD_ROWS", most)
            monkeypatch.setattr(RJ, "PAIRS", pairs)
            assert rows(RJ.range_join(a, b, relation), "query_id", "doc_id") == _expected(relation)


def test_range_join_sends_the_few_rows_to_the_many(spark, monkeypatch):
    monkeypatch.setattr(J, "HELD_ROWS", 300)
    a, b = _ranges(spark, A_ROWS * 10, "doc_id"), _ranges(spark, B_ROWS[:3], "query_id")
    found = RJ.range_join(a, b, "Intersects")
    assert "hashpartitioning(level" not in plan(found)
