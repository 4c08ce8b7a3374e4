"""Range relations between two tables against every pair."""

import datetime
import decimal
import random

import pytest
from pyspark.sql import functions as F

from lodestar.functions import ranges as R
from lodestar.operators import range_join as RJ
from tests.conftest import rows


def _value(kind, n):
    if kind in ("int4range", "int8range"):
        return n if kind == "int4range" else n * 10 ** 14
    if kind == "numrange":
        return decimal.Decimal(n) / 4
    day = datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=5 * n)
    return day.date() if kind == "daterange" else day


def _ranges(spark, kind, n, seed):
    rng, et = random.Random(seed), R.RANGE_ELEMENT_TYPES[kind]
    out = []
    for i in range(n):
        lo = rng.randrange(-40, 60)
        hi = lo + rng.choice([0, 0, 1, 2, 5, 30, -3])
        ends = [None if rng.random() < .12 else _value(kind, x) for x in (lo, hi)]
        out.append((i, *ends, rng.random() < .5, rng.random() < .5, rng.random() < .03))
    d = spark.createDataFrame(out, f"id bigint, lo {et}, hi {et}, li boolean, ui boolean, none boolean")
    r = R.normalize(R.make_range(F.col("lo"), F.col("hi"), F.col("li"), F.col("ui")), kind)
    return d.select("id", F.when(~F.col("none"), r).alias("range"))


@pytest.mark.parametrize("kind", list(R.RANGE_ELEMENT_TYPES))
def test_relations_are_those_of_every_pair(spark, kind):
    a = _ranges(spark, kind, 70, 1).withColumnRenamed("id", "doc_id").checkpoint()
    b = _ranges(spark, kind, 50, 2).withColumnRenamed("id", "query_id").checkpoint()
    every = a.crossJoin(b.select("query_id", F.col("range").alias("asked")))  # the plain version
    for relation, holds in R.RELATIONS.items():
        want = rows(every.where(holds(F.col("range"), F.col("asked"))), "query_id", "doc_id")
        assert rows(RJ.range_join(a, b, relation), "query_id", "doc_id") == want, relation
        assert len(want) > 50
    values = b.select("query_id", F.col("range.lower").alias("value"))
    want = rows(every.where(R.contains_value(F.col("range"), F.col("asked.lower"))), "query_id", "doc_id")
    assert rows(RJ.range_contains_value(a, values), "query_id", "doc_id") == want


def test_cells_make_up_the_range_exactly(spark):
    rng = random.Random(3)
    ends = [(RJ.LEAST, RJ.GREATEST), (RJ.GREATEST, RJ.GREATEST), (RJ.LEAST, RJ.LEAST), (0, 0), (5, 4), (RJ.LEAST, -1), (3, RJ.GREATEST)]
    ends += [tuple(sorted(rng.randrange(-2 ** rng.randrange(1, 64), 2 ** rng.randrange(1, 64)) for _ in "ab")) for _ in range(200)]
    got = spark.createDataFrame(ends, "lo bigint, hi bigint").withColumn("cells", RJ._cell_list("lo", "hi")).collect()
    for r in got:
        spans = sorted((c["cell"] << (2 * c["level"]), ((c["cell"] + 1) << (2 * c["level"])) - 1) for c in r["cells"])
        if r["lo"] > r["hi"]:
            assert not spans
            continue
        assert spans[0][0] == r["lo"] and spans[-1][1] == r["hi"]
        assert all(x[1] + 1 == y[0] for x, y in zip(spans, spans[1:], strict=False)) and len(spans) <= 6 * RJ.LEVELS


def test_no_cross_join_and_repeated_rows(spark):
    a = spark.createDataFrame([(1, 0, 10), (1, 0, 10), (2, 20, None)], "doc_id bigint, lo int, hi int").select(
        "doc_id", R.make_range(F.col("lo"), F.col("hi")).alias("range"))
    b = spark.createDataFrame([(7, 5, 25)], "query_id bigint, lo int, hi int").select(
        "query_id", R.make_range(F.col("lo"), F.col("hi")).alias("range"))
    out = RJ.range_join(a, b, "Intersects")
    assert rows(out, "query_id", "doc_id") == [(7, 1), (7, 1), (7, 2)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert RJ.range_join(a.limit(0), b, "Contains").count() == 0 and RJ.range_join(a, b.limit(0), "Within").count() == 0
    with pytest.raises(ValueError):
        RJ.range_join(a, b, "Touches")
