from pyspark.sql import functions as F

from lodestar.functions import ranges as R
from lodestar.operators import facets as FA
from tests.conftest import rows


def test_range_text_and_relations(spark):
    df = spark.createDataFrame([(1, 5, 10), (2, 10, 12), (3, 12, None), (4, None, 3)], "id int, lo int, hi int")
    r = R.make_range(F.col("lo"), F.col("hi"), True, False)  # [lo, hi), NULL = unbounded
    q = R.parse_range(F.lit("(10, 12]"), "int4range")  # normalised to [11, 13)
    got = df.select("id", R.intersects(r, q).alias("i"), R.contains(r, q).alias("c"), R.within(r, q).alias("w"),
                    R.contains_value(r, F.lit(11)).alias("v"))
    assert rows(got) == [(1, False, False, False, False), (2, True, False, False, True),
                         (3, True, False, False, False), (4, False, False, False, False)]
    open_q = R.parse_range(F.lit("[,4)"), "int4range")
    assert rows(df.select("id", R.within(r, open_q).alias("w"))) == [(1, False), (2, False), (3, False), (4, True)]


def test_daterange_normalised(spark):
    df = spark.createDataFrame([(1,)], "id int")
    r = R.parse_range(F.lit("[2024-01-01,2024-01-03]"), "daterange")
    out = df.select(R.contains_value(r, F.lit("2024-01-03").cast("date")).alias("a"),
                    R.contains_value(r, F.lit("2024-01-04").cast("date")).alias("b"), r["upper"].alias("u")).first()
    assert out.a and not out.b and str(out.u) == "2024-01-04"


def test_aggregations(spark):
    df = spark.createDataFrame([(1, "a", 10.0, '{"color": "red"}'), (2, "b", 20.0, '{"color": "red"}'),
                                (3, "a", None, None), (4, "a", 40.0, '{"size": 1}')],
                               "id int, cat string, price double, meta string")
    one = FA.aggregate(df, {"n": ("value_count", "price"), "avg": ("avg", "price"),
                            "n_a": ("value_count", "price", F.col("cat") == "a")}).first()
    assert (one.n, one.avg, one.n_a) == (3, 70.0 / 3, 2)
    assert rows(FA.terms_buckets(df, "cat")) == [("a", 3), ("b", 1)]
    assert rows(FA.terms_buckets(df, FA.json_path("meta", "color"))) == [("red", 2)]
    rb = FA.range_buckets(df, "price", [(None, 15), (15, 30), (30, None), (100, 200)])
    assert [(r.key, r.doc_count) for r in rb.orderBy("idx").collect()] == \
        [("*-15", 1), ("15-30", 1), ("30-*", 1), ("100-200", 0)]
    ov = FA.over(df, {"total": ("value_count", "id")})
    assert {r.total for r in ov.collect()} == {4}
