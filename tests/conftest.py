import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[4]").appName("lodestar-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="lodestar-test-ckpt-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


DOC_ROWS = [
    (1, "Running shoes for the running season"),
    (2, "Sleek white running shoes"),
    (3, "shoes"),
    (4, None),
    (5, ""),
    (6, "Café crème — naïve résumé"),
    (7, "中文 text 😀 here"),
    (8, "the quick brown fox jumps over the lazy dog the end"),
]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(DOC_ROWS, "id bigint, description string")


@pytest.fixture(scope="session")
def index(spark, docs):
    from lodestar.operators.index import Field, build_index

    path = tempfile.mkdtemp(prefix="lodestar-test-idx-")
    return build_index(docs, "id", [Field("description")]).save(path)


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
