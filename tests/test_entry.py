import re

import __spark_entry__ as E


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100
    rows_only = {k for k in set(q) - set(o) if k != "pipeline" and not re.match(r"op\d+_", k)}  # the optional operators aside
    assert rows_only == {"ix_vector_clusters", "v_clustered", "d_verify_sample"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["query_id", "doc_id", "score", "rank"]
    assert df.count() > 0
