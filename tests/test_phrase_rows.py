"""Rows that phrases of patterns form."""

from lodestar.operators import joins as J
from lodestar.operators import search as S
from lodestar.operators.index import Field, build_index
from tests.conftest import rows


def test_phrase_of_patterns_never_multiplies_documents_and_terms(spark, tmp_path, monkeypatch):
    words = [f"th{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)]
    docs = spark.createDataFrame([(i, f"{words[i]} and {words[-1 - i]}") for i in range(60)], "id bigint, text string")
    index = build_index(docs, "id", [Field("text")]).save(str(tmp_path / "idx"))
    most, held = [0], J.held

    def watched(df):
        out = held(df)
        most[0] = max(most[0], out[0].count())
        return out

    monkeypatch.setattr(J, "held", watched)
    found = rows(S.regex_phrase(index, "text", {1: ["th.*", "an."]}, slop=1), "query_id", "doc_id")
    assert found == [(1, i) for i in range(60)]
    assert most[0] <= 200  # documents x terms are 3,660
