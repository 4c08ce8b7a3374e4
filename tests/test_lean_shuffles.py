"""What the index build and more-like-this shuffle is kept lean."""

from lodestar.operators import mlt as M
from lodestar.operators import topk as T
from lodestar.operators.index import build_index
from lodestar.operators.joins import held
from tests.conftest import rows

TEXTS = [(i, f"the fox w{i} w{i % 7} w{i % 3} fox{' the' * (i % 4)}") for i in range(60)] + [(61, ""), (62, None), (63, "x the x")]


def _built(spark, path, monkeypatch):
    """An index, and the columns of what its build dealt out, by the columns dealt by."""
    docs = spark.createDataFrame(TEXTS, "id bigint, text string")
    dealt, deal = [], type(docs).repartition

    def noted(self, number, *by):
        if "positions" in self.columns or "gram" in self.columns or "term" in self.columns:
            dealt.append(set(self.columns))
        return deal(self, number, *by)

    with monkeypatch.context() as m:
        m.setattr(type(docs), "repartition", noted)
        return build_index(docs, "id", ["text"], buckets=3, hot_df=8, rare_parts=2).save(path), dealt


def test_a_build_deals_out_no_grams_and_lean_rare_postings(spark, tmp_path, monkeypatch):
    idx, dealt = _built(spark, str(tmp_path / "i"), monkeypatch)
    assert dealt and not any({"gram", "tf", "rpart", "positions"} & columns for columns in dealt)
    cold = idx.terms.where("not hot").select("field", "term")
    columns = ["field", "term", "doc_id", "tf", "dl", "positions"]
    as_rows = lambda df: sorted(map(tuple, df.select(*columns).collect()), key=repr)
    assert as_rows(idx.rare) == as_rows(idx.postings.join(cold, ["field", "term"])) != []
    assert idx.rare.where("tf > 1").count() and idx.rare.where("tf = 1").count()
    terms = {r["term"] for r in idx.terms.collect()}
    assert {r["term"] for r in idx.grams.collect()} == terms
    counted = {(r["gram"], r["n"]) for r in idx.gram_counts.collect()}
    assert counted == {(r["gram"], r["count"]) for r in idx.grams.groupBy("gram").count().collect()}


def test_costly_rows_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(0, 40, 1, 1).mapInArrow(count, "id bigint")
    kept, known = held(df, 10, costly=True)
    assert known is None and seen.value == 40 and kept.count() == 40 and seen.value == 40
    kept, known = held(df, 100, costly=True)
    assert known.num_rows == 40 and seen.value == 80


def test_many_sources_choose_the_same_terms(spark, tmp_path, monkeypatch):
    idx, _ = _built(spark, str(tmp_path / "i"), monkeypatch)
    src = spark.createDataFrame([(i % 2, i) for i in range(20)], "query_id bigint, src_id bigint")
    few = M.source_terms(idx, src)["text"]
    by_few = rows(M.most_like_this_id(idx, src, 5, exclude_sources=True))
    monkeypatch.setattr(M, "FEW_SOURCES", 0)
    many = M.source_terms(idx, src)["text"]
    assert many.columns == few.columns and rows(many) == rows(few)
    monkeypatch.setattr(T, "PASS_ROWS", 4)
    assert rows(M.most_like_this_id(idx, src, 5, exclude_sources=True)) == by_few != []
