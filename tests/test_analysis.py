import pytest
from pyspark.sql import functions as F

from lodestar.functions import analysis as A


def terms(spark, text, tok):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(tok.terms(F.col("t")).alias("x")).first()["x"]


def test_unicode_words_keeps_emoji_tokens(spark):
    assert terms(spark, "Hi 😀 there, Café!", A.unicode_words()) == ["hi", "😀", "there", "café"]


def test_remove_emojis(spark):
    assert terms(spark, "Hi 😀 there", A.unicode_words(remove_emojis=True)) == ["hi", "there"]


def test_lowercase_off(spark):
    assert terms(spark, "Hi There", A.unicode_words(lowercase=False)) == ["Hi", "There"]


def test_simple_and_stemmer(spark):
    assert terms(spark, "ponies cities goes glasses bus cats", A.simple(stemmer="english")) == \
        ["pony", "city", "goe", "glasse", "bus", "cat"]


def test_whitespace(spark):
    assert terms(spark, "a-b  C,d", A.whitespace()) == ["a-b", "c,d"]


def test_literal_and_normalized_trim(spark):
    assert terms(spark, " Big Box ", A.literal()) == [" Big Box "]
    assert terms(spark, " Big Box ", A.literal_normalized(trim=True)) == ["big box"]


def test_ngram_positions_and_prefix(spark):
    df = spark.createDataFrame([("Shoes",)], "t string")
    toks = df.select(F.inline(A.ngram(3, 3, positions=True).tokens(F.col("t")))).collect()
    assert [(r.term, r.pos) for r in toks] == [("sho", 0), ("hoe", 1), ("oes", 2)]
    assert terms(spark, "Shoes", A.ngram(3, 3, positions=True, prefix_only=True)) == ["sho"]
    assert terms(spark, "abcd", A.ngram(2, 3)) == ["ab", "abc", "bc", "bcd", "cd"]


def test_edge_ngram_and_token_chars(spark):
    assert terms(spark, "Run fast", A.edge_ngram(2, 3)) == ["ru", "run", "fa", "fas"]
    assert terms(spark, "Brand#12", A.edge_ngram(2, 5, token_chars="letter,digit,punctuation")) == \
        ["br", "bra", "bran", "brand"]


def test_regex_pattern(spark):
    assert terms(spark, "Ab1 cd2", A.regex_pattern("[a-z]+")) == ["ab", "cd"]


def test_source_code_boundaries(spark):
    assert terms(spark, "getHTTPResponse s2xx parse_json", A.source_code()) == \
        ["get", "httpresponse", "s", "2", "xx", "parse", "json"]


def test_chinese_compatible(spark):
    assert terms(spark, "中文text", A.chinese_compatible()) == ["中", "文", "text"]


def test_null_and_empty(spark):
    df = spark.createDataFrame([(None,), ("",), ("...",)], "t string")
    out = [r["x"] for r in df.select(A.unicode_words().terms(F.col("t")).alias("x")).collect()]
    assert out == [None, [], []]


def test_unknown_option_and_not_built():
    with pytest.raises(ValueError):
        A.unicode_words(bogus=True)
    with pytest.raises(NotImplementedError):
        A.tokenizer("jieba")


def test_token_offsets(spark):
    df = spark.createDataFrame([(1, "Hi, Café au lait")], "doc_id bigint, text string")
    out = A.token_offsets(df, "text", A.unicode_words()).orderBy("pos").collect()
    assert [(r.term, r.start, r.end) for r in out] == [("hi", 0, 2), ("café", 4, 8), ("au", 9, 11), ("lait", 12, 16)]
