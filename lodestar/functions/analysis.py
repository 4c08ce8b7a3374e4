"""Analyzers (tokenizers) as Spark ``Column`` expressions.

Every tokenizer turns a string column into ``array<struct<term, pos>>`` with
built-in functions only, so tokenising stays inside the JVM and runs wherever
the rows already are (no shuffle, no Python worker).  The DuckDB oracle in
``lodestar.plans.oracle`` spells the same rules in SQL.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the analyzer contract.
WORD_CLASS = r"\p{L}\p{N}"
EMOJI_CLASS = r"\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}"
TOKEN_CHAR_CLASSES = {"letter": r"\p{L}", "digit": r"\p{N}", "punctuation": r"\p{P}"}
# Harman (1991) S-stemmer rules, in order: (suffix, exceptions, replacement).
S_STEMMER_RULES = [
    ("ies", ("eies", "aies"), "y"),
    ("es", ("aes", "ees", "oes"), "e"),
    ("s", ("us", "ss"), ""),
]
ARRAY_POSITION_GAP = 100
MARK = "\uFDD0"  # a noncharacter (in no text): a word break that a tokenizer adds

_KNOWN_OPTIONS = {
    "unicode_words": {"remove_emojis", "lowercase", "stemmer", "alias"},
    "simple": {"lowercase", "stemmer", "alias"},
    "whitespace": {"lowercase", "stemmer", "alias"},
    "literal": {"alias"},
    "literal_normalized": {"trim", "alias", "lowercase"},
    "ngram": {"positions", "prefix_only", "alias", "lowercase"},
    "edge_ngram": {"token_chars", "alias", "lowercase"},
    "regex_pattern": {"lowercase", "alias"},
    "source_code": {"lowercase", "stemmer", "alias"},
    "chinese_compatible": {"lowercase", "stemmer", "alias"},
}

NOT_BUILT = {"icu", "jieba", "lindera"}


def _truthy(v) -> bool:
    return v is True or str(v).lower() in ("true", "t", "1", "yes")


@dataclass(frozen=True)
class Tokenizer:
    """A named analyzer with positional args and an option map."""

    name: str = "unicode_words"
    args: tuple = ()
    options: tuple = field(default_factory=tuple)  # sorted (key, value) pairs

    def __post_init__(self):
        if self.name in NOT_BUILT:
            raise NotImplementedError(f"tokenizer {self.name!r} is not built (dictionary segmenter)")
        if self.name not in _KNOWN_OPTIONS:
            raise ValueError(f"unknown tokenizer {self.name!r}")
        unknown = {k for k, _ in self.options} - _KNOWN_OPTIONS[self.name]
        if unknown:
            raise ValueError(f"unknown option(s) {sorted(unknown)} for tokenizer {self.name}")
        if self.name == "ngram" and self.opt("positions") and self.args[0] != self.args[1]:
            raise ValueError("ngram positions=true needs min_gram == max_gram")

    # -- option access -------------------------------------------------------
    def opt(self, key, default=None):
        for k, v in self.options:
            if k == key:
                return v
        return default

    @property
    def alias(self):
        return self.opt("alias")

    @property
    def lowercase(self) -> bool:
        return _truthy(self.opt("lowercase", True))

    @property
    def has_positions(self) -> bool:
        """False when every token sits at position 0 (phrases are refused)."""
        if self.name in ("ngram",):
            return _truthy(self.opt("positions", False))
        return True

    def describe(self) -> str:
        parts = [str(a) for a in self.args] + [f"{k}={v}" for k, v in self.options]
        return f"{self.name}({','.join(parts)})" if parts else self.name

    # -- pattern of word-like tokenizers (used for offsets) ------------------
    def word_pattern(self) -> str | None:
        if self.name == "unicode_words":
            if _truthy(self.opt("remove_emojis", False)):
                return f"[{WORD_CLASS}]+"
            return f"[{WORD_CLASS}]+|[{EMOJI_CLASS}]"
        if self.name in ("simple", "source_code", "chinese_compatible"):
            return f"[{WORD_CLASS}]+"
        if self.name == "whitespace":
            return r"\S+"
        if self.name == "regex_pattern":
            return self.args[0]
        if self.name == "edge_ngram":
            chars = self.opt("token_chars", "letter,digit")
            cls = "".join(TOKEN_CHAR_CLASSES[c.strip()] for c in str(chars).split(","))
            return f"[{cls}]+"
        return None

    # -- the analyzer ----------------------------------------------------------
    def _norm(self, c: Column) -> Column:
        return F.lower(c) if self.lowercase else c

    def broken(self, c: Column) -> Column:
        """The text with ``MARK`` at the word breaks that this tokenizer adds."""
        if self.name == "source_code":
            for before, after in ((r"\p{Ll}", r"\p{Lu}"), (r"\p{L}", r"\p{N}"), (r"\p{N}", r"\p{L}")):
                c = F.regexp_replace(c, f"({before})({after})", f"$1{MARK}$2")
        elif self.name == "chinese_compatible":
            c = F.regexp_replace(c, r"(\p{IsHan})", f"{MARK}$1{MARK}")
        return c

    def terms(self, col) -> Column:
        """``array<string>`` of tokens in order (positions not included)."""
        plain = self.plain_terms(col)
        return plain if plain is not None else F.transform(self.tokens(col), lambda t: t["term"])

    def plain_terms(self, col) -> Column | None:
        """``array<string>`` whose index is the position, or None (n-grams).

        This is the fast path: ``posexplode`` of a built-in array stays in
        generated code, without a per-element lambda.
        """
        c = F.col(col) if isinstance(col, str) else col
        n = self.name
        if n in ("unicode_words", "simple", "whitespace", "regex_pattern"):
            return self._stem(F.regexp_extract_all(self._norm(c), F.lit(self.word_pattern()), 0))
        if n in ("source_code", "chinese_compatible"):
            return self._stem(F.regexp_extract_all(self._norm(self.broken(c)), F.lit(self.word_pattern()), 0))
        if n == "literal":
            return F.when(c.isNotNull(), F.array(c))
        if n == "literal_normalized":
            v = F.trim(c) if _truthy(self.opt("trim", False)) else c
            return F.when(c.isNotNull(), F.array(self._norm(v)))
        return None

    def is_empty(self, col) -> Column:
        """True when a non-NULL value has no tokens (cheap test, no extraction)."""
        c = F.col(col) if isinstance(col, str) else col
        if self.name in ("unicode_words", "simple", "whitespace", "regex_pattern", "source_code",
                         "chinese_compatible", "edge_ngram"):
            return ~self._norm(c).rlike(self.word_pattern() or f"[{WORD_CLASS}]+")
        if self.name in ("literal", "literal_normalized"):
            return F.lit(False)
        return F.size(self.tokens(c)) == 0

    def tokens(self, col) -> Column:
        """``array<struct<term string, pos int>>``; NULL input gives NULL."""
        c = F.col(col) if isinstance(col, str) else col
        n = self.name
        plain = self.plain_terms(c)
        if plain is not None:
            return _indexed(plain)
        if n == "ngram":
            lo, hi = int(self.args[0]), int(self.args[1])
            s = self._norm(c)
            positions = _truthy(self.opt("positions", False))
            prefix_only = _truthy(self.opt("prefix_only", False))
            starts = F.array(F.lit(0)) if prefix_only else F.sequence(F.lit(0), F.greatest(F.length(s) - lo, F.lit(-1)))
            starts = F.filter(starts, lambda st: st <= F.length(s) - lo)
            grams = F.flatten(F.transform(starts, lambda st: F.transform(
                F.filter(F.sequence(F.lit(lo), F.lit(hi)), lambda ln: st + ln <= F.length(s)),
                lambda ln: F.struct(F.substring(s, st + 1, ln).alias("term"),
                                    (st if positions else F.lit(0)).cast("int").alias("pos")))))
            return F.when(c.isNotNull(), grams)
        if n == "edge_ngram":
            lo, hi = int(self.args[0]), int(self.args[1])
            words = F.regexp_extract_all(self._norm(c), F.lit(self.word_pattern()), 0)
            grams = F.flatten(F.transform(words, lambda w, wi: F.transform(
                F.filter(F.sequence(F.lit(lo), F.lit(hi)), lambda ln: ln <= F.length(w)),
                lambda ln: F.struct(F.substring(w, 1, ln).alias("term"), wi.alias("pos")))))
            return F.when(c.isNotNull(), grams)
        raise ValueError(n)

    def _stem(self, words: Column) -> Column:
        if self.opt("stemmer") is None:
            return words
        if str(self.opt("stemmer")).lower() != "english":
            raise ValueError(f"unsupported stemmer {self.opt('stemmer')!r}")
        return F.transform(words, s_stem)


def s_stem(w: Column) -> Column:
    """English S-stemmer on one term column."""
    expr = None
    for suffix, exceptions, repl in S_STEMMER_RULES:
        cond = w.endswith(suffix)
        for e in exceptions:
            cond = cond & ~w.endswith(e)
        stemmed = F.concat(F.left(w, F.length(w) - F.lit(len(suffix))), F.lit(repl))
        expr = F.when(cond, stemmed) if expr is None else expr.when(cond, stemmed)
    return expr.otherwise(w)


def _indexed(words: Column) -> Column:
    return F.transform(words, lambda t, i: F.struct(t.alias("term"), i.alias("pos")))


def tokenizer(name: str = "unicode_words", *args, **options) -> Tokenizer:
    return Tokenizer(name, tuple(args), tuple(sorted((k, v) for k, v in options.items())))


def unicode_words(**o):
    return tokenizer("unicode_words", **o)


def simple(**o):
    return tokenizer("simple", **o)


def whitespace(**o):
    return tokenizer("whitespace", **o)


def literal(**o):
    return tokenizer("literal", **o)


def literal_normalized(**o):
    return tokenizer("literal_normalized", **o)


def ngram(min_gram: int, max_gram: int, **o):
    return tokenizer("ngram", min_gram, max_gram, **o)


def edge_ngram(min_gram: int, max_gram: int, **o):
    return tokenizer("edge_ngram", min_gram, max_gram, **o)


def regex_pattern(pattern: str, **o):
    return tokenizer("regex_pattern", pattern, **o)


def source_code(**o):
    return tokenizer("source_code", **o)


def chinese_compatible(**o):
    return tokenizer("chinese_compatible", **o)


DEFAULT = unicode_words()


def token_offsets(df, text_col: str, tok: Tokenizer, keys=("doc_id",)):
    """Explode ``df`` to one row per token with 0-based code-point offsets into the text.

    ``split`` yields the n+1 separators around the n matches; the end offset of
    token i is the running sum of separator and token lengths up to i, taken
    with a window partitioned by the row (linear in tokens, no array folds).
    Word breaks that the tokenizer puts in (``MARK``) have no length, and where
    lower-casing makes a text longer the offsets are taken back to the text.
    Adds columns ``pos, start, end, term`` (the indexed term); other columns are
    kept.  An edge n-gram tokenizer gives one row per gram of each word.
    """
    from pyspark.sql import Window

    s = tok._norm(tok.broken(F.col(text_col)))
    toks = F.regexp_extract_all(s, F.lit(tok.word_pattern()), 0)
    marked = tok.name in ("source_code", "chinese_compatible")
    seps = F.transform(F.split(s, tok.word_pattern(), -1),
                       lambda x: F.length(F.translate(x, MARK, "") if marked else x))
    ex = df.select("*", (_widened(F.col(text_col)) if tok.lowercase else F.array().cast("array<int>")).alias("wide"),
                   F.posexplode(F.arrays_zip(F.slice(seps, 1, F.size(toks)).alias("sep"),
                                             toks.alias("tok"))).alias("pos", "st"))
    w = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    ex = ex.withColumn("end", F.sum(F.col("st.sep") + F.length("st.tok")).over(w).cast("int"))
    ex = (ex.withColumn("start", (F.col("end") - F.length("st.tok")).cast("int"))
            .withColumn("term", F.col("st.tok")).drop("st"))
    if tok.name == "edge_ngram":
        lo, hi = (int(a) for a in tok.args)
        ex = ex.where(F.length("term") >= lo).withColumn(
            "n", F.explode(F.sequence(F.lit(lo), F.least(F.lit(hi), F.length("term")))))
        ex = ex.withColumn("end", F.col("start") + F.col("n")).withColumn(
            "term", F.substring("term", F.lit(1), F.col("n"))).drop("n")
    elif tok.opt("stemmer") is not None:
        ex = ex.withColumn("term", s_stem(F.col("term")))
    start = F.col("start") - F.size(F.filter("wide", lambda x: x < F.col("start")))
    end = F.col("end") - F.size(F.filter("wide", lambda x: x + 1 < F.col("end")))
    return ex.withColumns({"start": start, "end": end}).drop("wide")


def _widened(c: Column) -> Column:
    """Places in ``lower(c)`` of the one letter (U+0130) that becomes two when lower-cased."""
    parts = F.split(c, "\u0130", -1)
    fold = F.aggregate(
        F.slice(parts, 1, F.size(parts) - 1),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda s, p: F.struct((s["at"] + F.length(p) + 2).alias("at"),
                              F.concat(s["out"], F.array(s["at"] + F.length(p))).alias("out")),
        lambda s: s["out"])
    return F.when(F.contains(c, F.lit("\u0130")), fold).otherwise(F.array().cast("array<int>"))
