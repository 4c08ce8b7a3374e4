"""Quality rules as weak supervision: every rule votes good, bad or abstains;
expectation-maximisation estimates how often each rule is right, and a document
is kept on its posterior probability of being good instead of having to pass
every rule.

The rules need only counts per text (``text_counts``: one Arrow pass, no
shuffle).  EM runs on the table of distinct vote patterns, which Spark counts
(at most 3^rules rows whatever the corpus size), so nothing per document
reaches the driver.

Defined cases: a null or empty text has no words, fails the base rules and is
not kept; a null ``doc_id`` is passed through; repeated rows are judged each on
its own; an empty table gives an empty result; only ``doc_id`` and ``text`` are
read, so other columns may have any names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import checkpointed
from . import kernel as K

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_end_lines",
          "n_letter_words"]
_SYMBOLS = K.byte_flags(b"#*$%&|<>")
_LETTER = K.byte_flags(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
_CODE_POINT = K.byte_flags(bytes(range(128, 192)), inside=False)  # not a continuation byte
_REPEAT_WIDTH = 5


def _line_counts(text: bytes) -> tuple[int, int, int]:
    """(lines with a word, of these equal to an earlier line, of these ending a sentence)."""
    seen, lines, dup, ends = set(), 0, 0, 0
    for line in text.split(b"\n"):
        body = line.rstrip(b" \t\x0b\x0c\r")
        if body:
            lines += 1
            ends += body.endswith((b".", b"!", b"?", b":", b'"'))
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    return lines, dup, ends


def _repeat_words(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text: words inside 5-word windows that occur at least twice in it."""
    at, per = K.windows(first, _REPEAT_WIDTH)
    h = K.window_hashes(hashes, at, _REPEAT_WIDTH)
    out = np.zeros(len(per), np.int64)
    stop = np.cumsum(per)
    for i, (a, b) in enumerate(zip(stop - per, stop, strict=True)):
        w = h[a:b]
        s = np.sort(w)
        same = s[1:] == s[:-1]
        if same.any():
            twice = np.isin(w, s[1:][same])
            hit = np.zeros(len(w) + _REPEAT_WIDTH - 1, bool)
            for j in range(_REPEAT_WIDTH):
                hit[j:j + len(w)] |= twice
            out[i] = hit.sum()
    return out


def count_texts(column) -> dict[str, np.ndarray]:
    """The ``COUNTS`` of every text of an Arrow string column."""
    parts: list[list[np.ndarray]] = []
    for _, _, offs, data in K.text_slices(column):
        start, end, first = K.word_bounds(data, offs)
        inside = K.WORD_BYTES[data]
        letters = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_LETTER[data], out=letters[1:])
        whole = data.tobytes()
        lines = np.array([_line_counts(whole[a:b]) for a, b in zip(offs[:-1], offs[1:], strict=True)], np.int64)
        parts.append([np.diff(first), K.count_in(inside & _CODE_POINT[data], offs), K.count_in(_SYMBOLS[data], offs),
                      lines[:, 1], _repeat_words(K.word_hashes(data, start, end), first), lines[:, 0], lines[:, 2],
                      K.count_in(letters[end] > letters[start], first)])
    return {c: np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64)
            for i, c in enumerate(COUNTS)}


def text_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, counts of ``COUNTS``) for every row of ``docs``."""
    def run(batches):
        for b in batches:
            n = count_texts(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(n[c]) for c in COUNTS)], ["doc_id", *COUNTS])

    narrow = docs.select("doc_id", "text")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(K.tidy(run), f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains (SQL over ``COUNTS``)."""

    name: str
    bad: str
    good: str


# thresholds of the default rules, as SQL over the counts
RULES = (
    Rule("length", "n_words < 10", "n_words >= 30"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words", "100 * n_repeat_words <= 5 * n_words"),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words",
         "word_chars >= 3 * n_words and word_chars <= 11 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    Rule("dense_symbols", "2 * n_symbols > n_words", "20 * n_symbols <= n_words"),
    Rule("duplicate_lines", "10 * n_dup_lines > 3 * n_lines", "20 * n_dup_lines <= n_lines"),
    Rule("letter_words", "100 * n_letter_words < 70 * n_words", "100 * n_letter_words >= 90 * n_words"),
    Rule("line_ends", "10 * n_end_lines < n_lines", "2 * n_end_lines >= n_lines"),
)
# rows with such counts fail whatever the votes are
BASE_FAILED = "n_words < 10 or 100 * n_repeat_words > 20 * n_words"


def vote(rule: Rule) -> Column:
    return F.expr(f"case when {rule.bad} then -1 when {rule.good} then 1 else 0 end")


def vote_patterns(counts: DataFrame, rules=RULES) -> DataFrame:
    """(one column per rule, n): how many rows cast each combination of votes."""
    return counts.groupBy(*[vote(r).alias(r.name) for r in rules]).agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class VoteModel:
    """``prior``: share of good documents.  Of the votes that rule j casts,
    ``good_right[j]`` are right on good documents and ``bad_right[j]`` on bad ones."""

    prior: float
    good_right: tuple[float, ...]
    bad_right: tuple[float, ...]
    rules: tuple[Rule, ...]

    def posterior(self) -> Column:
        """P(good | votes) as a Column over ``COUNTS``; an abstention says nothing."""
        odds = F.lit(float(np.log(self.prior / (1 - self.prior))))
        for r, g, b in zip(self.rules, self.good_right, self.bad_right, strict=True):
            odds = odds + F.when(vote(r) == 1, float(np.log(g / (1 - b)))).when(
                vote(r) == -1, float(np.log((1 - g) / b))).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def fit_votes(patterns: list[tuple], rules=RULES, rounds: int = 200, good_start: float = 0.97,
              bad_start: float = 0.4, prior_start: float = 0.85, pseudo: float = 50.0) -> VoteModel:
    """EM for two classes and independent rules.

    ``patterns``: rows (votes…, n).  Each accuracy starts at its ``_start`` with
    ``pseudo`` votes behind it; ``good_right`` stays in [0.9, 0.999],
    ``bad_right`` in [0.15, 0.95] and the prior in [0.5, 0.95], so a vote never
    changes its meaning and a document with only good votes is judged good.
    """
    table = np.array([tuple(p) for p in patterns], float).reshape(-1, len(rules) + 1)
    table = table[np.lexsort(table.T[::-1])]  # sums do not depend on Spark's row order
    votes, n = table[:, :-1], table[:, -1]
    up, down = votes > 0, votes < 0
    g_right, b_right, prior = np.full(len(rules), good_start), np.full(len(rules), bad_start), prior_start
    for _ in range(rounds):
        odds = np.log(prior / (1 - prior)) + up @ np.log(g_right / (1 - b_right)) + down @ np.log((1 - g_right) / b_right)
        good = n / (1 + np.exp(-odds))
        bad = n - good
        new = np.concatenate([
            np.clip((good @ up + pseudo * good_start) / (good @ (up | down) + pseudo), 0.9, 0.999),
            np.clip((bad @ down + pseudo * bad_start) / (bad @ (up | down) + pseudo), 0.15, 0.95),
            [np.clip((good.sum() + pseudo * prior_start) / (n.sum() + pseudo), 0.5, 0.95)]])
        moved = np.abs(new - np.concatenate([g_right, b_right, [prior]])).max()
        g_right, b_right, prior = new[:len(rules)], new[len(rules):-1], float(new[-1])
        if moved < 1e-9:
            break
    return VoteModel(round(prior, 9), tuple(round(float(p), 9) for p in g_right),
                     tuple(round(float(p), 9) for p in b_right), tuple(rules))


def fit(counts: DataFrame, rules=RULES, **options) -> VoteModel:
    """Fit on all rows; only the vote patterns (at most 3^rules) reach the driver."""
    return fit_votes([tuple(r) for r in vote_patterns(counts, rules).collect()], rules, **options)


def judged(docs: DataFrame, rules=RULES, threshold: float = 0.5) -> DataFrame:
    """(doc_id, counts, base_failed, posterior, kept) for every row of ``docs``."""
    counts = checkpointed(text_counts(docs))
    model = fit(counts, rules)
    failed = F.expr(BASE_FAILED)
    return counts.select("*", failed.alias("base_failed"), model.posterior().alias("posterior")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))


def keep_good(docs: DataFrame, rules=RULES, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are judged good, with all their columns.

    The second pass counts each text again inside the task that holds the row,
    so no text is shuffled.
    """
    model = fit(text_counts(docs), rules)
    kept = K.with_columns(docs, "text", count_texts, ", ".join(f"{c} long" for c in COUNTS))
    return kept.where(~F.expr(BASE_FAILED) & (model.posterior() >= threshold)).select("row.*")
