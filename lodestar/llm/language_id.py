"""Language ID with a byte convolutional network.

The network reads fixed windows of ``WINDOW`` bytes: filters of several widths
over the bytes, the maximum of each filter over the window, a softmax over the
languages.  It is trained in NumPy on a bounded sample of labelled texts and
applied to every window of every whole text inside Arrow batches; a text's
prediction is the mean of its windows' scores, weighted by their bytes.

The training sample is bounded by ``Training.docs`` texts per language (chosen
by a hash of the id, from the whole table) and ``Training.windows`` windows per
text, so the driver never holds more than a few megabytes.

Defined cases: a null text or one without a letter is ``und`` with score 0, as
is every text if no row is labelled; rows with a null ``doc_id`` are predicted
but never learned from; repeated rows get equal predictions; an empty table
gives an empty result; only ``doc_id``, ``text`` and (for training) ``lang`` are
read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernel as K

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16  # per width
UNKNOWN = "und"
_ASCII_LETTER = K.byte_flags(bytes(range(65, 91)) + bytes(range(97, 123)))


@dataclass(frozen=True)
class Training:
    docs: int = 800  # texts per language, about
    windows: int = 4  # windows per text
    epochs: int = 8
    steps: int = 600  # at least, whatever the number of windows
    batch: int = 128
    rate: float = 0.004
    seed: int = 11


@dataclass
class Network:
    """``filters[w][j]``: (256, FILTERS) weights of the j-th byte under filters of width w."""

    languages: list[str]
    filters: dict[int, np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray


def windows_of(offs: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, text of each, bytes in each): all windows of all texts, lower-cased, padded with spaces."""
    size = np.diff(offs)
    per = -(-size // WINDOW)
    text = np.repeat(np.arange(len(size)), per)
    out = np.full((int(per.sum()), WINDOW), 32, np.uint8)
    flat, low = out.reshape(-1), K.lowered(data)
    at = (np.cumsum(per) - per) * WINDOW
    for a, n, d in zip(offs[:-1].tolist(), size.tolist(), at.tolist(), strict=True):
        flat[d:d + n] = low[a:a + n]
    nth = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    return out, text, np.minimum(WINDOW, size[text] - nth * WINDOW)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], how: Training = Training()) -> Network:
    """Fit the network by Adam; only the byte places that win the pooling get a gradient."""
    if not len(windows):
        languages = []
    rng = np.random.Generator(np.random.PCG64(how.seed))
    width, hidden = len(WIDTHS), FILTERS * len(WIDTHS)
    p = {("w", w): rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
    p["b"] = np.zeros(hidden, np.float32)
    p["d"] = rng.normal(0, 0.2, (hidden, len(languages))).astype(np.float32)
    p["c"] = np.zeros(len(languages), np.float32)
    m1, m2 = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    step, lanes = 0, np.arange(FILTERS)
    epochs = max(how.epochs, -(-how.steps // max(1, -(-len(windows) // how.batch)))) if languages else 0
    for epoch in range(epochs):
        rate = how.rate * (1 - epoch / epochs)
        order = rng.permutation(len(windows))
        for a in range(0, len(order), how.batch):
            x, y = windows[order[a:a + how.batch]], labels[order[a:a + how.batch]]
            xt, rows, pooled, won = np.ascontiguousarray(x.T), len(x), [], []
            for w in WIDTHS:
                conv = sum(p["w", w][j][xt[j:WINDOW - w + 1 + j]] for j in range(w))
                at = conv.argmax(0)
                won.append(at)
                pooled.append(np.take_along_axis(conv, at[None], 0)[0])
            h = np.concatenate(pooled, 1) + p["b"]
            r = np.maximum(h, 0)
            z = r @ p["d"] + p["c"]
            e = np.exp(z - z.max(1, keepdims=True))
            dz = e / e.sum(1, keepdims=True)
            dz[np.arange(rows), y] -= 1
            dz /= rows
            dh = (dz @ p["d"].T) * (h > 0)
            g = {"d": r.T @ dz, "c": dz.sum(0), "b": dh.sum(0)}
            for k in range(width):
                w, d = WIDTHS[k], dh[:, k * FILTERS:(k + 1) * FILTERS]
                grad = np.empty((w, 256 * FILTERS), np.float32)
                for j in range(w):
                    byte = np.take_along_axis(x, won[k] + j, 1).astype(np.int64)
                    grad[j] = np.bincount((byte * FILTERS + lanes).ravel(), d.ravel(), 256 * FILTERS)
                g["w", w] = grad.reshape(w, 256, FILTERS)
            step += 1
            for k, v in g.items():
                m1[k] = 0.9 * m1[k] + 0.1 * v
                m2[k] = 0.999 * m2[k] + 0.001 * v * v
                p[k] = p[k] - rate * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)
    return Network(languages, {w: p["w", w].astype(np.float32) for w in WIDTHS}, p["b"], p["d"], p["c"])


class Scorer:
    """Scores windows; the filters are summed beforehand for every pair of
    neighbouring bytes, which gives the same convolutions with fewer lookups."""

    STEP = 64  # windows at a time stay in the processor's cache

    def __init__(self, net: Network):
        self.net = net
        self.parts = {}
        for w, f in net.filters.items():
            f = f.astype(np.float32)
            pairs = [(j, (f[j][:, None] + f[j + 1][None]).reshape(65536, FILTERS)) for j in range(0, w - 1, 2)]
            self.parts[w] = (pairs, f[w - 1] if w % 2 else None)

    def logits(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.net.languages)))
        for a in range(0, len(windows), self.STEP):
            x = np.ascontiguousarray(windows[a:a + self.STEP].T)
            two = x[:-1].astype(np.int32) * 256 + x[1:]
            pooled = []
            for w, (pairs, last) in self.parts.items():
                n = WINDOW - w + 1
                conv = np.take(pairs[0][1], two[:n], axis=0)
                for j, table in pairs[1:]:
                    conv += np.take(table, two[j:j + n], axis=0)
                if last is not None:
                    conv += np.take(last, x[w - 1:w - 1 + n], axis=0)
                pooled.append(conv.max(0))
            h = np.maximum(np.concatenate(pooled, 1) + self.net.bias, 0)
            out[a:a + self.STEP] = h @ self.net.dense + self.net.dense_bias
        return out


def predict_column(column, scorer: Scorer) -> dict:
    """``lang_pred`` and ``score`` of every text of an Arrow string column."""
    langs, scores = [], []
    for _, _, offs, data in K.text_slices(column):
        n = len(offs) - 1
        has = K.count_in(_ASCII_LETTER[data], offs) > 0
        for i in np.flatnonzero(~has & (np.diff(offs) > 0)):
            has[i] = any(c.isalpha() for c in data[offs[i]:offs[i + 1]].tobytes().decode())
        labels = np.full(n, UNKNOWN, object)
        score = np.zeros(n)
        if scorer.net.languages and has.any():
            windows, text, size = windows_of(offs, data)
            logit = np.zeros((n, len(scorer.net.languages)))
            np.add.at(logit, text, scorer.logits(windows) * size[:, None])
            logit /= np.maximum(np.diff(offs), 1)[:, None]
            e = np.exp(logit - logit.max(1, keepdims=True))
            best = e.argmax(1)
            labels[has] = np.array(scorer.net.languages, object)[best[has]]
            score[has] = (e.max(1) / e.sum(1))[has]
        langs.append(labels)
        scores.append(score)
    return {"lang_pred": pa.array(np.concatenate(langs) if langs else [], pa.string()),
            "score": pa.array(np.concatenate(scores) if scores else [], pa.float64())}


def training_windows(docs: DataFrame, how: Training = Training()) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(windows, label numbers, languages) of the bounded sample of labelled rows."""
    labelled = docs.where("lang is not null and text is not null and doc_id is not null")
    counts = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        return np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64), []
    share = F.lit(None).cast("double")
    for name in languages:
        share = F.when(F.col("lang") == name, min(1.0, how.docs / counts[name])).otherwise(share)
    chosen = labelled.where(F.pmod(F.xxhash64(F.lit(how.seed), "doc_id"), F.lit(1 << 24)) < share * (1 << 24)).select(
        F.col("doc_id").cast("string"), "lang", "text")

    def run(batches):
        for b in batches:
            ids, langs, nth, cut = [], [], [], []
            for i, s in enumerate(b.column(2).to_pylist()):
                raw = s.encode()
                n = -(-len(raw) // WINDOW)
                for k in sorted({j * n // how.windows for j in range(how.windows)} if n else ()):
                    ids.append(b.column(0)[i])
                    langs.append(b.column(1)[i])
                    nth.append(k)
                    cut.append(raw[k * WINDOW:(k + 1) * WINDOW])
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.as_py() for x in ids], pa.string()), pa.array([x.as_py() for x in langs], pa.string()),
                 pa.array(nth, pa.int64()), pa.array(cut, pa.binary())], ["doc_id", "lang", "nth", "cut"])

    # a sample by definition: rows that repeat one id cannot exceed twice its size
    bound = 2 * how.docs * how.windows * len(languages)
    got = chosen.mapInArrow(K.tidy(run), "doc_id string, lang string, nth long, cut binary").limit(bound).collect()
    got = sorted((r["lang"], r["doc_id"], r["nth"], bytes(r["cut"])) for r in got)
    raw = b"".join(r[3].translate(K.LOWER).ljust(WINDOW) for r in got)
    return (np.frombuffer(raw, np.uint8).reshape(-1, WINDOW),
            np.array([languages.index(r[0]) for r in got], np.int64), languages)


def held_out() -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def fit(docs: DataFrame, how: Training = Training()) -> Network:
    """Train on the labelled rows that are not held out."""
    windows, labels, languages = training_windows(docs.where(~held_out()), how)
    return train(windows, labels, languages if len(windows) else [], how)


def predict(docs: DataFrame, net: Network) -> DataFrame:
    """Every row of ``docs`` as ``row``, with ``lang_pred`` and ``score``."""
    def compute(column):
        return predict_column(column, Scorer(net))

    return K.with_columns(docs, "text", compute, "lang_pred string, score double")


def keep_known(docs: DataFrame, least: float = 0.5, how: Training = Training()) -> DataFrame:
    """The rows of ``docs`` whose language is predicted with a score of at least ``least``."""
    return predict(docs, fit(docs, how)).where(
        (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("row.*")
