"""Importance resampling: pick raw texts that look like a target set.

Words and word pairs are hashed into ``buckets``; one bag-of-features model is
counted over the target texts and one over all raw texts.  A text's importance
is the log ratio of the two models over its features; adding Gumbel noise and
taking the top k draws k texts without replacement in proportion to it.

Counts are summed inside each task before they are shuffled; only the two
models (``buckets`` numbers each) reach the driver.  The k-th key is found by
counting keys in ever finer ranges, so nothing is sorted as a whole.

Defined cases: a null or empty text has no features and weight 0; a null
``doc_id`` is never a target and shares one noise value; repeated rows have equal
keys and are taken or left together, as are all rows tied with the k-th; an empty
table gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import checkpointed, fits_broadcast
from . import kernel as K

BUCKETS = 1 << 13
SMOOTHING = 1.0
_RANGES = 4096  # key ranges counted at once
_FEW = 10_000  # keys of the last range that the driver sorts


def features(column, buckets: int):
    """Per slice: (bucket of every feature, first feature of each text and the end)."""
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    for _, _, offs, data in K.text_slices(column):
        low = K.lowered(data)
        start, end, first = K.word_bounds(low, offs)
        words = K.word_hashes(low, start, end)
        at, per = K.windows(first, 2)
        pairs = K.window_hashes(words, at, 2)
        both = np.concatenate((words, pairs)) >> shift
        text = np.concatenate((np.repeat(np.arange(len(per)), np.diff(first)), np.repeat(np.arange(len(per)), per)))
        order = np.argsort(text, kind="stable")
        yield both[order].astype(np.int64), np.concatenate(([0], np.cumsum(np.diff(first) + per)))


def count_features(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, raw, target): features of all rows and of those with ``is_target``."""
    def run(batches):
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for b in batches:
            wanted = b.column(1).to_numpy(zero_copy_only=False).astype(bool)
            row = 0
            for bucket, first in features(b.column(0), buckets):
                n = len(first) - 1
                raw += np.bincount(bucket, minlength=buckets)
                keep = np.repeat(wanted[row:row + n], np.diff(first))
                target += np.bincount(bucket[keep], minlength=buckets)
                row += n
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])], ["bucket", "raw", "target"])

    return docs.select("text", "is_target").mapInArrow(run, "bucket long, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def fit(docs: DataFrame, targets: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Log ratio of the target and raw models per bucket; ``targets``: distinct ``doc_id``."""
    ids = targets.select(F.col("doc_id").alias("target_id")).where("target_id is not null").distinct()
    ids = checkpointed(ids)
    side = F.broadcast(ids) if fits_broadcast(ids) else ids
    marked = docs.select("doc_id", "text").join(side, F.col("doc_id") == F.col("target_id"), "left").select(
        "text", F.col("target_id").isNotNull().alias("is_target"))
    raw, target = np.full(buckets, SMOOTHING), np.full(buckets, SMOOTHING)
    for bucket, r, t in count_features(marked, buckets).collect():
        raw[bucket] += r
        target[bucket] += t
    return np.round(np.log(target / target.sum()) - np.log(raw / raw.sum()), 9)


def weights(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """(doc_id, n_features, log_weight) for every row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    buckets = len(ratio)

    def run(batches):
        for b in batches:
            counts, sums = [], []
            for bucket, first in features(b.column(1), buckets):
                total = np.concatenate(([0.0], np.cumsum(ratio[bucket])))
                counts.append(np.diff(first))
                sums.append(np.round(np.diff(total[first]), 6))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int64)),
                 pa.array(np.concatenate(sums) if sums else np.zeros(0))], ["doc_id", "n_features", "log_weight"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_features long, log_weight double")


def gumbel(seed: int) -> Column:
    """Gumbel noise from a hash of the id: the same row draws the same noise anywhere."""
    bits = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 52))
    return -F.log(-F.log((bits + 0.5) / float(1 << 52)))


def kth_largest(keys: DataFrame, column: str, k: int) -> float:
    """The exact k-th largest value, by counting ranges that narrow on it."""
    low, high = keys.agg(F.min(column), F.max(column)).first()
    left = k  # the wanted value is the left-th largest inside [low, high]
    while True:
        inside = keys.where(F.col(column).between(low, high))
        width = (high - low) / _RANGES
        if not low + width > low:
            return high if left <= inside.where(F.col(column) == high).count() else low
        part = F.least(F.floor((F.col(column) - low) / width), F.lit(_RANGES - 1))
        counts = inside.groupBy(part.alias("part")).agg(
            F.count(F.lit(1)).alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).collect()
        for r in sorted(counts, key=lambda r: -r["part"]):
            if left <= r["n"]:
                break
            left -= r["n"]
        low, high = r["lo"], r["hi"]
        if low == high:
            return low
        if r["n"] <= _FEW:
            few = [x[0] for x in keys.where(F.col(column).between(low, high)).select(column).collect()]
            return sorted(few, reverse=True)[left - 1]


def resample(docs: DataFrame, targets: DataFrame, share: float = 0.25, seed: int = 5, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_features, log_weight, key, selected): ``selected`` marks a draw of ``share`` of the rows."""
    ratio = fit(docs, targets, buckets)
    scored = checkpointed(weights(docs, ratio).withColumn("key", F.col("log_weight") + gumbel(seed)))
    n = scored.count()
    k = int(-(-n * share // 1))
    if not k:
        return scored.withColumn("selected", F.lit(False))
    return scored.withColumn("selected", F.col("key") >= F.lit(kth_largest(scored, "key", k)))
