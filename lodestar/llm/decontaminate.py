"""Benchmark decontamination with suffix arrays over the training texts.

Every task builds a suffix array over the words of each shard (a run of whole
documents) it reads and binary-searches every suffix of every benchmark item in
it.  The interval of suffixes that share a whole window with an item gives all
verbatim occurrences; refining it to the last shared word gives the longest
match.  A document never leaves its task, so nothing is shuffled.

The array is sparse but exact: a suffix can only match a window if its first
words all occur in the benchmark, so stretches of such words shorter than the
shortest window are left out.

Benchmark items reach the tasks in blocks of at most ``BLOCK_BYTES`` text bytes;
a larger benchmark is searched block after block over the same rows, the hit
positions being carried along, so no broadcast exceeds the bound.

Defined cases: a null or empty text (document or item) has no words and
matches nothing; a repeated document row is judged by itself; item rows that
repeat an ``item_id`` count as one item; an item without ``item_id`` marks words
but is listed as ``null``; only ``doc_id``, ``text`` and ``item_id`` are read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernel as K

WINDOW = 10
BLOCK_BYTES = 16 << 20  # benchmark text broadcast at once
SHARD_BYTES = 4 << 20  # training text under one suffix array


class Suffixes:
    """All suffixes of a block of benchmark items, as word numbers."""

    def __init__(self, items: list[tuple], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        words, self.item, self.need, self.offset, at = [], [], [], [], []
        self.ids = sorted({_name(i) for i, _ in items})
        number = {name: k for k, name in enumerate(self.ids)}
        for key, text in sorted(items, key=lambda r: (_name(r[0]), r[1] or "")):
            own = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in split_words(text)]
            if not own:
                continue
            width = min(window, len(own))
            for o in range(len(own) - width + 1):  # later suffixes hold no whole window
                at.append(len(words) + o)
                self.item.append(number[_name(key)])
                self.offset.append(o)
                self.need.append(width)
            words += own + [-1]
        self.words = np.array(words + [-1], np.int32)
        self.at, self.need = np.array(at, np.int64), np.array(self.need, np.int64)
        self.item, self.offset = np.array(self.item, np.int64), np.array(self.offset, np.int64)
        self.shortest = int(self.need.min(initial=window))
        ends = np.flatnonzero(self.words < 0)
        self.longest = int(np.diff(np.concatenate(([-1], ends))).max()) - 1


def _suffixes(block, key: str, window: int) -> Suffixes:
    """The suffixes of a block, built once per Python worker; ``key`` names the block."""
    kept = K.worker_cache("benchmark suffixes", dict)
    if key not in kept:
        kept.clear()  # of an earlier block
        kept[key] = Suffixes(block.value, window)
    return kept[key]


def _name(key) -> str:
    return "null" if key is None else str(key)


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(K.ALNUM).split()


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of all non-zero entries, ordered by the words from there on (at
    least ``depth`` words deep, by prefix doubling)."""
    n = len(text)
    rank = np.zeros(n + 1, np.int64)
    rank[:n] = text
    places = np.flatnonzero(text)
    done = 1
    while True:
        later = np.minimum(places + done, n)
        top = int(rank.max(initial=0)) + 1
        key = rank[places] * top + rank[later]
        order = np.argsort(key, kind="stable")
        s = key[order]
        new = np.concatenate(([1], 1 + np.cumsum(s[1:] != s[:-1]))) if len(s) else s
        done *= 2
        if done >= depth or (len(s) and new[-1] == len(s)) or not len(s):
            return places[order]
        rank = np.zeros(n + 1, np.int64)
        rank[places[order]] = new


def _narrow(text, places, lo, hi, word, depth):
    """The part of each interval [lo, hi) of the suffix array whose suffixes have ``word`` at ``depth``."""
    def bound(right: bool):
        a, b = lo.copy(), hi.copy()
        while (open_ := a < b).any():
            mid = (a + b) >> 1
            there = text[np.minimum(places[np.minimum(mid, len(places) - 1)] + depth, len(text) - 1)]
            go = open_ & ((there <= word) if right else (there < word))
            a = np.where(go, mid + 1, a)
            b = np.where(open_ & ~go, mid, b)
        return a

    return bound(False), bound(True)


def search(text: np.ndarray, suffixes: Suffixes):
    """(test suffix, first, last, longest, first and last of the longest): for
    every suffix with a whole window in ``text``, its interval of the suffix array."""
    places = suffix_array(text, suffixes.longest)
    padded = np.concatenate((text, [0])).astype(np.int32)
    live = np.arange(len(suffixes.at))
    lo, hi = np.zeros(len(live), np.int64), np.full(len(live), len(places), np.int64)
    first, last = lo.copy(), lo.copy()
    best_lo, best_hi, longest = lo.copy(), lo.copy(), lo.copy()
    depth = 0
    while len(live) and len(places):
        a, b = _narrow(padded, places, lo[live], hi[live], suffixes.words[suffixes.at[live] + depth], depth)
        depth += 1
        on = a < b
        live = live[on]
        lo[live], hi[live] = a[on], b[on]
        longest[live], best_lo[live], best_hi[live] = depth, lo[live], hi[live]
        whole = live[suffixes.need[live] == depth]
        first[whole], last[whole] = lo[whole], hi[whole]
        live = live[suffixes.words[suffixes.at[live] + depth] > 0]
    found = np.flatnonzero(last > first)
    return places, found, first[found], last[found], longest[found], best_lo[found], best_hi[found]


class Shard:
    """The words of a run of texts, those that can take part in a match, and where these stand."""

    def __init__(self, texts: list[bytes], suffixes: Suffixes):
        get = suffixes.vocabulary.get
        ids, counts = [], []
        for t in texts:
            own = [get(w, 0) for w in t.translate(K.ALNUM).split()]
            counts.append(len(own))
            ids += own
        self.counts = np.array(counts, np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        n = len(ids)
        known = np.array(ids, np.int32)
        # stretches of benchmark words inside one text
        cut = np.zeros(n + 1, bool)
        cut[self.first] = True
        on = np.zeros(n + 1, bool)
        on[:n] = known > 0
        before = np.concatenate(([False], on[:-1]))
        start = np.flatnonzero(on & (~before | cut))
        end = np.flatnonzero(on[:n] & (~on[1:] | cut[1:])) + 1
        long = end - start >= suffixes.shortest
        start, size = start[long], (end - start)[long]
        # those stretches one after the other, a zero behind each
        shift = np.cumsum(size + 1) - (size + 1)
        self.words = np.zeros(int((size + 1).sum()), np.int32)
        step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        self.place = np.zeros(len(self.words), np.int64)
        target = np.repeat(shift, size) + step
        self.place[target] = np.repeat(start, size) + step
        self.words[target] = known[self.place[target]]

    def document(self, word: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, word, "right") - 1


def shard_hits(texts: list[bytes], suffixes: Suffixes):
    """(words per text, hit flag per word, first word per text, distinct items per text)."""
    shard = Shard(texts, suffixes)
    edge = np.zeros(int(shard.first[-1]) + 1, np.int64)
    items: list[set] = [set() for _ in texts]
    places, found, first, last, *_ = search(shard.words, suffixes)
    if len(found):
        windows, back = np.unique(np.stack([first, last, suffixes.need[found]]), axis=1, return_inverse=True)
        back = back.ravel()
        # a word is the start of at most one window per width, so all places together are linear in the words
        size = windows[1] - windows[0]
        window = np.repeat(np.arange(len(size)), size)
        at = shard.place[places[np.arange(len(window)) + np.repeat(windows[0] - (np.cumsum(size) - size), size)]]
        edge += np.bincount(at, minlength=len(edge)) - np.bincount(at + windows[2][window], minlength=len(edge))
        # items of a window, then of the texts the window stands in
        named = np.unique(np.stack([back, suffixes.item[found]]), axis=1)
        begin = np.searchsorted(named[0], np.arange(len(size) + 1))
        met = np.unique(np.stack([shard.document(at), window]), axis=1)
        per = begin[met[1] + 1] - begin[met[1]]
        item = named[1][np.arange(int(per.sum())) + np.repeat(begin[met[1]] - (np.cumsum(per) - per), per)]
        for d, i in np.unique(np.stack([np.repeat(met[0], per), item]), axis=1).T.tolist():
            items[d].add(i)
    return shard.counts, np.cumsum(edge[:-1]) > 0, shard.first, items


def _shards(column):
    """Runs of whole texts of about ``SHARD_BYTES``."""
    for _, _, offs, data in K.text_slices(column, SHARD_BYTES):
        whole = data.tobytes()
        yield [whole[a:b] for a, b in zip(offs[:-1], offs[1:], strict=True)]


def item_blocks(benchmark: DataFrame, limit: int = BLOCK_BYTES):
    """Lists of (item_id, text) of at most ``limit`` text bytes (one longer item stands alone)."""
    block, size = [], 0
    for r in benchmark.select("item_id", "text").toLocalIterator():
        more = len((r[1] or "").encode())
        if block and size + more > limit:
            yield block
            block, size = [], 0
        block.append((r[0], r[1]))
        size += more
    yield block


_HITS = "n_words long, hits array<struct<start:long,stop:long>>, items array<string>"


def _search_block(texts, before, suffixes: Suffixes) -> dict:
    """One block over an Arrow text column; ``before``: what earlier blocks found."""
    out = {"n_words": [], "hits": [], "items": []}
    row = 0
    for shard in _shards(texts):
        counts, hit, first, items = shard_hits(shard, suffixes)
        for i, n in enumerate(counts):
            flags = hit[first[i]:first[i + 1]]
            names = {suffixes.ids[k] for k in items[i]}
            if before is not None:
                old = before[row]
                names |= set(old["items"])
                for span in old["hits"]:
                    flags[span["start"]:span["stop"]] = True
            turn = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
            out["n_words"].append(int(n))
            out["hits"].append([{"start": int(a), "stop": int(b)} for a, b in turn.reshape(-1, 2)])
            out["items"].append(sorted(names))
            row += 1
    kinds = {"n_words": pa.int64(), "items": pa.list_(pa.string()),
             "hits": pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))}
    return {k: pa.array(v, kinds[k]) for k, v in out.items()}


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every row of ``docs`` as ``row``, with ``n_words``, the merged word spans
    ``hits`` [start, stop) that occur verbatim in the benchmark, and its ``items``."""
    spark, found = docs.sparkSession, None
    at, names = docs.columns.index("text"), docs.columns
    for block in item_blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared, key=uuid.uuid4().hex, more=found is not None):
            suffixes = _suffixes(shared, key, window)
            for b in batches:
                row = b.column(0) if more else pa.StructArray.from_arrays(b.columns, names)
                before = None
                if more:
                    before = [{"hits": h, "items": i} for h, i in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
                new = _search_block(row.field(at), before, suffixes)
                yield pa.RecordBatch.from_arrays([row, *new.values()], ["row", *new])

        found = (docs if found is None else found).mapInArrow(K.tidy(run), f"row {docs.schema.simpleString()}, {_HITS}")
    return found


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) from ``contamination``."""
    from pyspark.sql import functions as F

    return found.select(
        "row.doc_id", "n_words",
        F.expr("aggregate(hits, 0L, (s, h) -> s + h.stop - h.start)").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, item_word, doc_id, doc_word, n_words): for every benchmark suffix
    and shard, the places of its longest verbatim match of at least a window."""
    spark, out = docs.sparkSession, None
    kind = docs.schema["doc_id"].dataType.simpleString()
    for block in item_blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared, key=uuid.uuid4().hex):
            suffixes = _suffixes(shared, key, window)
            for b in batches:
                row = 0
                for texts in _shards(b.column(1)):
                    shard = Shard(texts, suffixes)
                    places, found, _, _, longest, lo, hi = search(shard.words, suffixes)
                    for q, n, a, z in zip(found, longest, lo, hi, strict=True):
                        word = shard.place[places[a:z]]
                        d = shard.document(word)
                        m = len(word)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([suffixes.ids[suffixes.item[q]]] * m), pa.array([int(suffixes.offset[q])] * m, pa.int64()),
                             b.column(0).take(pa.array(d + row)), pa.array(word - shard.first[d]), pa.array([int(n)] * m, pa.int64())],
                            ["item_id", "item_word", "doc_id", "doc_word", "n_words"])
                    row += len(texts)

        part = docs.select("doc_id", "text").mapInArrow(
            run, f"item_id string, item_word long, doc_id {kind}, doc_word long, n_words long")
        out = part if out is None else out.unionByName(part)
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any benchmark window."""
    return contamination(docs, benchmark, window).where("size(hits) = 0").select("row.*")
