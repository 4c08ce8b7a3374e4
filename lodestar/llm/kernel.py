"""Array kernels on Arrow text batches, shared by the operators of this subpackage.

Every kernel works on the UTF-8 bytes of a slice of rows at once (NumPy over
the Arrow buffers); a slice holds whole texts and about ``SLICE_BYTES`` bytes,
so memory per task is bounded by the slice plus the longest single text.
"""

from __future__ import annotations

import ctypes
import functools
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SLICE_BYTES = 1 << 20  # text bytes handled at once by one task
SEGMENT_BYTES = 1 << 19  # hashing buffer inside one slice; cut between words

_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
LOWER = bytes.maketrans(_UPPER, _LOWER)
# words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z: every other byte becomes a space
ALNUM = bytes((b if (48 <= b <= 57 or 97 <= b <= 122 or b >= 128) else 32) for b in LOWER)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # splitmix64 finalizer


def worker_cache(key, build):
    """``build()`` once per Python worker process (workers serve many tasks)."""
    store = sys.modules.setdefault("_lodestar_worker_cache", types.ModuleType("_lodestar_worker_cache")).__dict__
    if key not in store:
        store[key] = build()
    return store[key]


def give_back() -> None:
    """Return freed memory to the system; a worker process lives on between tasks and would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def tidy(run):
    """``run(batches)`` of a partition, after which its freed memory is given back."""
    @functools.wraps(run)
    def whole(batches):
        yield from run(batches)
        give_back()

    return whole


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offs - offs[0], raw[offs[0]:offs[-1]]


def text_slices(column, budget: int = SLICE_BYTES):
    """Yield (first row, last row, offsets, bytes) for runs of whole texts of about ``budget`` bytes."""
    offs, data = text_buffers(column)
    n, a = len(offs) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + budget, "right")) - 1)
        yield a, b, offs[a:b + 1] - offs[a], data[offs[a]:offs[b]]
        a = b


def byte_flags(members: bytes, inside: bool = True) -> np.ndarray:
    """256 flags: True for the bytes in ``members`` (or for all the others)."""
    t = np.full(256, not inside)
    t[np.frombuffer(members, np.uint8)] = inside
    return t


WORD_BYTES = byte_flags(b" \t\n\x0b\x0c\r", inside=False)  # words [^\x20\x09-\x0D]+


def count_in(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many flags are set between consecutive bounds."""
    c = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=c[1:])
    return np.diff(c[bounds])


def word_bounds(data: np.ndarray, offs: np.ndarray, word: np.ndarray = WORD_BYTES):
    """(start, end, first): byte bounds of all words of the slice and, per text,
    the index of its first word (``first`` has one entry more)."""
    inside = word[data]
    edge = np.zeros(len(data) + 1, bool)  # a word may not run over the end of its text
    edge[offs] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(start, offs)


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64 finalizer on uint64."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def _hash_tables():
    rng = np.random.Generator(np.random.PCG64(20240601))
    letters = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    base = 0x9E3779B97F4A7C15
    return letters, np.uint64(base), np.uint64(pow(base, -1, 1 << 64))


def _powers(n: int):
    letters, base, inverse = worker_cache("hash tables", _hash_tables)
    size = max(SEGMENT_BYTES * 2, n)

    def build():
        up = np.full(size, base, np.uint64)
        up[0] = 1
        down = np.full(size, inverse, np.uint64)
        down[0] = 1
        return np.cumprod(up), np.cumprod(down)

    if size > SEGMENT_BYTES * 2:  # one word longer than a segment
        return letters, *build()
    return letters, *worker_cache("hash powers", build)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every word's bytes: a polynomial over random letter values, then mixed."""
    out = np.empty(len(start), np.uint64)
    a = 0
    while a < len(start):
        b = max(a + 1, int(np.searchsorted(end, start[a] + SEGMENT_BYTES, "right")))
        lo, hi = int(start[a]), int(end[b - 1])
        letters, up, down = _powers(hi - lo + 1)
        c = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(letters[data[lo:hi]] * up[:hi - lo], out=c[1:])
        s, e = start[a:b] - lo, end[a:b] - lo
        out[a:b] = (c[e] - c[s]) * down[s] + (e - s).astype(np.uint64)
        a = b
    return mix(out)


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z lower-cased."""
    return np.frombuffer(LOWER, np.uint8)[data]


_STEPS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def windows(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word of every ``width``-word window inside a text, windows per text)."""
    per = np.maximum(np.diff(first) - (width - 1), 0)
    shift = first[:-1] - (np.cumsum(per) - per)
    return np.arange(int(per.sum())) + np.repeat(shift, per), per


def window_hashes(words: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of the ``width`` word hashes from each index in ``at``."""
    h = np.full(len(at), np.uint64(width), np.uint64)
    for j in range(width):
        h += words[at + j] * np.uint64(_STEPS[j % 5] + 2 * (j // 5))
    return mix(h)


def with_columns(docs: DataFrame, column: str, compute, ddl: str) -> DataFrame:
    """Every row of ``docs`` as a struct column ``row`` beside the columns of
    ``ddl`` that ``compute(Arrow column)`` returns by name.  Rows stay in their
    task: nothing is shuffled, and names in ``docs`` cannot clash."""
    names, at = docs.columns, docs.columns.index(column)

    def run(batches):
        for b in batches:
            new = compute(b.column(at))
            row = pa.StructArray.from_arrays(b.columns, names)
            yield pa.RecordBatch.from_arrays([row, *(pa.array(v) for v in new.values())], ["row", *new])

    return docs.mapInArrow(tidy(run), f"row {docs.schema.simpleString()}, {ddl}")
