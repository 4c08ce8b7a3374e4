"""Fill-in-the-middle by in-place block rotation.

A text is cut into units (white space with the word after it; trailing white
space is a unit of its own).  Two cuts drawn from a hash of the id divide it
into prefix, middle and suffix.  The text's bytes lie in one bytearray; the
sentinels are inserted at the cuts in natural order,

    <P>prefix<M>middle<S>suffix

and one rotation exchanges two neighbouring blocks: ``psm`` exchanges the
middle's and the suffix's block, ``spm`` the suffix's block with all before it.
A rotation is three reversals, each done in place with a buffer of bounded
size.  ``restore`` finds the sentinels, turns the same rotation back and takes
the sentinels out, so it needs the output and its form only.  No text that
holds a sentinel is transformed; hence every sentinel stands once.

Rows stay in their task, nothing is shuffled.  Memory per task: a slice of
texts (``kernel.SLICE_BYTES``) or the longest single text.

Defined cases: a null or empty text is ``plain`` with an empty output and no
units; a text of white space only is one unit; a null id hashes like an empty
one; repeated rows are transformed alike; an empty table gives an empty
result; only ``doc_id`` and ``text`` are read, so other names cannot clash.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernel as K

# fixed values: the sentinels of the formats
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3  # bytes of a sentinel
BLOCK = 1 << 16  # bytes exchanged at once by a reversal


@dataclass(frozen=True)
class Draw:
    """``rate`` of 100 documents are transformed, ``spm`` of 100 of those suffix first."""

    seed: int = 42
    rate: int = 50
    spm: int = 80

    def numbers(self, doc_id: str) -> tuple[int, int, int, int]:
        """Four numbers of 32 bits for an id."""
        digest = hashlib.sha256(f"{self.seed}:{doc_id}".encode()).digest()
        return tuple(int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12))


def reverse(view: np.ndarray, a: int, b: int) -> None:
    """Reverse ``view[a:b]`` in place, a block from either end at a time."""
    while b - a > 1:
        w = min(BLOCK, (b - a) // 2)
        left = view[a:a + w][::-1].copy()
        view[a:a + w] = view[b - w:b][::-1]
        view[b - w:b] = left
        a, b = a + w, b - w


def rotate(view: np.ndarray, a: int, m: int, b: int) -> None:
    """Exchange the blocks ``view[a:m]`` and ``view[m:b]`` in place."""
    reverse(view, a, m)
    reverse(view, m, b)
    reverse(view, a, b)


def fill_in(text: bytes, low: int, high: int, form: str) -> bytearray:
    """The text with its middle ``text[low:high]`` last, in the order of ``form``."""
    buf = bytearray(text)
    buf[high:high] = SUFFIX
    buf[low:low] = MIDDLE
    buf[0:0] = PREFIX
    suffix = high + 2 * MARK
    with memoryview(buf) as held:
        rotate(np.frombuffer(held, np.uint8), low + MARK if form == "psm" else 0, suffix, len(buf))
    return buf


def take_back(output: bytes, form: str) -> bytes:
    """The text that ``fill_in`` made ``output`` from."""
    if form == "plain":
        return output
    buf = bytearray(output)
    first = buf.index(SUFFIX)
    second = buf.index(MIDDLE if form == "psm" else PREFIX, first)
    with memoryview(buf) as held:
        rotate(np.frombuffer(held, np.uint8), first, second, len(buf))
    suffix = first + len(buf) - second  # where the exchanged block now starts
    del buf[suffix:suffix + MARK]
    middle = buf.index(MIDDLE)
    del buf[middle:middle + MARK]
    del buf[:MARK]
    return bytes(buf)


def _texts(parts: list) -> pa.Array:
    return pa.array([bytes(p) for p in parts], pa.binary()).cast(pa.string())


def transform(docs: DataFrame, draw: Draw = Draw()) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row of ``docs``."""
    def rows(ids, offs, data):
        _, end, first = K.word_bounds(data, offs)
        for i, doc_id in enumerate(ids):
            lo, hi = int(offs[i]), int(offs[i + 1])
            words, text = int(first[i + 1] - first[i]), data[lo:hi].tobytes()
            n = words + (hi > lo and not K.WORD_BYTES[data[hi - 1]])
            h1, h2, h3, h4 = draw.numbers(doc_id)
            if not text or h3 % 100 >= draw.rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
                yield n, "plain", None, None, text
                continue
            units = sorted((h1 % (n + 1), h2 % (n + 1)))
            low, high = (0 if not u else int(end[first[i] + u - 1]) - lo if u <= words else hi - lo for u in units)
            form = "spm" if h4 % 100 < draw.spm else "psm"
            chars = [int(np.count_nonzero((data[lo + a:lo + z] & 0xC0) != 0x80)) for a, z in ((0, low), (low, high))]
            yield n, form, *chars, fill_in(text, low, high, form)

    def run(batches):
        for b in batches:
            ids = b.column(0).cast(pa.string()).fill_null("")
            for a, z, offs, data in K.text_slices(b.column(1)):
                n, form, before, middle, output = zip(*rows(ids.slice(a, z - a).to_pylist(), offs, data), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(a, z - a), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                     pa.array(before, pa.int64()), pa.array(middle, pa.int64()), _texts(output)],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, form string, prefix_chars long, "
             "middle_chars long, output string")


def restore(transformed: DataFrame) -> DataFrame:
    """``transformed`` (any table with columns ``form`` and ``output``) with the exact text as column ``restored``."""
    names = transformed.columns
    at, form = names.index("output"), names.index("form")

    def run(batches):
        for b in batches:
            forms = b.column(form).to_pylist()
            for a, z, offs, data in K.text_slices(b.column(at)):
                texts = [take_back(data[x:y].tobytes(), f)
                         for x, y, f in zip(offs[:-1], offs[1:], forms[a:z], strict=True)]
                yield pa.RecordBatch.from_arrays([*b.slice(a, z - a).columns, _texts(texts)], [*names, "restored"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in transformed.schema.fields)
    return transformed.mapInArrow(run, f"{ddl}, restored string")
