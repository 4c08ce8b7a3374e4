"""Secret scan by zstandard novelty against primed dictionaries.

Base spans are found by patterns (assignments to a sensitive name, access
keys, long hexadecimal strings).  The method adds what no pattern names: a
*candidate* is a string of key characters with digits and letters, shortly
after a sensitive word of its line.  How new it is, is measured: a zstandard
compressor is primed with a dictionary of the corpus's most widespread
identifiers, and the surrounding code is compressed once without and once with
the candidate.  The difference, its marginal compressed bytes, is small for a
name made of known parts and about three quarters of its length for a random
string; from ``Scan.novelty`` on the candidate is reported.  Base spans are
measured alike and always reported.

The identifier dictionary counts every document: distinct identifiers per
text, summed per task and then by Spark, most widespread first until
``Scan.dictionary`` bytes (a fixed bound, so it may travel with the tasks).
Identifiers hold no digits, so a repeated key does not become part of it.

Offsets are code points, the end is exclusive.  Rows stay in their task; only
identifier counts are shuffled.  Memory per task: a slice of texts
(``kernel.SLICE_BYTES``) or the longest single text, and ``HELD`` counts.

Defined cases: a null or empty text has no spans; repeated rows get the same
spans each; an empty table gives an empty dictionary and an empty result; only
``doc_id`` and ``text`` are read, so other names cannot clash.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import checkpointed
from . import kernel as K

# fixed values: the base patterns; matches whose value is shorter than stated are dropped
ASSIGN = re.compile(
    rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_LEAST = 6
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX_LEAST = 24
KINDS = ("assign", "access", "hex", "novel")  # order of spans that start together

SENSITIVE = re.compile(
    rb"(?i)pass(?:word|wd|phrase|code)|pwd|secret|token|credential|bearer|signature|auth(?!or)|(?:private|api|access|account)[ _-]?key")
STEMS = (b"pass", b"pwd", b"secret", b"token", b"credential", b"bearer", b"signature", b"auth", b"key")  # one lies in every sensitive word
CANDIDATE = re.compile(rb"[A-Za-z0-9+/_=.-]+")

_HEX = K.byte_flags(b"0123456789abcdef")
_NAME = K.byte_flags(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz_0123456789")
_DIGIT = K.byte_flags(b"0123456789")
HELD = 100_000  # identifier counts a task holds before it hands them on


@dataclass(frozen=True)
class Scan:
    """``reach``: bytes after a sensitive word in which a candidate starts; ``least``: its
    length; ``around``: bytes of surrounding code on either side; ``novelty``: least marginal
    compressed bytes per byte; ``dictionary``: bytes of identifiers; ``level``: of compression."""

    reach: int = 64
    least: int = 16
    around: int = 256
    novelty: float = 0.6
    dictionary: int = 1 << 15
    level: int = 9
    name_least: int = 4
    name_most: int = 24


def identifiers(docs: DataFrame, scan: Scan = Scan()) -> bytes:
    """The most widespread identifiers of all texts, rarest first, joined by spaces."""
    def run(batches):
        counts: dict[bytes, int] = {}

        def handed_on():
            names, n = list(counts), list(counts.values())
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())], ["name", "n"])

        for b in batches:
            for _, _, offs, data in K.text_slices(b.column(0)):
                start, end, first = K.word_bounds(data, offs, _NAME)
                size = end - start
                fit = (size >= scan.name_least) & (size <= scan.name_most) & (K.count_in(
                    _DIGIT[data], np.column_stack([start, end]).ravel())[::2] == 0 if len(start) else size > 0)
                text = np.repeat(np.arange(len(first) - 1), np.diff(first))[fit]
                start, end = start[fit], end[fit]
                h = K.word_hashes(data, start, end)
                _, one = np.unique(h ^ K.mix(text.astype(np.uint64)), return_index=True)  # once per text
                _, at, n = np.unique(h[one], return_index=True, return_counts=True)
                raw = data.tobytes()
                for i, k in zip(one[at], n, strict=True):
                    name = raw[start[i]:end[i]]
                    counts[name] = counts.get(name, 0) + int(k)
                if len(counts) >= HELD:
                    yield handed_on()
        yield handed_on()

    counts = checkpointed(docs.select("text").mapInArrow(run, "name string, n long").groupBy("name").agg(F.sum("n").alias("n")))
    wanted = scan.dictionary // (scan.name_least + 1)
    # names by the power of two of their count (at most 64 rows), so that tasks send on few more than are wanted
    powers = counts.groupBy(F.floor(F.log2("n")).alias("power")).agg(F.count(F.lit(1)).alias("names")).collect()
    least, names = 0, 0
    for r in sorted(powers, reverse=True):
        least, names = r["power"], names + r["names"]
        if names >= wanted:
            break
    most = counts.where(F.floor(F.log2("n")) >= least).orderBy(F.desc("n"), "name").limit(wanted).collect()
    out, size = [], 0
    for r in most:
        size += len(r["name"]) + 1
        if size > scan.dictionary:
            break
        out.append(r["name"].encode())
    return b" ".join(reversed(out))


class Novelty:
    """Marginal compressed bytes per byte of a part of a text, given what surrounds it."""

    def __init__(self, names: bytes, scan: Scan):
        self.scan = scan
        primed = zstandard.ZstdCompressionDict(names, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(names) >= 8 else None
        if primed:
            primed.precompute_compress(level=scan.level)
        self.packer = zstandard.ZstdCompressor(level=scan.level, dict_data=primed, write_checksum=False, write_content_size=False)

    def __call__(self, text: bytes, start: int, end: int) -> float:
        part = text[start:end]
        near = text[max(0, start - self.scan.around):start] + text[end:end + self.scan.around]
        near = near.replace(part, b"")  # a string said twice is as new as one said once
        with_it = len(self.packer.compress(near + part))
        return (with_it - len(self.packer.compress(near))) / (end - start)


def candidates(text: bytes, scan: Scan):
    """(start, end) of key-like strings that start within reach of a sensitive word of their line."""
    done = -1
    for m in SENSITIVE.finditer(text):
        line = text.find(b"\n", m.end())
        stop = min(m.end() + scan.reach, line if line >= 0 else len(text))
        at = max(m.end(), done)
        while at < stop and (c := CANDIDATE.search(text, at)) and c.start() < stop:
            at = done = c.end()
            value = c.group()
            if len(value) >= scan.least and any(48 <= x <= 57 for x in value) and value.upper() != value.lower():
                yield c.start(), c.end()


def spans_of(text: bytes, novelty: Novelty, hexes=(), sensitive: bool = True):
    """(kind, start, end, novelty) in bytes, by start and kind; ``hexes``: the spans of that kind."""
    found = [(2, s, e) for s, e in hexes]
    found += [(1, *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    if sensitive:
        found += [(0, *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    out = [(*f[1:], f[0], novelty(text, f[1], f[2])) for f in found]
    if sensitive:
        taken = sorted((s, e) for _, s, e in found)
        for s, e in candidates(text, novelty.scan):
            if not any(a < e and s < z for a, z in taken) and (new := novelty(text, s, e)) >= novelty.scan.novelty:
                out.append((s, e, 3, new))
    return [(KINDS[k], s, e, new) for s, e, k, new in sorted(out)]


def hex_spans(data: np.ndarray, offs: np.ndarray):
    """(start, end, first): the hexadecimal strings of all texts, as ``kernel.word_bounds`` gives words."""
    start, end, _ = K.word_bounds(data, offs, _HEX)
    long = end - start >= HEX_LEAST
    return start[long], end[long], np.searchsorted(start[long], offs)


def _places(data: bytes, stems) -> list[int]:
    low, out = data.translate(K.LOWER), []
    for stem in stems:
        at = low.find(stem)
        while at >= 0:
            out.append(at)
            at = low.find(stem, at + len(stem))
    return out


def scan_secrets(docs: DataFrame, names: bytes | None = None, scan: Scan = Scan()) -> DataFrame:
    """(doc_id, spans) for every row of ``docs``: kind, start, end (code points) and novelty of
    every span, by start and kind.  ``names``: the identifier dictionary (default: that of ``docs``)."""
    names = identifiers(docs, scan) if names is None else names

    def run(batches):
        novelty = Novelty(names, scan)
        for b in batches:
            for a, z, offs, data in K.text_slices(b.column(1)):
                raw = data.tobytes()
                hs, he, hf = hex_spans(data, offs)
                hit = np.zeros(z - a, bool)
                hit[np.searchsorted(offs, _places(raw, STEMS), "right") - 1] = True
                some = hit.copy()
                some[np.searchsorted(offs, _places(raw, (b"akia",)), "right") - 1] = True
                some |= np.diff(hf) > 0
                spans = [[] for _ in range(z - a)]
                for i in np.flatnonzero(some):
                    lo, hi = int(offs[i]), int(offs[i + 1])
                    hexes = [(int(s) - lo, int(e) - lo) for s, e in zip(hs[hf[i]:hf[i + 1]], he[hf[i]:hf[i + 1]], strict=True)]
                    found = spans_of(raw[lo:hi], novelty, hexes, bool(hit[i]))
                    if found:
                        chars = np.concatenate(([0], np.cumsum((data[lo:hi] & 0xC0) != 0x80)))
                        spans[i] = [{"kind": k, "start": int(chars[s]), "end": int(chars[e]), "novelty": new} for k, s, e, new in found]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, z - a), pa.array(spans, _SPANS)], ["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
             "spans array<struct<kind: string, start: long, end: long, novelty: double>>")


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("novelty", pa.float64())]))
