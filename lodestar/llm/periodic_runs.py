"""Periodic runs of words by a dictionary of basic factors.

A run is a stretch of words with smallest period q that is at least ``times``
periods and at least ``least`` words long and that no neighbouring word
extends.  All texts of a slice are handled at once:

* level 0 names every word of every text, level k + 1 names the factors of
  2^(k+1) words by the pair of names of their halves (one sort per level);
* on each level the next occurrence of a factor, if it follows within twice
  the factor's length, proposes its distance as a period; proposals of one
  distance at consecutive places are the arithmetic progression of a run;
* the stretch a progression covers is extended word by word while the period
  holds, and what several levels found is kept once.

Nothing is missed: in a run of period q every factor of length l with
q <= l < 2q recurs at distance q and not sooner, so the level of that length
sees the whole run as one progression.  Factors that stand once in their text
cannot recur when lengthened and are not named again, which leaves few places
after the first levels.

Rows stay in their task, nothing is shuffled.  Memory per task is a slice of
texts (``kernel.SLICE_BYTES``) or the longest single text.

Defined cases: a null or empty text has no words, no runs and an empty
collapsed text; fewer than ``least`` words hold no run; repeated rows get the
same result each; an empty table gives an empty result; only ``doc_id`` and
``text`` are read, so other names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernel as K


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, follower, several): dense names of equal keys, the index of the next
    equal key (-1: none) and whether a key stands more than once."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    name = np.empty(len(keys), np.int64)
    name[order] = np.cumsum(np.concatenate(([0], ~same))) if len(keys) else 0
    follower = np.full(len(keys), -1, np.int64)
    follower[order[:-1][same]] = order[1:][same]
    several = np.zeros(len(keys), bool)
    several[order[:-1][same]] = True
    several[order[1:][same]] = True
    return name, follower, several


def _progressions(at: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first place, last place, gap) of maximal stretches of consecutive places with one gap."""
    if not len(at):
        return at, at, gap
    cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(gap) != 0)) + 1
    lo = np.concatenate(([0], cut))
    return at[lo], at[np.concatenate((cut, [len(at)])) - 1], gap[lo]


def find_runs(words: np.ndarray, first: np.ndarray, least: int = 24, times: int = 3):
    """(start, length, period) arrays, by start and period, of the runs of all texts;
    text t has the words ``first[t]`` to ``first[t + 1] - 1`` and a run stays in its text."""
    sizes = np.diff(first)
    text = np.repeat(np.arange(len(sizes)), sizes)
    stop = first[1:][text]
    long_enough = sizes[text] >= max(least, times)
    at = np.flatnonzero(long_enough)
    keys = K.mix(words[at] ^ K.mix(text[at].astype(np.uint64) + np.uint64(1)))
    names = np.full(len(words) + 1, -1, np.int64)
    found, length = [], 1
    while len(at):
        name, follower, several = _named(keys)
        names[:] = -1
        names[at[several]] = name[several]
        near = follower >= 0
        place, gap = at[near], at[follower[near]] - at[near]
        near = gap <= 2 * length
        lo, hi, period = _progressions(place[near], gap[near])
        cover = hi - lo + length + period
        good = cover >= np.maximum(least, times * period)
        found.append(np.stack([lo[good], lo[good] + cover[good], period[good]]))
        # a longer period than this level's length needs a text of ``times`` such periods
        at = at[several]
        at = at[(at + 2 * length <= stop[at]) & (times * length < sizes[text[at]])]
        at = at[names[at + length] >= 0]
        keys = names[at] * (len(words) + 1) + names[at + length]
        length *= 2
    start, end, period = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    start, end = _extended(words, first, text, start, end, period)
    runs = np.unique(np.stack([start, period, end - start], axis=1), axis=0) if len(start) else np.zeros((0, 3), np.int64)
    return runs[:, 0], runs[:, 2], runs[:, 1]


def _extended(words, first, text, start, end, period):
    """The stretches lengthened to both sides while the word a period away is the same."""
    start, end = start.copy(), end.copy()
    begin, stop = (first[text[start]], first[text[start] + 1]) if len(start) else (start, end)
    todo = np.arange(len(start))
    while len(todo):
        todo = todo[start[todo] > begin[todo]]
        todo = todo[words[start[todo] - 1] == words[start[todo] - 1 + period[todo]]]
        start[todo] -= 1
    todo = np.arange(len(start))
    while len(todo):
        todo = todo[end[todo] < stop[todo]]
        todo = todo[words[end[todo]] == words[end[todo] - period[todo]]]
        end[todo] += 1
    return start, end


def _collapsed(data: np.ndarray, offs: np.ndarray, start, end, first, kept: np.ndarray) -> pa.StringArray:
    """The kept words of every text, joined by one space."""
    step = np.zeros(len(data) + 1, np.int8)
    step[start[kept]] += 1
    step[end[kept]] -= 1
    inside = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
    # the byte after a kept word becomes its space, unless the word is the last kept one of its text
    which = np.flatnonzero(kept)
    owner = np.searchsorted(first, which, "right") - 1
    followed = which[:-1][owner[:-1] == owner[1:]]
    out = data.copy()
    out[end[followed]] = 32
    inside[end[followed]] = True
    bounds = np.concatenate(([0], np.cumsum(K.count_in(inside, offs))))
    return pa.StringArray.from_buffers(len(offs) - 1, pa.py_buffer(bounds.astype(np.int32).tobytes()),
                                       pa.py_buffer(out[inside].tobytes()))


def collapse_runs(docs: DataFrame, least: int = 24, times: int = 3) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row of ``docs``: the runs by start
    and period, and the words that no run holds after its first period, joined by one space."""
    def run(batches):
        for b in batches:
            for a, z, offs, data in K.text_slices(b.column(1)):
                start, end, first = K.word_bounds(data, offs)
                at, length, period = find_runs(K.word_hashes(data, start, end), first, least, times)
                depth = np.zeros(len(start) + 1, np.int64)
                np.add.at(depth, at + period, 1)
                np.add.at(depth, at + length, -1)
                owner = np.searchsorted(first, at, "right") - 1
                runs = pa.StructArray.from_arrays(
                    [pa.array(at - first[owner]), pa.array(length), pa.array(period)], ["start", "length", "period"])
                per_text = np.searchsorted(owner, np.arange(z - a + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(a, z - a), pa.array(np.diff(first).astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(per_text), runs),
                     _collapsed(data, offs, start, end, first, np.cumsum(depth[:-1]) == 0)],
                    ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, "
             "runs array<struct<start: long, length: long, period: long>>, collapsed string")
