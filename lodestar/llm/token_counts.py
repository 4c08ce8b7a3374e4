"""Token counts by a linear longest-match automaton.

The vocabulary's pieces form a trie over UTF-8 bytes.  Each node has a failure
link and, computed once, the number of tokens that following it completes, so
greedy longest-match lengths come from one step per byte without building any
piece.  All words of a slice advance together, byte by byte.

A word is ``[^\\x20\\x09-\\x0D]+`` with the piece vocabulary's word mark before it;
every byte is a piece of its own (byte fallback), so each word has a length.

Defined cases: a null or empty text has no words and no tokens; a null
``doc_id`` is passed through; repeated rows are counted each on its own; an
empty table gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernel as K

MARK = "▁".encode()  # stands before every word
_TOGETHER = 96  # the rest of a longer word is stepped in pieces of its own
_PIECE, _WARM, _ROUNDS = 256, 64, 8  # bytes of such a piece, bytes that lead to its first state, attempts


def read_pieces(path: str) -> list[bytes]:
    """The byte strings of a sentencepiece vocabulary: its pieces and all single bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    own = [model.id_to_piece(i).encode() for i in range(model.get_piece_size())
           if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return sorted({*own, *(bytes([b]) for b in range(256))})


class Automaton:
    """Trie, failure links and token counts of a set of byte strings that holds every single byte."""

    def __init__(self, pieces: list[bytes]):
        children: list[dict[int, int]] = [{}]
        whole = [False]
        for p in pieces:
            v = 0
            for c in p:
                if c not in children[v]:
                    children[v][c] = len(children)
                    children.append({})
                    whole.append(False)
                v = children[v][c]
            whole[v] = True
        fail, popped, end = [0] * len(children), [0] * len(children), [0] * len(children)
        level = [(0, c, v) for c, v in children[0].items()]
        while level:
            later = []
            for u, c, v in level:
                if whole[v]:
                    popped[v] = 1  # the whole string is one token; start over
                else:  # the longest token of the parent's string is complete, and so on
                    n, z = popped[u], fail[u]
                    while c not in children[z]:
                        n, z = n + popped[z], fail[z]
                    popped[v], fail[v] = n, children[z][c]
                end[v] = popped[v] + end[fail[v]]
                later += [(v, d, w) for d, w in children[v].items()]
            level = later
        self.fail, self.popped, self.end = (np.array(x, np.int32) for x in (fail, popped, end))
        inner = [v for v in range(len(children)) if children[v]]
        self.row = np.zeros(len(children), np.int32)  # row 0: no children
        self.row[inner] = np.arange(1, len(inner) + 1)
        self.next = np.full((len(inner) + 1, 256), -1, np.int32)
        for r, v in enumerate(inner, 1):
            self.next[r, list(children[v])] = list(children[v].values())

    def step(self, state: np.ndarray, count: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Next states; tokens completed on the way are added to ``count``."""
        new = self.next[self.row[state], byte]
        stuck = np.flatnonzero(new < 0)
        at = state[stuck]
        while len(stuck):
            count[stuck] += self.popped[at]
            at = self.fail[at]
            there = self.next[self.row[at], byte[stuck]]
            new[stuck] = there
            on = there < 0
            stuck, at = stuck[on], at[on]
        return new

    def lengths(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Greedy longest-match tokens of each word, the word mark included."""
        first = np.zeros(1, np.int32)
        marked = np.zeros(1, np.int64)
        for c in MARK:
            first = self.step(first, marked, np.array([c], np.uint8))
        size = end - start
        order = np.argsort(-size, kind="stable")
        size, at = size[order], start[order]
        state = np.full(len(size), first[0], np.int32)
        count = np.full(len(size), marked[0], np.int64)
        for i in range(int(min(size[0], _TOGETHER)) if len(size) else 0):
            n = int(np.searchsorted(-size, -i, "left"))  # words longer than i
            state[:n] = self.step(state[:n], count[:n], data[at[:n] + i])
        for w in np.flatnonzero(size > _TOGETHER):
            state[w], more = self._long(data[at[w] + _TOGETHER:at[w] + size[w]], int(state[w]))
            count[w] += more
        out = np.empty(len(size), np.int64)
        out[order] = count + self.end[state]
        return out


    def _long(self, data: np.ndarray, state: int) -> tuple[int, int]:
        """(state, tokens) after one long word's bytes.  Its pieces are stepped together, each from the
        state that ``_WARM`` bytes before it lead to; a piece whose predecessor ends elsewhere is stepped
        again from there.  What does not settle in ``_ROUNDS`` rounds (a repeated byte) goes byte by byte."""
        n = len(data) // _PIECE
        pieces = data[:n * _PIECE].reshape(n, _PIECE)
        start = np.zeros(n, np.int32)
        if n > 1:
            warm, none = start[1:].copy(), np.zeros(n - 1, np.int64)
            for i in range(_PIECE - _WARM, _PIECE):
                warm = self.step(warm, none, pieces[:-1, i])
            start[1:] = warm
        if n:
            start[0] = state
        end, count, sure = np.zeros(n, np.int32), np.zeros(n, np.int64), 0
        todo = np.arange(n)
        for _ in range(_ROUNDS):
            v, c = start[todo], np.zeros(len(todo), np.int64)
            for i in range(_PIECE):
                v = self.step(v, c, pieces[todo, i])
            end[todo], count[todo] = v, c
            wrong = np.flatnonzero(start[1:] != end[:-1]) + 1
            sure = int(wrong[0]) if len(wrong) else n
            start[wrong] = end[wrong - 1]
            todo = wrong
            if not len(todo):
                break
        total = int(count[:sure].sum())
        state = int(end[sure - 1]) if sure else state
        for c in data[sure * _PIECE:].tolist():
            while (z := int(self.next[self.row[state], c])) < 0:
                total, state = total + int(self.popped[state]), int(self.fail[state])
            state = z
        return state, total


def automaton(path: str) -> Automaton:
    return K.worker_cache(("automaton", path), lambda: Automaton(read_pieces(path)))


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_bytes, n_words, n_tokens, longest_word) for every row of ``docs``;
    ``longest_word``: most tokens of one word."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        machine = automaton(vocabulary)
        for b in batches:
            out: list[list] = [[], [], [], []]
            for _, _, offs, data in K.text_slices(b.column(1)):
                start, end, first = K.word_bounds(data, offs)
                n = machine.lengths(data, start, end)
                total = np.concatenate(([0], np.cumsum(n)))
                words = np.diff(first)
                most = np.zeros(len(words), np.int64)
                if len(n):
                    most[words > 0] = np.maximum.reduceat(n, first[:-1][words > 0])
                for x, v in zip(out, (np.diff(offs), words, np.diff(total[first]), most), strict=True):
                    x.append(v)
            cols = [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)) for x in out]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], ["doc_id", "n_bytes", "n_words", "n_tokens", "longest_word"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_words long, n_tokens long, longest_word long")
