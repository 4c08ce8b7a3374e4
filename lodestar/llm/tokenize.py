"""Token ids of whole texts with the public word-level BPE vocabulary.

The vocabulary's normaliser and splitter never join anything across white
space, so the ids of a text are the ids of its white-space chunks one after the
other; each distinct chunk is tokenised once per worker and looked up after.
"""

from __future__ import annotations

import os
import struct

from . import kernel as K

_GENERATION = 150_000  # chunks kept: at most two generations per worker
# ASCII punctuation but the apostrophe: a run of it after letters is a token group of its own
_END = bytes(b for b in range(33, 127) if not chr(b).isalnum() and b != 39)


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Chunks:
    """``ids(text)``: the token ids of a text, as little-endian 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        self.whole = tokenizers.Tokenizer.from_file(path)
        self.model = self.whole.model
        self.letters = _byte_letters()
        self.special = [t.content.encode().lower() for t in self.whole.get_added_tokens_decoder().values()]
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def ids(self, text: bytes) -> bytes:
        low = text.translate(K.LOWER)
        if any(s in low for s in self.special):
            return _packed(self.whole.encode(text.decode(), add_special_tokens=False).ids)
        try:
            return b"".join([self.young[w] for w in low.split()])
        except KeyError:
            return b"".join([self.chunk(w) for w in low.split()])

    def chunk(self, w: bytes) -> bytes:
        got = self.young.get(w)
        if got is None:
            got = self.old.get(w)
            if got is None:
                got = self._tokenize(w)
            if len(self.young) >= _GENERATION:
                self.old, self.young = self.young, {}
            self.young[w] = got
        return got

    def _tokenize(self, w: bytes) -> bytes:
        stem = w.rstrip(_END)
        if len(stem) < len(w) and stem:
            if self._plain(stem):
                return self.chunk(stem) + self.chunk(w[len(stem):])
        elif self._plain(w):
            shown = w.decode() if w.isascii() else "".join([self.letters[b] for b in w.decode().lower().encode()])
            return _packed([t.id for t in self.model.tokenize(shown)])
        return _packed(self.whole.encode(w.decode(), add_special_tokens=False).ids)

    @staticmethod
    def _plain(w: bytes) -> bool:
        """Only letters that the normaliser leaves alone but for their case."""
        if w.isascii():
            return w.isalpha()
        s = w.decode()
        return s.isalpha() and all(c < "\x80" or "\xc0" <= c <= "\xff" for c in s)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def chunks(path: str) -> Chunks:
    """The worker's tokenizer for a vocabulary file."""
    return K.worker_cache(("chunks", path), lambda: Chunks(path))
