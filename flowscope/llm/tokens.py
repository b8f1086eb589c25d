"""Token ids of whole texts with a public tokenizer file, batched per task.

A word-level BPE never merges across white space, nor across a border between
an ASCII letter or digit and ASCII punctuation other than an apostrophe. Texts
are cut there with numpy; every distinct unit is tokenised once by the
library and kept in a per-process cache, and the ids of a text are gathered
from the cache. The result equals tokenising the whole text.
"""

from __future__ import annotations

import numpy as np

from flowscope.llm.textnum import LOWER, NOT_SPACE, ranges, span_hashes, word_spans

U = np.uint64
END_ID = 1
CACHE_UNITS = 150_000  # the cache starts afresh beyond this many units

_LETTER = np.zeros(256, bool)
_LETTER[0x30:0x3A] = True
_LETTER[0x61:0x7B] = True
_MARK = np.zeros(256, bool)
_MARK[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'"]] = True
# UTF-8 of the precomposed Latin-1 letters: lead byte, then 0x80-0xBF but for the two signs
_PLAIN = np.zeros(256, bool)
_PLAIN[0x61:0x7B] = True


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The printable character that byte-level BPE uses for each byte."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in own}
    for i, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + i)
    return out


class WordTokenizer:
    """ids of texts; ``path`` is a ``tokenizers`` file of a word-level BPE."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.letters = {b: s for b, s in _byte_letters().items()}
        self.table = str.maketrans({chr(b): s for b, s in self.letters.items()})
        self._clear()

    def _clear(self):
        self.known = np.empty(0, np.uint64)
        self.slot = np.empty(0, np.int64)
        self.start = np.zeros(1, np.int64)
        self.ids = np.empty(0, np.uint32)

    def _unit_ids(self, units: list[bytes]) -> list[list[int]]:
        out: list = [None] * len(units)
        rest = []
        for i, u in enumerate(units):
            if u.isalpha() or (u.isascii() and not u.isalnum() and not any(c in b"'" or 48 <= c < 58 or 97 <= c < 123 for c in u)):
                out[i] = [t.id for t in self.model.tokenize(u.decode("latin-1").translate(self.table))]
            elif _latin_word(u):
                out[i] = [t.id for t in self.model.tokenize(_latin_lower(u).decode("latin-1").translate(self.table))]
            else:
                rest.append(i)
        if rest:
            encoded = self.tokenizer.encode_batch_fast([units[i].decode("utf-8", "replace") for i in rest],
                                                       add_special_tokens=False)
            for i, e in zip(rest, encoded):
                out[i] = e.ids
        return out

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows in one array, offsets of each row's ids)."""
        data = LOWER[raw]
        cut = np.zeros(len(data), bool)
        letter, mark = _LETTER[data], _MARK[data]
        cut[1:] = (letter[1:] & mark[:-1]) | (mark[1:] & letter[:-1])
        starts, ends, first = word_spans(data, offsets, NOT_SPACE, cut)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        distinct, at, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) > CACHE_UNITS:
            self._clear()
        place = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        old = place < len(self.known)
        new[old] = self.known[place[old]] != distinct[old]
        if new.any():
            text = data.tobytes()
            where = at[new]
            lists = self._unit_ids([text[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist())])
            n = len(self.start) - 1
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            self.ids = np.concatenate([self.ids, np.fromiter((i for x in lists for i in x), np.uint32, int(sizes.sum()))])
            self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(sizes)])
            self.known = np.insert(self.known, place[new], distinct[new])
            self.slot = np.insert(self.slot, place[new], np.arange(n, n + len(lists)))
            place = np.searchsorted(self.known, distinct)
        unit = self.slot[place][inverse]
        size = self.start[unit + 1] - self.start[unit]
        ids = self.ids[ranges(self.start[unit], size)]
        return ids, np.concatenate([[0], np.cumsum(size)])[first]


def _latin_word(u: bytes) -> bool:
    """Only ASCII letters and precomposed Latin-1 letters (one pre-token, unchanged by NFC)."""
    rest = u.translate(None, b"abcdefghijklmnopqrstuvwxyz")
    return (len(rest) % 2 == 0 and set(rest[::2]) == {0xC3} and all(0x80 <= c < 0xC0 and c not in (0x97, 0xB7) for c in rest[1::2])
            and u.count(b"\xc3") * 2 == len(rest))


def _latin_lower(u: bytes) -> bytes:
    return u.decode().lower().encode()


_loaded: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One tokenizer (and cache) per process and file."""
    if path not in _loaded:
        _loaded[path] = WordTokenizer(path)
    return _loaded[path]


def with_end(ids: np.ndarray, first: np.ndarray, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """The end id after each row's ids."""
    return np.insert(ids, first[1:], end_id), first + np.arange(len(first))
