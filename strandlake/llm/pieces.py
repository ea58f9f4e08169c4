"""Byte-level BPE of whole texts through a cache of space-led pieces.

A space between two characters that are not white space always starts a new
pre-token of a byte-level BPE, and merges never cross pre-tokens.  So a text
may be cut before each such space and its pieces encoded one by one: the ids
are those of the whole text.  Pieces repeat, hence each is encoded once by the
``tokenizers`` library and then gathered from a table by numpy.  Added tokens
(as ``<|endoftext|>``) in a text are found by the library as in the whole text:
they hold no white space, so no cut goes through one, and it is checked that
none of them swallows the white space beside it.

Pieces are found and looked up in the batch's own bytes, without a Python
string for each.  One of up to 16 bytes is known exactly by its first eight
bytes, its last eight and its length; longer ones go through a dictionary.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from . import rolling
from .common import CACHES

#: Bytes of pieces that the library gets at once.
GROUP_BYTES = 1 << 13
_SHORT, _PAD = 16, 16
_U = np.uint64
# White space of one byte (a few control characters more than the tokenizer's do no harm).
_WS = np.zeros(256, bool)
_WS[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
#: White space beyond ASCII, as UTF-8 in a number.
_WIDE = np.array([int.from_bytes(chr(c).encode(), "big") for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)], np.int64)


def load_tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _blank(data: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
    """Whether the character that begins (step 1) or ends (step -1) at a byte is white space."""
    b = data[at]
    out = _WS[b]
    wide = np.flatnonzero(b >= 128)
    if len(wide):
        p, q = at[wide], b[wide].astype(np.int64)
        x, y = data[p + step].astype(np.int64), data[p + 2 * step].astype(np.int64)
        two, three = ((q << 8 | x), (q << 16 | x << 8 | y)) if step > 0 else ((x << 8 | q), (y << 16 | x << 8 | q))
        out[wide] = np.isin(two, _WIDE) | np.isin(three, _WIDE)
    return out


def _gathered(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The stretches [start, end) one after another."""
    n = end - start
    return data[np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


class _Table:
    """Rows of short pieces by (first eight bytes, last eight, tag); open addressing, compared exactly."""

    def __init__(self, bits: int = 16) -> None:
        self.bits, self.used = bits, 0
        self.rec = np.zeros((1 << bits, 4), np.uint64)  # a tag of zero marks a free slot

    def _slot(self, key: np.ndarray) -> np.ndarray:
        h = rolling.mixed((key[0] * _U(rolling.BASE)) ^ (key[1] + key[2]) * _U(rolling.MIX))
        return (rolling.mixed(h) >> _U(64 - self.bits)).astype(np.int64)

    def find(self, key: np.ndarray) -> np.ndarray:
        """Rows of the keys (3 x n), -1 for those that are not there."""
        out, open_, slot = np.full(key.shape[1], -1, np.int64), None, self._slot(key)
        while len(slot):
            rec = self.rec[slot]
            same = (rec[:, 0] == key[0]) & (rec[:, 1] == key[1]) & (rec[:, 2] == key[2])
            hit = np.flatnonzero(same)
            out[hit if open_ is None else open_[hit]] = rec[hit, 3]
            go = np.flatnonzero(~same & (rec[:, 2] != 0))
            open_, key, slot = go if open_ is None else open_[go], key[:, go], (slot[go] + 1) & ((1 << self.bits) - 1)
        return out

    def add(self, key: np.ndarray, rows: np.ndarray) -> None:
        """Enter keys that are not there, each once."""
        self.used += len(rows)
        if 2 * self.used > len(self.rec):
            old = self.rec[self.rec[:, 2] != 0]
            self.bits = max(self.bits + 1, int(4 * self.used).bit_length() - 1)
            self.rec = np.zeros((1 << self.bits, 4), np.uint64)
            self._put(np.ascontiguousarray(old[:, :3].T), old[:, 3])
        self._put(key, rows.astype(np.uint64))

    def _put(self, key: np.ndarray, rows: np.ndarray) -> None:
        slot = self._slot(key)
        while len(slot):
            free = np.flatnonzero(self.rec[slot, 2] == 0)
            _, first = np.unique(slot[free], return_index=True)
            take = free[first]
            self.rec[slot[take], :3], self.rec[slot[take], 3] = key[:, take].T, rows[take]
            go = np.ones(len(slot), bool)
            go[take] = False
            key, rows, slot = key[:, go], rows[go], (slot[go] + 1) & ((1 << self.bits) - 1)


class PieceEncoder:
    """Encodes batches of texts.  The cache holds ``limit`` pieces at most, besides those of the batch at hand."""

    def __init__(self, path: str, limit: int = 1_000_000) -> None:
        self.tok = load_tokenizer(path)
        self.vocab = self.tok.get_vocab_size()
        self.n_bytes = np.zeros(self.vocab, np.int64)  # a byte-level token has a character for each byte
        for token, i in self.tok.get_vocab().items():
            self.n_bytes[i] = len(token)
        for i, added in self.tok.get_added_tokens_decoder().items():
            if added.lstrip or added.rstrip or any(map(str.isspace, added.content)):
                raise ValueError("an added token that takes white space in can't be found piece by piece")
            self.n_bytes[i] = len(added.content.encode())
        self.limit = limit
        self._clear()

    def _clear(self) -> None:
        self.short, self.long, self.n = _Table(), {}, 0
        self.flat, self.used = np.empty(1 << 16, np.uint32), 0
        self.first, self.count = np.empty(1 << 14, np.int32), np.empty(1 << 14, np.int32)

    def _ids(self, text: bytes) -> np.ndarray:
        return np.array(self.tok.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids, np.uint32)

    def _learn(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Encode new pieces; their rows follow one another."""
        rows = np.arange(self.n, self.n + len(start))
        self.n += len(start)
        if self.n > len(self.first):
            grow = max(self.n, 2 * len(self.first)) - len(self.first)
            self.first = np.concatenate([self.first, np.empty(grow, np.int32)])
            self.count = np.concatenate([self.count, np.empty(grow, np.int32)])
        # Pieces that start with a space and a character and end with one stay apart when put one after another.
        plain = (data[start] == 32) & ~_blank(data, end - 1, -1) & ~_blank(data, start + 1, 1) & (end > start)
        which = np.flatnonzero(plain)
        ends = np.cumsum(end[which] - start[which])
        for group in np.split(which, np.flatnonzero(np.diff(ends // GROUP_BYTES)) + 1):
            if len(group):
                ids = self._ids(_gathered(data, start[group], end[group]).tobytes())
                last = np.searchsorted(np.cumsum(self.n_bytes[ids]), np.cumsum(end[group] - start[group])) + 1
                self._store(rows[group], ids, np.diff(last, prepend=0))
        for i in np.flatnonzero(~plain):
            ids = self._ids(data[start[i] : end[i]].tobytes())
            self._store(rows[i : i + 1], ids, np.array([len(ids)]))
        return rows

    def _store(self, rows: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(max(len(ids), len(self.flat)), np.uint32)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.first[rows] = self.used + np.cumsum(n) - n
        self.count[rows] = n
        self.used += len(ids)

    def _rows(self, texts: pa.Array | list) -> tuple[np.ndarray, np.ndarray]:
        """Cache rows of all pieces, and the first piece of each text (every text has one)."""
        if self.n > self.limit:
            self._clear()
        if isinstance(texts, list):
            texts = pa.array(texts, pa.large_string())
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        base, size = int(offsets[0]), int(offsets[-1] - offsets[0])
        data = np.zeros((size + 2 * _PAD + 7) // 8 * 8, np.uint8)
        if size:
            data[_PAD : _PAD + size] = np.frombuffer(texts.buffers()[2], np.uint8, size, base)
        begin = offsets - base + _PAD  # text i is [begin[i], begin[i + 1])
        at = np.flatnonzero(data == 32)
        at = at[~_blank(data, at - 1, -1) & ~_blank(data, at + 1, 1)]
        of = np.searchsorted(begin, at, side="right") - 1
        inside = (at > begin[of]) & (at + 1 < begin[of + 1])
        at, of = at[inside], of[inside]
        n_pieces = np.bincount(of, minlength=len(texts)) + 1
        starts = np.cumsum(n_pieces) - n_pieces
        start = np.empty(len(at) + len(texts), np.int64)
        heads = np.zeros(len(start), bool)
        heads[starts] = True
        start[heads], start[~heads] = begin[:-1], at
        end = np.append(start[1:], begin[-1])
        end[starts[1:] - 1] = begin[1:-1]
        rows = np.empty(len(start), np.int64)
        led = ~heads
        word = start + led
        size = end - word
        short = np.flatnonzero(size <= _SHORT)
        words = data.view(np.uint64)
        key = np.empty((3, len(short)), np.uint64)
        key[0], key[1] = rolling.ends(words, word[short], end[short])
        key[2] = 2 * size[short] + led[short] + 1
        found = self.short.find(key)
        new = np.flatnonzero(found < 0)
        if len(new):
            order = new[np.lexsort((key[2][new], key[1][new], key[0][new]))]
            k = key[:, order]
            fresh = np.ones(len(order), bool)
            fresh[1:] = (k[:, 1:] != k[:, :-1]).any(axis=0)
            one = order[fresh]
            learned = self._learn(data, start[short][one], end[short][one])
            self.short.add(key[:, one], learned)
            found[order] = learned[np.cumsum(fresh) - 1]
        rows[short] = found
        long = np.flatnonzero(size > _SHORT)
        if len(long):
            raw = data.tobytes()
            names = [raw[a:b] for a, b in zip(start[long].tolist(), end[long].tolist())]
            fresh = list({k: i for k, i in zip(reversed(names), reversed(long.tolist())) if k not in self.long}.items())
            if fresh:
                i = np.array([i for _, i in fresh])
                self.long.update(zip((k for k, _ in fresh), self._learn(data, start[i], end[i]).tolist()))
            rows[long] = [self.long[k] for k in names]
        return rows, starts

    def counts(self, texts: pa.Array | list) -> np.ndarray:
        """Number of ids of each text."""
        if not len(texts):
            return np.zeros(0, np.int64)
        rows, starts = self._rows(texts)
        return np.add.reduceat(self.count[rows], starts, dtype=np.int64)

    def encode(self, texts: pa.Array | list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the number of each text's.  Null counts as empty."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        rows, starts = self._rows(texts)
        n = self.count[rows]
        ends = np.cumsum(n, dtype=np.int64)
        at = np.repeat(self.first[rows] - (ends - n), n)
        at += np.arange(len(at))
        return self.flat[at], np.add.reduceat(n, starts, dtype=np.int64)


_ENCODERS: dict[str, PieceEncoder] = {}
CACHES.append(_ENCODERS)


def encoder(path: str) -> PieceEncoder:
    """One encoder for each Python worker; its cache outlives a task, but not one of another kind."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
