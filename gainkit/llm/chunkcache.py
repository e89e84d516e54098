"""Encode whole texts through a bounded cache of their chunks.

The byte-level pattern begins a new piece, whatever stands around, at these
places, so a text may be cut there and the ids of the chunks laid end to end:

* before a space that a non-space follows;
* between an ASCII letter and an ASCII byte that is none, and so for digits;
* after one ASCII white space other than a space, between two ASCII bytes that
  are no white space (of a longer run the last character would part).

Chunks repeat a great deal; each distinct one is given to the tokenizer once
while the cache holds it. Cutting, looking up and laying out are array work
over a slice of documents. The cut is left out before bytes that may start
white space outside ASCII, which makes such chunks longer but never wrong.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd

from gainkit.llm.bytesops import U, owner, prefix_hash, span_hash

#: bytes that are white space or may start a character that is
SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
LONG = 256
_LETTER, _DIGIT, _OTHER, _BREAK, _SPACE, _WIDE = range(6)
_KIND = np.full(256, _WIDE, np.uint8)
_KIND[:128] = _OTHER
_KIND[9:14] = _BREAK
_KIND[[0x20, 0x1C, 0x1D, 0x1E, 0x1F]] = _SPACE
_KIND[48:58] = _DIGIT
_KIND[65:91] = _KIND[97:123] = _LETTER


def found(data: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Where ``word`` begins in ``data``."""
    at = np.flatnonzero(data[:max(0, len(data) - len(word) + 1)] == word[0])
    for k in range(1, len(word)):
        at = at[data[at + k] == word[k]]
    return at


def cuts(data: np.ndarray, offsets: np.ndarray, uncut: list[np.ndarray] = ()) -> np.ndarray:
    """Where chunks begin, and the end of the last one."""
    cut = np.zeros(len(data) + 1, bool)
    cut[:-2] = (data[:-1] == 0x20) & ~SPACES[data[1:]]
    cut[offsets[1:] - 1] = False  # what follows the last byte is another document's
    kind = _KIND[data]
    cut[1:-1] |= (kind[:-1] <= _DIGIT) & (kind[1:] != kind[:-1]) & (kind[1:] != _WIDE)
    cut[2:-1] |= (kind[1:-1] == _BREAK) & (kind[:-2] <= _OTHER) & (kind[2:] <= _OTHER)
    for word in uncut:
        at = found(data, word)
        for k in {-1, *range(1, len(word))}:
            cut[np.maximum(at + k, 0)] = False
    cut[offsets] = True
    return np.flatnonzero(cut)


def spans(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The given spans of ``data``, end to end."""
    at = np.cumsum(lens) - lens
    return data[np.arange(int(lens.sum())) + np.repeat(starts - at, lens)]


class Places:
    """From 64-bit hashes to places, whole arrays at a time (linear probing)."""

    def __init__(self, bits: int = 17):
        self.n, self.mask = 0, U((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, U)
        self.places = np.full(1 << bits, -1, np.int32)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 for one that is not held."""
        slot = (keys & self.mask).astype(np.int64)
        out = self.places[slot]
        open_ = np.flatnonzero((out >= 0) & (self.keys[slot] != keys))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & int(self.mask)
            s = slot[open_]
            out[open_] = self.places[s]
            open_ = open_[(out[open_] >= 0) & (self.keys[s] != keys[open_])]
        return out

    def put(self, keys: np.ndarray, places: np.ndarray) -> None:
        """Adds distinct keys that are not held."""
        if 2 * (self.n + len(keys)) > len(self.keys):
            held = np.flatnonzero(self.places >= 0)
            old = self.keys[held], self.places[held]
            self.__init__((2 * (self.n + len(keys))).bit_length())
            self.put(*old)
        self.n += len(keys)
        slot = (keys & self.mask).astype(np.int64)
        while len(keys):
            free = self.places[slot] < 0
            self.places[slot[free]] = places[free]
            left = self.places[slot] != places  # taken before, or by another of these keys
            self.keys[slot[~left]] = keys[~left]
            keys, places, slot = keys[left], places[left], (slot[left] + 1) & int(self.mask)


class ChunkCache:
    """``encode`` takes (data, starts, ends) of distinct chunks and returns their
    ids end to end and the number of ids of each. At most ``limit`` chunks are
    held (then it starts anew); chunks of more than 256 bytes are encoded on
    the spot and never held. Texts are not cut in the strings ``uncut`` nor
    before a space that stands before one, as the tokenizer takes them out of
    a text first."""

    def __init__(self, encode: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], limit: int = 1_000_000,
                 uncut: list[bytes] = ()):
        self.encode, self.limit = encode, limit
        self.uncut = [np.frombuffer(x, np.uint8) for x in uncut if x]
        self._reset()

    def _reset(self):
        self.index = Places()
        self.starts = np.zeros(1 << 16, np.int64)
        self.lens = np.zeros(1 << 16, np.int32)
        self.flat = np.zeros(1 << 18, np.int32)
        self.n = self.used = 0

    def _add(self, ids: np.ndarray, lens: np.ndarray) -> np.ndarray:
        while self.n + len(lens) > len(self.starts):
            self.starts, self.lens = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lens, 2 * len(self.lens))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        at = np.arange(self.n, self.n + len(lens))
        self.starts[at] = self.used + np.cumsum(lens) - lens
        self.lens[at] = lens
        self.flat[self.used:self.used + len(ids)] = ids
        self.n += len(lens)
        self.used += len(ids)
        return at

    def encode_slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the slice end to end, number of ids of each document)."""
        n_docs = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(n_docs, np.int64)
        if self.n > self.limit:
            self._reset()
        edges = cuts(data, offsets, self.uncut)
        starts, ends = edges[:-1], edges[1:]
        inverse, uniq = pd.factorize(span_hash(data, prefix_hash(data), starts, ends))
        place = self.index.get(uniq).astype(np.int64)
        miss = np.flatnonzero(place < 0)
        if len(miss):
            first = np.empty(len(uniq), np.int64)
            first[inverse[::-1]] = np.arange(len(inverse) - 1, -1, -1)
            # the long ones last, so that they can be forgotten
            far = (ends - starts)[first[miss]] > LONG
            miss = np.concatenate((miss[~far], miss[far]))
            place[miss] = self._add(*self.encode(data, starts[first[miss]], ends[first[miss]]))
            held = miss[:len(miss) - int(far.sum())]
            self.index.put(uniq[held], place[held])
        out = self._lay(place[inverse], starts, offsets, n_docs)
        if len(miss) and len(held) < len(miss):
            self.n -= len(miss) - len(held)
            self.used = int(self.starts[self.n])
        return out

    def _lay(self, place, starts, offsets, n_docs):
        lens = self.lens[place].astype(np.int64)
        counts = np.bincount(owner(starts, offsets), weights=lens, minlength=n_docs).astype(np.int64)
        return spans(self.flat, self.starts[place], lens), counts
