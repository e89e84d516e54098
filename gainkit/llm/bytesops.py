"""Vectorised byte and word work on Arrow string columns, for use inside tasks.

Everything works on the UTF-8 bytes of a slice of documents laid end to end:
``data`` (uint8) and ``offsets`` (document ``i`` is ``data[offsets[i]:offsets[i+1]]``).
A slice holds about ``SLICE_BYTES`` (or one longer document), which bounds the
memory of the 64-bit arrays made here to some 30 bytes per input byte.
Hashes of up to ``LONG`` bytes are 64-bit polynomials over a fixed random byte
table, then mixed. Longer ones, in which structured strings (Thue-Morse words)
could cancel such a polynomial, are digests of a cryptographic hash. All are
the same on every executor.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
#: spans of more bytes are hashed by a digest of their bytes
LONG = 128
U = np.uint64
_BASE = U(0x9E3779B97F4A7C15 | 1)
_BASE_INV = U(pow(int(_BASE), -1, 1 << 64))
_TABLE = np.random.Generator(np.random.PCG64(20240601)).integers(1, 2**63, 256, dtype=np.uint64) | U(1)
#: the white space of the word rule [^\x20\x09-\x0D]+
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: A-Z to a-z, every other byte as it is
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**k and BASE**-k mod 2**64 for k < n (kept between calls, grown by doubling)."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        for i, base in enumerate((_BASE, _BASE_INV)):
            step = np.full(size, base, U)
            step[0] = 1
            _powers[i] = np.cumprod(step, dtype=U)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def text_slices(column: pa.Array | pa.ChunkedArray, limit: int | None = None):
    """Yields (first row, data, offsets) over a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    n, limit = len(column), limit or SLICE_BYTES
    if not n:
        return
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H with (H[e] - H[s]) * BASE**-s the hash of data[s:e]."""
    h = np.zeros(len(data) + 1, U)
    np.cumsum(_TABLE[data] * powers(len(data))[0], out=h[1:])
    return h


def span_hash(data: np.ndarray, h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each data[start:end], where ``h`` is the prefix hash of ``data``."""
    inv = powers(len(h))[1]
    out = mix(((h[ends] - h[starts]) * inv[starts]) ^ (np.asarray(ends - starts).astype(U) * U(0xD6E8FEB86659FD93)))
    far = np.flatnonzero(ends - starts > LONG)
    if len(far):
        raw = memoryview(np.ascontiguousarray(data))
        out[far] = np.frombuffer(b"".join(hashlib.blake2b(raw[s:e], digest_size=8).digest() for s, e in zip(starts[far].tolist(), ends[far].tolist(), strict=True)), U)
    return out


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; no run crosses a document's end."""
    n = len(mask)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = mask[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = mask[1:]
    starts = np.flatnonzero(mask & (~before | cut[:-1]))
    ends = np.flatnonzero(mask & (~after | cut[1:])) + 1
    return starts, ends


def owner(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The document each start lies in."""
    return np.searchsorted(offsets, starts, side="right") - 1


def words(data: np.ndarray, offsets: np.ndarray):
    """Starts, ends, document and hash of every word [^\\x20\\x09-\\x0D]+."""
    starts, ends = runs(~SPACE[data], offsets)
    return starts, ends, owner(starts, offsets), span_hash(data, prefix_hash(data), starts, ends)


def chain(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive codes (ordered)."""
    n = max(0, len(codes) - k + 1)
    acc = codes[:n].copy()
    for j in range(1, k):
        acc = mix(acc * U(0x9FB21C651E98DF25) + codes[j:n + j])
    return mix(acc + U(k))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct k-word shingles, sorted by both. With
    fewer than k words the whole sequence is the one shingle; without words
    there is none."""
    _, _, doc, code = words(data, offsets)
    n_docs = len(offsets) - 1
    count = np.bincount(doc, minlength=n_docs)
    n = max(0, len(code) - k + 1)
    whole = doc[:n] == doc[len(doc) - n:] if n else np.zeros(0, bool)
    docs, hashes = [doc[:n][whole]], [chain(code, k)[whole]]
    first = np.concatenate(([0], np.cumsum(count)))
    for c in range(1, k):
        few = np.flatnonzero(count == c)
        if len(few):
            acc = code[first[few]]
            for j in range(1, c):
                acc = mix(acc * U(0x9FB21C651E98DF25) + code[first[few] + j])
            docs.append(few)
            hashes.append(mix(acc + U(c)))
    doc, h = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[new], h[new]


def union(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the intervals [start, end); touching ones join."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(s), bool)
    new[1:] = s[1:] > e[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(s) - 1)
    return s[new], e[last]
