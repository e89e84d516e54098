"""Operator 11: vector code compression by equal-average search.

Vectors become short codes: components are scaled to integers, a vector is cut
into ``PARTS`` equal parts, and each part is named by the nearest entry of its
position's codebook. A codebook starts as that part of the vectors with the
smallest ids and is improved by ``ROUNDS`` rounds over all vectors: assign,
then replace each entry by the floor of its parts' mean.

The nearest entry is found by equal-average search. Entries are sorted by the
sum of their components. From the place of the part's own sum the search goes
outward, nearer sums first. For d components the squared distance is at least
the squared gap of the sums over d, so a part is done as soon as that bound
strictly exceeds its best distance; equal distances go to the lower index.

Each round is one pass over the written integer vectors: a task keeps sums and
counts per (part, entry), the sums of the tasks meet in one grouped aggregate,
and only the codebooks (parts x entries x components) reach the driver and go
out to the tasks again. The table itself is never collected.

Defined results: rows whose vector is null or holds null or non-finite
components are left out; shorter vectors count as filled up with zeros to the
longest one's length, and that length to a multiple of the parts (an empty
vector is all zeros); null ids come last among the starting entries, rows of
equal ids by their components; with fewer rows than entries the codebooks are
smaller; null labels are one label; repeated rows count each; other columns
are ignored; an empty table gives an empty one. Components so large that a
squared distance would not fit 64 bits fail with a message.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gainkit.session import Scratch

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6


class Book:
    """One position's codebook, sorted by component sum for the search."""

    def __init__(self, entries: np.ndarray):
        sums = entries.sum(axis=1)
        self.index = np.argsort(sums, kind="stable")
        self.entries, self.sums = entries[self.index], sums[self.index]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each row."""
        k, (n, d) = len(self.sums), x.shape
        own = x.sum(axis=1)
        high = np.searchsorted(self.sums, own)
        low = high - 1
        best, found = np.full(n, -1, np.int64), np.full(n, k, np.int64)
        open_ = np.arange(n)
        while len(open_):
            lo, hi, s = low[open_], high[open_], own[open_]
            below = np.where(lo >= 0, s - self.sums[np.maximum(lo, 0)], np.iinfo(np.int64).max)
            above = np.where(hi < k, self.sums[np.minimum(hi, k - 1)] - s, np.iinfo(np.int64).max)
            down = below <= above
            gap, left = np.minimum(below, above), (lo >= 0) | (hi < k)
            gap = np.where(left, gap, 0)
            go = left & ((best[open_] < 0) | (gap * gap <= best[open_] * d))
            open_, down, lo, hi = open_[go], down[go], lo[go], hi[go]
            at = np.where(down, lo, hi)
            diff = x[open_] - self.entries[at]
            far, name = (diff * diff).sum(axis=1), self.index[at]
            better = (best[open_] < 0) | (far < best[open_]) | ((far == best[open_]) & (name < found[open_]))
            best[open_[better]], found[open_[better]] = far[better], name[better]
            low[open_] -= down
            high[open_] += ~down
        return found, best


def kept(vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(id, label, q): the rows that take part, components scaled and floored."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col(id_).alias("id"), F.col(label).alias("label"), v.alias("v"), F.coalesce(finite, F.lit(False)).alias("ok")) \
        .filter("ok").select("id", "label", F.transform("v", lambda x: F.floor(x * SCALE)).alias("q"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of a batch as rows of ``dim`` components, short ones filled up."""
    length = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    if (length == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(column), dim), np.int64)
    row = np.repeat(np.arange(len(column)), length)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)] = flat
    return out


def _sums(q: DataFrame, books: np.ndarray) -> DataFrame:
    """(cell, n, s): number and component sums of the parts nearest to each
    entry, a row for each task and entry in use."""
    parts, entries, d = books.shape

    def run(batches):
        search = [Book(b) for b in books]
        n, s = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, d), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), parts * d).reshape(-1, parts, d)
            for p in range(parts):
                cell = p * entries + search[p].nearest(x[:, p])[0]
                n += np.bincount(cell, minlength=parts * entries)
                np.add.at(s, cell, x[:, p])
        used = np.flatnonzero(n)
        at = np.repeat(used, d)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.tile(np.arange(d), len(used))), pa.array(n[at]), pa.array(s[used].ravel())],
                                         names=["cell", "place", "n", "s"])

    # sums of tasks fit 64 bits, those of the table need not
    return q.select("q").mapInArrow(run, "cell long, place long, n long, s long") \
        .groupBy("cell", "place").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(20,0)")).alias("s"))


def fit(q: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (part, entry, position) from the scaled rows of :func:`kept`;
    None without rows."""
    seen = q.agg(F.max(F.size("q")).alias("dim"), F.max(F.greatest(F.abs(F.array_max("q")), F.abs(F.array_min("q")))).alias("most")).first()
    if seen["dim"] is None:
        return None
    d = max(1, -(-seen["dim"] // parts))
    if d * d * (2 * int(seen["most"] or 0)) ** 2 * parts >= 2**63:
        raise ValueError(f"components up to {seen['most'] / SCALE:g} are too large for squared distances in 64 bits")
    first = q.orderBy(F.col("id").asc_nulls_last(), "q").limit(entries).select("q").toArrow().column(0).combine_chunks()
    books = _matrix(first, parts * d).reshape(-1, parts, d).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        for r in _sums(q, books).collect():     # parts x entries x positions at most
            books[r["cell"] // books.shape[1], r["cell"] % books.shape[1], r["place"]] = int(r["s"]) // r["n"]
    return books


def encode(q: DataFrame, books: np.ndarray) -> DataFrame:
    """(id, label, code, error): two hexadecimal digits for each part."""
    parts, _, d = books.shape

    def run(batches):
        search = [Book(b) for b in books]
        for batch in batches:
            x = _matrix(batch.column(2), parts * d).reshape(-1, parts, d)
            got = [search[p].nearest(x[:, p]) for p in range(parts)]
            code = [bytes(row).hex() for row in np.stack([g[0] for g in got], axis=1).astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code, pa.string()), pa.array(sum(g[1] for g in got))],
                                             names=["id", "label", "code", "error"])

    kinds = dict(q.dtypes)
    return q.select("id", "label", "q").mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, code string, error long")


def decode(code: str, books: np.ndarray) -> np.ndarray:
    """The vector that a code stands for."""
    return np.concatenate([books[p, i] for p, i in enumerate(bytes.fromhex(code))]) / SCALE


def digest(books: np.ndarray | None) -> str:
    """SHA-256 of all components in order, as decimals joined by commas."""
    return hashlib.sha256(",".join(map(str, [] if books is None else books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, scratch: Scratch) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every row kept."""
    q = scratch.cut(kept(vectors))
    books = fit(q)
    if books is None:
        books = np.zeros((PARTS, 0, 1), np.int64)
    coded = scratch.cut(encode(q, books))
    scratch.drop(q)
    by_label = scratch.cut(coded.groupBy("label").agg(F.sum("error").alias("label_error")))   # its size decides how it is joined
    return coded.alias("c").join(by_label.alias("l"), F.col("c.label").eqNullSafe(F.col("l.label"))).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
