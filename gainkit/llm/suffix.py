"""Operator 7: remove repeated byte strings by a sampled suffix array.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller id. The suffix array is sparse: of every window of
``LENGTH`` bytes only the suffix that starts at its smallest ``SEED``-byte
string (by hash, leftmost on ties) is kept. Equal windows choose the same
place, so windows of two documents are equal only if suffixes at two such
anchors agree to the right of the anchor and the bytes before them agree to
the left.

1. Texts are dealt into blocks and written by block; no later step moves a
   text to another task's partition. Texts that repeat exactly are represented
   by the smallest id: the others' places (block and row, no text) go to their
   blocks, which leave them out of steps 2 to 5 and lose them whole.
2. Each block gives the hashes of its anchors' seeds, packed by hash range;
   hashes of one block only cannot repeat.
3. Each block takes the anchors whose seed is shared by documents and writes
   their suffixes with ``SEED_SPAN`` bytes before them. Suffixes of one block
   with the same bytes all around go out once, with the smallest id; the others
   are settled on the spot. So a passage that many documents hold sends at
   most one suffix per block and context.
4. Splitters sampled from the anchors' leading bytes cut the suffixes into
   ranges. Each range sorts its suffixes by multikey quicksort over 8-byte
   characters and takes the common prefix length of neighbours. Splitters stand
   between different leading 8 bytes, fewer than a seed, so neighbours on the
   two sides of a boundary never share a window; the ranges are complete.
5. In each range suffixes that agree far enough to the right are grouped by the
   bytes before them, the smallest id of each group is found, and larger ids
   get the covered interval. Intervals of a document are united with its text.

A row is known by its block and its number there, never by its id alone: ids
(null ones above all) may repeat with different texts. Ids only decide which of
two documents is the smaller one.

Packed arrays travel between the steps, not rows per suffix. Equality to the
left is by 64-bit hash of at most 30 bytes, to the right by bytes.

Defined results: null and empty texts have nothing; a text shorter than
``LENGTH`` keeps all; matches never cross documents; of rows with equal ids
none removes from another; a null id counts as larger than all others; an
empty table gives an empty one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gainkit.llm.bytesops import U, mix, powers, prefix_hash, text_slices, union
from gainkit.session import Scratch

LENGTH = 50
SEED = 20
SPAN = LENGTH - SEED + 1       # seeds in a window
BEFORE = LENGTH - SEED         # most bytes of a window before its anchor
WIDTH = 56                     # right context, padded to whole 8-byte characters
BLOCK_BYTES = 2 << 20
ROW_BYTES = 32                 # what a row counts in a block besides its text
SAMPLE = 1 << 16
NO_ID = 2**63 - 1

_REC = np.dtype([("right", "S56"), ("left", "S32"), ("doc", "<i8"), ("row", "<i4"), ("pos", "<i4"), ("nl", "<i2"), ("nr", "<i2"), ("block", "<i8")])
#: what is covered of a block's row, and the anchor it was found at
_HIT = np.dtype([("row", "<i4"), ("start", "<i4"), ("end", "<i4"), ("pos", "<i4"), ("block", "<i8")])
#: an anchor, and the place of the same id (``twin`` in row ``other``) that shares its fate
_TWIN = np.dtype([("row", "<i4"), ("pos", "<i4"), ("other", "<i4"), ("twin", "<i4")])


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the anchors of all windows, and the hashes of their seeds."""
    n = len(data) - SEED + 1
    if n < SPAN:
        return np.zeros(0, np.int64), np.zeros(0, U)
    h = prefix_hash(data)
    code = mix((h[SEED:] - h[:-SEED]) * powers(len(h))[1][:n])
    place = U(32)
    low = (code & ~((U(1) << place) - U(1))) | (np.arange(n, dtype=U) & ((U(1) << place) - U(1)))
    step, have = 1, 1
    while have < SPAN:  # sliding minimum by doubling
        step = min(have, SPAN - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    size = np.diff(offsets)
    first = np.repeat(offsets[:-1], np.maximum(size - LENGTH + 1, 0))
    count = np.maximum(size - LENGTH + 1, 0)
    start = first + np.arange(len(first)) - np.repeat(np.cumsum(count) - count, count)
    at = (low[start] & ((U(1) << place) - U(1))).astype(np.int64)
    keep = np.ones(len(at), bool)
    keep[1:] = at[1:] != at[:-1]
    at = at[keep]
    return at, code[at]


def _contexts(data, offsets, at, doc, ids, numbers, block) -> np.ndarray:
    """Suffix records of the anchors ``at`` of documents ``doc``."""
    out = np.zeros(len(at), _REC)
    lo, hi = offsets[doc], offsets[doc + 1]
    nr, nl = np.minimum(hi - at, LENGTH), np.minimum(at - lo, BEFORE)
    padded = np.concatenate((np.zeros(32, np.uint8), data, np.zeros(WIDTH, np.uint8)))
    right = padded[(at + 32)[:, None] + np.arange(WIDTH)]
    right[np.arange(WIDTH) >= nr[:, None]] = 0
    left = padded[(at + 31)[:, None] - np.arange(32)]
    left[np.arange(32) >= nl[:, None]] = 0
    out["right"], out["left"] = right.view("S56")[:, 0], left.view("S32")[:, 0]
    out["doc"], out["row"], out["pos"], out["nl"], out["nr"], out["block"] = ids[doc], numbers[doc], at - lo, nl, nr, block
    return out


def words64(text: np.ndarray) -> np.ndarray:
    """Rows of bytes (a fixed-width string array) as big-endian 64-bit characters."""
    return np.ascontiguousarray(text).view(">u8").reshape(len(text), text.dtype.itemsize // 8).astype(U)


def multikey_quicksort(keys: np.ndarray, small: int = 512) -> np.ndarray:
    """Order of the rows of ``keys`` (64-bit characters): three-way partition
    on one character, equal rows go on with the next; short segments are
    finished by a library sort over the characters that are left."""
    n, width = keys.shape
    order = np.arange(n)
    todo = [(0, n, 0)]
    while todo:
        lo, hi, depth = todo.pop()
        if hi - lo < 2 or depth == width:
            continue
        own = order[lo:hi]
        if hi - lo <= small:
            order[lo:hi] = own[np.lexsort(keys[own, depth:].T[::-1])]
            continue
        c = keys[own, depth]
        some = np.sort(c[:: max(1, len(c) // 99)])
        pivot = some[len(some) // 2]
        less, equal = c < pivot, c == pivot
        a, b = int(less.sum()), int(equal.sum())
        order[lo:hi] = np.concatenate((own[less], own[equal], own[~less & ~equal]))
        todo += [(lo, lo + a, depth), (lo + a, lo + a + b, depth + 1), (lo + a + b, hi, depth)]
    return order


def common_prefix(right: np.ndarray, nr: np.ndarray) -> np.ndarray:
    """Bytes that each suffix shares with the one before it (0 for the first)."""
    out = np.zeros(len(right), np.int64)
    if len(right) > 1:
        b = right.view(np.uint8).reshape(len(right), right.dtype.itemsize)
        differ = b[1:] != b[:-1]
        out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), b.shape[1])
        out[1:] = np.minimum(out[1:], np.minimum(nr[1:], nr[:-1]))
    return out


def covered(rec: np.ndarray) -> np.ndarray:
    """Sorts the suffixes of one range and returns the intervals that windows
    shared with a smaller id cover (one per suffix at most)."""
    if len(rec) < 2:
        return np.zeros(0, _HIT)
    rec = rec[multikey_quicksort(words64(rec["right"]))]
    lcp = common_prefix(np.ascontiguousarray(rec["right"]), rec["nr"])
    # only runs that share a seed can match
    run = np.cumsum(lcp < SEED)
    n = np.bincount(run)
    alike = n[run] > 1
    rec, lcp = rec[alike], lcp[alike]
    if not len(rec):
        return np.zeros(0, _HIT)
    lcp[0] = 0
    left = np.ascontiguousarray(rec["left"]).view(np.uint8).reshape(len(rec), rec.dtype["left"].itemsize)
    most, least = np.full(len(rec), -1), np.full(len(rec), LENGTH)
    h = np.zeros(len(rec), U)
    for r in range(BEFORE + 1):
        if r:
            h = mix(h * U(0x9FB21C651E98DF25) + left[:, r - 1].astype(U) + U(1))
        can = np.flatnonzero((rec["nl"] >= r) & (rec["nr"] >= LENGTH - r))
        if len(can) < 2:
            continue
        group = np.cumsum(lcp < LENGTH - r)[can]
        order = np.lexsort((rec["doc"][can], h[can], group))
        at = can[order]
        g, k, d = group[order], h[at], rec["doc"][at]
        new = np.ones(len(at), bool)
        new[1:] = (g[1:] != g[:-1]) | (k[1:] != k[:-1])
        low = d[np.flatnonzero(new)][np.cumsum(new) - 1]
        hit = at[d > low]
        most[hit] = r
        least[hit] = np.minimum(least[hit], r)
    at = np.flatnonzero(most >= 0)
    out = np.zeros(len(at), _HIT)
    out["row"], out["start"], out["end"] = rec["row"][at], rec["pos"][at] - most[at], rec["pos"][at] - least[at] + LENGTH
    out["pos"], out["block"] = rec["pos"][at], rec["block"][at]
    return out


def settle(rec: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of suffixes with the same bytes on both sides one of the smallest id goes
    on. Windows of larger ids are all covered by it; further places under the
    same id (twins, in this row or another) share its fate. Returns (going on, intervals, twins)."""
    keys = np.concatenate((words64(rec["right"]), words64(rec["left"]), (rec["nl"].astype(U) * U(64) + rec["nr"].astype(U))[:, None]), axis=1)
    h = np.zeros(len(rec), U)
    for c in keys.T:
        h = mix(h * U(0x9FB21C651E98DF25) + c)
    order = np.lexsort((rec["pos"], rec["row"], rec["doc"], h))
    rec, keys = rec[order], keys[order]
    same = np.zeros(len(rec), bool)
    same[1:] = (keys[1:] == keys[:-1]).all(axis=1)
    first = np.flatnonzero(~same)[np.cumsum(~same) - 1] if len(rec) else np.zeros(0, np.int64)
    larger = rec["doc"] > rec["doc"][first]
    twin = same & ~larger
    gone, again = rec[larger], rec[twin]
    hits = np.zeros(len(gone), _HIT)
    hits["row"], hits["start"], hits["end"] = gone["row"], gone["pos"] - gone["nl"], gone["pos"] + gone["nr"]
    hits["pos"], hits["block"] = gone["pos"], gone["block"]
    twins = np.zeros(len(again), _TWIN)
    twins["row"], twins["pos"] = rec["row"][first[twin]], rec["pos"][first[twin]]
    twins["other"], twins["twin"] = again["row"], again["pos"]
    return rec[~same], hits, twins


def expand(hits: np.ndarray, twins: np.ndarray) -> np.ndarray:
    """The intervals, also those at the twins of the anchors they were found at."""
    if not len(hits) or not len(twins):
        return hits
    place = lambda x: (x["row"].astype(np.int64) << 32) + x["pos"]
    twins = twins[np.argsort(place(twins), kind="stable")]
    key, want = place(twins), place(hits)
    lo, hi = np.searchsorted(key, want), np.searchsorted(key, want, side="right")
    n = hi - lo
    if not n.sum():
        return hits
    which = np.repeat(np.arange(len(hits)), n)
    at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    more = hits[which]
    shift = twins["twin"][at] - twins["pos"][at]
    more["start"] += shift
    more["end"] += shift
    more["row"], more["pos"] = twins["other"][at], twins["twin"][at]
    return np.concatenate((hits, more))


# ---------------------------------------------------------------- Spark steps

def _blocks(docs: DataFrame) -> DataFrame:
    """(block, doc, text, row): runs of about ``BLOCK_BYTES`` as the tasks read
    them, and the number of each row in its block."""
    def run(batches):
        from pyspark import TaskContext
        part, seq, held, row = TaskContext.get().partitionId(), 0, 0, 0
        for batch in batches:
            for i, data, offsets in text_slices(batch.column(1)):
                n = len(offsets) - 1
                size = len(data) + ROW_BYTES * n
                if held and held + size > BLOCK_BYTES:
                    seq, held, row = seq + 1, 0, 0
                held += size
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, (part << 24) + seq)), batch.column(0).slice(i, n), batch.column(1).slice(i, n),
                                                  pa.array(np.arange(row, row + n, dtype=np.int32))], names=["block", "doc", "text", "row"])
                row += n

    return docs.mapInArrow(run, "block long, doc long, text string, row int")


def _range_of(h: np.ndarray, n: int) -> np.ndarray:
    """Equal ranges of the hashes: 0..n-1."""
    return ((h >> U(32)) * U(n) >> U(32)).astype(np.int64)


def _whole(table: pa.Table) -> pa.Table:
    """Of one block: the intervals that cover its exact copies."""
    hits = np.zeros(table.num_rows, _HIT)
    hits["row"], hits["block"] = table.column("row").to_numpy(), table.column("block").to_numpy()
    hits["end"], hits["pos"] = np.iinfo(np.int32).max, -1
    return pa.table({"block": table.column("block").slice(0, 1), "kind": pa.array([1], pa.int32()), "blob": pa.array([hits.tobytes()], pa.binary())})


def _but_copies(step):
    """``step`` on the texts of one block that are no copies (kind 1 of
    ``given``), with the rest of ``given``."""
    def run(key, texts: pa.Table, given: pa.Table) -> pa.Table:
        kind = given.column("kind").to_numpy()
        blobs = given.column("blob").filter(pa.array(kind == 1)).to_pylist()
        gone = np.concatenate([np.zeros(0, _HIT), *(np.frombuffer(x, _HIT) for x in blobs)])["row"]
        if len(gone):
            texts = texts.filter(pa.array(~np.isin(texts.column("row").to_numpy(), gone)))
        return step(key, texts, given.filter(pa.array(kind != 1)))

    return run


def _seeds(n_ranges: int, every: int):
    """For one block: its distinct seed hashes by hash range, and with part -1 a
    sample of the anchors' leading bytes."""
    def run(key, texts: pa.Table, _) -> pa.Table:
        block, got, leads = key[0].as_py(), [np.zeros(0, U)], [np.zeros(0, U)]
        for _, data, offsets in text_slices(texts.column("text")):
            where, h = anchors(data, offsets)
            got.append(np.unique(h))
            pick = where[mix(h + U(1)) % U(every) == 0]
            lead = np.concatenate((data, np.zeros(8, np.uint8)))[pick[:, None] + np.arange(8)]
            leads.append(np.ascontiguousarray(lead).view(">u8").astype(U).ravel())
        h = np.unique(np.concatenate(got))
        part = _range_of(h, n_ranges)
        cut = np.flatnonzero(np.diff(part, prepend=-1))
        rows = [(int(part[c]), block, x.tobytes()) for c, x in zip(cut, np.split(h, cut[1:]) if len(cut) else [], strict=True)]
        sample = np.concatenate(leads)
        if len(sample):
            rows.append((-1, -1, sample.tobytes()))
        return pa.table({"part": pa.array([r[0] for r in rows], pa.int64()), "block": pa.array([r[1] for r in rows], pa.int64()),
                         "blob": pa.array([r[2] for r in rows], pa.binary())})

    return run


def _shared(table: pa.Table) -> pa.Table:
    """Of one hash range: the hashes that two blocks hold, for each block."""
    names = ["block", "blob"]
    if table.num_rows and table.column("part")[0].as_py() < 0:
        return table.select(names)
    block = table.column("block").to_numpy()
    own = [np.frombuffer(x, U) for x in table.column("blob").to_pylist()]
    sizes = np.array([len(x) for x in own])
    h = np.concatenate(own)
    order = np.argsort(h, kind="stable")
    s = h[order]
    twice = np.zeros(len(s), bool)
    twice[1:] = s[1:] == s[:-1]
    twice[:-1] |= twice[1:].copy()
    keep = np.zeros(len(h), bool)
    keep[order] = twice
    ends = np.cumsum(sizes)
    out = [(int(b), h[e - n:e][keep[e - n:e]].tobytes()) for b, n, e in zip(block, sizes, ends, strict=True)]
    out = [x for x in out if x[1]]
    return pa.table({"block": pa.array([x[0] for x in out], pa.int64()), "blob": pa.array([x[1] for x in out], pa.binary())})


def _suffixes(splitters: np.ndarray):
    """For one block with its shared seed hashes: its suffixes by range (kind 0,
    key the range), intervals settled here (kind 1), twins inside a piece (kind 2) and between
    pieces (kind 3)."""
    def run(key, texts: pa.Table, shared: pa.Table) -> pa.Table:
        block = key[0].as_py()
        known = np.unique(np.concatenate([np.zeros(0, U), *(np.frombuffer(x, U) for x in shared.column("blob").to_pylist())]))
        ids, numbers = texts.column("doc").to_numpy(), texts.column("row").to_numpy()
        pieces = []
        for i, data, offsets in text_slices(texts.column("text")):
            at, h = anchors(data, offsets)
            pieces.append((i, data, offsets, at, h, np.searchsorted(offsets, at, side="right") - 1 + i))
        # seeds that two documents of this block share
        h = np.concatenate([np.zeros(0, U), *(p[4] for p in pieces)])
        d = np.concatenate([np.zeros(0, np.int64), *(p[5] for p in pieces)])
        order = np.lexsort((d, h))
        h, d = h[order], d[order]
        here = np.unique(h[1:][(h[1:] == h[:-1]) & (d[1:] != d[:-1])])
        known = np.union1d(known, here)
        recs, hits, twins = [np.zeros(0, _REC)], [np.zeros(0, _HIT)], [np.zeros(0, _TWIN)]
        for i, data, offsets, at, h, doc in pieces:
            if not len(known):
                break
            k = np.searchsorted(known, h)
            k[k == len(known)] = 0
            use = known[k] == h
            rec, hit, twin = settle(_contexts(data, offsets, at[use], doc[use] - i, ids[i:], numbers[i:], block))
            recs.append(rec)
            hits.append(hit)
            twins.append(twin)
        rec, hit, again = settle(np.concatenate(recs))  # between the pieces; twins only where an id repeats
        hits.append(hit)
        part = np.searchsorted(splitters, words64(rec["right"])[:, 0], side="right") if len(rec) else np.zeros(0, np.int64)
        order = np.argsort(part, kind="stable")
        rec, part = rec[order], part[order]
        cut = np.flatnonzero(np.diff(part, prepend=-1))
        rows = [(0, int(part[c]), x.tobytes()) for c, x in zip(cut, np.split(rec, cut[1:]) if len(cut) else [], strict=True)]
        rows += [(k, block, x.tobytes()) for k, x in ((1, np.concatenate(hits)), (2, np.concatenate(twins)), (3, again)) if len(x)]
        return pa.table({"kind": pa.array([r[0] for r in rows], pa.int32()), "key": pa.array([r[1] for r in rows], pa.int64()),
                         "blob": pa.array([r[2] for r in rows], pa.binary())})

    return run


def _in_range(table: pa.Table) -> pa.Table:
    """Sorts and compares the suffixes of one range; what is settled passes."""
    kind = table.column("kind")[0].as_py()
    blobs = table.column("blob").to_pylist()
    if kind:
        return pa.table({"block": table.column("key"), "kind": table.column("kind"), "blob": table.column("blob")})
    hits = covered(np.concatenate([np.frombuffer(x, _REC) for x in blobs]))
    hits = hits[np.argsort(hits["block"], kind="stable")]
    cut = np.flatnonzero(np.diff(hits["block"], prepend=-1))
    rows = list(zip(hits["block"][cut].tolist(), np.split(hits, cut[1:]) if len(cut) else [], strict=True))
    return pa.table({"block": pa.array([r[0] for r in rows], pa.int64()), "kind": pa.array([1] * len(rows), pa.int32()),
                     "blob": pa.array([r[1].tobytes() for r in rows], pa.binary())})


_RESULT = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<int>"


def _united(key, texts: pa.Table, found: pa.Table) -> pa.Table:
    """Per document of one block: the union of its intervals and what is left."""
    kinds, blobs = found.column("kind").to_pylist(), found.column("blob").to_pylist()
    of = lambda kind, dtype: np.concatenate([np.zeros(0, dtype), *(np.frombuffer(b, dtype) for k, b in zip(kinds, blobs, strict=True) if k == kind)])
    hits = expand(expand(of(1, _HIT), of(3, _TWIN)), of(2, _TWIN))
    hits = hits[np.argsort(hits["row"], kind="stable")]
    ids, numbers = texts.column("doc").to_numpy(), texts.column("row").to_numpy()
    lo, hi = np.searchsorted(hits["row"], numbers), np.searchsorted(hits["row"], numbers, side="right")
    rows = []
    for i, data, offsets in text_slices(texts.column("text")):
        for j in range(len(offsets) - 1):
            own = data[offsets[j]:offsets[j + 1]]
            a, b = int(lo[i + j]), int(hi[i + j])
            s, e = union(hits["start"][a:b], np.minimum(hits["end"][a:b], len(own)))
            left = own
            if len(s):
                edge = np.zeros(len(own) + 1, np.int8)
                edge[s] += 1
                edge[e] -= 1
                left = own[np.cumsum(edge)[:-1] == 0]
            rows.append((int(ids[i + j]), len(own), len(own) - len(left), len(s), hashlib.sha256(left.tobytes()).hexdigest(),
                         np.stack((s, e), 1).ravel().tolist()))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()))
    names = ("doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
    return pa.table({n: pa.array([r[c] for r in rows], k) for c, (n, k) in enumerate(zip(names, kinds, strict=True))})


def repeated_spans(docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc (NO_ID for null), n_bytes, n_removed, n_spans,
    kept_sha256 and spans (start, end, start, ... in bytes)."""
    src = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = src.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    per = max(12 << 20, total // 50_000)
    blocks, drop = scratch.bucketed(_blocks(src), total // per + 1, "block")
    try:
        return _spans(blocks, total, scratch)
    finally:
        drop()


def _copies(blocks: DataFrame, scratch: Scratch) -> DataFrame:
    """(block, kind, blob): the places of the texts that a smaller id has too."""
    size = F.octet_length("text")
    named = scratch.cut(blocks.filter(size >= LENGTH).select("block", "row", "doc", size.alias("n_bytes"), F.unhex(F.sha2("text", 256)).alias("h")))
    first = named.groupBy("h", "n_bytes").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).filter("first < last").drop("last")
    places = named.join(first, ["h", "n_bytes"]).filter("doc > first").select("block", "row")
    copies = scratch.cut(places.groupBy("block").applyInArrow(_whole, "block long, kind int, blob binary"))
    scratch.drop(named)
    return copies


def _spans(blocks: DataFrame, total: int, scratch: Scratch) -> DataFrame:
    copies = _copies(blocks, scratch)
    by_block = blocks.groupBy("block")
    every = max(1, total // 16 // SAMPLE)
    packed = by_block.cogroup(copies.groupBy("block")).applyInArrow(_but_copies(_seeds(total // (8 << 20) + 1, every)), "part long, block long, blob binary")
    shared = scratch.cut(packed.groupBy("part").applyInArrow(_shared, "block long, blob binary"))
    leads = [np.frombuffer(r[0], U) for r in shared.filter("block < 0").select("blob").collect()]
    leads = np.sort(np.concatenate([np.zeros(0, U), *leads]))
    n_ranges = total // (4 << 20) + 1
    splitters = np.unique(leads[np.linspace(0, len(leads) - 1, n_ranges + 1).astype(np.int64)[1:-1]]) if len(leads) else leads
    given = shared.filter("block >= 0").select("block", F.lit(0).alias("kind"), "blob").unionByName(copies)
    found = scratch.cut(by_block.cogroup(given.groupBy("block")).applyInArrow(_but_copies(_suffixes(splitters)), "kind int, key long, blob binary")
                        .groupBy("kind", "key").applyInArrow(_in_range, "block long, kind int, blob binary"))
    scratch.drop(shared)
    out = scratch.cut(by_block.cogroup(found.unionByName(copies).groupBy("block")).applyInArrow(_united, _RESULT))
    scratch.drop(found, copies)
    return out


def kept_digests(docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text") -> DataFrame:
    found = repeated_spans(docs, scratch, key, text)
    return found.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias(key), "n_bytes", "n_removed", "n_spans", "kept_sha256")
