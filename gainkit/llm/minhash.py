"""Operator 1: near-duplicate documents by SetSketch registers.

A document is the set of its distinct k-word shingles. Its sketch has ``M``
registers; register i is ``floor(1 - log_b(min h_i))``, cut to 0..65535, where
every element's values ``h_i`` are exponential with rate ``a``: the minima are
exponentially spaced, and sketches merge by the larger register. As in the
second construction of the SetSketch paper an element meets the registers in
a random order with ascending values, so a batch of documents needs few
rounds over its elements.

1. Equal sets are one class (by two 64-bit sums over the set and its size),
   which gets a number. Classes are the vertices of all links; ids come back
   only when components are known.
2. Bands of registers make keys; classes that share a key are candidates.
   Pairs are not listed: in each bucket every member is first compared with one
   hub (the smallest number), then, where the bucket still holds more than one
   component, with the member that has most links. At last the members that
   are still in different components are compared by their registers within
   blocks of their bucket, each pair in the first band it shares, and those
   that step 3 leaves possible by their sets; pairs never become rows. Members
   of a bucket's largest component meet only the others, not one another.
3. For each candidate pair the counts of larger, smaller and equal registers
   and both set sizes give the likelihood of the similarity; pairs for which
   no similarity at or above the threshold is likely are dropped.
4. What is left is confirmed on the full sets, made anew from the texts.

Defined results: a document without words (or null text) has the empty set,
is linked with nothing and kept; equal texts and repeated rows are linked; null
ids take part as one id larger than all others; texts of any length are read
whole; an empty table gives an empty one. Rows that repeat an id with other
texts are told apart by two 64-bit hashes of the text: each has its own class,
links and component.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gainkit.llm.bytesops import LOWER, U, mix, shingle_sets, text_slices
from gainkit.llm.components import components
from gainkit.llm.grouped import stream
from gainkit.session import Scratch

M = 256
#: registers that make bands; all of them estimate
BANDED = 128
#: members of a bucket compared in one task
BLOCK = 256
BASE = 1.001
RATE = 20.0
TOP = 65535
#: pairs are dropped when likelier by this log ratio below the threshold than at or above it
SLACK = 10.0
#: chance that a pair at the threshold shares no band, at most
MISS = 1e-6
NO_ID = 2**63 - 1
ROW = ["id", "t1", "t2"]
SET = ["n", "d1", "d2"]
_STEP = U(0x9E3779B97F4A7C15)


def bands(threshold: float, m: int = BANDED, miss: float = MISS) -> tuple[int, int]:
    """(rows, bands): the most rows for which bands over m registers miss a
    pair at the threshold with probability ``miss`` at most."""
    for rows in range(m, 0, -1):
        n = m // rows
        if (1 - threshold ** rows) ** n <= miss:
            return rows, n
    return 1, m


def registers(doc: np.ndarray, h: np.ndarray, n_docs: int) -> np.ndarray:
    """(n_docs, M) registers of the sets given as sorted (doc, hash) pairs."""
    low = np.full(n_docs * M, np.inf)
    seed = mix(h ^ U(0xA5A5A5A5DEADBEEF))
    first, stride = (seed & U(M - 1)).astype(np.int64), ((seed >> U(20)) & U(M - 1)).astype(np.int64) | 1
    count = np.bincount(doc, minlength=n_docs)
    for j in range(M):
        if not len(h):
            break
        v = (j + (mix(h + U(int(_STEP) * (j + 1) % 2**64)) >> U(11)).astype(np.float64) * 2.0**-53) / M
        value = -np.log1p(-v) / RATE
        slot = doc * M + ((first + stride * j) & (M - 1))
        np.minimum.at(low, slot, value)
        bound = -np.log1p(-(j + 1) / M) / RATE if j + 1 < M else np.inf
        go = (low.reshape(n_docs, M).max(axis=1) > bound) & (count > 0)
        keep = go[doc]
        if not keep.all():
            doc, h, first, stride = doc[keep], h[keep], first[keep], stride[keep]
    with np.errstate(divide="ignore"):
        k = np.floor(1 - np.log(low) / np.log(BASE))
    return np.clip(k, 0, TOP).astype(np.uint16).reshape(n_docs, M)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def _row_names(key: str, text: str) -> list[F.Column]:
    """The columns ``ROW`` that tell rows apart: id and two hashes of the text."""
    t = F.coalesce(F.col(text), F.lit(""))
    return [F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(t).alias("t1"), F.xxhash64(F.lit(1), t).alias("t2")]


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(*_row_names(key, text), F.col(text).alias("_text"))


def sketches(docs: DataFrame, k: int, key: str, text: str) -> DataFrame:
    """(id, t1, t2, n, d1, d2, regs) per row: the row's text by two hashes, set
    size, two sums naming the set, registers."""
    src = _rows(docs, key, text)

    def run(batches):
        for batch in batches:
            for i, data, offsets in text_slices(batch.column(3)):
                n = len(offsets) - 1
                doc, h = shingle_sets(LOWER[data], offsets, k)
                edge = np.searchsorted(doc, np.arange(n + 1))
                sums = []
                for salt in (0x1234567, 0x89ABCDEF01):
                    total = np.concatenate((np.zeros(1, U), np.cumsum(mix(h ^ U(salt)), dtype=U)))
                    sums.append(pa.array((total[edge[1:]] - total[edge[:-1]]).view(np.int64)))
                regs = registers(doc, h, n)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(i, n) for c in range(3)), pa.array(np.diff(edge)), *sums,
                     pa.array([r.tobytes() for r in regs], pa.binary())], names=[*ROW, "n", "d1", "d2", "regs"])

    return src.mapInArrow(run, "id long, t1 long, t2 long, n long, d1 long, d2 long, regs binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, M)


def _band_keys(regs: np.ndarray, rows: int, n_bands: int) -> np.ndarray:
    x = regs[:, :rows * n_bands].reshape(-1, n_bands, rows).astype(U)
    key = np.broadcast_to(np.arange(n_bands, dtype=U) * _STEP, x.shape[:2]).copy()
    for j in range(rows):
        key = mix(key + x[:, :, j] * U(0xD6E8FEB86659FD93) + U(j))
    return key.view(np.int64)


def band_rows(reps: DataFrame, rows: int, n_bands: int) -> DataFrame:
    """(key, id) for every band of every class."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                keys = _band_keys(_matrix(batch.column(1)), rows, n_bands)
                ids = np.repeat(batch.column(0).to_numpy(), n_bands)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], names=["key", "id"])

    return reps.select("id", "regs").mapInArrow(run, "key long, id long")


def log_likelihood(more, less, nu, nv, jaccard) -> np.ndarray:
    """Log likelihood of each similarity (columns) for pairs with ``more``
    registers larger in u, ``less`` smaller and M - more - less equal, whose
    sets have nu and nv elements."""
    u, v = (nu / (nu + nv))[:, None], (nv / (nu + nv))[:, None]

    def p(x):
        return -np.log1p(-np.clip(x, 1e-9, 1 - 1e-12) * (BASE - 1) / BASE) / np.log(BASE)

    grid = jaccard[None, :]
    a, b = p(u - v * grid), p(v - u * grid)
    same = np.clip(1 - a - b, 1e-12, 1)
    return more[:, None] * np.log(np.clip(a, 1e-12, 1)) + less[:, None] * np.log(np.clip(b, 1e-12, 1)) + (M - more - less)[:, None] * np.log(same)


_GRID = np.linspace(0.0, 1.0, 101)


def estimate(more, less, nu, nv) -> np.ndarray:
    """The likeliest similarity on a grid of hundredths."""
    ll = log_likelihood(more, less, nu, nv, _GRID)
    ll[_GRID[None, :] > (np.minimum(nu, nv) / np.maximum(nu, nv))[:, None] + 0.005] = -np.inf
    return _GRID[ll.argmax(axis=1)]


def _likely(ra, rb, na, nb, threshold: float) -> np.ndarray:
    more, less = (ra > rb).sum(axis=1), (ra < rb).sum(axis=1)
    ll = log_likelihood(more, less, na, nb, _GRID)
    top = np.minimum(na, nb) / np.maximum(na, nb)
    ll[_GRID[None, :] > top[:, None] + 0.005] = -np.inf
    high = ll[:, _GRID >= threshold - 0.005].max(axis=1)
    return (top >= threshold) & (high >= ll.max(axis=1) - SLACK)


def likely(pairs: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of classes that the registers and sizes leave possible."""
    r = reps.select("id", "n", "regs")
    wide = pairs.join(r.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("regs").alias("ra")), "a") \
        .join(r.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("regs").alias("rb")), "b") \
        .filter((F.least("na", "nb") >= F.greatest("na", "nb") * (threshold - 1e-9))).select("a", "b", "na", "nb", "ra", "rb")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                ok = _likely(_matrix(batch.column(4)), _matrix(batch.column(5)), batch.column(2).to_numpy(), batch.column(3).to_numpy(), threshold)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok))

    return wide.mapInArrow(run, "a long, b long")


def _pairs_inside(t: pa.Table, starts: np.ndarray, shape: tuple[int, int], threshold: float):
    """For each group of ``t`` the rows of its possible pairs: in different
    components, met in the first band they share, not ruled out by registers."""
    ids, comp, n, own = (t.column(c).to_numpy() for c in ("id", "comp", "n", "own"))
    regs = _matrix(t.column("regs").combine_chunks())
    key, apart = t.column("key").to_numpy(), t.column("i").to_numpy() != t.column("j").to_numpy()
    band = _band_keys(regs, *shape)
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), t.num_rows], strict=True):
        p, q = np.triu_indices(b - a, 1)
        p, q = p + a, q + a
        use = (comp[p] != comp[q]) & (np.minimum(n[p], n[q]) >= threshold * np.maximum(n[p], n[q]) - 1e-9)
        if apart[a]:
            use &= own[p] != own[q]
        p, q = p[use], q[use]
        found = [(np.zeros(0, np.int64),) * 2]
        for at in range(0, len(p), 20_000):
            x, y = p[at:at + 20_000], q[at:at + 20_000]
            ok = band[x, (band[x] == band[y]).argmax(axis=1)] == key[a]
            x, y = x[ok], y[ok]
            ok = _likely(regs[x], regs[y], n[x], n[y], threshold)
            found.append((x[ok], y[ok]))
        x, y = (np.concatenate(z) for z in zip(*found, strict=True))
        if len(x):
            yield ids, comp, x, y


def dealt(members: DataFrame, block: int) -> DataFrame:
    """Members (key, id, comp, ...) of buckets dealt to pairs of blocks: adds
    i <= j (the pair) and own (the member's block). Two members in different
    components meet in exactly one pair. A bucket of at most ``block`` rows is
    one block; in others the largest component has blocks of its own, which are
    never paired with each other."""
    sizes = members.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("_n")) \
        .groupBy("key").agg(F.max(F.struct("_n", "comp")).alias("_t"), F.sum("_n").alias("_c")).filter("_c > _t._n") \
        .select("key", F.col("_t.comp").alias("_top"), (F.col("_c") <= block).alias("_one"), F.ceil(F.col("_t._n") / block).cast("int").alias("_p"),
                F.ceil((F.col("_c") - F.col("_t._n")) / block).cast("int").alias("_q"))
    h, top, last = F.xxhash64("id"), F.col("comp") == F.col("_top"), F.col("_p") + F.col("_q") - 1
    m = members.join(sizes, "key").withColumn("own", F.when(F.col("_one"), 0).when(top, F.pmod(h, "_p")).otherwise(F.col("_p") + F.pmod(h, "_q")).cast("int"))
    m = m.withColumn("_o", F.explode(F.when(F.col("_one"), F.array(F.lit(0))).otherwise(F.sequence(F.when(top, F.col("_p")).otherwise(0), last))))
    return m.withColumn("i", F.least("own", "_o")).withColumn("j", F.greatest("own", "_o")).drop("_top", "_one", "_p", "_q", "_o")


def linked_inside(members: DataFrame, reps: DataFrame, texts: DataFrame, k: int, threshold: Fraction, shape: tuple[int, int], block: int = BLOCK) -> DataFrame:
    """Links among the members (key, id, comp) of each bucket that lie in
    different components, enough of them to join all components that any link
    joins. Buckets are cut into blocks; members without a possible partner go
    first by the registers, the others' full sets are compared in their block.
    Pairs never become rows."""
    keys, limit = ["key", "i", "j"], float(threshold)
    regs = reps.select("id", "n", "regs")
    first = dealt(members.join(regs, "id"), block).select(*keys, "own", "id", "comp", "n", "regs").repartition(*keys).sortWithinPartitions(*keys)

    def involved(batches):
        for t, starts in stream(batches, keys):
            rows = [np.unique(np.concatenate((x, y))) for _, _, x, y in _pairs_inside(t, starts, shape, limit)]
            if rows:
                yield from t.take(pa.array(np.concatenate(rows))).combine_chunks().to_batches()

    left = first.mapInArrow(involved, "key long, i int, j int, own int, id long, comp long, n long, regs binary")
    full = left.join(texts, "id").select(*keys, "own", "id", "comp", "n", "regs", "_text").repartition(*keys).sortWithinPartitions(*keys)

    def compare(batches):
        for t, starts in stream(batches, keys):
            text = t.column("_text")
            for ids, comp, x, y in _pairs_inside(t, starts, shape, limit):
                sets = {i: _one_set(text[i].as_py(), k) for i in np.unique(np.concatenate((x, y))).tolist()}
                up: dict = {}
                out = []
                for i, j in zip(x.tolist(), y.tolist(), strict=True):
                    a, b = _top(up, int(comp[i])), _top(up, int(comp[j]))
                    if a != b and _alike(sets[i], sets[j], threshold):
                        up[a] = b
                        out.append((int(ids[i]), int(ids[j])))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out]) for c in (0, 1)], names=["u", "v"])

    return full.mapInArrow(compare, "u long, v long")


def _top(up: dict, x: int) -> int:
    while x in up:
        x = up[x]
    return x


def _alike(x: np.ndarray, y: np.ndarray, threshold: Fraction) -> bool:
    """Whether two sorted sets reach the threshold, exactly."""
    at = np.searchsorted(x, y)
    at[at == len(x)] = 0
    both = int((x[at] == y).sum()) if len(x) else 0
    return both > 0 and threshold.denominator * both >= threshold.numerator * (len(x) + len(y) - both)


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, threshold: Fraction) -> DataFrame:
    """The pairs whose full sets are similar enough, compared exactly."""
    wide = pairs.join(texts.select(F.col("id").alias("a"), F.col("_text").alias("ta")), "a") \
        .join(texts.select(F.col("id").alias("b"), F.col("_text").alias("tb")), "b").select("a", "b", "ta", "tb")

    def run(batches):
        kept: dict = {}

        def set_of(i, text):
            if i not in kept:
                if len(kept) >= 512:
                    kept.clear()
                kept[i] = _one_set(text.as_py(), k)
            return kept[i]

        for batch in batches:
            ok = []
            for a, b, ta, tb in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                ok.append(_alike(set_of(a, ta), set_of(b, tb), threshold))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(ok, pa.bool_()))

    return wide.mapInArrow(run, "u long, v long")


def _one_set(text: str | None, k: int) -> np.ndarray:
    data = np.frombuffer((text or "").encode(), np.uint8)
    return shingle_sets(LOWER[data], np.array([0, len(data)]), k)[1]


def classes(docs: DataFrame, scratch: Scratch, k: int = 5, threshold: Fraction = Fraction(4, 5), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: id, t1, t2 (the row, by id and text), n (set size),
    component (smallest id reachable by links, itself included) and group (the
    number of the component; null for the empty set)."""
    rows, n_bands = bands(float(threshold))
    limit = float(threshold)
    sk = scratch.cut(sketches(docs, k, key, text))
    sets = sk.filter("n > 0")
    # a class goes by the row of its smallest id; written, so its number stays
    first = sets.groupBy(*SET).agg(F.min(F.struct(*ROW)).alias("row"))
    cls = scratch.cut(first.select(*SET, *(F.col(f"row.{c}").alias(f"r_{c}") for c in ROW), F.monotonically_increasing_id().alias("v")))
    of_row = [F.col(c) == F.col(f"r_{c}") for c in ROW]
    reps = sets.join(cls, SET).filter(of_row[0] & of_row[1] & of_row[2]).groupBy("v").agg(F.min(F.struct("n", "regs")).alias("r"))
    reps = scratch.cut(reps.select(F.col("v").alias("id"), "r.n", "r.regs"))

    every = band_rows(reps, rows, n_bands)
    buckets = every.groupBy("key").agg(F.min("id").alias("hub"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    shared = scratch.cut(every.join(buckets.select("key", "hub"), "key"))
    wanted = cls.join(shared.select(F.col("id").alias("v")).distinct(), "v", "left_semi").select("v", *(F.col(f"r_{c}").alias(c) for c in ROW))
    texts = _rows(docs, key, text).join(wanted, ROW).select(F.col("v").alias("id"), "_text")
    repeats = sk.count() != sk.select(*ROW).distinct().count()
    texts = scratch.cut(texts.groupBy("id").agg(F.min("_text").alias("_text")) if repeats else texts)

    stars = shared.filter("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    tried = scratch.cut(likely(stars, reps, limit))
    links = scratch.cut(confirmed(tried, texts, k, threshold))
    of = scratch.cut(components(links, scratch))

    def open_buckets():
        """Members of the buckets that hold more than one component."""
        m = shared.join(of, shared["id"] == of["v"], "left").select("key", "id", F.coalesce("component", "id").alias("comp"))
        many = m.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("key")
        return m.join(many, "key")

    degree = links.select("u").union(links.select("v")).groupBy("u").agg(F.count(F.lit(1)).alias("deg"))
    left = scratch.cut(open_buckets().join(degree, F.col("id") == F.col("u"), "left").select("key", "id", "comp", F.coalesce("deg", F.lit(0)).alias("deg")))
    hub = left.groupBy("key").agg(F.max(F.struct("deg", "id", "comp")).alias("hub"))
    more = left.join(hub, "key").filter("comp <> hub.comp").select(F.least("id", "hub.id").alias("a"), F.greatest("id", "hub.id").alias("b")).distinct()
    seen = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    again = scratch.cut(likely(more.join(seen, ["a", "b"], "left_anti"), reps, limit))
    links = scratch.cut(links.union(confirmed(again, texts, k, threshold)))
    of = scratch.cut(components(links, scratch))

    rest = scratch.cut(open_buckets())
    links = scratch.cut(links.union(linked_inside(rest, reps, texts, k, threshold, (rows, n_bands))))
    of = components(links, scratch)
    scratch.drop(reps, shared, texts, tried, left, again, rest)

    joined = cls.join(of, "v").select(*SET, "component", "r_id")
    low = joined.groupBy("component").agg(F.min("r_id").alias("low"))
    named = scratch.cut(joined.join(low, "component").select(*SET, "component", "low"))
    alone = cls.select(*SET, "v", "r_id").join(named, SET, "left")
    groups = alone.select(*SET, F.coalesce("component", "v").alias("grp"), F.coalesce("low", "r_id").alias("low"))
    return sk.select(*ROW, *SET).join(groups, SET, "left").select(*ROW, "n", F.coalesce("low", "id").alias("component"), "grp")


def near_duplicates(docs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    c = classes(docs, scratch, **options)
    back = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return c.select(back("id").alias("doc_id"), F.col("n").alias("n_shingles"), back("component").alias("component_id"),
                    (F.col("id") == F.col("component")).alias("kept"))


def drop_duplicates(docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each group: the row with the smallest id
    (and, under one id, the smallest hashes of its text). Of rows that repeat
    an id and its text one stays, picked by a hash of the row. Rows without an
    id or without words all stay."""
    rows = scratch.cut(classes(docs, scratch, key=key, text=text, **options).filter(f"grp is not null and id <> {NO_ID}").select(*ROW, "grp"))
    kept = rows.groupBy("grp").agg(F.min(F.struct(*ROW)).alias("first"), F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    marked = scratch.cut(rows.join(kept, "grp").select(*ROW, (F.struct(*ROW) == F.col("first")).alias("stays"))
                         .groupBy(*ROW, "stays").agg(F.count(F.lit(1)).alias("c")).filter("not stays or c > 1"))
    mark = lambda condition: marked.filter(condition).select(*(F.col(c).alias(f"_m_{c}") for c in ROW))

    def on():
        i, t1, t2 = _row_names(key, text)
        return (i == F.col("_m_id")) & (t1 == F.col("_m_t1")) & (t2 == F.col("_m_t2"))

    left = docs.join(mark("not stays"), on(), "left_anti")
    twice = mark("stays")
    if not twice.isEmpty():
        digest = F.struct(F.sha2(F.to_json(F.struct("*")), 256).alias("h"), F.struct(*docs.columns).alias("d"))
        first = left.join(twice, on(), "left_semi").groupBy(*_row_names(key, text)).agg(F.min(digest)["d"].alias("_d"))
        left = left.join(twice, on(), "left_anti").unionByName(first.select("_d.*"))
    return left
