"""Operator 5: near-duplicate vectors by a pivot-permutation index.

Reference points (pivots) are a bounded sample of the vectors: of the rows with
the smallest hash of their id, those that are not near one chosen before. So a
group that holds a large share of the rows has no more pivots than others, its
members see the same ones, and they meet. A vector is described by its
``prefix`` nearest pivots in order. Inverted lists are kept for pairs of
pivots: a vector is in the list of each pair among its prefix, so two vectors
meet in a list exactly when they share two pivots or more, and meet in
``s(s-1)/2`` lists for ``s`` shared ones. A pair that shares s pivots counts in
the list of its two smallest shared pivots only. Members of a list with equal
labels are compared by cosine in double precision, and only links that reach
the threshold are kept.

Equal vectors with equal labels are one class with a multiplicity first. Lists
longer than ``BLOCK`` are cut into blocks, and pairs of blocks are tasks of
their own, so a hot list is spread out; a task reports for each member the
number of linked vectors and its smallest linked class, never pairs.

Recall against brute force is measured in the tests (``recall`` here); it must
be at least 0.9.

Defined results: vectors that are null, zero, empty or hold null or non-finite
components, and rows without a label, link with nothing; vectors of different
lengths never link; equal rows link; null ids take part as one id larger than
all others; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gainkit.llm.components import components
from gainkit.llm.grouped import block_pairs, stream
from gainkit.session import Scratch

THRESHOLD = 0.98
PIVOTS = 512
APART = 0.9     # pivots have cosines below this
DRAWN = 4       # rows read for each pivot wanted, as near ones are passed over
PREFIX = 6
BLOCK = 1024
NO_ID = 2**63 - 1


def usable(vector: str = "embedding") -> F.Column:
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def pivots(vectors: DataFrame, n: int = PIVOTS) -> dict[int, np.ndarray]:
    """At most ``n`` unit reference vectors for each vector length, none near
    another, from the ``DRAWN * n`` rows with the smallest hash of their id.
    Nothing else reaches the driver."""
    nth = F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64("id"), "id", "label"))
    rows = vectors.select("id", "label", "dim", "v").withColumn("nth", nth).filter(F.col("nth") <= DRAWN * n).select("dim", "nth", "v").collect()
    out = {}
    for dim in {r["dim"] for r in rows}:
        own = sorted((r for r in rows if r["dim"] == dim), key=lambda r: r["nth"])
        out[dim] = thinned(unit(np.array([r["v"] for r in own], np.float64)), n)
    return out


def thinned(x: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` rows that have a cosine below ``APART`` to all taken before."""
    out, taken = np.empty((min(n, len(x)), x.shape[1])), 0
    for row in x:
        if taken < len(out) and (out[:taken] @ row < APART).all():
            out[taken] = row
            taken += 1
    return out[:taken]


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that large and small values survive the squares."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def prefixes(x: np.ndarray, reference: np.ndarray, prefix: int = PREFIX) -> np.ndarray:
    """The ``prefix`` nearest pivots of each row, nearest first; ties go to the
    smaller pivot."""
    near = x @ reference.T
    k = min(prefix, near.shape[1])
    top = np.argpartition(-near, k - 1, axis=1)[:, :k] if k < near.shape[1] else np.tile(np.arange(k), (len(x), 1))
    order = np.lexsort((top, -np.round(np.take_along_axis(near, top, 1), 12)), axis=1)
    return np.take_along_axis(top, order, 1)


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _by_dim(dims: np.ndarray):
    for dim in np.unique(dims).tolist():
        yield dim, np.flatnonzero(dims == dim)


def describe(vectors: DataFrame, reference: dict[int, np.ndarray]) -> DataFrame:
    """(id, label, dim, order): the pivots nearest to each vector."""
    sent = vectors.sparkSession.sparkContext.broadcast(reference)  # PIVOTS rows for each vector length

    def run(batches):
        for batch in batches:
            dims = batch.column(2).to_numpy(zero_copy_only=False)
            for dim, at in _by_dim(dims):
                part = batch.take(pa.array(at))
                top = prefixes(unit(_vectors(part.column(3), dim)), sent.value[dim])
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * top.shape[1]), pa.array(top.ravel().astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), flat], names=["id", "label", "dim", "order"])

    kind = dict(vectors.dtypes)["label"]
    return vectors.select("id", "label", "dim", "v").mapInArrow(run, f"id long, label {kind}, dim int, order array<int>")


def lists(described: DataFrame) -> DataFrame:
    """(label, dim, x, y, id): the inverted lists of pivot pairs x < y. With a
    single pivot its own list stands in."""
    o = F.array_sort("order")
    pairs = F.flatten(F.transform(o, lambda x: F.transform(F.filter(o, lambda y: y > x), lambda y: F.struct(x.alias("x"), y.alias("y")))))
    alone = F.array(F.struct(F.element_at(o, 1).alias("x"), F.element_at(o, 1).alias("y")))
    return described.select("label", "dim", "id", F.explode(F.when(F.size("order") > 1, pairs).otherwise(alone)).alias("p")) \
        .select("label", "dim", "p.x", "p.y", "id")


def compared(vectors: DataFrame, described: DataFrame, scratch: Scratch, threshold: float, block: int = BLOCK) -> DataFrame:
    """(id, n, low): for each class and list block that links it: how many
    vectors it links with there that no earlier list counts, and the smallest
    class of its component there."""
    entries = scratch.cut(lists(described))
    keys = ["label", "dim", "x", "y", "i", "j"]
    e = block_pairs(entries, keys[:4], block).select("id", "x", "y", "i", "j", "own")
    full = e.join(vectors.select("id", "label", "dim", "v", "mult"), "id").join(described.select("id", "order"), "id")
    tasks = full.select(*keys, "own", "id", "mult", "order", "v").repartition(*keys).sortWithinPartitions(*keys)

    def run(batches):
        for t, starts in stream(batches, keys):
            yield from _work(t, starts, threshold)

    return tasks.mapInArrow(run, "id long, n long, low long")


def _work(t: pa.Table, starts: np.ndarray, threshold: float):
    """Compares the members of every group of ``t`` (groups begin at ``starts``)."""
    dims = t.column("dim").to_numpy()
    ends = np.append(starts[1:], t.num_rows)
    size = ends - starts
    ids, mult, own = (t.column(c).to_numpy() for c in ("id", "mult", "own"))
    apart = t.column("i").to_numpy() != t.column("j").to_numpy()
    x, y = t.column("x").to_numpy(), t.column("y").to_numpy()
    for dim, rows in _by_dim(dims):
        lo, hi = int(rows[0]), int(rows[-1]) + 1  # rows are sorted; a dim may come again under another label
        own_groups = np.flatnonzero((dims[starts] == dim) & (size > 1))
        if not len(own_groups):
            continue
        part = t.slice(lo, hi - lo)
        use = dims[lo:hi] == dim
        flat = part.filter(pa.array(use))
        place = np.full(hi - lo, -1)
        place[use] = np.arange(int(use.sum()))
        v = unit(_vectors(flat.column("v").combine_chunks(), dim))
        orders = flat.column("order").combine_chunks()
        width = len(orders.values) // len(orders) if len(orders) else 0
        sets = np.sort(orders.flatten().to_numpy().reshape(-1, width), axis=1)
        for g in own_groups.tolist():
            a, b = int(starts[g]), int(ends[g])
            members = slice(place[a - lo], place[a - lo] + b - a)
            lower = _lower(sets[members], x[a], y[a])
            if len(lower) and np.bincount(lower[:, 1]).max() == b - a:
                continue  # all share an earlier list
            m = v[members]
            near = (m @ m.T) >= threshold
            np.fill_diagonal(near, False)
            if apart[a]:
                near &= own[a:b, None] != own[None, a:b]
            if not near.any():
                continue
            near &= ~_shared(lower, b - a)
            linked = near.any(axis=1)
            if linked.any():
                n, low = near @ mult[a:b], _components(near, ids[a:b])
                yield pa.RecordBatch.from_arrays([pa.array(ids[a:b][linked]), pa.array(n[linked]), pa.array(low[linked])], names=["id", "n", "low"])


def _components(near: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id that each row reaches by the links ``near``."""
    label = ids.copy()
    while True:
        low = np.minimum(label, np.where(near, label, np.iinfo(np.int64).max).min(axis=1))
        if (low == label).all():
            return label
        label = low


def _lower(sets: np.ndarray, x: int, y: int) -> np.ndarray:
    """(row, pivot): the pivots that come before the pair (x, y) in a row's set."""
    at, k = np.nonzero((sets < y) & (sets != x))
    return np.stack((at, sets[at, k]), 1)


def _shared(lower: np.ndarray, n: int) -> np.ndarray:
    """Whether two of the ``n`` rows share one of their ``lower`` pivots, so that
    the two smallest pivots they share are others."""
    which, column = np.unique(lower[:, 1], return_inverse=True)
    has = np.zeros((n, len(which)), np.float32)
    has[lower[:, 0], column] = 1
    return has @ has.T > 0


def near_duplicates(table: DataFrame, scratch: Scratch, threshold: float = THRESHOLD, n_pivots: int = PIVOTS, block: int = BLOCK,
                    key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    rows = table.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"), F.col(label).alias("label"), F.col(vector).alias("v"),
                        (usable(vector) & F.col(label).isNotNull()).alias("ok"))
    # a class is named by the hash of its content, its smallest row id is kept beside it
    same = rows.filter("ok").groupBy("label", "v").agg(F.min("id").alias("row"), F.count(F.lit(1)).alias("mult"))
    classes = scratch.cut(same.select(F.xxhash64("label", "v").alias("id"), "label", "v", "row", "mult", F.size("v").alias("dim")))
    described = scratch.cut(describe(classes, pivots(classes, n_pivots)))
    found = scratch.cut(compared(classes, described, scratch, threshold, block))
    of = components(found.filter("id <> low").select(F.col("id").alias("u"), F.col("low").alias("v")), scratch)
    per = classes.select("id", "row", "mult").join(found.groupBy("id").agg(F.sum("n").alias("n")), "id", "left") \
        .join(of.select(F.col("v").alias("id"), F.col("component").alias("root")), "id", "left") \
        .select("id", "row", F.coalesce("root", "id").alias("root"), (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n"))
    per = per.join(per.groupBy("root").agg(F.min("row").alias("component")), "root").select(F.col("id").alias("cls"), "n", "component")
    out = rows.filter("ok").select("id", F.xxhash64("label", "v").alias("cls")).join(per, "cls")
    alone = rows.filter("not ok").select("id", F.lit(0).cast("long").alias("n"), F.col("id").alias("component"))
    back = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return out.select("id", "n", "component").union(alone).select(
        back("id").alias("vec_id"), F.col("n").alias("n_links"), back("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))


def recall(found: int, true: int) -> float:
    return 1.0 if not true else found / true
