"""Ordered scans without a global window and without a task per group.

Rows are dealt to range partitions, each range is sorted and read in order by
one task, and what a range needs from the ranges before it - its carry - is
worked out from one small row for each range. So a group of any size is spread
over as many ranges as its rows need, and small groups share a range.

* :func:`numbered`: row numbers over an order, from the sizes of the ranges.
* :class:`ThresholdScan`: every threshold of every continuous feature of every
  group from running class counts, and the sums that discrete features need.

The rows of a range reach the scan in Arrow batches: running sums that start
in another partition have no form among the built-in operators, since a window
needs a group's rows together. Memory holds one batch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gainkit.functions.measures import COMPARE_DIGITS, sum_sql, xl_sql
from gainkit.session import Scratch, cut_lineage

G, P, VS, VD, Y, R = "_g", "_p", "_vs", "_vd", "_y", "_r"
TOTALS = -1                 # pseudo feature with the class totals of a group, first in its order

RANGE_ROWS = 20_000         # a range of its own is not worth its task below
FULL_ROWS = 2_000_000       # beyond shuffle.partitions ranges, a range is this long


def n_ranges(spark, rows: int, range_rows: int = RANGE_ROWS) -> int:
    """How many ranges ``rows`` rows are dealt to: as many as the session has
    shuffle partitions, fewer for few rows, more for very many."""
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(-(-rows // range_rows), max(usual, -(-rows // FULL_ROWS))))


def in_ranges(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The rows in ``n`` sorted ranges, with the range's number ``_r``. Cached
    by the caller: the ranges hold for one evaluation."""
    dealt = df.repartitionByRange(n, *order) if n > 1 else df.repartition(1)
    return dealt.sortWithinPartitions(*order).withColumn(R, F.spark_partition_id())


def numbered(df: DataFrame, order: list, name: str = "_n", scratch: Scratch | None = None) -> DataFrame:
    """``df`` with 0-based row numbers over ``order``. Rows that tie are told
    apart arbitrarily, but every number is given once. The ranges are written;
    their sizes, one row for each, give the first number of each range."""
    tie, at = "_tie", "_at"
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    ranges = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*order, F.col(tie))
    placed = cut_lineage(ranges.sortWithinPartitions(*order, F.col(tie)).drop(tie).withColumn(at, F.monotonically_increasing_id()), scratch)
    sizes = sorted(placed.groupBy(F.shiftright(at, 33).alias(R)).count().collect())
    before = np.cumsum([0] + [s["count"] for s in sizes])
    first = df.sparkSession.createDataFrame([(s[R], int(b)) for s, b in zip(sizes, before)], f"{R} long, _first long")
    return placed.withColumn(R, F.shiftright(at, 33)).join(F.broadcast(first), R) \
        .withColumn(name, F.col("_first") + F.col(at).bitwiseAND(F.lit((1 << 33) - 1))).drop(R, at, "_first")


# ---------------------------------------------------------------------------
# thresholds
# ---------------------------------------------------------------------------

def xl(x: np.ndarray) -> np.ndarray:
    """x log2 x, 0 at 0."""
    x = x.astype(np.float64)
    return x * np.log2(np.where(x > 0, x, 1.0))


def _differs(col: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before; nulls are equal, and so are NaNs."""
    a, b = col.slice(1), col.slice(0, len(col) - 1)
    out = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False) | \
        (pc.is_null(a).to_numpy(zero_copy_only=False) != pc.is_null(b).to_numpy(zero_copy_only=False))
    if pa.types.is_floating(col.type):
        nan = lambda x: pc.fill_null(pc.is_nan(x), False).to_numpy(zero_copy_only=False)
        out &= ~(nan(a) & nan(b))
    return out


def _starts(batch: pa.RecordBatch, n_keys: int, first: tuple[bool, bool]) -> tuple[np.ndarray, np.ndarray]:
    """Which rows start a group, and which a (group, feature)."""
    group = np.zeros(len(batch) - 1, bool)
    for i in range(n_keys):
        group |= _differs(batch.column(i))
    pair = group | _differs(batch.column(n_keys))
    return np.concatenate([[first[0]], group]), np.concatenate([[first[1]], pair])


def _counts(batch: pa.RecordBatch, n_keys: int) -> np.ndarray:
    return np.stack([c.to_numpy() for c in batch.columns[n_keys + 2:]], axis=1)


@dataclass
class Carry:
    """What a range needs from others."""
    same_group: bool        # its first row's group has begun before,
    same_pair: bool         # its first row's (group, feature) too,
    run: list               # with these class counts so far;
    totals: list | None     # that group's class totals
    after: float | None     # the value that follows its last one, if of the same (group, feature)


def carries(seen: list, n_keys: int, k: int) -> dict[int, Carry]:
    """From one row for each range that has rows: its carry."""
    out: dict[int, Carry] = {}
    last, run, totals = None, [0] * k, None
    for s in sorted(seen, key=lambda s: s[R]):
        head, tail = tuple(map(repr, s["head"])), tuple(map(repr, s["tail"]))
        same = head == last
        out[s[R]] = Carry(last is not None and head[:n_keys] == last[:n_keys], same, run if same else [0] * k, totals, None)
        if same:
            out[prev].after = s["value"]
        run = [a + b for a, b in zip(run, s["sums"])] if same and s["one"] else list(s["sums"])
        totals, last, prev = (s["totals"] if s["totals"] is not None else totals), tail, s[R]
    return out


class ThresholdScan:
    """Over value x class counts (``_g``, ``_p``, [``_vs``,] ``_vd``, ``c0`` ..)
    with the class totals of each group as feature ``TOTALS``.

    ``stats`` has a row for each (group, feature); ``candidates`` one for each
    threshold. Both read the cached ``ranges``; ``close`` lets them go."""

    def __init__(self, counts: DataFrame, k: int, discrete: list[int], rows: int, range_rows: int = RANGE_ROWS):
        """``rows``: a bound on the rows of ``counts``."""
        self.k, self.discrete = k, sorted(discrete)
        self.group = counts.schema[G].dataType
        order = [G, P, *([VS] if VS in counts.columns else []), VD]
        self.n = n_ranges(counts.sparkSession, rows, range_rows)
        self.ranges = in_ranges(counts, order, self.n).persist(StorageLevel.MEMORY_AND_DISK)
        struct = self.group.typeName() == "struct"
        fields = self.group.fields if struct else [None]
        self.keys = [f"_k{i}" for i in range(len(fields))]
        self.kinds = [f.dataType.simpleString() if f else self.group.simpleString() for f in fields]
        flat = [F.col(f"{G}.`{f.name}`" if f else G).alias(n) for f, n in zip(fields, self.keys)]
        self.flat = self.ranges.select(*flat, F.col(P), F.col(VD), *[f"c{i}" for i in range(k)], R)
        self.carries, self.sizes = self._carries() if self.n > 1 else ({}, None)

    def close(self) -> None:
        self.ranges.unpersist()

    def _carries(self) -> tuple[dict[int, Carry], dict[int, int]]:
        """The carry of each range, and the rows of each feature."""
        n_keys, k = len(self.keys), self.k

        def summary(batches):
            head = tail = value = totals = number = before = None
            sums, one, rows = np.zeros(k, np.int64), True, np.zeros(0, np.int64)
            for b in batches:
                if not len(b):
                    continue
                number, b = b.column(b.num_columns - 1)[0].as_py(), b.select(range(b.num_columns - 1))
                if head is None:
                    head, value = [repr(b.column(i)[0].as_py()) for i in range(n_keys + 1)], b.column(n_keys + 1)[0].as_py()
                joined = b if before is None else pa.Table.from_batches([before, b]).combine_chunks().to_batches()[0]
                pair = _starts(joined, n_keys, (False, False))[1][0 if before is None else 1:]
                c, begins = _counts(b, n_keys), np.flatnonzero(pair)
                one &= not len(begins)
                sums = c[begins[-1]:].sum(axis=0) if len(begins) else sums + c.sum(axis=0)
                p = b.column(n_keys).to_numpy()
                is_total = np.flatnonzero(p == TOTALS)
                more = np.bincount(p - TOTALS, minlength=len(rows))
                more[:len(rows)] += rows
                rows = more
                totals = c[is_total[-1]].tolist() if len(is_total) else totals
                before = b.slice(len(b) - 1)
            if head is not None:
                tail = [repr(before.column(i)[0].as_py()) for i in range(n_keys + 1)]
                yield pa.RecordBatch.from_pydict({R: [number], "head": [head], "tail": [tail], "value": [value], "sums": [sums.tolist()], "one": [one], "totals": [totals], "rows": [rows.tolist()]}, schema)

        strings, longs = pa.list_(pa.string()), pa.list_(pa.int64())
        schema = pa.schema([(R, pa.int32()), ("head", strings), ("tail", strings), ("value", pa.float64()), ("sums", longs), ("one", pa.bool_()), ("totals", longs), ("rows", longs)])
        seen = self.flat.mapInArrow(
            summary, f"{R} int, head array<string>, tail array<string>, value double, sums array<long>, one boolean, totals array<long>, rows array<long>").collect()
        sizes: dict[int, int] = {}
        for s in seen:          # one row for each range
            for i, n in enumerate(s["rows"]):
                sizes[i + TOTALS] = sizes.get(i + TOTALS, 0) + n
        return carries(seen, n_keys, k), sizes

    def _scan(self, emit, schema: str) -> DataFrame:
        """``emit`` gets, for rows in order: the batch, their running and total
        class counts, the next value (NaN at the last), and the starts."""
        n_keys, k = len(self.keys), self.k
        sent = self.carries

        def run(batches):
            nothing = Carry(False, False, [0] * k, None, None)
            carry, held, flags = None, None, (True, True)
            state = {}

            def rows(b, n, group, pair, after):
                c, p, v = _counts(b, n_keys)[:n], b.column(n_keys).to_numpy()[:n], b.column(n_keys + 1).to_numpy(zero_copy_only=False)
                at = np.arange(n)
                start = np.maximum.accumulate(np.where(pair[:n], at, -1))
                cum = np.vstack([np.zeros((1, k), np.int64), np.cumsum(c, axis=0)])
                base = np.where((start >= 0)[:, None], cum[np.maximum(start, 0)], -state["run"])
                below = cum[1:] - base
                total_at = np.maximum.accumulate(np.where(p == TOTALS, at, -1))
                total = np.where((total_at >= 0)[:, None], c[np.maximum(total_at, 0)], state["totals"])
                follows = np.append(v[1:n], v[n] if len(v) > n else np.nan)
                follows = np.where(np.append(pair[1:n], pair[n] if len(v) > n else True), np.nan, follows)
                if len(v) == n and after is not None:
                    follows[-1] = after
                state["run"], state["totals"] = below[-1], total[-1]
                yield from emit(b.slice(0, n), p, v[:n], c, below, total, follows, pair[:n])

            for b in batches:
                if not len(b):
                    continue
                number, b = b.column(b.num_columns - 1)[0].as_py(), b.select(range(b.num_columns - 1))
                if carry is None:
                    carry = sent.get(number, nothing)
                    flags = (not carry.same_group, not carry.same_pair)
                    state = {"run": np.array(carry.run, np.int64), "totals": np.array(carry.totals or [0] * k, np.int64)}
                if held is not None:
                    b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
                group, pair = _starts(b, n_keys, flags)
                if len(b) > 1:
                    yield from rows(b, len(b) - 1, group, pair, None)
                held, flags = b.slice(len(b) - 1), (group[-1], pair[-1])
            if held is not None:
                yield from rows(held, 1, *[np.array([f]) for f in flags], carry.after)

        return self.flat.mapInArrow(run, schema)

    def _packed(self, df: DataFrame) -> DataFrame:
        """The key columns as ``_g`` again."""
        if self.group.typeName() != "struct":
            return df.withColumnRenamed(self.keys[0], G)
        whole = F.struct(*[F.col(n).alias(f.name) for n, f in zip(self.keys, self.group.fields)])
        return df.select(whole.alias(G), *[c for c in df.columns if c not in self.keys])

    def candidates(self) -> DataFrame:
        """(_g, _p, _vd, _next, threshold, gain, iv, lt_counts, class_counts):
        a threshold between each value and the next."""
        n_keys, disc = len(self.keys), self.discrete

        def emit(b, p, v, c, below, total, follows, pair):
            at = np.flatnonzero((p >= 0) & ~np.isin(p, disc) & ~np.isnan(follows))
            if len(at):
                t, gain, iv = measures(v[at], follows[at], below[at], total[at])
                yield pa.RecordBatch.from_arrays([*[b.column(i).take(pa.array(at)) for i in range(n_keys + 1)], pa.array(v[at]), pa.array(follows[at]),
                                                  pa.array(t), pa.array(gain), pa.array(iv), _lists(below[at]), _lists(total[at])],
                                                 names=[*self_keys, P, VD, "_next", "threshold", "gain", "iv", "lt_counts", "class_counts"])

        self_keys = self.keys
        schema = ", ".join([f"{n} {t}" for n, t in zip(self.keys, self.kinds)] + [
            f"{P} int, {VD} double, _next double, threshold double, gain double, iv double, lt_counts array<long>, class_counts array<long>"])
        return self._packed(self._scan(emit, schema))

    def stats(self) -> DataFrame:
        """(_g, _p, n_values, threshold, gain, iv, ratio, lt_counts,
        class_counts): a row for each (group, feature). A continuous feature has
        its best threshold - the largest gain, ties to the largest threshold -
        or nulls if it has one value."""
        n_keys, disc, self_keys = len(self.keys), self.discrete, self.keys

        def emit(b, p, v, c, below, total, follows, pair):
            n = len(p)
            seg = np.flatnonzero(pair | (np.arange(n) == 0))
            is_disc, score = np.isin(p, disc), np.full(n, -1.0)
            t, gain, iv = np.full(n, np.nan), np.full(n, np.nan), np.full(n, np.nan)
            at = np.flatnonzero((p >= 0) & ~is_disc & ~np.isnan(follows))
            if len(at):
                t[at], gain[at], iv[at] = measures(v[at], follows[at], below[at], total[at])
                score[at] = np.round(gain[at], COMPARE_DIGITS)
            length = np.diff(np.append(seg, n))
            top = score == np.repeat(np.maximum.reduceat(score, seg), length)
            best = np.maximum.reduceat(np.where(top, np.arange(n), -1), seg)
            sums = [np.add.reduceat(np.where(is_disc, x, 0.0), seg) for x in (xl(c.sum(axis=1)), xl(c).sum(axis=1))]
            use = p[seg] >= 0
            if use.any():
                best, first = best[use], pa.array(seg[use])
                found = pa.array(score[best] < 0)
                yield pa.RecordBatch.from_arrays([
                    *[b.column(i).take(first) for i in range(n_keys + 1)], pa.array(length[use]), *[pa.array(x[use]) for x in sums], pa.array(score[best]),
                    pa.array(np.where(np.isnan(v[best]), 0.0, v[best])), *[pc.if_else(found, None, pa.array(x[best])) for x in (t, gain, iv)],
                    _lists(below[best]), _lists(total[best])],
                    names=[*self_keys, P, "nv", "sv", "svk", "score", "v", "threshold", "gain", "iv", "lt", "cc"])

        schema = ", ".join([f"{n} {t}" for n, t in zip(self.keys, self.kinds)] + [
            f"{P} int, nv long, sv double, svk double, score double, v double, threshold double, gain double, iv double, lt array<long>, cc array<long>"])
        parts = self._scan(emit, schema)
        if self.n > 1:
            parts = parts.repartition(*self.keys)       # a row for each (group, feature) and range
        pairs = parts.groupBy(*self.keys, P).agg(*map(F.expr, (
            "sum(nv) AS n_values", "sum(sv) AS sv", "sum(svk) AS svk", "max(cc) AS class_counts", "max(struct(score, v, threshold, gain, iv, lt)) AS b")))
        cc = [f"class_counts[{i}]" for i in range(self.k)]
        n = sum_sql(cc)
        known = pairs.selectExpr("*", f"{n} AS n", f"{xl_sql(n)} AS xn", f"{sum_sql(xl_sql(c) for c in cc)} AS sk",
                                 f"{P} IN ({', '.join(map(str, self.discrete or [TOTALS]))}) AS d")
        gain, iv = "(xn - sk - sv + svk) / n", "(xn - sv) / n"
        return self._packed(known.selectExpr(
            *self.keys, P, "n_values", "CASE WHEN NOT d THEN b.threshold END AS threshold",
            f"CASE WHEN d THEN greatest({gain}, 0D) ELSE b.gain END AS gain", f"CASE WHEN d THEN {iv} ELSE b.iv END AS iv",
            f"CASE WHEN d THEN CASE WHEN n_values > 1 AND xn - sv > 0 THEN ({gain}) / ({iv}) ELSE 0D END "
            "WHEN b.gain IS NOT NULL THEN CASE WHEN b.iv > 0 THEN b.gain / b.iv ELSE 0D END END AS ratio",
            "CASE WHEN NOT d AND b.gain IS NOT NULL THEN b.lt END AS lt_counts", "class_counts"))


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(np.ascontiguousarray(x).ravel()))


def measures(v: np.ndarray, nxt: np.ndarray, below: np.ndarray, total: np.ndarray):
    """Threshold, gain (at least 0) and intrinsic value between ``v`` and ``nxt``.
    A midpoint that rounds onto the lower value gives way to the upper one."""
    with np.errstate(over="ignore"):
        mid = (v + nxt) / 2.0
    t = np.where((mid > v) & (mid <= nxt), mid, nxt)
    n, n_below = total.sum(axis=1), below.sum(axis=1)
    above = total - below
    whole, low, high = xl(n), xl(n_below), xl(n - n_below)
    after = low - xl(below).sum(axis=1) + high - xl(above).sum(axis=1)
    return t, np.maximum((whole - xl(total).sum(axis=1) - after) / n, 0.0), (whole - low - high) / n
