"""The rest of a tree below nodes of few rows, grown where their rows are.

A level of a distributed fit costs the same number of jobs whatever its nodes
hold. Nodes below the root whose rows fit a task are therefore dealt to groups
with their rows, and each task grows the subtrees of its group, all nodes of a
level at once, by the rules of ``tree`` and the measures of ``ordered``.
Larger nodes stay distributed, whatever their depth.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from gainkit.functions.measures import COMPARE_DIGITS
from gainkit.operators.ordered import P, _lists, measures, xl

CANDIDATE = "struct<_p:int, threshold:double, gain:double, intrinsic_value:double, gain_ratio:double, n_values:long>"
#: what a group's task returns: a row for each node. ``_from``: the discrete
#: feature by which the parent was split, if inside the subtree
SUBTREE = ("path array<int>, depth int, branch int, branch_value string, _from int, stop_reason string, split_pos int, threshold double, "
           f"gain double, gain_ratio double, n_branches int, mean_gain double, candidates array<{CANDIDATE}>, class_counts array<long>")
ARROW = pa.schema([
    ("path", pa.list_(pa.int32())), ("depth", pa.int32()), ("branch", pa.int32()), ("branch_value", pa.string()), ("_from", pa.int32()),
    ("stop_reason", pa.string()), ("split_pos", pa.int32()), ("threshold", pa.float64()), ("gain", pa.float64()), ("gain_ratio", pa.float64()),
    ("n_branches", pa.int32()), ("mean_gain", pa.float64()), ("candidates", pa.list_(pa.struct([
        (P, pa.int32()), ("threshold", pa.float64()), ("gain", pa.float64()), ("intrinsic_value", pa.float64()), ("gain_ratio", pa.float64()),
        ("n_values", pa.int64())]))), ("class_counts", pa.list_(pa.int64()))])


def half_up(x: np.ndarray) -> np.ndarray:
    """Spark's ``round`` to ``COMPARE_DIGITS``, for small numbers."""
    scale = 10.0 ** COMPARE_DIGITS
    return np.floor(x * scale + 0.5) / scale


def counted(node: np.ndarray, value: np.ndarray, y: np.ndarray, k: int):
    """For rows in the order of node and value: node, value and class counts of each distinct (node, value)."""
    nan = np.isnan(value) if value.dtype.kind == "f" else np.zeros(len(value), bool)
    same = (node[1:] == node[:-1]) & ((value[1:] == value[:-1]) | (nan[1:] & nan[:-1]))
    first = np.concatenate([[True], ~same]) if len(node) else np.zeros(0, bool)
    place = np.cumsum(first) - 1
    n = int(first.sum())
    return node[first], value[first], np.bincount(place * k + y, minlength=n * k).reshape(n, k)


class Level:
    """Measures of every feature of every open node: arrays (nodes, features)."""

    def __init__(self, totals: np.ndarray, n_features: int):
        m = len(totals)
        self.totals, self.n = totals, totals.sum(axis=1)
        self.threshold, self.gain, self.iv, self.ratio = (np.full((m, n_features), np.nan) for _ in range(4))
        self.values = np.zeros((m, n_features), np.int64)

    def discrete(self, p: int, node: np.ndarray, c: np.ndarray) -> None:
        m = len(self.n)
        sv, svk = (np.bincount(node, weights=x, minlength=m) for x in (xl(c.sum(axis=1)), xl(c).sum(axis=1)))
        xn, found = xl(self.n), np.bincount(node, minlength=m)
        gain, iv = (xn - xl(self.totals).sum(axis=1) - sv + svk) / self.n, (xn - sv) / self.n
        self.values[:, p], at = found, found > 0
        self.gain[at, p], self.iv[at, p] = np.maximum(gain, 0.0)[at], iv[at]
        self.ratio[at, p] = np.where((found > 1) & (xn - sv > 0), gain / np.where(iv > 0, iv, 1.0), 0.0)[at]

    def continuous(self, p: int, node: np.ndarray, v: np.ndarray, c: np.ndarray) -> None:
        self.values[:, p] = np.bincount(node, minlength=len(self.n))
        start = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        length = np.diff(np.append(start, len(node)))
        below = np.cumsum(c, axis=0)
        below -= np.repeat(below[start] - c[start], length, axis=0)
        last = np.append(node[1:] != node[:-1], True)
        follows = np.where(last, np.nan, np.append(v[1:], np.nan))
        at = np.flatnonzero(~np.isnan(follows))
        if not len(at):
            return
        t, gain, iv = measures(v[at], follows[at], below[at], self.totals[node[at]])
        score = np.round(gain, COMPARE_DIGITS)
        start = np.flatnonzero(np.concatenate([[True], node[at][1:] != node[at][:-1]]))
        top = score == np.repeat(np.maximum.reduceat(score, start), np.diff(np.append(start, len(at))))
        best = np.maximum.reduceat(np.where(top, np.arange(len(at)), -1), start)    # ties: the largest threshold
        of = node[at][start]
        self.threshold[of, p], self.gain[of, p], self.iv[of, p] = t[best], gain[best], iv[best]
        self.ratio[of, p] = np.where(iv[best] > 0, gain[best] / np.where(iv[best] > 0, iv[best], 1.0), 0.0)

    def decide(self, used: np.ndarray, stop_rule: str):
        """(whether a feature is a candidate, mean gain, reason to stop or None, chosen feature or -1) of each node."""
        m, n_features = used.shape
        rows, valid = np.arange(m), ~used & ~np.isnan(self.gain)
        gain, ratio = half_up(np.where(valid, self.gain, 0.0)), half_up(np.where(valid, self.ratio, 0.0))
        mean, count = np.zeros(m), valid.sum(axis=1)
        for p in range(n_features):
            mean += gain[:, p]
        mean = np.where(count > 0, mean / np.maximum(count, 1), np.nan)
        if stop_rule == "first_constant":
            constant = (self.values[rows, np.argmin(used, axis=1)] == 1) & ~used.all(axis=1)
        else:
            constant = np.where(used, 0, self.values).max(axis=1) == 1
        stop = np.where(constant, "constant", np.where(count == 0, "no_candidate", None))
        fit = valid & (gain >= half_up(np.where(count > 0, mean, 0.0))[:, None])
        best = np.where(fit, ratio, -np.inf)
        pick = n_features - 1 - np.argmax(best[:, ::-1], axis=1)        # ties: the last feature
        return valid, mean, stop, np.where(stop == None, pick, -1)  # noqa: E711


def _paths(codes: np.ndarray, length: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(codes[np.arange(codes.shape[1])[None, :] < length[:, None]], pa.int32()))


def _table(nodes: dict, **more) -> pa.Table:
    n, cols = len(nodes["depth"]), {}
    for f in ARROW:
        x = more.get(f.name)
        cols[f.name] = pa.nulls(n, f.type) if x is None else x
    cols |= {"path": _paths(nodes["codes"], nodes["depth"]), "depth": pa.array(nodes["depth"], pa.int32()), "branch": pa.array(nodes["branch"], pa.int32()),
             "branch_value": nodes["value"], "_from": pa.array(nodes["from"], pa.int32(), mask=nodes["from"] < 0), "class_counts": _lists(nodes["counts"])}
    return pa.table([cols[f.name].cast(f.type) for f in ARROW], schema=ARROW)


def _decided(nodes: dict, level: Level, valid, mean, stop, pick, branches: np.ndarray) -> pa.Table:
    some, row = pick >= 0, np.arange(len(pick))
    at = np.maximum(pick, 0)
    chosen = lambda x: pa.array(x[row, at], mask=~some | np.isnan(x[row, at]))
    p = np.broadcast_to(np.arange(valid.shape[1], dtype=np.int32), valid.shape)[valid]
    threshold = level.threshold[valid]
    listed = pa.StructArray.from_arrays(
        [pa.array(p), pa.array(threshold, mask=np.isnan(threshold)), *[pa.array(x[valid]) for x in (level.gain, level.iv, level.ratio)], pa.array(level.values[valid])],
        fields=list(ARROW.field("candidates").type.value_type))
    ends = np.concatenate([[0], np.cumsum(valid.sum(axis=1))]).astype(np.int32)
    return _table(nodes, stop_reason=pa.array(stop.tolist(), pa.string()), split_pos=pa.array(pick.astype(np.int32), mask=~some), threshold=chosen(level.threshold),
                  gain=chosen(level.gain), gain_ratio=chosen(level.ratio), n_branches=pa.array(branches[at].astype(np.int32), mask=~some),
                  mean_gain=pa.array(mean, mask=np.isnan(mean)), candidates=pa.ListArray.from_arrays(pa.array(ends), listed))


def grow(rows: pa.Table, roots: pa.Table, discrete: list[bool], branches: list[int], k: int, max_depth: int, stop_rule: str) -> pa.Table:
    """The nodes of the subtrees below ``roots`` (node_id, depth, path, branch,
    branch_value, used, class_counts), themselves included, from their
    ``rows`` (node_id, _y, _f0 ..)."""
    n_features, branches = len(discrete), np.array(branches, np.int64)
    roots = roots.sort_by("node_id")
    m = len(roots)
    depth = roots.column("depth").to_numpy()
    nodes = {"depth": depth.copy(), "branch": roots.column("branch").to_numpy(), "value": roots.column("branch_value").combine_chunks().cast(pa.string()),
             "from": np.full(m, -1, np.int32), "counts": np.array(roots.column("class_counts").to_pylist(), np.int64).reshape(m, k),
             "codes": np.zeros((m, max(int(depth.max(initial=0)), max_depth + 1)), np.int32), "used": np.zeros((m, n_features), bool)}
    for i, (path, used) in enumerate(zip(roots.column("path").to_pylist(), roots.column("used").to_pylist())):
        nodes["codes"][i, :len(path)] = path
        nodes["used"][i, used] = True
    y = rows.column("_y").to_numpy().astype(np.int64)
    values = [rows.column(f"_f{i}").to_numpy() + (0 if d else 0.0) for i, d in enumerate(discrete)]      # no -0.0
    at = np.searchsorted(roots.column("node_id").to_numpy(), rows.column("node_id").to_numpy())
    order = [np.argsort(v, kind="stable") for v in values]
    out = []
    while len(nodes["depth"]):
        level = Level(nodes["counts"], n_features)
        for p in range(n_features):
            o = order[p][at[order[p]] >= 0]
            order[p] = o = o[np.argsort(at[o], kind="stable")]
            o = o[~nodes["used"][at[o], p]]
            if len(o):
                node, v, c = counted(at[o], values[p][o], y[o], k)
                level.discrete(p, node, c) if discrete[p] else level.continuous(p, node, v, c)
        valid, mean, stop, pick = level.decide(nodes["used"], stop_rule)
        out.append(_decided(nodes, level, valid, mean, stop, pick, branches))

        # every row goes to its child
        live = np.flatnonzero(at >= 0)
        split = np.where(at >= 0, pick[at], -1)
        branch = np.full(len(at), -1, np.int64)
        for p in np.unique(pick[pick >= 0]):
            mine = live[split[live] == p]
            branch[mine] = values[p][mine] if discrete[p] else values[p][mine] < level.threshold[at[mine], p]
        live = live[branch[live] >= 0]
        wide = int(branches.max(initial=1))
        keys, child = np.unique(at[live] * wide + branch[live], return_inverse=True)
        parent, b = keys // wide, (keys % wide).astype(np.int32)
        by = pick[parent]
        was_discrete = np.array(discrete, bool)[by]
        kids = {x: nodes[x][parent] for x in ("codes", "used")} | {
            "depth": nodes["depth"][parent] + 1, "branch": b, "from": np.where(was_discrete, by, -1).astype(np.int32),
            "counts": np.bincount(child * k + y[live], minlength=len(keys) * k).reshape(len(keys), k),
            "value": pa.array(np.where(b == 0, ">=", "<"), pa.string(), mask=was_discrete)}
        kids["codes"][np.arange(len(keys)), nodes["depth"][parent]] = b
        kids["used"][np.flatnonzero(was_discrete), by[was_discrete]] = True
        pure, deep = (kids["counts"] > 0).sum(axis=1) == 1, kids["depth"] > max_depth
        done = pure | deep
        pick_of = lambda which: {x: (v.filter(pa.array(which)) if isinstance(v, pa.Array) else v[which]) for x, v in kids.items()}
        ended = pick_of(done)
        out.append(_table(ended, stop_reason=pa.array(np.where(pure[done], "pure", "depth").tolist(), pa.string())))
        number = np.where(done, -1, np.cumsum(~done) - 1)
        at = np.full(len(at), -1, np.int64)
        at[live] = number[child]
        nodes = pick_of(~done)
    return pa.concat_tables(out) if out else ARROW.empty_table()
