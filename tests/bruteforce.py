"""Plain-Python statement of the tree rules, applied row by row.

Used only by the tests to check the Spark operators on small tables.  It grows
the tree depth first and prunes node by node by recomputing whole-tree
accuracy, i.e. the slow, literal form of what the library does level-wise.
"""

from __future__ import annotations

import math
from decimal import ROUND_HALF_UP, Decimal

DIGITS = 12


def rnd(x: float, digits: int = DIGITS) -> float:
    return float(Decimal(repr(float(x))).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def entropy(labels, classes=None) -> float:
    n = len(labels)
    if n == 0:
        return 0.0
    out = 0.0
    for c in (classes if classes is not None else sorted(set(labels))):
        k = sum(1 for x in labels if x == c)
        if k:
            p = k / n
            out -= p * math.log2(p)
    return out


def split_info(parts, n) -> float:
    out = 0.0
    for size in parts:
        if size:
            p = size / n
            out -= p * math.log2(p)
    return out


def discrete_measures(rows, f, values, classes):
    n = len(rows)
    labels = [r["class"] for r in rows]
    cond = 0.0
    sizes = []
    for v in values:
        part = [r["class"] for r in rows if r[f] == v]
        sizes.append(len(part))
        cond += len(part) / n * entropy(part, classes)
    gain = max(entropy(labels, classes) - cond, 0.0)
    iv = split_info(sizes, n)
    ratio = gain / iv if sum(1 for s in sizes if s) > 1 and iv > 0 else 0.0
    return gain, iv, ratio


def midpoint(a, b):
    t = (a + b) / 2.0
    return t if a < t <= b else b


def continuous_best(rows, f, classes):
    """(threshold, gain, iv, ratio, n_values) or None when one value."""
    vals = sorted(set(r[f] for r in rows))
    if len(vals) < 2:
        return None
    n = len(rows)
    labels = [r["class"] for r in rows]
    h = entropy(labels, classes)
    best = None
    for a, b in zip(vals, vals[1:]):
        t = midpoint(a, b)
        ge = [r["class"] for r in rows if r[f] >= t]
        lt = [r["class"] for r in rows if r[f] < t]
        gain = max(h - len(ge) / n * entropy(ge, classes) - len(lt) / n * entropy(lt, classes), 0.0)
        key = (rnd(gain), t)
        if best is None or key >= best[0]:
            iv = split_info([len(ge), len(lt)], n)
            best = (key, t, gain, iv, gain / iv if iv > 0 else 0.0)
    _, t, gain, iv, ratio = best
    return t, gain, iv, ratio, len(vals)


def majority(rows, classes):
    counts = [sum(1 for r in rows if r["class"] == c) for c in classes]
    return classes[counts.index(max(counts))]


def candidates(rows, spec, remaining, root_values, classes):
    out = []
    for pos, (f, kind) in enumerate(spec):
        if f not in remaining:
            continue
        if kind == "discrete":
            gain, iv, ratio = discrete_measures(rows, f, root_values[f], classes)
            out.append(dict(pos=pos, feature=f, kind=kind, threshold=None, gain=gain, iv=iv, ratio=ratio))
        else:
            b = continuous_best(rows, f, classes)
            if b is not None:
                t, gain, iv, ratio, _ = b
                out.append(dict(pos=pos, feature=f, kind=kind, threshold=t, gain=gain, iv=iv, ratio=ratio))
    return out


def choose(cands):
    if not cands:
        return None
    gains = [rnd(c["gain"]) for c in cands]
    mean = rnd(sum(gains) / len(gains))
    qual = [c for c, g in zip(cands, gains) if g >= mean]
    return max(qual, key=lambda c: (rnd(c["ratio"]), c["pos"]))


def grow(rows, spec, classes, root_values, depth=0, remaining=None, max_depth=20,
         stop_rule="first_constant"):
    if remaining is None:
        remaining = [f for f, _ in spec]
    node = {"n": len(rows), "majority": majority(rows, classes) if rows else None}
    labels = set(r["class"] for r in rows)
    if len(labels) == 1:
        return {**node, "leaf": True, "reason": "pure", "pred": next(iter(labels))}
    if depth > max_depth:
        return {**node, "leaf": True, "reason": "depth", "pred": node["majority"]}
    if remaining:
        consts = [len(set(r[f] for r in rows)) == 1 for f in remaining]
        if (consts[0] if stop_rule == "first_constant" else all(consts)):
            return {**node, "leaf": True, "reason": "constant", "pred": node["majority"]}
    best = choose(candidates(rows, spec, remaining, root_values, classes))
    if best is None:
        return {**node, "leaf": True, "reason": "no_candidate", "pred": node["majority"]}
    f = best["feature"]
    kids = []
    if best["kind"] == "discrete":
        rest = [x for x in remaining if x != f]
        for v in root_values[f]:
            part = [r for r in rows if r[f] == v]
            if not part:
                kids.append({"n": 0, "leaf": True, "reason": "empty", "pred": node["majority"], "majority": None})
            else:
                kids.append(grow(part, spec, classes, root_values, depth + 1, rest, max_depth, stop_rule))
    else:
        t = best["threshold"]
        for part in ([r for r in rows if r[f] >= t], [r for r in rows if r[f] < t]):
            kids.append(grow(part, spec, classes, root_values, depth + 1, remaining, max_depth, stop_rule))
    return {**node, "leaf": False, "feature": f, "kind": best["kind"], "threshold": best["threshold"],
            "values": root_values[f] if best["kind"] == "discrete" else None,
            "gain": best["gain"], "ratio": best["ratio"], "children": kids}


def fit(rows, spec, classes=None, max_depth=20, stop_rule="first_constant"):
    classes = classes or sorted(set(r["class"] for r in rows))
    root_values = {f: sorted(set(r[f] for r in rows)) for f, k in spec if k == "discrete"}
    return grow(rows, spec, classes, root_values, 0, None, max_depth, stop_rule), classes


def predict(node, row):
    while not node["leaf"]:
        v = row[node["feature"]]
        if node["kind"] == "discrete":
            if v not in node["values"]:
                return None
            node = node["children"][node["values"].index(v)]
        else:
            node = node["children"][0 if v >= node["threshold"] else 1]
    return node["pred"]


def accuracy(tree, rows):
    if not rows:
        return None
    return sum(1 for r in rows if predict(tree, r) == r["class"]) / len(rows)


def prune(tree, rows):
    """Post-order, node by node: keep a node as a leaf when whole-tree
    accuracy on ``rows`` does not fall."""
    def visit(node):
        if node["leaf"]:
            return
        for c in node["children"]:
            visit(c)
        before = accuracy(tree, rows) or 0.0
        saved = dict(node)
        node.update(leaf=True, reason="pruned", pred=node["majority"])
        after = accuracy(tree, rows) or 0.0
        if after >= before:
            node.pop("children", None)
            return
        node.clear()
        node.update(saved)
    visit(tree)
    return tree


def canon(node, digits=9):
    """Comparable nested form of a brute-force tree."""
    if node["leaf"]:
        return ("leaf", node["pred"], node["reason"])
    t = None if node["threshold"] is None else round(node["threshold"], digits)
    return (node["feature"], t, tuple(canon(c, digits) for c in node["children"]))


def canon_spark(rows, digits=9):
    """Same nested form from collected rows of a TreeModel.tree."""
    by_id = {r["node_id"]: r for r in rows}
    kids = {}
    for r in rows:
        if r["parent_id"] is not None:
            kids.setdefault(r["parent_id"], []).append(r)

    def build(r):
        if r["is_leaf"]:
            return ("leaf", r["prediction"], r["stop_reason"])
        t = None if r["threshold"] is None else round(r["threshold"], digits)
        ch = sorted(kids.get(r["node_id"], []), key=lambda x: x["branch"])
        return (r["split_feature"], t, tuple(build(c) for c in ch))
    return build(by_id[0])
