"""Reduced-error pruning (G5, G6) as one routing pass plus a fold.

Turning node X into a leaf only changes the rows that reach X, so "whole-tree
accuracy does not fall" is "rows X gets right as a leaf (its training
majority) >= rows its current, already pruned, subtree gets right".  The
holdout is routed once through the grown tree keeping each row's path; one
aggregate gives for every node what it gets right as a leaf and what its
default (values without a child) gets right. The fold runs over subtrees: the
node table is cut into bands of depths, the subtrees of a band are dealt to
groups of about ``FOLD_NODES`` nodes, and each group is folded bottom-up in one
task; a band takes over what the one below has kept. A tree of up to
``FOLD_NODES`` nodes is one group. A node that no holdout row reaches is pruned
(0 >= 0), as in the node-by-node procedure.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gainkit.operators.score import route
from gainkit.operators.tree import TreeModel
from gainkit.session import Scratch

FOLD_NODES = 500_000
BAND = 4            # depths of a band below the top one


def node_hits(model: TreeModel, df: DataFrame, label: str | None = None) -> DataFrame:
    """(node_id, n_reach, leaf_ok, default_ok): holdout rows reaching each node,
    how many of them the node would get right as a leaf, and how many its
    default gets right now."""
    label = label or model.label
    routed = route(model, df, keep=[label], with_path=True)
    # of a row that took a default, the node before the last one of its path gave it
    kept = F.when(F.col("defaulted"), F.slice("path", 1, F.size("path") - 1)).otherwise(F.col("path"))
    steps = F.transform(kept, lambda x, i: F.struct(x.alias("node_id"), (F.col("defaulted") & (i == F.size("path") - 2)).alias("_d")))
    per = (routed.select(F.explode(steps).alias("_s"), F.col(label).cast("string").alias("_y")).select("_s.*", "_y")
           .groupBy("node_id", "_y").agg(F.count(F.lit(1)).alias("_n"), F.count_if("_d").alias("_nd")))
    labels = model.nodes.select("node_id", F.when(F.col("is_leaf"), F.col("prediction")).otherwise(F.col("majority")).alias("_as_leaf"), "majority")
    right = lambda n, as_: F.sum(F.when(F.col("_y") == F.col(as_), F.col(n)).otherwise(0))
    return per.join(labels, "node_id").groupBy("node_id").agg(
        F.sum("_n").alias("n_reach"), right("_n", "_as_leaf").alias("leaf_ok"), right("_nd", "majority").alias("default_ok"))


def fold(nodes: pa.Table) -> pa.Table:
    """(node_id, parent_id, pruned, kept_ok) of whole subtrees given as
    (node_id, parent_id, depth, is_leaf, leaf_ok, other_ok)."""
    nodes = nodes.sort_by("node_id")
    ids, depth = nodes.column("node_id").to_numpy(), nodes.column("depth").to_numpy()
    parent = nodes.column("parent_id").fill_null(-1).to_numpy()
    leaf, leaf_ok = nodes.column("is_leaf").to_numpy(), nodes.column("leaf_ok").to_numpy()
    under, pruned, kept = nodes.column("other_ok").to_numpy().copy(), np.zeros(len(ids), bool), np.zeros(len(ids), np.int64)
    up = np.minimum(np.searchsorted(ids, parent), max(len(ids) - 1, 0))
    for d in np.unique(depth)[::-1]:
        at = np.flatnonzero(depth == d)
        pruned[at] = ~leaf[at] & (leaf_ok[at] >= under[at])
        kept[at] = np.where(leaf[at] | pruned[at], leaf_ok[at], under[at])
        own = at[ids[up[at]] == parent[at]]
        np.add.at(under, up[own], kept[own])
    return pa.table({"node_id": ids, "parent_id": nodes.column("parent_id"), "pruned": pruned, "kept_ok": kept})


def bands(per_depth: dict[int, int], fold_nodes: int = FOLD_NODES, band: int = BAND) -> list[tuple[int, int]]:
    """Depth ranges [a, b), the top one first."""
    end = max(per_depth, default=-1) + 1
    top, n = 0, 0
    while top < end and (n + per_depth.get(top, 0) <= fold_nodes or top == 0):
        n, top = n + per_depth.get(top, 0), top + 1
    return [(0, top)] + [(a, min(a + band, end)) for a in range(top, end, band)]


def _decisions(t: DataFrame, scratch: Scratch, fold_nodes: int) -> DataFrame:
    """(node_id, pruned) of every node, from the deepest band up."""
    per_depth = {r["depth"]: r["count"] for r in t.groupBy("depth").count().collect()}
    done: list[DataFrame] = []
    for a, b in reversed(bands(per_depth, fold_nodes)):
        part = t.where((F.col("depth") >= a) & (F.col("depth") < b))
        if done:
            # of the band below, only the subtrees' roots have parents here
            below = done[-1].groupBy(F.col("parent_id").alias("node_id")).agg(F.sum("kept_ok").alias("_below"))
            part = part.join(below, "node_id", "left").withColumn("other_ok", F.col("other_ok") + F.coalesce("_below", F.lit(0)))
        groups = -(-sum(per_depth.get(d, 0) for d in range(a, b)) // fold_nodes)
        part = part.withColumn("_g", F.pmod(F.xxhash64(F.get("path", F.lit(a))), F.lit(groups)))    # subtrees stay whole
        done.append(scratch.cut(part.select("_g", "node_id", "parent_id", "depth", "is_leaf", "leaf_ok", "other_ok").groupBy("_g").applyInArrow(
            fold, "node_id long, parent_id long, pruned boolean, kept_ok long")))
    return reduce(DataFrame.unionByName, done).select("node_id", "pruned")


def prune(model: TreeModel, df: DataFrame, label: str | None = None, fold_nodes: int = FOLD_NODES) -> TreeModel:
    """Pruned copy of ``model`` (pruned nodes become leaves with
    stop_reason 'pruned' and predict their training majority). Only the new
    tree's table stays; those of the levels are deleted."""
    scratch = Scratch(df.sparkSession, "prune")
    try:
        return _pruned(model, df, label, scratch, fold_nodes)
    finally:
        scratch.close()


def _pruned(model: TreeModel, df: DataFrame, label: str | None, scratch: Scratch, fold_nodes: int) -> TreeModel:
    hits = node_hits(model, df, label)
    t = scratch.cut(model.nodes.join(hits, "node_id", "left").select(
        "node_id", "parent_id", "depth", "path", "is_leaf", F.coalesce("leaf_ok", F.lit(0)).alias("leaf_ok"), F.coalesce("default_ok", F.lit(0)).alias("other_ok")))
    flags = _decisions(t, scratch, fold_nodes)
    cut = flags.where("pruned").select(F.col("node_id").alias("_anc"))
    ancestors = model.nodes.select("node_id", F.explode(F.slice("path", 1, F.size("path") - 1)).alias("_anc"))
    removed = ancestors.join(cut, "_anc").select("node_id").distinct()
    tree = model.nodes.join(removed, "node_id", "left_anti").join(flags, "node_id", "left")
    p = F.coalesce(F.col("pruned"), F.lit(False))
    split = ["split_feature", "split_kind", "split_pos", "threshold", "gain", "gain_ratio", "n_branches", "first_child"]
    new = {c: F.when(~p, F.col(c)) for c in split} | {
        "is_leaf": F.col("is_leaf") | p, "stop_reason": F.when(p, F.lit("pruned")).otherwise(F.col("stop_reason")),
        "prediction": F.when(p, F.col("majority")).otherwise(F.col("prediction"))}
    tree = tree.select(*[new[c].alias(c) if c in new else F.col(c) for c in model.nodes.columns])
    return model.with_nodes(Scratch(df.sparkSession, "tree").cut(tree))
