"""Scoring with a fitted tree.

The node table of a tree of at most ``PACK_NODES`` nodes is packed into sorted
arrays, sent to every task once, and walked for whole Arrow batches: one scan,
one column expression, no join per level. Only the feature columns meet
Python, and only their codes and numbers. Larger trees are met level by level:
at depth d rows join the split nodes of that depth.

A row whose discrete value was not seen in training (or is null) stops at that
node and gets no prediction, which counts as wrong. A value that was seen, but
not at this node, leads to the split's default: the node's majority.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gainkit.operators.tree import BROADCAST_NODES, TreeModel, branch_sql, encode_features, fcol

PACK_NODES = 500_000    # nodes sent to every task at most (about 40 bytes each)


class Packed:
    """A tree as arrays over its node ids in ascending order."""

    def __init__(self, nodes: pa.Table, classes: list[str], kinds: list[bool]):
        nodes = nodes.sort_by("node_id")
        number = lambda c, none: pc.fill_null(nodes.column(c), none).to_numpy()
        label = lambda c: pc.fill_null(pc.index_in(nodes.column(c).cast(pa.string()), pa.array(classes, pa.string())), -1).to_numpy()
        self.ids, self.leaf = number("node_id", -1), number("is_leaf", True)
        self.pos, self.threshold, self.first = number("split_pos", -1), number("threshold", np.nan), number("first_child", -1)
        self.prediction, self.majority = label("prediction"), label("majority")
        self.classes, self.discrete = classes, kinds

    def walk(self, n: int, features: list[pa.Array]):
        """(node ids, class indexes or -1, whether by default, path of each row, path lengths)."""
        null = [pc.is_null(f).to_numpy(zero_copy_only=False) for f in features]
        value = [pc.fill_null(f, -1).to_numpy(zero_copy_only=False) for f in features]
        at, live = np.zeros(n, np.int64), np.arange(n)
        ids, label, default = np.zeros(n, np.int64), np.full(n, -1, np.int64), np.zeros(n, bool)
        paths, length = [np.full(n, self.ids[0])], np.ones(n, np.int64)
        while len(live):
            ended = live[self.leaf[at[live]]]
            ids[ended], label[ended] = self.ids[at[ended]], self.prediction[at[ended]]
            live = live[~self.leaf[at[live]]]
            node = at[live]
            pos, branch = self.pos[node], np.full(len(live), -1, np.int64)
            for p in np.unique(pos):
                mine = pos == p
                v = value[p][live[mine]]
                branch[mine] = np.where(null[p][live[mine]], -1, v if self.discrete[p] else v < self.threshold[node[mine]])
            stop = branch < 0
            ids[live[stop]] = self.ids[node[stop]]
            live, node, branch = live[~stop], node[~stop], branch[~stop]
            child = self.first[node] + branch
            step = np.full(n, -1, np.int64)
            step[live] = child
            paths.append(step)
            length[live] += 1
            place = np.minimum(np.searchsorted(self.ids, child), len(self.ids) - 1)
            absent = self.ids[place] != child
            ids[live[absent]], label[live[absent]], default[live[absent]] = child[absent], self.majority[node[absent]], True
            at[live] = place
            live = live[~absent]
        return ids, label, default, np.stack(paths, axis=1), length


def pack(model: TreeModel) -> Packed:
    """The tree's nodes on the driver: for at most ``PACK_NODES`` of them."""
    columns = ["node_id", "is_leaf", "split_pos", "threshold", "first_child", "prediction", "majority"]
    return Packed(model.nodes.select(*columns).toArrow(), model.classes, [s.discrete for s in model.spec])


def _walked(model: TreeModel, encoded: DataFrame) -> DataFrame:
    """Adds ``_walk``: node_id, prediction, defaulted, path."""
    sent = model.nodes.sparkSession.sparkContext.broadcast(pack(model))

    @F.arrow_udf("struct<node_id:long, prediction:string, defaulted:boolean, path:array<long>>")
    def walk(one, *features):
        tree = sent.value
        ids, label, default, paths, length = tree.walk(len(one), list(features))
        ends = pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32))
        path = pa.ListArray.from_arrays(ends, pa.array(paths[np.arange(paths.shape[1])[None, :] < length[:, None]]))
        prediction = pa.array(tree.classes, pa.string()).take(pa.array(label, mask=label < 0))
        return pa.StructArray.from_arrays([pa.array(ids), prediction, pa.array(default), path], names=["node_id", "prediction", "defaulted", "path"])

    # the first argument counts the rows of a tree without features
    return encoded.withColumn("_walk", walk(F.lit(0), *[F.col(fcol(i)) for i in range(len(model.spec))]))


def _joined(model: TreeModel, encoded: DataFrame, broadcast_nodes: int) -> DataFrame:
    """As :func:`_walked`, one join for each level."""
    cur = encoded.withColumns({"_id": F.lit(0).cast("long"), "_path": F.array(F.lit(0).cast("long")), "_default": F.lit(None).cast("string")})
    for d in sorted(model.levels):
        lvl = model.nodes.where((F.col("depth") == d) & ~F.col("is_leaf")).select(
            F.col("node_id").alias("_at"), "split_pos", "threshold", "first_child", "majority")
        if model.levels[d] <= broadcast_nodes:
            lvl = F.broadcast(lvl)
        cur = cur.join(lvl, F.col("_id") == F.col("_at"), "left")
        idx = F.expr(branch_sql(model.spec))
        moved = F.col("_at").isNotNull() & idx.isNotNull()
        cur = cur.withColumn("_next", F.when(moved, F.col("first_child") + idx).otherwise(F.col("_id"))).withColumns({
            "_path": F.when(moved, F.concat("_path", F.array("_next"))).otherwise(F.col("_path")),
            "_default": F.when(moved, F.col("majority")).when(F.col("_at").isNull(), F.col("_default")),
            "_id": F.col("_next")}).drop("_at", "split_pos", "threshold", "first_child", "majority", "_next")
    ends = model.nodes.select(F.col("node_id").alias("_end"), "prediction")
    if model.n_nodes <= broadcast_nodes:
        ends = F.broadcast(ends)
    cur = cur.join(ends, F.col("_id") == F.col("_end"), "left")
    absent = F.col("_end").isNull()
    return cur.withColumn("_walk", F.struct(
        F.col("_id").alias("node_id"), F.when(absent, F.col("_default")).otherwise(F.col("prediction")).alias("prediction"),
        absent.alias("defaulted"), F.col("_path").alias("path")))


def route(model: TreeModel, df: DataFrame, keep: list[str] | None = None, with_path: bool = False,
          pack_nodes: int = PACK_NODES, positional: bool = False, broadcast_nodes: int = BROADCAST_NODES) -> DataFrame:
    """``keep`` columns + ``node_id`` (the node where the row
    stopped), ``prediction`` (null when it stopped at an inner node) and with
    ``with_path`` the visited node ids and whether the last one is a child
    without training rows (``defaulted``).  ``positional=True`` reads features
    by position (every column except the label, in order) instead of by name."""
    if positional:
        cols = [c for c in df.columns if c != model.label]
        if len(cols) != len(model.spec):
            raise ValueError(f"expected {len(model.spec)} feature columns, got {len(cols)}")
        keep_cols = list(keep) if keep is not None else list(df.columns)
        df = df.select(*[F.col(c).alias(f"__k_{c}") for c in keep_cols],
                       *[F.col(c).alias(s.name) for c, s in zip(cols, model.spec)])
        out = route(model, df, [f"__k_{c}" for c in keep_cols], with_path, pack_nodes, False, broadcast_nodes)
        return out.select(*[F.col(f"__k_{c}").alias(c) for c in keep_cols],
                          *[c for c in out.columns if not c.startswith("__k_")])
    keep = list(keep) if keep is not None else list(df.columns)
    encoded = encode_features(df, model.spec, model.dictionary, model.dict_sizes, keep=keep)
    out = _walked(model, encoded) if model.n_nodes <= pack_nodes else _joined(model, encoded, broadcast_nodes)
    return out.select(*keep, "_walk.node_id", *(["_walk.path", "_walk.defaulted"] if with_path else []), "_walk.prediction")


def predict(model: TreeModel, df: DataFrame, positional: bool = False) -> DataFrame:
    """All input columns + ``prediction`` (string, null when unroutable)."""
    return route(model, df, positional=positional).drop("node_id")


def accuracy(model: TreeModel, df: DataFrame, label: str | None = None) -> DataFrame:
    """One row (n_rows, n_correct, accuracy); a missing prediction is wrong."""
    label = label or model.label
    scored = route(model, df, keep=[label])
    ok = F.col("prediction").eqNullSafe(F.col(label).cast("string")) & F.col("prediction").isNotNull()
    return scored.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(ok).alias("n_correct")).select(
        "n_rows", "n_correct",
        F.when(F.col("n_rows") > 0, F.col("n_correct") / F.col("n_rows")).alias("accuracy"))
