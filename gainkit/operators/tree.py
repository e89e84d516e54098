"""Grow a gain-ratio classification tree level by level.

A level has a histogram (rows per class for each value of each feature of each
node) and one ordered scan over it (see ``ordered``) that yields every measure
of every node. Nodes whose class counts already make them leaves are settled
when their parent splits, and their rows are read no more. Of the other nodes
only some are counted: where a child holds more than half of its parent's
rows, its histogram is the parent's minus those of its siblings, whenever that
handles fewer rows than counting would. Below the root, nodes of at most
``SUBTREE_CELLS`` row x class cells leave the levels: their rows are dealt to
tasks that grow the rest (see ``subtree``).

Node ids are given when the tree has ended: level d holds ids ``base_d + pos`` with ``pos < R_d``. A split node
owns the ids ``first_child .. first_child + B - 1`` with ``first_child =
base_{d+1} + pos * B`` (B = widest split of the level), so ids are computed on
the executors, are the same on every run and are unique. If the id range would
pass ``id_limit`` the split nodes of the level are numbered densely first. Until
then a node's path holds the branch numbers from the root.

Rules (kept from the reference algorithm):
* a node is a leaf when its rows have one class ('pure'), when its depth is
  above ``max_depth`` ('depth'), when its first remaining feature has one
  value ('constant', or all remaining features with
  ``stop_rule='all_constant'``), or when no candidate split exists
  ('no_candidate'); leaves predict the majority class, ties -> the earliest
  label in ``classes``;
* a discrete split has a child for each value seen at the root, in value
  order; the feature is not offered again below that node. Only children with
  rows are kept as nodes: a row with another known value gets the split's
  default, the majority of the split node. ``TreeModel.tree`` writes these
  children out as leaves ('empty');
* a continuous split makes child 0 (``>= t``) and child 1 (``< t``) and the
  feature stays available.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gainkit.functions.measures import COMPARE_DIGITS, rounded
from gainkit.operators.ordered import RANGE_ROWS, ThresholdScan, n_ranges, numbered
from gainkit.operators.split_search import G, P, VD, cnames, label_index, labels_of, value_class_counts
from gainkit.operators.subtree import CANDIDATE, SUBTREE, grow
from gainkit.session import Scratch
from gainkit.spec import CONTINUOUS, DISCRETE, FeatureSpec, check_spec, infer_spec

ID_LIMIT = 1 << 62
BROADCAST_NODES = 500_000       # nodes sent to every task at most,
BROADCAST_BYTES = 16_000_000    # and bytes of them
SUBTREE_CELLS = 1_000_000       # rows x classes of a node that a task takes over at most (about 200 bytes of memory each)
SAVED_ROWS = 5_000_000          # additions that make histograms by subtraction worth their extra steps
BROADCAST_DICT = 1_000_000      # values of one discrete feature sent to every task at most

TREE_COLUMNS = [
    "node_id", "parent_id", "depth", "branch", "branch_value", "path",
    "is_leaf", "stop_reason", "split_feature", "split_kind", "split_pos", "threshold",
    "gain", "gain_ratio", "n_branches", "first_child",
    "n_rows", "class_counts", "majority", "prediction",
]


@dataclass
class TreeModel:
    """A fitted tree. ``nodes`` is a written table with a row for each node that
    has rows: TREE_COLUMNS, ``mean_gain`` and ``candidates`` (what the node
    could have been split by, by feature position)."""

    nodes: DataFrame
    spec: list[FeatureSpec]
    classes: list[str]
    label: str
    dictionary: DataFrame                      # (_p, value, code) of discrete features
    dict_sizes: dict = field(default_factory=dict)
    max_depth: int = 20
    levels: dict = field(default_factory=dict)  # depth -> number of split nodes
    n_nodes: int = 0

    @property
    def feature_names(self) -> list[str]:
        return [s.name for s in self.spec]

    def with_nodes(self, nodes: DataFrame) -> "TreeModel":
        return _model(nodes, self.spec, self.classes, self.label, self.dictionary, self.dict_sizes, self.max_depth)

    @property
    def tree(self) -> DataFrame:
        """One row for each node, children without rows included."""
        whole = self.nodes.select(*TREE_COLUMNS)
        if not any(s.discrete for s in self.spec):
            return whole
        return whole.unionByName(self.empty_children())

    def empty_children(self) -> DataFrame:
        """The children that no training row reached, as leaves that predict
        their parent's majority: nodes x dictionary rows, so on request only."""
        splits = self.nodes.where(F.col("split_kind") == DISCRETE).select(
            F.col("node_id").alias("parent_id"), "depth", "path", "first_child", "majority", F.col("split_pos").alias(P))
        values = self.dictionary
        if sum(self.dict_sizes.values()) <= BROADCAST_DICT:     # few feature positions: one side goes to every task
            values = F.broadcast(values)
        every = splits.join(values, P).withColumn("node_id", F.col("first_child") + F.col("code"))
        none = lambda kind, *names: [F.lit(None).cast(kind).alias(n) for n in names]
        zero = F.lit(0).cast("long")
        return every.join(self.nodes.select("node_id"), "node_id", "left_anti").select(
            "node_id", "parent_id", (F.col("depth") + 1).alias("depth"), F.col("code").alias("branch"), F.col("value").alias("branch_value"),
            F.concat("path", F.array("node_id")).alias("path"), F.lit(True).alias("is_leaf"), F.lit("empty").alias("stop_reason"),
            *none("string", "split_feature", "split_kind"), *none("int", "split_pos"), *none("double", "threshold", "gain", "gain_ratio"),
            *none("int", "n_branches"), *none("long", "first_child"), zero.alias("n_rows"),
            F.array(*[zero] * len(self.classes)).cast("array<long>").alias("class_counts"), *none("string", "majority"), F.col("majority").alias("prediction"))

    def candidates(self) -> DataFrame:
        """The ledger of the fit: a row for each node and feature it could have
        been split by, with the rank (1 = chosen, if the node was split)."""
        names, kinds = (F.array(*[F.lit(x) for x in xs]) for xs in ([s.name for s in self.spec], [s.kind for s in self.spec]))
        g, r = (lambda x: rounded(x["gain"])), (lambda x: rounded(x["gain_ratio"]))
        order = F.transform("candidates", lambda x: F.struct((g(x) >= rounded(F.col("mean_gain"))).alias("qualified"), r(x).alias("r"), x[P].alias("p"), x.alias("x")))
        return self.nodes.where(F.size("candidates") > 0).select(
            "node_id", "depth", "is_leaf", "mean_gain", F.posexplode(F.sort_array(order, asc=False)).alias("rank", "c")).select(
            "node_id", "depth", (F.col("rank") + 1).alias("rank"), F.element_at(names, F.col(f"c.x.{P}") + 1).alias("feature"),
            F.element_at(kinds, F.col(f"c.x.{P}") + 1).alias("kind"), "c.x.threshold", "c.x.gain", "c.x.intrinsic_value", "c.x.gain_ratio", "c.x.n_values",
            "mean_gain", "c.qualified", ((F.col("rank") == 0) & ~F.col("is_leaf")).alias("chosen"))


def _model(nodes: DataFrame, spec, classes, label, dictionary, dict_sizes, max_depth) -> TreeModel:
    """The model over a written node table, with its counts per depth."""
    counts = nodes.groupBy("depth").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("is_leaf")).alias("split")).collect()
    return TreeModel(nodes, spec, classes, label, dictionary, dict_sizes, max_depth,
                     {r["depth"]: r["split"] for r in counts if r["split"]}, sum(r["n"] for r in counts))


# ---------------------------------------------------------------------------
# preparation: label index, discrete dictionaries, encoded rows
# ---------------------------------------------------------------------------

def fcol(pos: int) -> str:
    return f"_f{pos}"


def build_dictionary(df: DataFrame, spec: list[FeatureSpec], scratch: Scratch | None = None, nulls: bool = False) -> DataFrame:
    """(_p, value, code) for every discrete feature; codes follow value
    order, with ``nulls`` a null is the last value. The values of all features
    are numbered in one order over ranges."""
    d_pos = [i for i, s in enumerate(spec) if s.discrete]
    spark = df.sparkSession
    if not d_pos:
        return spark.createDataFrame([], "_p int, value string, code int")
    structs = [F.struct(F.lit(i).alias(P), F.col(spec[i].name).cast("string").alias("value")).alias(f"_d{i}")
               for i in d_pos]
    vals = (df.select(*structs).unpivot([], [f"_d{i}" for i in d_pos], "_f", "_s")
            .select("_s.*").where(F.lit(nulls) | F.col("value").isNotNull()).distinct())
    placed = numbered(vals, [P, F.col("value").asc_nulls_last()], "_n", scratch)
    first = placed.groupBy(P).agg(F.min("_n").alias("_first"))      # a row for each discrete feature
    return placed.join(F.broadcast(first), P).select(P, "value", (F.col("_n") - F.col("_first")).cast("int").alias("code"))


def encode_features(df: DataFrame, spec: list[FeatureSpec], dictionary: DataFrame,
                    dict_sizes: dict, keep: list[str] | None = None) -> DataFrame:
    """Rename features to f{pos}: discrete -> int code (null when unseen, as a
    null is unless training kept nulls), continuous -> double.  ``keep`` columns are carried along."""
    keep = list(keep or [])
    out = df.select(*keep, *[F.col(s.name).alias(fcol(i)) for i, s in enumerate(spec)])
    for i, s in enumerate(spec):
        c = fcol(i)
        if not s.discrete:
            out = out.withColumn(c, F.col(c).cast("double"))
            continue
        d = dictionary.where(F.col(P) == i).select(F.col("value").alias("_dv"), F.col("code").alias("_dc"))
        if dict_sizes.get(i, 0) <= BROADCAST_DICT:
            d = F.broadcast(d)
        out = (out.withColumn(c, F.col(c).cast("string"))
               .join(d, F.col(c).eqNullSafe(F.col("_dv")), "left")
               .withColumn(c, F.col("_dc")).drop("_dv", "_dc"))
    return out


def branch_sql(spec: list[FeatureSpec], pos: str = "split_pos", threshold: str = "threshold") -> str:
    """Child position of a row at its node, as SQL text: the code for a discrete
    split, 0 for value >= t and 1 for value < t; null when the row cannot go on."""
    cases = [f"WHEN {pos} = {i} THEN " + (fcol(i) if s.discrete else f"CASE WHEN {fcol(i)} >= {threshold} THEN 0 WHEN {fcol(i)} < {threshold} THEN 1 END")
             for i, s in enumerate(spec)]
    return f"(CASE {' '.join(cases)} END)" if cases else "CAST(NULL AS INT)"


# ---------------------------------------------------------------------------
# fit
# ---------------------------------------------------------------------------

def fit(df: DataFrame, label: str, spec: list[FeatureSpec] | None = None, classes=None,
        max_depth: int = 20, stop_rule: str = "first_constant", handle_null: str = "error",
        range_rows: int = RANGE_ROWS, checkpoint_interval: int = 1,
        broadcast_nodes: int = BROADCAST_NODES, id_limit: int = ID_LIMIT,
        prune_df: DataFrame | None = None, subtract: bool | None = None, subtree_cells: int | None = None) -> TreeModel:
    """grow a tree on ``df`` (label column + features) and, with
    ``prune_df``, prune it on that table.  Returns a :class:`TreeModel` whose
    ``nodes`` and ``dictionary`` are written tables; the tables of the levels
    are deleted when the fit ends or fails.  Every ``checkpoint_interval``
    levels the rows are written instead of cached.  ``subtract``: whether large
    children's histograms are taken from their parents' (None: by cost).
    ``subtree_cells``: rows x classes of a node below the root whose subtree one
    task grows (0: all levels are distributed; the tree is the same).
    None: ``SUBTREE_CELLS``, or 0 if ``subtract`` is given, which is about levels.
    ``handle_null``: rows with a null feature fail the fit ('error') or are left
    out ('drop'); with 'bucket' a null of a discrete feature is a value of its
    own, the last branch (``branch_value`` null), in training and in routing,
    while nulls of continuous features fail."""
    if stop_rule not in ("first_constant", "all_constant"):
        raise ValueError("stop_rule must be 'first_constant' or 'all_constant'")
    if handle_null not in ("error", "drop", "bucket"):
        raise ValueError("handle_null must be 'error', 'drop' or 'bucket'")
    spec = list(spec) if spec is not None else infer_spec(df, label)
    spec = [s if isinstance(s, FeatureSpec) else FeatureSpec(s, CONTINUOUS) for s in spec]
    check_spec(df, label, spec)
    if subtree_cells is None:
        subtree_cells = SUBTREE_CELLS if subtract is None else 0
    scratch, kept = Scratch(df.sparkSession, "fit"), Scratch(df.sparkSession, "tree")
    try:
        model = _grow(df, label, spec, classes, max_depth, stop_rule, handle_null, range_rows, checkpoint_interval,
                      broadcast_nodes, id_limit, subtract, subtree_cells, scratch, kept)
    except BaseException:
        kept.close()
        raise
    finally:
        scratch.close()
    if prune_df is None:
        return model
    from gainkit.operators.prune import prune
    pruned = prune(model, prune_df, label)
    kept.drop(model.nodes)
    return pruned


FRONTIER = ["node_id", "parent_id", "depth", "branch", "branch_value", "path", "used", "class_counts"]
TOTAL = "aggregate(class_counts, 0L, (a, x) -> a + x)"
#: node columns that only split nodes or decided ones have
SPLIT = {"split_feature": "string", "split_kind": "string", "split_pos": "int", "threshold": "double", "gain": "double", "gain_ratio": "double",
         "n_branches": "int", "mean_gain": "double", "candidates": f"array<{CANDIDATE}>"}


# The expressions of a level are SQL text: built once, one call each.

def _text(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _record(nodes: DataFrame, classes: list[str]) -> DataFrame:
    """Rows of the node table from frontier rows with a ``stop_reason`` and the
    columns of ``SPLIT`` they have; the rest are null."""
    labels = f"array({', '.join(map(_text, classes))})" if classes else "array(CAST(NULL AS STRING))"
    majority = f"CASE WHEN {TOTAL} > 0 THEN get({labels}, CAST(array_position(class_counts, array_max(class_counts)) AS INT) - 1) END"
    return nodes.selectExpr(
        *FRONTIER[2:6], "stop_reason IS NOT NULL AS is_leaf", "stop_reason",
        *[f"{c if c in nodes.columns else f'CAST(NULL AS {t})'} AS {c}" for c, t in SPLIT.items()],
        f"{TOTAL} AS n_rows", "class_counts", f"{majority} AS majority", f"CASE WHEN stop_reason IS NOT NULL THEN {majority} END AS prediction")


def _with_ids(records: DataFrame, scratch: Scratch, id_limit: int) -> DataFrame:
    """The node table of all records. Ids follow the branches from the root and
    the widest split of each level."""
    t = scratch.cut(records)
    levels = {r["depth"]: r for r in t.groupBy("depth").agg(F.count("split_pos").alias("n"), F.max("n_branches").alias("wide")).collect()}
    base, wide, dense, d, r_d = [0], [], [], 0, 1
    while d in levels and levels[d]["n"]:
        n, w = levels[d]["n"], levels[d]["wide"]
        r_next = r_d * w
        if base[d] + r_d + r_next > id_limit:
            dense.append(d)
            r_next = n * w
            if base[d] + r_d + r_next > id_limit:
                raise OverflowError(f"tree too wide for node ids up to {id_limit}")
        base.append(base[d] + r_d)
        wide.append(w)
        d, r_d = d + 1, r_next
    longs = lambda xs: f"array({', '.join(f'{x}L' for x in xs)})"
    bases, wides = longs(base), longs(wide or [0])
    t = t.selectExpr("*", "0L AS _pos", "array(0L) AS _ids")
    for a, b in zip([0, *dense], [*dense, d]):
        # places and ids of the levels after a, up to b
        step = f"x.p * get({wides}, x.i) + c"
        walk = (f"aggregate(slice(path, {a + 1}, {b - a}), named_struct('i', {a}, 'p', _pos, 'ids', _ids), (x, c) -> "
                f"named_struct('i', x.i + 1, 'p', {step}, 'ids', array_append(x.ids, get({bases}, x.i + 1) + {step})))")
        t = t.selectExpr(*[c for c in t.columns if c not in ("_pos", "_ids")], f"{walk} AS _w") \
            .selectExpr(*[c for c in t.columns if c not in ("_pos", "_ids")], "_w.p AS _pos", "_w.ids AS _ids")
        if b in dense:
            t = scratch.cut(t)
            placed = numbered(t.where(f"depth = {b} AND split_pos IS NOT NULL").select("_pos"), ["_pos"], "_n", scratch).select(F.col("_pos").alias("_was"), "_n")
            t = t.join(placed, (F.col("depth") >= b) & (F.col("_pos") == F.col("_was")), "left") \
                .withColumn("_pos", F.coalesce("_n", "_pos")).drop("_was", "_n")
    kept = {"node_id": "element_at(_ids, -1)", "parent_id": "get(_ids, size(_ids) - 2)", "path": "_ids",
            "first_child": f"CASE WHEN split_pos IS NOT NULL THEN get({bases}, depth + 1) + _pos * get({wides}, depth) END"}
    return t.selectExpr(*[f"{kept.get(c, c)} AS {c}" for c in [*TREE_COLUMNS, "mean_gain", "candidates"]])


def _subtrees(rows: list[DataFrame], roots: list[DataFrame], n_rows: int, limit: int, spec, dictionary, small_dictionary: bool, names: str, kinds: str,
              branches: list[int], k: int, max_depth: int, stop_rule: str) -> DataFrame:
    """Every node of the subtrees below ``roots``, themselves included: the
    columns that :func:`_record` reads. Nodes are dealt to groups with their rows."""
    rows, roots = reduce(DataFrame.unionByName, rows), reduce(DataFrame.unionByName, roots)
    groups = max(-(-2 * n_rows // limit), n_ranges(rows.sparkSession, n_rows))
    dealt = lambda df: df.withColumn("_g", F.pmod(F.xxhash64("node_id"), F.lit(groups))).groupBy("_g")
    discrete = [s.discrete for s in spec]
    grown = dealt(rows).cogroup(dealt(roots)).applyInArrow(lambda r, n: grow(r, n, discrete, branches, k, max_depth, stop_rule), SUBTREE)
    if any(discrete):
        values = dictionary.selectExpr(f"{P} AS _from", "code AS branch", "value AS _value")
        grown = grown.join(F.broadcast(values) if small_dictionary else values, ["_from", "branch"], "left") \
            .withColumn("branch_value", F.coalesce("branch_value", "_value"))
    return grown.selectExpr("*", f"get({names}, split_pos) AS split_feature", f"get({kinds}, split_pos) AS split_kind")


def _decided(stats: DataFrame, nodes: DataFrame, stop_rule: str, send) -> DataFrame:
    """The frontier columns of each node with its candidates, their mean gain,
    the chosen one (null for leaves) and the reason to stop. ``stats`` has a row
    for each node and feature; all of a node's meet in one list."""
    rows = stats.selectExpr(f"{G} AS node_id", P, "threshold", "gain", "iv AS intrinsic_value", "ratio AS gain_ratio", "n_values", "lt_counts") \
        .join(send(nodes), "node_id")
    of = ", ".join(f"'{c}', {c}" for c in (P, "threshold", "gain", "intrinsic_value", "gain_ratio", "n_values", "lt_counts"))
    node = rows.groupBy("node_id").agg(*[F.expr(f"first({c}) AS {c}") for c in FRONTIER[1:]], F.expr(
        f"sort_array(collect_list(CASE WHEN NOT array_contains(used, {P}) THEN named_struct({of}) END)) AS _f"))
    const = "get(_f, 0).n_values" if stop_rule == "first_constant" else "array_max(transform(_f, x -> x.n_values))"
    node = node.selectExpr(*FRONTIER, f"{const} AS _const", "filter(_f, x -> x.gain IS NOT NULL) AS _c")
    r = lambda x: f"round({x}, {COMPARE_DIGITS})"
    node = node.selectExpr("*", f"aggregate(_c, 0D, (a, x) -> a + {r('x.gain')}) / nullif(size(_c), 0) AS mean_gain",
                           "CASE WHEN _const = 1 THEN 'constant' WHEN size(_c) = 0 THEN 'no_candidate' END AS stop_reason")
    pick = f"array_max(transform(filter(_c, x -> {r('x.gain')} >= {r('mean_gain')}), x -> named_struct('r', {r('x.gain_ratio')}, 'p', x.{P}, 'x', x))).x"
    of = ", ".join(f"'{c}', x.{c}" for c in (P, "threshold", "gain", "intrinsic_value", "gain_ratio", "n_values"))
    return node.selectExpr(*FRONTIER, "mean_gain", "stop_reason", f"transform(_c, x -> named_struct({of})) AS candidates",
                           f"CASE WHEN stop_reason IS NULL THEN {pick} END AS _pick")


def _children(splits: DataFrame, counts: DataFrame, dictionary: DataFrame, small_dictionary: bool, spec: list[FeatureSpec], k: int, depth: int,
              max_depth: int, limit: int) -> DataFrame:
    """The children with rows of the split nodes of a level: frontier columns,
    why a child is a leaf whatever its features are (else null), its rows,
    whether it is open and holds more than half of its parent's rows
    (``_large``), and the id of its family's large child. ``counts``: the
    level's histogram, which has the values seen at each node."""
    parts, d_pos = [], [i for i, s in enumerate(spec) if s.discrete]
    if len(d_pos) < len(spec):
        above = "zip_with(class_counts, lt_counts, (a, b) -> a - b)"
        parts.append(splits.where(f"split_kind = '{CONTINUOUS}'").selectExpr("*", "explode(array(0, 1)) AS _b").selectExpr(
            "first_child + _b AS node_id", "node_id AS parent_id", "_b AS branch", "CASE WHEN _b = 0 THEN '>=' ELSE '<' END AS branch_value",
            "path", "used", f"CASE WHEN _b = 0 THEN {above} ELSE lt_counts END AS class_counts"))
    if d_pos:
        seen = counts.where(f"{P} IN ({', '.join(map(str, d_pos))})").selectExpr(
            f"{G} AS node_id", f"{P} AS split_pos", f"CAST({VD} AS INT) AS code", f"array({', '.join(cnames(k))}) AS _cc")
        values = dictionary.withColumnRenamed(P, "split_pos")
        many = splits.where(f"split_kind = '{DISCRETE}'").join(seen, ["node_id", "split_pos"]) \
            .join(F.broadcast(values) if small_dictionary else values, ["split_pos", "code"])
        parts.append(many.selectExpr("first_child + code AS node_id", "node_id AS parent_id", "code AS branch", "value AS branch_value",
                                     "path", "array_append(used, split_pos) AS used", "_cc AS class_counts"))
    kids = reduce(DataFrame.unionByName, parts)
    return _with_sizes(kids.selectExpr("node_id", "parent_id", f"{depth} AS depth", "branch", "branch_value", "array_append(path, branch) AS path",
                                       "used", "class_counts"), max_depth, limit)


def _with_sizes(kids: DataFrame, max_depth: int, limit: int = -1) -> DataFrame:
    """A node of at most ``limit`` rows that would be open is handed over to a task."""
    n = "size(filter(class_counts, x -> x > 0))"
    return kids.selectExpr("*", f"{TOTAL} AS _n").selectExpr("*", f"CASE WHEN {n} = 0 THEN 'empty' WHEN {n} = 1 THEN 'pure' WHEN depth > {max_depth} THEN 'depth' WHEN _n <= {limit} THEN 'handed' END AS stop_reason") \
        .selectExpr("*", "stop_reason IS NULL AND parent_id IS NOT NULL AND _n * 2 > sum(_n) OVER (PARTITION BY parent_id) AS _large") \
        .selectExpr("*", "max(CASE WHEN _large THEN node_id END) OVER (PARTITION BY parent_id) AS _of_large")


def _level_counts(rows: DataFrame, feats, k: int, front: DataFrame, before: DataFrame, taken: list[int], send, own: list, scratch: Scratch) -> DataFrame:
    """The histogram of a level's open nodes. For the feature positions
    ``taken``, only the rows flagged so are counted: a large child has its
    parent's counts (in ``before``) minus its siblings'. The former are written:
    else each level's plan would hold those of all levels above, and the driver
    keeps a plan's text for every step."""
    cs, of = cnames(k), f"{P} IN ({', '.join(map(str, taken))})"
    counted = value_class_counts(rows, F.col("node_id"), F.col("_y"), feats, k, coded=True, only="_counted",
                                 always=tuple(i for i, _, _ in feats if i not in taken)).persist(StorageLevel.MEMORY_AND_DISK)
    own.append(counted)
    open_ = front.where("stop_reason IS NULL").selectExpr(f"node_id AS {G}")
    parents = front.where("_large").selectExpr(f"parent_id AS {G}", "node_id AS _to")
    siblings = front.where("_of_large IS NOT NULL AND NOT _large").selectExpr(f"node_id AS {G}", "_of_large AS _to")
    moved = lambda df, to, sign: df.where(of).join(send(to), G).selectExpr(f"_to AS {G}", P, VD, *[f"{sign}{c} AS {c}" for c in cs])
    from_parents = scratch.cut(moved(before.select(G, P, VD, *cs), parents, ""))
    own.append(from_parents)
    rest = from_parents.unionByName(moved(counted, siblings, "-")) \
        .groupBy(G, P, VD).agg(*[F.expr(f"sum({c}) AS {c}") for c in cs]).where(" + ".join(cs) + " > 0")
    return counted.join(send(open_), G, "left_semi").select(G, P, VD, *cs).unionByName(rest)


def _taken(sizes: dict[int, int] | None, n_large: int, n_features: int, subtract: bool | None) -> list[int]:
    """The features (and the totals) whose counts large children take from
    their parents: those with few histogram rows for the rows it saves, as
    histogram rows are shuffled once more. Both ways give the same counts;
    below ``SAVED_ROWS`` additions in all, the extra steps cost more."""
    every = [-1, *range(n_features)]
    if subtract is not None or not n_large or sizes is None:
        return every if subtract and n_large else []
    few = [i for i in every if 2 * sizes.get(i, 0) < n_large]
    return few if sum(n_large - 2 * sizes.get(i, 0) for i in few) >= SAVED_ROWS else []


def _grow(df, label, spec, classes, max_depth, stop_rule, handle_null, range_rows, checkpoint_interval,
          broadcast_nodes, id_limit, subtract, subtree_cells, scratch: Scratch, kept: Scratch) -> TreeModel:
    spark = df.sparkSession
    base = df.select(F.col(label).cast("string").alias("_label"), *[F.col(s.name) for s in spec])
    if handle_null == "drop":
        base = base.dropna()
    classes = labels_of(base, "_label", classes)
    k = len(classes)

    dictionary = kept.cut(build_dictionary(base, spec, scratch, handle_null == "bucket"))
    dict_sizes = {r[P]: r["n"] for r in dictionary.groupBy(P).agg(F.count(F.lit(1)).alias("n")).collect()}
    small_dictionary = sum(dict_sizes.values()) <= BROADCAST_DICT

    rows = encode_features(base.withColumn("_y", label_index("_label", classes)), spec, dictionary, dict_sizes, keep=["_y"])
    rows = rows.withColumn("node_id", F.lit(0).cast("long")).persist(StorageLevel.MEMORY_AND_DISK)
    bad = reduce(lambda a, b: a | b, [F.col(fcol(i)).isNull() for i in range(len(spec))], F.col("_y").isNull())
    by_class = {(r["_y"], r["bad"]): r["count"] for r in rows.groupBy("_y", bad.alias("bad")).count().collect()}
    n_bad = sum(n for (_, b), n in by_class.items() if b)
    if n_bad:
        rows.unpersist()
        raise ValueError(f"{n_bad} rows have a null feature or a label outside {classes}; "
                         "use handle_null='drop' (or 'bucket' for discrete features) or clean the input")

    feats = [(i, fcol(i), s.kind) for i, s in enumerate(spec)]
    d_pos = [i for i, s in enumerate(spec) if s.discrete]
    names, kinds = (f"array({', '.join(map(_text, x))})" for x in ([s.name for s in spec], [s.kind for s in spec]))
    widths = [int(dict_sizes.get(i, 0)) if s.discrete else 2 for i, s in enumerate(spec)]
    branches, limit = f"array({', '.join(map(str, widths))})", subtree_cells // max(k, 1)
    node_bytes = 200 + 8 * (max_depth + k + 2 * len(spec))

    def sender(n: int):
        """Small tables of ``n`` nodes go to every task, others are shuffled."""
        return F.broadcast if n <= min(broadcast_nodes, BROADCAST_BYTES // node_bytes) else (lambda d: d)

    root = [(0, None, 0, None, None, [], [], [by_class.get((i, False), 0) for i in range(k)])]
    front = spark.createDataFrame(root, "node_id long, parent_id long, depth int, branch int, branch_value string, "
                                        "path array<int>, used array<int>, class_counts array<long>")
    front = _with_sizes(front, max_depth)
    n_rows, n_open = sum(by_class.values()), 1
    base_d, r_d, depth = 0, 1, 0
    records: list[DataFrame] = []
    scan, old_rows, written, taken = None, None, False, []
    handed_rows, handed, n_handed = [], [], 0
    while True:
        records.append(_record(front.where("stop_reason IS NOT NULL AND stop_reason <> 'handed'"), classes))
        nodes = front.where("stop_reason IS NULL").select(*FRONTIER)
        if not n_open:
            break
        if not spec:
            records.append(_record(nodes.withColumn("stop_reason", F.lit("no_candidate")), classes))
            break
        own: list[DataFrame] = []
        if taken:
            counts = _level_counts(rows, feats, k, front, scan.ranges, taken, sender(n_open), own, scratch)
        else:
            counts = value_class_counts(rows, F.col("node_id"), F.col("_y"), feats, k, coded=True)
        above, scan = scan, ThresholdScan(counts, k, d_pos, n_rows * (len(spec) + 1), range_rows)
        # written: the later steps of the level and the final tree read it
        dec = scratch.cut(_decided(scan.stats(), nodes, stop_rule, sender(n_open)))
        for done in own:
            done.unpersist()
        scratch.drop(*own)
        if above is not None:
            above.close()
        if old_rows is not None:
            old_rows.unpersist()
            if written:     # nothing is computed from them again
                scratch.drop(old_rows)

        split = dec.where("_pick IS NOT NULL")
        n_split, wide = split.agg(F.expr("count(1)"), F.expr(f"coalesce(max(get({branches}, _pick.{P})), 0)")).first()
        base_next, place, r_next = base_d + r_d, f"node_id - {base_d}", r_d * wide
        if base_next + r_next > id_limit:
            r_next = n_split * wide
            if base_next + r_next > id_limit:
                raise OverflowError(f"tree too wide for node ids up to {id_limit}")
            dec = dec.join(numbered(split.select("node_id"), ["node_id"], "_n", scratch), "node_id", "left")
            place = "_n"
        dec = dec.selectExpr(
            *FRONTIER, "stop_reason", "mean_gain", "candidates", f"get({names}, _pick.{P}) AS split_feature", f"get({kinds}, _pick.{P}) AS split_kind",
            f"_pick.{P} AS split_pos", "_pick.threshold AS threshold", "_pick.gain AS gain", "_pick.gain_ratio AS gain_ratio", "_pick.lt_counts AS lt_counts",
            f"get({branches}, _pick.{P}) AS n_branches", f"CASE WHEN _pick IS NOT NULL THEN {base_next} + ({place}) * {wide} END AS first_child")
        records.append(_record(dec, classes))
        if not n_split:
            break

        # the next frontier is written: this cuts the plan chain between levels
        splits = dec.where("first_child IS NOT NULL")
        depth += 1
        front = scratch.cut(_children(splits, scan.ranges, dictionary, small_dictionary, spec, k, depth, max_depth, limit))
        n_open, n_rows, n_large, n_roots, n_below = front.agg(F.expr("count_if(stop_reason IS NULL)"), F.expr("coalesce(sum(_n) FILTER (WHERE stop_reason IS NULL), 0)"),
                                            F.expr("coalesce(sum(_n) FILTER (WHERE _large), 0)"), F.expr("count_if(stop_reason = 'handed')"),
                                                                    F.expr("coalesce(sum(_n) FILTER (WHERE stop_reason = 'handed'), 0)")).first()
        route = splits.select("node_id", "split_pos", "threshold", "first_child")
        values = ["_y", *[fcol(i) for i in range(len(spec))]]
        moved = rows.join(sender(n_split)(route), "node_id").selectExpr(*values, f"first_child + {branch_sql(spec)} AS node_id")
        if n_roots:
            roots = front.where("stop_reason = 'handed'")
            handed.append(roots.select(*FRONTIER))
            handed_rows.append(scratch.cut(moved.join(sender(n_roots)(roots.select("node_id")), "node_id", "left_semi")))
            n_handed += n_below
        if not n_open:
            continue
        taken = _taken(scan.sizes, n_large, len(spec), subtract)
        counted = "((stop_reason IS NULL OR _of_large IS NOT NULL) AND NOT _large)" if taken else "(stop_reason IS NULL)"
        wanted = front.where(f"stop_reason IS NULL OR {counted}").selectExpr("node_id", f"{counted} AS _counted")
        nxt = moved.join(sender(2 * n_open)(wanted), "node_id")
        # written, the next level's plan starts from a table; else it is filled by
        # the next level's histogram. The parents' rows stay until then
        written = bool(checkpoint_interval) and depth % checkpoint_interval == 0
        nxt, old_rows = scratch.cut(nxt) if written else nxt.persist(StorageLevel.MEMORY_AND_DISK), rows
        rows = nxt
        base_d, r_d = base_next, r_next

    rows.unpersist()
    if old_rows is not None:
        old_rows.unpersist()
    if handed:
        records.append(_record(_subtrees(handed_rows, handed, n_handed, limit, spec, dictionary, small_dictionary, names, kinds, widths, k, max_depth, stop_rule), classes))
    nodes = kept.cut(_with_ids(reduce(DataFrame.unionByName, records), scratch, id_limit))
    if scan is not None:
        scan.close()
    return _model(nodes, spec, classes, label, dictionary, dict_sizes, max_depth)
