"""Registered queries that grow, prune and score whole trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from gainkit.functions.measures import REPORT_DIGITS as RD
from gainkit.operators.evaluate import repeated_holdout
from gainkit.operators.prune import prune
from gainkit.operators.sampling import hash_split
from gainkit.operators.score import accuracy, route
from gainkit.operators.tree import TreeModel, fit
from gainkit.plans import oracle as O
from gainkit.plans import oracle_tree as OT
from gainkit.plans.views import VIEWS, load_view

BIN = ["0", "1"]

TREE_OUT = ["node_id", "parent_id", "depth", "branch", "branch_value", "is_leaf", "stop_reason",
            "split_feature", "threshold", "n_rows", "majority", "prediction"]


def _tree_cols(tree):
    return tree.select(*TREE_OUT[:9], F.round("gain", RD).alias("gain"), F.round("gain_ratio", RD).alias("gain_ratio"),
                       *TREE_OUT[9:])


def _tuples(name):
    return [(s.name, s.kind) for s in VIEWS[name].spec]


def q_tree_root_rule(spark, sf):
    """F1-F8 for one level: the root split of the rule view and its leaves."""
    m = fit(load_view(spark, sf, "v_rule"), "class", list(VIEWS["v_rule"].spec), classes=BIN, max_depth=0)
    return _tree_cols(m.tree)


SQL_TREE_ROOT_RULE = O.tree_depth0_sql(VIEWS["v_rule"].sql, _tuples("v_rule"), BIN)


def q_tree_root_orders(spark, sf):
    m = fit(load_view(spark, sf, "v_orders"), "class", list(VIEWS["v_orders"].spec), classes=BIN, max_depth=0)
    return _tree_cols(m.tree)


SQL_TREE_ROOT_ORDERS = O.tree_depth0_sql(VIEWS["v_orders"].sql, _tuples("v_orders"), BIN)


def q_tree_root_docs(spark, sf):
    m = fit(load_view(spark, sf, "v_docs"), "class", list(VIEWS["v_docs"].spec), classes=BIN, max_depth=0)
    return _tree_cols(m.tree)


SQL_TREE_ROOT_DOCS = O.tree_depth0_sql(VIEWS["v_docs"].sql, _tuples("v_docs"), BIN)


def _two_levels(name):
    def q(spark, sf):
        m = fit(load_view(spark, sf, name), "class", list(VIEWS[name].spec), classes=BIN, max_depth=1)
        return _tree_cols(m.tree)
    q.__doc__ = f"F1-F9 over two levels of the {name} view (splits at depths 0 and 1)."
    return q


def q_holdout_accuracy_events(spark, sf):
    """Fit on the keyed train side, score the held-out side."""
    v = load_view(spark, sf, "v_events")
    train, test = hash_split(v, "event_id", (4, 1), 100)
    m = fit(train, "class", list(VIEWS["v_events"].spec), classes=BIN, max_depth=0)
    return accuracy(m, test)


SQL_HOLDOUT_ACCURACY_EVENTS = O.holdout_accuracy_depth0_sql(VIEWS["v_events"].sql, "event_id",
                                                            _tuples("v_events"), BIN)


def q_holdout_accuracy_docs(spark, sf):
    v = load_view(spark, sf, "v_docs")
    train, test = hash_split(v, "doc_id", (4, 1), 100)
    m = fit(train, "class", list(VIEWS["v_docs"].spec), classes=BIN, max_depth=0)
    return accuracy(m, test)


SQL_HOLDOUT_ACCURACY_DOCS = O.holdout_accuracy_depth0_sql(VIEWS["v_docs"].sql, "doc_id", _tuples("v_docs"), BIN)


def q_fit_docs(spark, sf):
    """the full tree (max depth 20) of the documents view."""
    m = fit(load_view(spark, sf, "v_docs"), "class", list(VIEWS["v_docs"].spec), classes=BIN)
    return _tree_cols(m.tree)


def q_fit_prune_orders(spark, sf):
    """Grow on the train side of the orders view, prune on the holdout."""
    v = load_view(spark, sf, "v_orders")
    train, test = hash_split(v, "o_orderkey", (4, 1), 100)
    m = fit(train, "class", list(VIEWS["v_orders"].spec), classes=BIN, max_depth=4)
    return _tree_cols(prune(m, test, "class").tree)


def q_repeated_holdout_docs(spark, sf):
    """Five keyed holdout rounds (seeds 100..500), pruned trees with
    splits at depths 0..3 (five full-depth fits are ``f_fit_docs`` five times)."""
    return repeated_holdout(load_view(spark, sf, "v_docs"), "class", key="doc_id", rounds=5,
                            spec=list(VIEWS["v_docs"].spec), classes=BIN, max_depth=3)


def _fit_full(name):
    def q(spark, sf):
        m = fit(load_view(spark, sf, name), "class", list(VIEWS[name].spec), classes=BIN)
        return _tree_cols(m.tree)
    q.__doc__ = f"F10/F12: the full tree (max depth 20) of the {name} view."
    return q


def _holdout_accuracy_full(name, key):
    def q(spark, sf):
        train, test = hash_split(load_view(spark, sf, name), key, (4, 1), 100)
        return accuracy(fit(train, "class", list(VIEWS[name].spec), classes=BIN), test)
    q.__doc__ = f"G1/G2/G4: the full tree (max depth 20) of the {name} view's train side, scored on the held-out side."
    return q


def q_fit_prune_orders_full(spark, sf):
    """The full tree (max depth 20) of the orders view's train side, pruned on the holdout."""
    v = load_view(spark, sf, "v_orders")
    train, test = hash_split(v, "o_orderkey", (4, 1), 100)
    m = fit(train, "class", list(VIEWS["v_orders"].spec), classes=BIN)
    return _tree_cols(prune(m, test, "class").tree)


def q_repeated_holdout_docs_full(spark, sf):
    """Five keyed holdout rounds (seeds 100..500) of full trees (max depth 20), pruned."""
    return repeated_holdout(load_view(spark, sf, "v_docs"), "class", key="doc_id", rounds=5,
                            spec=list(VIEWS["v_docs"].spec), classes=BIN)


def branch_paths(model: TreeModel, tree):
    """(node_id, path_of): the branch numbers from the root ('0', '0.2', ...)
    instead of ids, which depend on how wide the levels are."""
    steps = tree.select("node_id", F.posexplode("path").alias("at", "step"))
    branches = tree.select(F.col("node_id").alias("step"), F.coalesce("branch", F.lit(0)).alias("b"))
    return steps.join(branches, "step").groupBy("node_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "b"))), lambda x: x["b"]), ".").alias("path_of"))


def _full_tree(name):
    def q(spark, sf):
        m = fit(load_view(spark, sf, name), "class", list(VIEWS[name].spec), classes=BIN)
        tree = m.tree
        return tree.join(branch_paths(m, tree), "node_id").select(
            F.col("path_of").alias("path"), "depth", "is_leaf", "stop_reason", "split_feature", "threshold", F.round("gain", RD).alias("gain"),
            F.round("gain_ratio", RD).alias("gain_ratio"), "n_rows", "majority", "prediction")
    q.__doc__ = f"F1-F13: every node of the full tree (max depth 20) of the {name} view, by branch path."
    return q


def _null_bucket(name, max_depth):
    def q(spark, sf):
        m = fit(load_view(spark, sf, name), "class", list(VIEWS[name].spec), classes=BIN, max_depth=max_depth, handle_null="bucket")
        tree = m.tree
        return tree.join(branch_paths(m, tree), "node_id").select(
            F.col("path_of").alias("path"), "branch_value", "is_leaf", "stop_reason", "split_feature", "threshold", "n_rows", "prediction")
    q.__doc__ = f"F6 with handle_null='bucket': the tree of the {name} view, whose discrete features have nulls."
    return q


def _null_bucket_sql(name, max_depth):
    return OT.branch_values_sql(VIEWS[name].sql, _tuples(name), BIN, max_depth)


def _ledger(name):
    def q(spark, sf):
        m = fit(load_view(spark, sf, name), "class", list(VIEWS[name].spec), classes=BIN)
        return m.candidates().join(branch_paths(m, m.nodes), "node_id").select(
            F.col("path_of").alias("path"), "depth", "rank", "feature", "kind", "threshold", *[F.round(c, RD).alias(c) for c in (
                "gain", "intrinsic_value", "gain_ratio")], "n_values", F.round("mean_gain", RD).alias("mean_gain"), "qualified", "chosen")
    q.__doc__ = f"E9/F12: the candidates of every node of the {name} view's full tree, with their ranks."
    return q


def _sides_sql(name):
    """SQL of the train and test side as hash_split deals them (4:1, seed 100)."""
    side = f"('0x' || substr(md5(concat_ws('|', CAST({VIEWS[name].key} AS VARCHAR), '100')), 1, 8))::BIGINT / 4294967296.0 < 0.8"
    return (f"SELECT * FROM ({VIEWS[name].sql}) WHERE {side}", f"SELECT * FROM ({VIEWS[name].sql}) WHERE NOT ({side})")


def _pruned_tree(name):
    def q(spark, sf):
        train, test = hash_split(load_view(spark, sf, name), VIEWS[name].key, (4, 1), 100)
        m = fit(train, "class", list(VIEWS[name].spec), classes=BIN, prune_df=test)
        tree = m.tree
        return tree.join(branch_paths(m, tree), "node_id").select(
            F.col("path_of").alias("path"), "depth", "is_leaf", "stop_reason", "split_feature", "threshold", "n_rows", "prediction")
    q.__doc__ = f"F12/G5/G6: the full tree (max depth 20) of the {name} view's train side, pruned on the held-out side as part of the fit."
    return q


def _pruned_sql(name):
    return OT.pruned_sql(*_sides_sql(name), VIEWS[name].key, _tuples(name), BIN)


def _predictions(name, **options):
    def q(spark, sf):
        key = VIEWS[name].key
        train, test = hash_split(load_view(spark, sf, name), key, (4, 1), 100)
        m = fit(train, "class", list(VIEWS[name].spec), classes=BIN, **options)
        scored = route(m, test, keep=[key, "class"])
        tree = m.tree
        return scored.join(branch_paths(m, tree), "node_id").select(key, "class", F.col("path_of").alias("path"), "prediction")
    q.__doc__ = f"G1/G2: where every held-out row of the {name} view ends in the full tree of the train side, and its prediction."
    return q


def _predictions_positional(name):
    def q(spark, sf):
        key = VIEWS[name].key
        train, test = hash_split(load_view(spark, sf, name), key, (4, 1), 100)
        spec = list(VIEWS[name].spec)
        m = fit(train, "class", spec, classes=BIN, max_depth=3)
        # the features by place: other names, and the key beside them
        placed = test.select(F.col("class"), *[F.col(s.name).alias(f"_{i}") for i, s in enumerate(spec)])
        scored = route(m, placed, keep=["class", "_0"], positional=True)
        return scored.groupBy(F.col("_0").alias("first_feature"), "class", "prediction").agg(F.count(F.lit(1)).alias("n_rows"))
    q.__doc__ = f"G3: rows of the {name} view scored by position, counted by first feature, class and prediction."
    return q


def _predictions_sql(name, max_depth=20):
    train, test = _sides_sql(name)
    return OT.predictions_sql(train, test, VIEWS[name].key, _tuples(name), BIN, max_depth)


def _positional_sql(name, max_depth=3):
    train, test = _sides_sql(name)
    key, first = VIEWS[name].key, VIEWS[name].spec[0].name
    return (f"SELECT t.{first} AS first_feature, p.class, p.prediction, count(*) AS n_rows FROM ({OT.predictions_sql(train, test, key, _tuples(name), BIN, max_depth)}) p "
            f"JOIN ({test}) t ON p.{key} = t.{key} GROUP BY ALL")


TREE_QUERIES = {
    "f_tree_root_rule": (q_tree_root_rule, SQL_TREE_ROOT_RULE),
    "f_tree_root_orders": (q_tree_root_orders, SQL_TREE_ROOT_ORDERS),
    "f_tree_root_docs": (q_tree_root_docs, SQL_TREE_ROOT_DOCS),
    "f_tree_two_levels_docs": (_two_levels("v_docs"), O.tree_depth1_sql(VIEWS["v_docs"].sql, _tuples("v_docs"), BIN)),
    "f_tree_two_levels_orders": (_two_levels("v_orders"),
                                 O.tree_depth1_sql(VIEWS["v_orders"].sql, _tuples("v_orders"), BIN)),
    "f_tree_two_levels_events": (_two_levels("v_events"),
                                 O.tree_depth1_sql(VIEWS["v_events"].sql, _tuples("v_events"), BIN)),
    "g4_holdout_accuracy_events": (q_holdout_accuracy_events, SQL_HOLDOUT_ACCURACY_EVENTS),
    "g4_holdout_accuracy_docs": (q_holdout_accuracy_docs, SQL_HOLDOUT_ACCURACY_DOCS),
    "f_fit_docs": (q_fit_docs, None),
    "g5_fit_prune_orders": (q_fit_prune_orders, None),
    "g7_repeated_holdout_docs": (q_repeated_holdout_docs, None),
    "f_fit_rule": (_fit_full("v_rule"), None),
    "f_fit_orders": (_fit_full("v_orders"), None),
    "f_tree_full_docs": (_full_tree("v_docs"), OT.tree_sql(VIEWS["v_docs"].sql, _tuples("v_docs"), BIN)),
    "f_tree_full_rule": (_full_tree("v_rule"), OT.tree_sql(VIEWS["v_rule"].sql, _tuples("v_rule"), BIN)),
    "f_null_bucket_docs": (_null_bucket("v_gaps", 2), _null_bucket_sql("v_gaps", 2)),
    "g1_predictions_null_bucket_docs": (_predictions("v_gaps", handle_null="bucket"), _predictions_sql("v_gaps")),
    "g5_pruned_tree_docs": (_pruned_tree("v_docs"), _pruned_sql("v_docs")),
    "g5_pruned_tree_lines": (_pruned_tree("v_lines"), _pruned_sql("v_lines")),
    "f_splits_docs": (_ledger("v_docs"), OT.ledger_sql(VIEWS["v_docs"].sql, _tuples("v_docs"), BIN)),
    "g1_predictions_docs": (_predictions("v_docs"), _predictions_sql("v_docs")),
    "g3_predictions_by_position_docs": (_predictions_positional("v_docs"), _positional_sql("v_docs")),
    "g4_holdout_accuracy_events_full": (_holdout_accuracy_full("v_events", "event_id"), None),
    "g4_holdout_accuracy_docs_full": (_holdout_accuracy_full("v_docs", "doc_id"), OT.accuracy_of_sql(_predictions_sql("v_docs"))),
    "g5_fit_prune_orders_full": (q_fit_prune_orders_full, None),
    "g7_repeated_holdout_docs_full": (q_repeated_holdout_docs_full, None),
}
