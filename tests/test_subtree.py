"""Subtrees grown in tasks give the tree of the distributed levels."""

import random

import pytest
from pyspark.sql import functions as F

from gainkit import FeatureSpec, fit
from gainkit.operators.tree import TREE_COLUMNS
from tests import bruteforce as bf
from tests.test_tree import SPEC, make_rows, spark_spec, to_df


def nodes(model):
    """Every column of every node, the ledger's too, floats to 12 digits."""
    plain = lambda v: round(v, 12) if isinstance(v, float) else [plain(x) for x in v] if isinstance(v, (list, tuple)) else v
    return sorted(repr([plain(r[c]) for c in [*TREE_COLUMNS, "mean_gain", "candidates"]]) for r in model.nodes.collect())


@pytest.mark.parametrize("options", [{}, {"stop_rule": "all_constant"}, {"max_depth": 2}, {"id_limit": 100, "max_depth": 3}], ids=str)
def test_subtrees_in_tasks_give_the_same_nodes(spark, options):
    rows = make_rows(31, 260)
    for i in range(0, 40, 4):
        rows[i]["c1"] = float("nan") if i % 8 else -0.0
    df = to_df(spark, rows).repartition(3)
    whole = fit(df, "class", spark_spec(), subtree_cells=0, **options)
    want = nodes(whole)
    for cells in (60, 10**6):       # some nodes leave the levels early, or all below the root
        assert nodes(fit(df, "class", spark_spec(), subtree_cells=cells, **options)) == want


def test_subtrees_match_the_rules(spark):
    rows = make_rows(8, 200)
    ref, _ = bf.fit(rows, SPEC)
    for cells in (100, 10**6):
        assert bf.canon_spark(fit(to_df(spark, rows), "class", spark_spec(), subtree_cells=cells).tree.collect()) == bf.canon(ref)


def test_a_small_deep_tree_needs_few_jobs(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(str(rnd.randrange(2)), rnd.random(), rnd.random()) for _ in range(300)], "class string, a double, b double")
    tracker, group = spark.sparkContext.statusTracker(), "few-jobs"
    spark.sparkContext.setJobGroup(group, group)
    try:
        model = fit(df, "class", [FeatureSpec("a"), FeatureSpec("b")])
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(model.levels) >= 8 and len(tracker.getJobIdsForGroup(group)) <= 40


def test_nulls_as_a_value_in_subtrees(spark):
    rows = [dict(r, d1=None if r["id"] % 4 == 0 else r["d1"]) for r in make_rows(21, 220)]
    df = to_df(spark, rows)
    got = [fit(df, "class", spark_spec(), handle_null="bucket", subtree_cells=c) for c in (0, 120, 10**6)]
    assert nodes(got[0]) == nodes(got[1]) == nodes(got[2])
    assert got[2].nodes.where(F.col("branch_value").isNull() & F.col("parent_id").isNotNull()).count() > 0
