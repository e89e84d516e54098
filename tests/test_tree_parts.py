"""The parts of a fit: histograms by subtraction, sparse children, packed
routing, the fold over subtrees, the ledger of candidates."""

import random

import pytest
from pyspark.sql import functions as F

from gainkit import FeatureSpec, fit, predict, prune
from gainkit.operators import tree as tree_module
from gainkit.operators.prune import bands, prune as prune_tree
from gainkit.operators.rows import preview, rank_index, rows_at
from gainkit.operators.score import accuracy, route
from gainkit.operators.split_search import split_candidates
from gainkit.operators.tree import _taken, build_dictionary
from tests import bruteforce as bf
from tests.test_tree import SPEC, make_rows, spark_spec, to_df


@pytest.mark.parametrize("range_rows", [25, 20_000])
def test_subtraction_gives_the_same_tree(spark, range_rows, monkeypatch):
    rows = make_rows(31, 260)
    taken = []
    whole = tree_module._level_counts
    monkeypatch.setattr(tree_module, "_level_counts", lambda *a: taken.append(a[5]) or whole(*a))
    ref, _ = bf.fit(rows, SPEC, max_depth=2)
    for subtract in (True, False):
        model = fit(to_df(spark, rows).repartition(3), "class", spark_spec(), max_depth=2, subtract=subtract, range_rows=range_rows)
        assert bf.canon_spark(model.tree.collect()) == bf.canon(ref)
    assert taken and all(t == [-1, 0, 1, 2, 3] for t in taken)


def test_features_are_subtracted_where_that_is_cheaper():
    sizes = {-1: 4, 0: 30, 1: 5_000_000, 2: 20_000_000}
    assert _taken(sizes, 12_000_000, 3, None) == [-1, 0, 1]
    assert _taken(sizes, 1_000_000, 3, None) == [] == _taken(None, 10**9, 3, None) == _taken(sizes, 10**9, 3, False)
    assert _taken(sizes, 10, 3, True) == [-1, 0, 1, 2] and _taken(sizes, 0, 3, True) == []


def wide(n, values, seed=1):
    """A discrete feature of many values, most of them at few nodes."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        x, w = float(rnd.randint(0, 3)), f"w{rnd.randrange(values):04d}"
        rows.append({"id": i, "class": str(int((x > 1) ^ (int(w[1:]) % 3 == 0))), "d1": w, "c1": x, "d2": rnd.choice("xy"), "c2": 0.0})
    return rows


def test_wide_features_keep_the_children_they_have(spark):
    rows = wide(400, 150)
    spec = [FeatureSpec("c1"), FeatureSpec("d1", "discrete")]
    df = to_df(spark, rows)
    model = fit(df, "class", spec, max_depth=2, stop_rule="all_constant")
    ref, _ = bf.fit(rows, [("c1", "continuous"), ("d1", "discrete")], max_depth=2, stop_rule="all_constant")
    full = model.tree.collect()
    assert bf.canon_spark(full) == bf.canon(ref)
    assert model.nodes.where("n_rows = 0").count() == 0 and model.n_nodes == model.nodes.count()
    n_empty = sum(r["stop_reason"] == "empty" for r in full)
    assert len(full) == model.n_nodes + n_empty and len({r["node_id"] for r in full}) == len(full)
    # rows with values that other nodes have seen take the default
    test = wide(300, 160, seed=2)
    got = {r["id"]: r["prediction"] for r in predict(model, to_df(spark, test)).collect()}
    assert got == {r["id"]: bf.predict(ref, r) for r in test}
    assert n_empty == 0 or any(r["defaulted"] for r in route(model, to_df(spark, test), ["id"], with_path=True).collect())


def test_packed_and_joined_routing_agree(spark):
    rows = make_rows(14, 200)
    model = fit(to_df(spark, rows[:120]), "class", spark_spec(), max_depth=3)
    test = rows[120:] + [dict(rows[0], id=900, d1="zz"), dict(rows[0], id=901, d2=None), dict(rows[1], id=902, c1=None), dict(rows[2], id=903, c1=float("nan"))]
    df = to_df(spark, test).repartition(3)
    pick = lambda d: sorted(map(tuple, d.select("id", "node_id", "path", "defaulted", "prediction").collect()))
    packed = pick(route(model, df, ["id"], with_path=True))
    assert packed == pick(route(model, df, ["id"], with_path=True, pack_nodes=0))
    assert packed == pick(route(model, df, ["id"], with_path=True, pack_nodes=0, broadcast_nodes=0))
    by_id = {t[0]: t for t in packed}
    assert by_id[900][4] is None or "d1" not in {r["split_feature"] for r in model.nodes.collect()}
    plan = route(model, df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 2      # the dictionaries of the two discrete features
    positional = df.select(F.col("id").alias("a"), F.lit("?").alias("class"), F.col("d1").alias("p"), F.col("c1").alias("q"), F.col("d2").alias("r"), F.col("c2").alias("s"))
    got = predict(model, positional.drop("a"), positional=True)
    assert got.columns == ["class", "p", "q", "r", "s", "prediction"]
    assert sorted(str(r["prediction"]) for r in got.collect()) == sorted(str(t[4]) for t in packed)


def test_a_tree_without_features_and_an_empty_input(spark):
    df = spark.createDataFrame([("1",), ("0",), ("1",)], "class string")
    model = fit(df, "class", [])
    assert [(r["stop_reason"], r["prediction"]) for r in model.tree.collect()] == [("no_candidate", "1")]
    assert [r["prediction"] for r in predict(model, df).collect()] == ["1"] * 3
    assert accuracy(model, df.limit(0)).first()["n_rows"] == 0


@pytest.mark.parametrize("fold_nodes", [2, 6, 500_000])
def test_pruning_in_bands_of_subtrees(spark, fold_nodes):
    rows = make_rows(11, 220)
    train, test = rows[:150], rows[150:]
    ref, _ = bf.fit(train, SPEC, max_depth=4)
    model = fit(to_df(spark, train), "class", spark_spec(), max_depth=4)
    bf.prune(ref, test)
    pruned = prune_tree(model, to_df(spark, test), "class", fold_nodes=fold_nodes)
    assert bf.canon_spark(pruned.tree.collect()) == bf.canon(ref)
    reasons = {r["stop_reason"] for r in pruned.tree.collect()}
    assert "pruned" in reasons and None in reasons


def test_bands_cover_all_depths():
    for fold_nodes in (1, 10, 10**6):
        cut = bands({d: 2**d for d in range(12)}, fold_nodes)
        assert [d for a, b in cut for d in range(a, b)] == list(range(12))
    assert bands({}) == [(0, 0)] or bands({0: 1}) == [(0, 1)]


def test_fit_with_a_prune_table(spark):
    rows = make_rows(14, 200)
    train, test = to_df(spark, rows[:130]), to_df(spark, rows[130:])
    a = fit(train, "class", spark_spec(), max_depth=3, prune_df=test)
    b = prune(fit(train, "class", spark_spec(), max_depth=3), test)
    assert bf.canon_spark(a.tree.collect()) == bf.canon_spark(b.tree.collect())


def test_ledger_has_every_candidate(spark):
    rows = make_rows(4, 150)
    df = to_df(spark, rows)
    model = fit(df, "class", spark_spec(), max_depth=1)
    ledger = model.candidates()
    root = {r["feature"]: r for r in ledger.where("node_id = 0").collect()}
    want = {r["feature"]: r for r in split_candidates(df, "class", spark_spec()).collect()}
    assert root.keys() == want.keys()
    for f, r in root.items():
        assert r["gain"] == pytest.approx(want[f]["gain"]) and r["gain_ratio"] == pytest.approx(want[f]["gain_ratio"])
        assert (r["threshold"], r["n_values"], r["kind"]) == (want[f]["threshold"], want[f]["n_values"], want[f]["kind"])
    assert sorted(r["rank"] for r in root.values()) == [1, 2, 3, 4]
    chosen = {r["node_id"]: r["feature"] for r in ledger.where("chosen").collect()}
    assert chosen == {r["node_id"]: r["split_feature"] for r in model.nodes.where("NOT is_leaf").collect()}


def test_dictionary_codes_follow_value_order(spark):
    rnd = random.Random(5)
    values = [f"{rnd.randrange(10**6):06d}" for _ in range(3_000)]
    df = spark.createDataFrame([(v, rnd.choice(["a", "b", None])) for v in values], "u string, t string")
    d = build_dictionary(df, [FeatureSpec("u", "discrete"), FeatureSpec("t", "discrete")])
    got = {(r["_p"], r["value"]): r["code"] for r in d.collect()}
    assert got == {(0, v): i for i, v in enumerate(sorted(set(values)))} | {(1, "a"): 0, (1, "b"): 1}
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_nulls_as_a_value(spark):
    rnd = random.Random(9)
    rows = [dict(r, d1=None if rnd.random() < 0.3 else r["d1"], d2=None if rnd.random() < 0.2 else r["d2"]) for r in make_rows(21, 220)]
    filled = [dict(r, d1=r["d1"] or "~", d2=r["d2"] or "~") for r in rows]      # sorts last, as nulls do
    train, test = rows[:150], rows[150:]
    ref, _ = bf.fit(filled[:150], SPEC, max_depth=2)
    model = fit(to_df(spark, train), "class", spark_spec(), max_depth=2, handle_null="bucket")
    assert bf.canon_spark(model.tree.collect()) == bf.canon(ref)
    got = {r["id"]: r["prediction"] for r in predict(model, to_df(spark, test)).collect()}
    assert got == {r["id"]: bf.predict(ref, r) for r in filled[150:]}
    measured = {r["feature"]: r["n_values"] for r in split_candidates(to_df(spark, train), "class", spark_spec(), handle_null="bucket").collect()}
    assert measured["d1"] == 4 and measured["d2"] == 3
    broken = [dict(r, c1=None) if r["id"] == 3 else r for r in train]
    with pytest.raises(ValueError):
        fit(to_df(spark, broken), "class", spark_spec(), handle_null="bucket")


def test_rows_by_position_and_preview(spark):
    values = [(i, (i * 37) % 101) for i in range(500)]
    df = spark.createDataFrame(values, "i long, v int").repartition(5)
    want = sorted(values, key=lambda r: (-r[1], r[0]))
    order = [F.desc("v"), F.col("i")]
    got = sorted((r["at"], r["i"]) for r in rows_at(df, order, 90, 210, "at").collect())
    assert got == [(n, want[n][0]) for n in range(90, 210)]
    assert rows_at(df, order, 490, 600).columns == ["i", "v"] and rows_at(df, order, 490, 600).count() == 10
    assert [r["i"] for r in preview(df, 7, order).collect()] == [i for i, _ in want[:7]] and preview(df, 3).count() == 3
    assert "Window" not in rank_index(df, order)._jdf.queryExecution().executedPlan().toString()
