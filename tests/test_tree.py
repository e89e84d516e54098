"""Whole trees, pruned trees and predictions against the brute-force rules."""

import random

import pytest

from gainkit import FeatureSpec, accuracy, fit, predict, prune
from tests import bruteforce as bf

SPEC = [("d1", "discrete"), ("c1", "continuous"), ("d2", "discrete"), ("c2", "continuous")]


def make_rows(seed, n, const=()):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        d1 = rnd.choice("abc")
        d2 = rnd.choice(["x", "y"])
        c1 = float(rnd.randint(0, 9))
        c2 = rnd.choice([0.0, 0.5, 1.0, 1.5, 2.5])
        score = (c1 > 4) + (d1 == "a") + (c2 >= 1.0) * (d2 == "x") + (rnd.random() < 0.25)
        row = {"id": i, "class": str(int(score >= 2)) if seed % 3 else ["p", "q", "r"][score % 3],
               "d1": d1, "c1": c1, "d2": d2, "c2": c2}
        for f in const:
            row[f] = {"d1": "a", "c1": 1.0, "d2": "x", "c2": 0.5}[f]
        rows.append(row)
    return rows


def to_df(spark, rows):
    return spark.createDataFrame(rows, "id long, class string, d1 string, c1 double, d2 string, c2 double")


def spark_spec():
    return [FeatureSpec(n, k) for n, k in SPEC]


CASES = [
    (1, 60, (), 20, "first_constant"),
    (3, 90, (), 2, "first_constant"),
    (4, 150, ("d1",), 3, "first_constant"),
    (5, 150, ("d1",), 3, "all_constant"),
    (6, 80, ("c2",), 2, "all_constant"),
]


@pytest.mark.parametrize("seed,n,const,max_depth,rule", CASES)
def test_tree_matches_bruteforce(spark, seed, n, const, max_depth, rule):
    rows = make_rows(seed, n, const)
    ref, classes = bf.fit(rows, SPEC, max_depth=max_depth, stop_rule=rule)
    model = fit(to_df(spark, rows).repartition(5), "class", spark_spec(), max_depth=max_depth, stop_rule=rule)
    assert model.classes == classes
    assert bf.canon_spark(model.tree.collect()) == bf.canon(ref)


@pytest.mark.parametrize("seed", [11, 14])
def test_prune_and_predict_match_bruteforce(spark, seed):
    rows = make_rows(seed, 160)
    train, test = rows[:110], rows[110:]
    # a test row with a discrete value never seen in training
    test.append({"id": 999, "class": "1", "d1": "zz", "c1": 3.0, "d2": "q", "c2": 0.5})
    ref, classes = bf.fit(train, SPEC, max_depth=3)
    model = fit(to_df(spark, train), "class", spark_spec(), max_depth=3)
    got = {r["id"]: r["prediction"] for r in predict(model, to_df(spark, test)).collect()}
    assert got == {r["id"]: bf.predict(ref, r) for r in test}
    acc = accuracy(model, to_df(spark, test)).first()
    assert acc["accuracy"] == pytest.approx(bf.accuracy(ref, test))
    pruned = prune(model, to_df(spark, test), "class")
    bf.prune(ref, test)
    assert bf.canon_spark(pruned.tree.collect()) == bf.canon(ref)
    acc2 = accuracy(pruned, to_df(spark, test)).first()["accuracy"]
    assert acc2 >= acc["accuracy"] - 1e-12
    assert acc2 == pytest.approx(bf.accuracy(ref, test))


def test_same_tree_any_partitioning_and_blocks(spark):
    rows = make_rows(21, 300)
    df = to_df(spark, rows)
    a = bf.canon_spark(fit(df.coalesce(1), "class", spark_spec(), max_depth=2).tree.collect())
    b = bf.canon_spark(fit(df.repartition(13), "class", spark_spec(), range_rows=3, max_depth=2).tree.collect())
    c = bf.canon_spark(fit(df.repartition(7), "class", spark_spec(), checkpoint_interval=1,
                           broadcast_nodes=0, max_depth=2).tree.collect())
    assert a == b == c


def test_dense_ids_when_id_space_is_small(spark):
    rows = make_rows(22, 200)
    df = to_df(spark, rows)
    a = fit(df, "class", spark_spec(), max_depth=3)
    b = fit(df, "class", spark_spec(), id_limit=40, max_depth=3)
    assert bf.canon_spark(a.tree.collect()) == bf.canon_spark(b.tree.collect())
    ids = [r["node_id"] for r in b.tree.collect()]
    assert len(ids) == len(set(ids))
    assert [r["prediction"] for r in predict(b, df).orderBy("id").collect()] == \
           [r["prediction"] for r in predict(a, df).orderBy("id").collect()]


def test_edge_tables(spark):
    schema = "id long, class string, d1 string, c1 double, d2 string, c2 double"
    one = [{"id": 0, "class": "1", "d1": "a", "c1": 1.0, "d2": "x", "c2": 0.0}]
    t = fit(spark.createDataFrame(one, schema), "class", spark_spec()).tree.collect()
    assert len(t) == 1 and t[0]["stop_reason"] == "pure" and t[0]["prediction"] == "1"
    one_class = [dict(r, **{"class": "0"}) for r in make_rows(3, 40)]
    t = fit(spark.createDataFrame(one_class, schema), "class", spark_spec()).tree.collect()
    assert len(t) == 1 and t[0]["prediction"] == "0"
    const = [dict(r, d1="a", c1=1.0, d2="x", c2=0.0) for r in make_rows(1, 40)]
    t = fit(spark.createDataFrame(const, schema), "class", spark_spec()).tree.collect()
    assert len(t) == 1 and t[0]["stop_reason"] == "constant"
    empty = spark.createDataFrame([], schema)
    t = fit(empty, "class", spark_spec(), classes=["0", "1"]).tree.collect()
    assert len(t) == 1 and t[0]["stop_reason"] == "empty" and t[0]["prediction"] is None


def test_equal_gains_tie_to_last_feature(spark):
    # two features that are copies of each other: equal gain and ratio, last in spec order wins
    rows = [{"class": str(i % 2), "u": float(i % 2), "v": float(i % 2)} for i in range(20)]
    df = spark.createDataFrame(rows, "class string, u double, v double")
    t = fit(df, "class", [FeatureSpec("u"), FeatureSpec("v")]).tree.where("node_id = 0").first()
    assert t["split_feature"] == "v"
    ref, _ = bf.fit(rows, [("u", "continuous"), ("v", "continuous")])
    assert ref["feature"] == "v"


def test_two_thresholds_equal_gain_take_largest(spark):
    # classes 0,1,0 over values 1,2,3: thresholds 1.5 and 2.5 have equal gain
    rows = [{"class": c, "x": x} for x, c in [(1.0, "0"), (2.0, "1"), (3.0, "0")] for _ in range(3)]
    df = spark.createDataFrame(rows, "class string, x double")
    t = fit(df, "class", [FeatureSpec("x")]).tree.where("node_id = 0").first()
    assert t["threshold"] == 2.5
    ref, _ = bf.fit(rows, [("x", "continuous")])
    assert ref["threshold"] == 2.5


def test_null_policy(spark):
    rows = make_rows(5, 30)
    rows[3]["c1"] = None
    df = to_df(spark, rows)
    with pytest.raises(ValueError):
        fit(df, "class", spark_spec())
    m = fit(df, "class", spark_spec(), handle_null="drop")
    assert m.tree.where("node_id = 0").first()["n_rows"] == 29
