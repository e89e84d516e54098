"""Measures, thresholds, splits and curve steps against plain-Python
definitions, plus a DuckDB gate over a sample of the registered queries."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gainkit import best_threshold, entropy, gain_ratio, intrinsic_value
from gainkit.functions.curve import (even_grid, fixed_weights, minmax_scale, network_score, network_sql,
                                     squared_loss)
from gainkit.operators.aggregates import distinct_counts, majority_class
from gainkit.operators.sampling import exact_split, hash_split, kfold_assign, random_split
from gainkit.operators.split_search import all_thresholds
from tests import bruteforce as bf
from tests.conftest import SF0001


def rows(seed=3, n=150):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        g = rnd.choice("xy")
        x = float(rnd.randint(0, 12))
        d = rnd.choice(["a", "b", "c"])
        c = "1" if (x > 5) ^ (rnd.random() < 0.2) else "0"
        out.append({"id": i, "g": g, "x": x, "d": d, "class": c})
    return out


def test_entropy_gain_iv_by_group(spark):
    rs = rows()
    df = spark.createDataFrame(rs, "id long, g string, x double, d string, class string")
    e = {r["g"]: r["entropy"] for r in entropy(df, "class", by=["g"]).collect()}
    gr = {r["g"]: r for r in gain_ratio(df, "class", "d", by=["g"]).collect()}
    iv = {r["g"]: r["intrinsic_value"] for r in intrinsic_value(df, "x", by=["g"], threshold=5.5).collect()}
    for g in "xy":
        part = [r for r in rs if r["g"] == g]
        assert e[g] == pytest.approx(bf.entropy([r["class"] for r in part]), abs=1e-12)
        gain, ivd, ratio = bf.discrete_measures(part, "d", ["a", "b", "c"], ["0", "1"])
        assert gr[g]["gain"] == pytest.approx(gain, abs=1e-12)
        assert gr[g]["intrinsic_value"] == pytest.approx(ivd, abs=1e-12)
        assert gr[g]["gain_ratio"] == pytest.approx(ratio, abs=1e-12)
        n_ge = sum(1 for r in part if r["x"] >= 5.5)
        assert iv[g] == pytest.approx(bf.split_info([n_ge, len(part) - n_ge], len(part)), abs=1e-12)


@pytest.mark.parametrize("range_rows", [2, 40, 1_000_000])
def test_best_threshold_matches_bruteforce(spark, range_rows):
    rs = rows(7, 300)
    df = spark.createDataFrame(rs, "id long, g string, x double, d string, class string").repartition(9)
    got = {r["g"]: r for r in best_threshold(df, "class", ["x"], by=["g"], range_rows=range_rows).collect()}
    for g in "xy":
        t, gain, iv, ratio, nv = bf.continuous_best([r for r in rs if r["g"] == g], "x", ["0", "1"])
        assert got[g]["threshold"] == t
        assert got[g]["gain"] == pytest.approx(gain, abs=1e-12)
        assert got[g]["gain_ratio"] == pytest.approx(ratio, abs=1e-12)
        assert got[g]["n_values"] == nv


def test_all_thresholds_one_row_per_gap(spark):
    rs = rows(8, 100)
    df = spark.createDataFrame(rs, "id long, g string, x double, d string, class string")
    th = all_thresholds(df, "class", ["x"]).collect()
    assert len(th) == len(set(r["x"] for r in rs)) - 1
    for r in th:
        assert r["value"] < r["threshold"] <= r["next_value"]


def test_majority_and_distinct(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "0"), ("b", "1"), ("b", "1"), ("c", None)], "g string, class string")
    m = {r["g"]: r["majority"] for r in majority_class(df, "class", by=["g"], classes=["0", "1"]).collect()}
    assert m == {"a": "0", "b": "1", "c": None}
    d = distinct_counts(df, ["class"]).first()
    assert d["class_distinct"] == 3


def test_splits(spark):
    o = spark.read.parquet(f"{SF0001}/orders.parquet")
    n = o.count()
    a, b = hash_split(o, "o_orderkey", (4, 1), 100)
    a2, _ = hash_split(o.repartition(7), "o_orderkey", (4, 1), 100)
    assert a.count() + b.count() == n
    assert sorted(r[0] for r in a.select("o_orderkey").collect()) == \
           sorted(r[0] for r in a2.select("o_orderkey").collect())
    c, d = exact_split(o, "o_orderkey", (4, 1), 100)
    assert c.count() == int(n * 4 / 5) and d.count() == n - int(n * 4 / 5)
    assert c.join(d, "o_orderkey").count() == 0
    folds = {r["fold"] for r in kfold_assign(o, "o_orderkey", 5).collect()}
    assert folds <= set(range(5))
    r1, r2 = random_split(o, (4, 1), 100)
    assert r1.count() + r2.count() == n


def test_curve_steps(spark):
    e = spark.read.parquet(f"{SF0001}/events.parquet").select("event_id", "value")
    s = minmax_scale(e, ["value"]).collect()
    vals = [r["value"] for r in s]
    lo, hi = min(vals), max(vals)
    for r in s:
        assert r["value_scaled"] == pytest.approx((r["value"] - lo) / (hi - lo))
    w = fixed_weights()
    df = spark.createDataFrame([(0.0,), (0.3,), (1.0,)], "x double")
    a = [r[0] for r in df.select(network_score("x", *w)).collect()]
    b = [r[0] for r in df.select(F.expr(network_sql("x", *w))).collect()]
    assert a == pytest.approx(b)
    sig = lambda z: 1 / (1 + math.exp(-z))
    w1, b1, w2, b2, w3, b3 = w
    for x, got in zip([0.0, 0.3, 1.0], a):
        h1 = [sig(x * w1[0][j] + b1[j]) for j in range(5)]
        h2 = [sig(sum(h1[i] * w2[i][j] for i in range(5)) + b2[j]) for j in range(10)]
        assert got == pytest.approx(sum(h2[i] * w3[i][0] for i in range(10)) + b3[0])
    loss = squared_loss(spark.createDataFrame([(1.0, 0.0), (0.0, 0.0)], "y double, p double"), "y", "p").first()
    assert loss["loss"] == pytest.approx(0.5)
    g = even_grid(spark, 5).collect()
    assert [r["x"] for r in g] == [0.0, 0.25, 0.5, 0.75, 1.0]


GATE = ["e1_entropy", "e2_info_gain", "e8_best_threshold", "e9_rank_splits", "e10_best_split_docs",
        "c3_hash_split", "c2_exact_split", "a4_replicate", "i4_network_score", "f_tree_root_docs",
        "g4_holdout_accuracy_events", "d2_class_counts", "d5_distinct_counts", "f_tree_two_levels_orders"]


def test_oracle_gate_sf0001(spark):
    import duckdb

    from __spark_entry__ import oracle_sql, queries
    from gainkit.sources.tables import TABLES
    from tools.oracle_check import rows_of
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    qs, sqls = queries(), oracle_sql()
    for name in GATE:
        df = qs[name](spark, SF0001)
        got = [tuple(r) for r in df.collect()]
        res = con.execute(sqls[name])
        ocols = [d[0] for d in res.description]
        assert sorted(df.columns) == sorted(ocols), name
        assert rows_of(df.columns, got) == rows_of(ocols, res.fetchall()), name


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() >= 1
    assert "gain_ratio" in df.columns


def test_null_features_fail_or_go(spark):
    from gainkit import best_threshold
    from gainkit.operators.impurity import gain_ratio, info_gain
    df = spark.createDataFrame([("1", None)] * 3 + [("0", 1.0), ("1", 2.0), ("0", 3.0)], "class string, x double")
    clean = df.dropna()
    with pytest.raises(Exception, match="null feature"):
        best_threshold(df, "class", ["x"]).collect()
    with pytest.raises(Exception, match="null feature"):
        info_gain(df, "class", "x", threshold=2.0).collect()
    assert best_threshold(df, "class", ["x"], handle_null="drop").collect() == best_threshold(clean, "class", ["x"]).collect()
    assert gain_ratio(df, "class", "x", threshold=2.0, handle_null="drop").first()["n_values"] == 2


def test_unknown_labels_fail(spark):
    from gainkit.operators.impurity import gain_ratio
    df = spark.createDataFrame([("1", "a"), ("0", "b"), ("zz", "a"), (None, "b")], "class string, g string")
    for bad in (df, df.where("class is not null"), df.where("class is null or class <> 'zz'")):
        with pytest.raises(Exception, match="label outside"):
            gain_ratio(bad, "class", "g", classes=["0", "1"]).collect()


def test_large_integers_stay_apart(spark):
    from gainkit.operators.impurity import info_gain
    from gainkit.spec import DISCRETE, FeatureSpec
    from gainkit import split_candidates
    df = spark.createDataFrame([(str(i % 2), 2**53 + i, "h") for i in range(4)], "class string, x long, h string")
    r = info_gain(df, "class", "x").first()
    assert (r["n_values"], r["gain"]) == (4, 1.0)
    c = split_candidates(df, "class", [FeatureSpec("x", DISCRETE)], by=["h"])
    assert c.columns[:2] == ["h", "feature"] and c.first()["n_values"] == 4


def test_exact_split_of_repeated_keys_is_fixed(spark):
    df = spark.range(4000).selectExpr("id % 7 AS k", "id AS v")
    one, two = (sorted(r["v"] for r in exact_split(df.repartition(n), "k", (4, 1), 100)[0].collect()) for n in (3, 7))
    assert one == two and len(one) == 3200


def test_replicate_needs_a_copy(spark):
    from gainkit.operators.rows import replicate
    with pytest.raises(ValueError):
        replicate(spark.range(3), 0, "id")
    assert replicate(spark.range(3), 1, "id").count() == 3
