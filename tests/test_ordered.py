"""Ordered scans: every threshold and every row number, however rows are dealt to ranges."""

import random

import pytest
from pyspark.sql import functions as F

from gainkit.operators.ordered import ThresholdScan, carries, numbered
from gainkit.operators.split_search import all_thresholds, best_split, best_threshold, split_candidates, value_class_counts
from gainkit.spec import FeatureSpec
from tests import bruteforce as bf

SCHEMA = "g string, h int, x double, y double, d string, class string"


def table(seed, n, groups=3):
    rnd = random.Random(seed)
    return [{"g": rnd.choice(["a", "b", None][:groups]), "h": rnd.choice([1, None]), "x": float(rnd.randint(-40, 40)), "y": rnd.choice([0.0, 1.5]),
             "d": rnd.choice("pqr"), "class": rnd.choice("012")} for _ in range(n)]


@pytest.fixture
def small_batches(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    yield lambda n: spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(n))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


@pytest.mark.parametrize("range_rows,batch", [(1, 1), (5, 2), (17, 3), (17, 10_000), (10**6, 1), (10**6, 10_000)])
def test_scan_does_not_depend_on_ranges_and_batches(spark, small_batches, range_rows, batch):
    small_batches(batch)
    rows = table(1, 250)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    spec = [FeatureSpec("d", "discrete"), FeatureSpec("x"), FeatureSpec("y")]
    got = {(r["g"], r["h"], r["feature"]): r for r in split_candidates(df, "class", spec, by=["g", "h"], range_rows=range_rows).collect()}
    every = {}
    for r in all_thresholds(df, "class", ["x", "y"], by=["g", "h"], range_rows=range_rows).collect():
        every.setdefault((r["g"], r["h"], r["feature"]), {})[r["value"]] = (r["next_value"], r["threshold"])
    classes = ["0", "1", "2"]
    for key in {(r["g"], r["h"]) for r in rows}:
        part = [r for r in rows if (r["g"], r["h"]) == key]
        gain, iv, ratio = bf.discrete_measures(part, "d", ["p", "q", "r"], classes)
        assert (got[(*key, "d")]["gain"], got[(*key, "d")]["intrinsic_value"]) == (pytest.approx(gain, abs=1e-12), pytest.approx(iv, abs=1e-12))
        for f in "xy":
            values = sorted({r[f] for r in part})
            assert every.get((*key, f), {}) == {a: (b, (a + b) / 2) for a, b in zip(values, values[1:])}
            best = bf.continuous_best(part, f, classes)
            if len(values) > 1:
                r = got[(*key, f)]
                assert (r["threshold"], r["n_values"], r["n_rows"]) == (best[0], len(values), len(part))
                assert (r["gain"], r["intrinsic_value"], r["gain_ratio"]) == tuple(pytest.approx(x, abs=1e-12) for x in best[1:4])
            else:
                assert (*key, f) not in got


def test_a_hot_feature_is_dealt_to_many_ranges(spark):
    """One feature of one group: no task gets all of it, and the ranges agree with one."""
    rows = spark.range(30_000).select(((F.col("id") * 7919) % 30_011).cast("double").alias("x"), (F.xxhash64("id") % 2 == 0).cast("int").alias("_y"))
    counts = value_class_counts(rows, F.lit(0).cast("long"), F.col("_y"), [(0, "x", "continuous")], 2)
    many, one = ThresholdScan(counts, 2, [], 30_001, range_rows=5_000), ThresholdScan(counts, 2, [], 30_001)
    sizes = [r["count"] for r in many.ranges.groupBy("_r").count().collect()]
    assert len(sizes) == 7 and max(sizes) < 10_000
    assert one.n == 2
    a, b = many.stats().first(), one.stats().first()
    assert a == b and a["n_values"] == 30_000
    assert many.candidates().count() == 29_999
    many.close()
    one.close()


def test_carries_reach_over_ranges_without_a_change():
    row = lambda r, head, tail, value, sums, one, totals=None: {"_r": r, "head": head, "tail": tail, "value": value, "sums": sums, "one": one, "totals": totals}
    out = carries([row(0, ["1", "-1"], ["1", "0"], None, [2, 1], False, [9, 9]), row(2, ["1", "0"], ["1", "0"], 5.0, [1, 1], True),
                   row(3, ["1", "0"], ["2", "0"], 7.0, [4, 0], False, [5, 5]), row(5, ["2", "1"], ["2", "1"], 1.0, [1, 0], True)], 1, 2)
    assert (out[0].same_pair, out[0].after) == (False, 5.0)
    assert (out[2].same_pair, out[2].run, out[2].totals, out[2].after) == (True, [2, 1], [9, 9], 7.0)
    assert (out[3].same_pair, out[3].run, out[3].totals, out[3].after) == (True, [3, 2], [9, 9], None)
    assert (out[5].same_group, out[5].same_pair, out[5].run, out[5].totals) == (True, False, [0, 0], [5, 5])


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    spec = [FeatureSpec("d", "discrete"), FeatureSpec("x")]
    assert best_split(df, "class", spec, by=["g"], classes=["0", "1"]).collect() == []
    assert best_threshold(df, "class", ["x"], classes=["0", "1"]).collect() == []
    assert numbered(df, ["x"]).collect() == []


def test_numbered(spark):
    rnd = random.Random(2)
    values = [rnd.randint(0, 50) for _ in range(3_000)] + [7] * 2_000
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v int").repartition(6)
    got = numbered(df, ["v", "i"]).collect()
    assert [(r["v"], r["i"]) for r in sorted(got, key=lambda r: r["_n"])] == sorted((v, i) for i, v in enumerate(values))
    ties = numbered(df, [F.desc("v")], "at").collect()
    assert sorted(r["at"] for r in ties) == list(range(5_000))
    assert [r["v"] for r in sorted(ties, key=lambda r: r["at"])] == sorted(values, reverse=True)
