"""CSV path (A1-A3, A7, A8), row operators (B*) and replication (A4)."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from gainkit.operators.rows import (cast_columns, drop_header_rows, horizontal_sum, parse_flag,
                                    positional_features, project_ordinals, rename_positional, replicate,
                                    row_range, union_rows)
from gainkit.sources.csv import (FLAG_NAMES, MATCH_SPEC, append_csv, match_holdout, read_csv_text,
                                 read_match_features)


def write_match_csv(path, n=200, seed=5):
    rnd = random.Random(seed)
    header = ["index", "x1", "x2", "x3", "class"] + FLAG_NAMES + ["x11"]
    for p in range(1, 6):
        header += [f"player{p}_kills", f"player{p}_deaths", f"player{p}_assists", f"player{p}_goldEarned"]
        if p < 5:
            header += [f"p{p}_a", f"p{p}_b", f"p{p}_c"]
    rows = []
    for i in range(n):
        r = [i, rnd.randint(0, 9), "z", rnd.random(), rnd.randint(0, 1)]
        r += [rnd.choice(["True", "False"]) for _ in FLAG_NAMES] + [0]
        for p in range(1, 6):
            r += [rnd.randint(0, 15), rnd.randint(0, 15), rnd.randint(0, 20), rnd.randint(3000, 20000)]
            if p < 5:
                r += [1, 2, 3]
        rows.append(r)
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)
    return header, rows


def test_match_csv_features(spark, tmp_path):
    path = str(tmp_path / "match.csv")
    header, rows = write_match_csv(path)
    assert len(header) == 44
    spec, df = read_match_features(spark, path, 10, 50)
    got = {r["index"]: r for r in df.collect()}
    assert sorted(got) == list(range(10, 50))
    for r in rows[10:50]:
        g = got[r[0]]
        assert g["class"] == str(r[4])
        assert [g[n] for n in FLAG_NAMES] == r[5:11]
        kills = sum(r[12 + 7 * p] for p in range(5))
        gold = sum(r[15 + 7 * p] for p in range(5))
        assert g["player_kills"] == kills and g["player_goldEarned"] == gold
    assert [s.name for s in spec] == [s.name for s in MATCH_SPEC]


def test_match_holdout_and_append(spark, tmp_path):
    path = str(tmp_path / "match.csv")
    write_match_csv(path, 120)
    spec, train, test = match_holdout(spark, path)
    a, b = train.count(), test.count()
    assert a + b == 120 and 80 <= a <= 110
    assert train.join(test, "index").count() == 0
    out = str(tmp_path / "appended")
    append_csv(train.limit(5), out)
    append_csv(train.limit(5), out)
    assert read_csv_text(spark, out, header=False).count() == 10
    # appended text with header lines in the middle: the header rows are dropped
    raw = read_csv_text(spark, path, header=False)
    assert drop_header_rows(raw, "_c0", "index").count() == 120


def test_row_ops(spark):
    df = spark.createDataFrame([(i, str(i), "True" if i % 2 else "False") for i in range(10)],
                               "index long, txt string, flag string")
    assert row_range(df, 3, 7).count() == 4
    assert project_ordinals(df, [2, 0]).columns == ["flag", "index"]
    assert rename_positional(df, ["a", "b", "c"]).columns == ["a", "b", "c"]
    hs = horizontal_sum(df, {"s": ["index", "txt"]}, cast="long").select("s").collect()
    assert [r["s"] for r in hs] == [2 * i for i in range(10)]
    bad = spark.createDataFrame([("1",), ("x",)], "v string")
    assert [r["v"] for r in cast_columns(bad, ["v"], strict=False).collect()] == [1, None]
    flags = spark.createDataFrame([("True",), ("False",), ("7",), ("x",)], "v string")
    assert [r[0] for r in flags.select(parse_flag("v")).collect()] == [1, 0, 7, None]
    assert union_rows(df, df).count() == 20
    pf = positional_features(df.select("flag", "index", "txt"), "flag", ["a", "b"])
    assert pf.columns == ["flag", "a", "b"]


def test_replicate(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 6)], "k long, v double")
    out = replicate(df, 4, "k").collect()
    assert len(out) == 20
    keys = sorted(r["k"] for r in out)
    assert keys == list(range(1, 21))
