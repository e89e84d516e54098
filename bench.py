"""Headline timings at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]; prints one JSON line.

q1  best threshold of the 4 continuous lineitem features at the root (E7/E8)
q2  ranked split candidates of all 6 features at the root (E1-E10)
q3  grow the rule tree, splits at depths 0..4 (F1-F13)
q4  score every row with it and report accuracy (G1/G4)
q5  prune it on a keyed holdout (G5)
q6  keyed and exact-size splits of orders (C2/C3)

``sec_per_threshold`` = q1 seconds / thresholds evaluated in q1, the unit the
reference's own timer prints per threshold.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pyspark.sql import functions as F

    from gainkit.operators.prune import prune
    from gainkit.operators.sampling import exact_split, hash_split
    from gainkit.operators.score import accuracy
    from gainkit.operators.split_search import best_split, best_threshold
    from gainkit.operators.tree import fit
    from gainkit.plans.views import VIEWS, load_view
    from gainkit.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * int(cpus)), app="gainkit-bench")
    v = load_view(spark, sf, "v_rule")
    spec = list(VIEWS["v_rule"].spec)
    cont = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
    times = {}

    # warm-up on the smallest folder so JIT and codegen are not charged to q1
    warm = load_view(spark, "/root/testdata/sf0.001", "v_rule")
    best_threshold(warm, "class", cont, classes=["0", "1"]).collect()

    t = time.time()
    bt = best_threshold(v, "class", cont, classes=["0", "1"]).collect()
    times["q1_best_threshold"] = time.time() - t
    n_thresholds = sum(r["n_candidates"] for r in bt)

    t = time.time()
    best_split(v, "class", spec, classes=["0", "1"], all_candidates=True).collect()
    times["q2_rank_splits"] = time.time() - t

    t = time.time()
    model = fit(v, "class", spec, classes=["0", "1"], max_depth=4)
    model.tree.count()
    times["q3_fit_depth4"] = time.time() - t

    t = time.time()
    acc = accuracy(model, v).first()
    times["q4_score_all"] = time.time() - t

    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    keyed = v.withColumn("_k", F.xxhash64(*[F.col(c) for c in v.columns]))
    train, test = hash_split(keyed, "_k", (4, 1), 100)
    t = time.time()
    pm = fit(train.drop("_k"), "class", spec, classes=["0", "1"], max_depth=4)
    pruned = prune(pm, test.drop("_k"), "class")
    pruned.tree.count()
    times["q5_fit_prune"] = time.time() - t

    t = time.time()
    o = spark.read.parquet(f"{sf}/orders.parquet")
    a, b = hash_split(o, "o_orderkey", (4, 1), 100)
    c, d = exact_split(o, "o_orderkey", (4, 1), 100)
    sizes = [a.count(), b.count(), c.count(), d.count()]
    times["q6_splits"] = time.time() - t

    total = sum(times.values())
    print(json.dumps({
        "metric": "total_seconds", "value": round(total, 3), "unit": "sec",
        "queries": {k: round(x, 3) for k, x in times.items()},
        "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""),
        "cpus": int(cpus), "rows": li.count(),
        "thresholds_q1": n_thresholds,
        "sec_per_threshold": round(times["q1_best_threshold"] / max(n_thresholds, 1), 9),
        "accuracy_q4": acc["accuracy"], "split_sizes_q6": sizes,
    }))


if __name__ == "__main__":
    main()
