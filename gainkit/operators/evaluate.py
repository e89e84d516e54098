"""Repeated holdout (C4, G7): split, fit, prune on the holdout, score it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gainkit.operators.prune import prune as prune_tree
from gainkit.operators.sampling import exact_split, hash_split, random_split
from gainkit.operators.score import accuracy
from gainkit.operators.tree import fit


def repeated_holdout(df: DataFrame, label: str, key=None, rounds: int = 5, weights=(4, 1),
                     seed0: int = 100, spec=None, classes=None, prune: bool = True,
                     split: str = "hash", **fit_args) -> DataFrame:
    """One row per round: (round, seed, n_train, n_test, n_correct, accuracy).
    Round r uses seed ``seed0 * r``.  As in the reference, the holdout used for
    pruning is the one scored; pass ``prune=False`` for an unbiased figure."""
    out = []
    for r in range(1, rounds + 1):
        seed = seed0 * r
        if split == "hash":
            train, test = hash_split(df, key, weights, seed)
        elif split == "exact":
            train, test = exact_split(df, key, weights, seed)
        elif split == "random":
            train, test = random_split(df, weights, seed)
        else:
            raise ValueError("split must be 'hash', 'exact' or 'random'")
        model = fit(train, label, spec, classes=classes, **fit_args)
        if prune:
            model = prune_tree(model, test, label)
        n_train = model.nodes.where(F.col("node_id") == 0).select(F.col("n_rows").alias("n_train"))
        acc = accuracy(model, test, label)
        out.append(acc.crossJoin(n_train).select(
            F.lit(r).alias("round"), F.lit(seed).alias("seed"), "n_train",
            F.col("n_rows").alias("n_test"), "n_correct", "accuracy"))
    return reduce(lambda a, b: a.unionByName(b), out)


def mean_accuracy(rounds: DataFrame) -> DataFrame:
    """Mean accuracy over rounds."""
    return rounds.agg(F.count(F.lit(1)).alias("rounds"), F.avg("accuracy").alias("mean_accuracy"))
