"""Splits and samples.

The default split is keyed: a row's side is a function of its key and the
seed only, so it is the same on every run, partitioning and engine (the
DuckDB oracle reproduces it).  ``random_split`` keeps Spark's Bernoulli split
for parity with the reference; it repeats only for one input layout.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _key_text(key: str | list[str], seed: int) -> Column:
    keys = [key] if isinstance(key, str) else list(key)
    return F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))


def hash_u32(key, seed: int) -> Column:
    """First 32 bits of md5(key|seed) as a number in [0, 2^32)."""
    return F.conv(F.substring(F.md5(_key_text(key, seed)), 1, 8), 16, 10).cast("long")


def hash_u60(key, seed: int) -> Column:
    """First 60 bits of md5(key|seed): the order of the exact-size split."""
    return F.conv(F.substring(F.md5(_key_text(key, seed)), 1, 15), 16, 10).cast("long")


def hash_side(key, weights, seed: int) -> Column:
    """0-based part index of each row for the given weights."""
    total = float(sum(weights))
    u = hash_u32(key, seed) / F.lit(4294967296.0)
    side, acc = None, 0.0
    for i, w in enumerate(weights[:-1]):
        acc += w
        cond = u < F.lit(acc / total)
        side = F.when(cond, F.lit(i)) if side is None else side.when(cond, F.lit(i))
    last = F.lit(len(weights) - 1)
    return last if side is None else side.otherwise(last)


def hash_split(df: DataFrame, key, weights=(4, 1), seed: int = 100) -> list[DataFrame]:
    """Deterministic weighted split on a key (no shuffle, one pass each)."""
    side = hash_side(key, list(weights), seed)
    tagged = df.withColumn("_side", side)
    return [tagged.where(F.col("_side") == i).drop("_side") for i in range(len(weights))]


def random_split(df: DataFrame, weights=(4, 1), seed: int = 100) -> list[DataFrame]:
    """Spark's Bernoulli split (depends on partitioning)."""
    return df.randomSplit([float(w) for w in weights], seed)


def exact_rank(df: DataFrame, key, seed: int, target_bucket_rows: int = 1_000_000) -> DataFrame:
    """Adds ``_rank`` (0-based, dense, exact) in the order of (md5 prefix, key).
    The order is cut into hash buckets (uniform, so evenly sized); bucket
    offsets come from a table of at most 2^20 counts, and ranks inside a
    bucket from a window over that bucket only.  Rows with equal keys are told
    apart by a hash of all columns, so the ranks do not depend on how the rows
    are partitioned."""
    keys = [key] if isinstance(key, str) else list(key)
    h = hash_u60(key, seed)
    total = df.count()
    bits = 0 if total <= target_bucket_rows else min(20, math.ceil(math.log2(total / target_bucket_rows)))
    t = df.withColumn("_h", h).withColumn("_bk", F.shiftright(F.col("_h"), 60 - bits) if bits else F.lit(0))
    counts = t.groupBy("_bk").agg(F.count(F.lit(1)).alias("_bn"))
    offs = counts.select("_bk", F.coalesce(F.sum("_bn").over(
        Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    w = Window.partitionBy("_bk").orderBy("_h", *keys, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    ranked = t.join(F.broadcast(offs), "_bk").withColumn("_rank", F.col("_off") + F.row_number().over(w) - 1)
    return ranked.drop("_h", "_bk", "_off")


def exact_split(df: DataFrame, key, weights=(4, 1), seed: int = 100, total: int | None = None) -> list[DataFrame]:
    """Exact-size shuffled split: the first int(n * w0 / sum(w)) rows in
    hash order are train, the rest test.  With ``total`` only rows whose
    rank is below ``total`` are used (C2b)."""
    ranked = exact_rank(df, key, seed)
    n = df.count() if total is None else total
    if total is not None:
        ranked = ranked.where(F.col("_rank") < total)
    n_train = int(n * weights[0] / float(sum(weights)))
    return [ranked.where(F.col("_rank") < n_train).drop("_rank"),
            ranked.where(F.col("_rank") >= n_train).drop("_rank")]


def kfold_assign(df: DataFrame, key, k: int = 5, seed: int = 100) -> DataFrame:
    """``fold`` in [0, k) from the key hash."""
    return df.withColumn("fold", F.pmod(hash_u32(key, seed), F.lit(k)).cast("int"))


from gainkit.operators.rows import row_range  # noqa: E402,F401  (kept here for the C6 name)
