"""Entropy, information gain, intrinsic value and gain ratio as grouped
aggregates (E1-E6).  Each takes ``by`` columns, so the same call measures one
table, every node of a tree level, or any other grouping at once.  Null
features fail, or are left out with ``handle_null='drop'``; labels outside
``classes`` fail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gainkit.functions.measures import xlog2x
from gainkit.operators.split_search import split_candidates
from gainkit.spec import DISCRETE, FeatureSpec


def entropy(df: DataFrame, label: str, by: list[str] | None = None) -> DataFrame:
    """(by..., n_rows, entropy) with entropy in bits over the labels found.
    Computed as (n log2 n - sum n_k log2 n_k) / n from exact integer counts."""
    by = list(by or [])
    counts = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("_n"))
    agg = counts.groupBy(*by).agg(F.sum("_n").alias("n_rows"), F.sum(xlog2x("_n")).alias("_s"),
                                  F.count(F.lit(1)).alias("n_classes"))
    return agg.select(*by, "n_rows", "n_classes",
                      ((xlog2x("n_rows") - F.col("_s")) / F.col("n_rows")).alias("entropy"))


def class_counts(df: DataFrame, label: str, by: list[str] | None = None) -> DataFrame:
    """Rows per class per group."""
    by = list(by or [])
    return df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n_rows"))


def _as_discrete(df: DataFrame, feature: str, threshold: float | None):
    if threshold is None:
        return df, feature
    side = F.when(F.col(feature) >= F.lit(float(threshold)), F.lit(">=")).when(
        F.col(feature) < F.lit(float(threshold)), F.lit("<"))  # null stays null
    return df.withColumn("_side", side), "_side"


def _measure(df, label, feature, by, threshold, classes, handle_null):
    by = list(by or [])
    d, col = _as_discrete(df, feature, threshold)
    out = split_candidates(d, label, [FeatureSpec(col, DISCRETE)], by, classes, handle_null=handle_null, keep_position=True)
    out = out.drop("_p").withColumn("feature", F.lit(feature)) \
             .withColumn("threshold", F.lit(threshold).cast("double"))
    if by:
        out = out.select(*[F.col(f"_g.{b}").alias(b) for b in by], *[c for c in out.columns if c != "_g"])
    else:
        out = out.drop("_g")
    return out.drop("kind")


def info_gain(df: DataFrame, label: str, feature: str, by: list[str] | None = None,
              threshold: float | None = None, classes=None, handle_null: str = "error") -> DataFrame:
    """E2 (discrete: one part per value) or E3 (continuous: parts >= t and < t)."""
    return _measure(df, label, feature, by, threshold, classes, handle_null).select(
        *(by or []), "feature", "threshold", "gain", "n_values", "n_rows")


def intrinsic_value(df: DataFrame, feature: str, by: list[str] | None = None,
                    threshold: float | None = None, handle_null: str = "error") -> DataFrame:
    """Split information of a feature (or a threshold) per group."""
    one = df.withColumn("_one", F.lit("1"))
    return _measure(one, "_one", feature, by, threshold, ["1"], handle_null).select(
        *(by or []), "feature", "threshold", "intrinsic_value", "n_values", "n_rows")


def gain_ratio(df: DataFrame, label: str, feature: str, by: list[str] | None = None,
               threshold: float | None = None, classes=None, handle_null: str = "error") -> DataFrame:
    """Gain / intrinsic value; 0 when the feature has one value in the group."""
    return _measure(df, label, feature, by, threshold, classes, handle_null).select(
        *(by or []), "feature", "threshold", "gain", "intrinsic_value", "gain_ratio", "n_values", "n_rows")
