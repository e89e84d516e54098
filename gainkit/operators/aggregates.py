"""Grouped counts, distinct counts and the majority class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gainkit.operators.split_search import labels_of


def majority_class(df: DataFrame, label: str, by: list[str] | None = None, classes=None) -> DataFrame:
    """(by..., n_rows, majority): the most frequent label; ties go to the
    label that comes first in ``classes`` (default: sorted labels).  Null where
    no row of the group has a label in ``classes``."""
    by = list(by or [])
    classes = labels_of(df, label, classes)
    counts = [F.count_if(F.col(label).cast("string") == F.lit(c)).alias(f"_c{i}") for i, c in enumerate(classes)]
    agg = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *counts)
    arr = F.array(*[F.col(f"_c{i}") for i in range(len(classes))])
    names = F.array(*[F.lit(c) for c in classes])
    first = F.element_at(names, F.array_position(arr, F.array_max(arr)).cast("int"))
    return agg.select(*by, "n_rows", F.when(F.array_max(arr) > 0, first).alias("majority"))


def distinct_counts(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Exact distinct values per column and group, null counted as a value
    (as ``select(c).distinct().count()`` does)."""
    by = list(by or [])
    aggs = []
    for c in columns:
        aggs.append((F.count_distinct(F.col(c)) + F.max(F.col(c).isNull().cast("int"))).alias(f"{c}_distinct"))
    return df.groupBy(*by).agg(*aggs)
