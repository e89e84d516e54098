"""Scoring a stream with a fitted tree.

Routing is stateless: each micro-batch meets the (static, small) tree levels
and discrete dictionaries through stream-static left joins, so the same plan
as batch scoring runs per trigger.  ``running_accuracy`` keeps the only state
needed for monitoring: two counters per label (or overall).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gainkit.operators.score import route
from gainkit.operators.tree import TreeModel


def score_stream(model: TreeModel, stream: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Streaming (or batch) rows + ``node_id`` and ``prediction``."""
    return route(model, stream, keep=keep)


def running_accuracy(model: TreeModel, stream: DataFrame, label: str | None = None,
                     by: list[str] | None = None) -> DataFrame:
    """Streaming aggregate (n_rows, n_correct, accuracy) over all rows seen so
    far, optionally per ``by`` columns; run with output mode 'complete' or
    'update'."""
    label = label or model.label
    by = list(by or [])
    scored = route(model, stream, keep=[label, *by])
    ok = F.col("prediction").isNotNull() & (F.col("prediction") == F.col(label).cast("string"))
    return scored.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(ok).alias("n_correct")) \
        .withColumn("accuracy", F.col("n_correct") / F.col("n_rows"))
