"""Table-shaped steps of the curve fit (I1-I5): min-max scaling, its
inverse, an even grid, scoring a given 1-5-10-1 sigmoid network and the
squared-error loss.  Training the network is not part of this library; its
weights are an input."""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def minmax_bounds(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: min_<c>, span_<c> for every column (a single aggregate)."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).cast("double").alias(f"min_{c}"),
                 (F.max(c) - F.min(c)).cast("double").alias(f"span_{c}")]
    return df.agg(*aggs)


def minmax_scale(df: DataFrame, cols: list[str], suffix: str = "_scaled", bounds=None) -> DataFrame:
    """(x - min) / span per column; span 0 gives null.  The bounds come
    from one aggregate (a single row) and enter the plan as literals."""
    b = bounds if bounds is not None else minmax_bounds(df, cols).first()
    out = df
    for c in cols:
        mn, span = b[f"min_{c}"], b[f"span_{c}"]
        scaled = F.lit(None).cast("double") if not span else (F.col(c) - F.lit(mn)) / F.lit(span)
        out = out.withColumn(f"{c}{suffix}", scaled)
    return out


def inverse_minmax(x, minimum, span) -> Column:
    """X * span + min."""
    x = F.col(x) if isinstance(x, str) else x
    m = F.col(minimum) if isinstance(minimum, str) else F.lit(minimum)
    s = F.col(span) if isinstance(span, str) else F.lit(span)
    return x * s + m


def even_grid(spark: SparkSession, n: int = 1000, col: str = "x") -> DataFrame:
    """N evenly spaced points on [0, 1] (n >= 2)."""
    return spark.range(n).select(F.col("id").alias("i"), (F.col("id") / F.lit(n - 1)).alias(col))


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def network_score(x, w1, b1, w2, b2, w3, b3) -> Column:
    """I4: 1-5-10-1 network, sigmoid hidden layers, linear output.
    w1: [1][5], b1: [5], w2: [5][10], b2: [10], w3: [10][1], b3: [1]
    (shapes as in a row-vector ``x @ W + b`` network)."""
    x = F.col(x) if isinstance(x, str) else x
    h1 = [sigmoid(x * F.lit(float(w1[0][j])) + F.lit(float(b1[j]))) for j in range(len(b1))]
    h2 = [sigmoid(reduce(add, [h1[i] * F.lit(float(w2[i][j])) for i in range(len(h1))]) + F.lit(float(b2[j])))
          for j in range(len(b2))]
    return reduce(add, [h2[i] * F.lit(float(w3[i][0])) for i in range(len(h2))]) + F.lit(float(b3[0]))


def squared_loss(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Mean of (y - yhat)^2 as one row ``loss``."""
    return df.agg(F.avg(F.pow(F.col(y) - F.col(yhat), 2)).alias("loss"))


def fixed_weights(seed: int = 7):
    """Deterministic example weights (a rule, not trained values) so a scoring
    query can be written down and checked; shape 1-5-10-1, biases 0.1."""
    def w(i, j, layer):
        return round(math.sin(seed * 1.7 + layer * 3.1 + i * 0.9 + j * 0.37), 6)
    w1 = [[w(0, j, 1) for j in range(5)]]
    w2 = [[w(i, j, 2) for j in range(10)] for i in range(5)]
    w3 = [[w(i, 0, 3)] for i in range(10)]
    return w1, [0.1] * 5, w2, [0.1] * 10, w3, [0.1]


def network_sql(x: str, w1, b1, w2, b2, w3, b3) -> str:
    """SQL text of :func:`network_score` (valid in Spark SQL and DuckDB)."""
    def sig(z):
        return f"(1.0 / (1.0 + exp(-({z}))))"
    h1 = [sig(f"{x} * {float(w1[0][j])!r} + {float(b1[j])!r}") for j in range(len(b1))]
    h2 = [sig(" + ".join(f"{h1[i]} * {float(w2[i][j])!r}" for i in range(len(h1))) + f" + {float(b2[j])!r}")
          for j in range(len(b2))]
    return "(" + " + ".join(f"{h2[i]} * {float(w3[i][0])!r}" for i in range(len(h2))) + f" + {float(b3[0])!r})"
