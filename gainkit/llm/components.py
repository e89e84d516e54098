"""Connected components of a link table, by large-star and small-star rounds.

Each round hooks every vertex to the smallest neighbour it sees; joins go on
vertex keys where one side has one row per vertex, so adaptive skew handling
can split a hot vertex. Every round is written under the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gainkit.session import Scratch


def _mark(df: DataFrame) -> tuple:
    """Number of links and an order-free sum over them; equal when nothing moved."""
    return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(v, component) for every vertex of ``links`` (columns u, v; both
    directions or one); component is the smallest vertex reachable."""
    at = scratch.cut(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = _mark(at)
    while True:
        # large star: larger neighbours of u go to the smallest of u and its neighbours
        both = at.union(at.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        nxt = scratch.cut(small.filter("u <> v").distinct())
        scratch.drop(at)
        new = _mark(nxt)
        at, done, mark = nxt, new == mark, new
        if done:
            break
    return at.select(F.col("u").alias("v"), F.col("v").alias("component")) \
        .union(at.select("v").distinct().select("v", F.col("v").alias("component")))
