"""Groups of sorted Arrow batches, many small ones at a time.

For group work in ``mapInArrow`` after a repartition and sort by the group's
keys: a call per group would cost more than the work of a small group. Groups
too large for one task are cut into blocks before, and pairs of blocks become
groups of their own (``block_pairs``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def block_pairs(members: DataFrame, keys: list[str], block: int) -> DataFrame:
    """Members (keys, id, ...) of groups with two rows or more, dealt to pairs of
    blocks: adds i <= j (the pair) and own (the member's block). Two members
    meet in exactly one pair of blocks."""
    sizes = members.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1")
    m = members.join(sizes, keys).withColumn("_b", F.ceil(F.col("_c") / block).cast("int")).withColumn("own", F.pmod(F.xxhash64("id"), F.col("_b")).cast("int"))
    m = m.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_b") - 1)))
    return m.withColumn("i", F.least("own", "_o")).withColumn("j", F.greatest("own", "_o")).drop("_c", "_b", "_o")


def stream(batches, keys: list[str]):
    """Yields (table, starts): whole groups of adjacent rows and where they begin."""
    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if held is not None:
            t = pa.concat_tables([held, t])
        t = t.combine_chunks()
        if not t.num_rows:
            continue
        new = _starts(t, keys)
        if new[-1]:
            yield t.slice(0, int(new[-1])), new[:-1]
        held = t.slice(int(new[-1]))
    if held is not None and held.num_rows:
        yield held, np.zeros(1, np.int64)


def _starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(t.num_rows, bool)
    new[0] = True
    for c in keys:
        v = t.column(c).to_pandas().factorize()[0]
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)
