"""Operator 2: Merkle fixity audit of record replicas.

Records are written out as WARC resource records in key order; each has its
offset in that order and a leaf, the SHA-256 of its bytes. A tree over ordered
ranges covers them: a leaf range holds ``fanout`` consecutive keys and a node
``fanout`` consecutive nodes below, so a record that another replica lacks or
has in addition changes one branch and shifts none.
A node's hash is over its children's in order. Two replicas are compared from
the root down: only children of nodes whose hashes differ are looked at, and
the records of the differing leaf ranges name the corruption and its place.

Ranks come from counts per range partition, so no window sees the whole
table; a node is built from at most ``fanout`` children (copies of one record
under one key are one child with their number).

Keys are integers. Defined results: null keys come first and belong to the
first range, null urls and bodies are written empty; equal keys are ordered by
their leaf; an empty replica has no nodes and
the other's records are then missing or extra; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gainkit.session import Scratch

FANOUT = 64


def record(key: Column, url: Column, body: Column) -> Column:
    """The bytes of one WARC resource record."""
    content = F.encode(F.coalesce(body, F.lit("")), "UTF-8")
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(key.cast("string"), F.lit("")),
                    F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
                    F.octet_length(content).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(F.encode(head, "UTF-8"), content, F.encode(F.lit("\r\n\r\n"), "UTF-8"))


def leaves(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """(k, n_bytes, leaf) per record; the texts go no further."""
    raw = pages.select(F.col(key).alias("k"), record(F.col(key), F.col(url), F.col(body)).alias("r"))
    return raw.select("k", F.octet_length("r").cast("long").alias("n_bytes"), F.unhex(F.sha2("r", 256)).alias("leaf"))


def placed(records: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds ``pos`` (rank from 0) and ``start`` (byte offset) in key order.
    The rank within a range partition is taken while it is sorted; partition
    totals, one row each, are summed in a window."""
    ordered = records.repartitionByRange("k", "leaf").sortWithinPartitions("k", "leaf").withColumn("at", F.monotonically_increasing_id())
    t = scratch.cut(ordered).withColumn("part", F.shiftright("at", 33))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = t.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("b"))
    before = totals.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("n0"), F.coalesce(F.sum("b").over(ahead), F.lit(0)).alias("b0"))
    within = Window.partitionBy("part").orderBy("at")
    return t.join(before, "part").select(
        "k", "n_bytes", "leaf", (F.col("n0") + F.row_number().over(within) - 1).alias("pos"),
        (F.col("b0") + F.sum("n_bytes").over(within) - F.col("n_bytes")).alias("start"))


def _node(children: Column) -> Column:
    """Hash over (order, hash, count) children in order."""
    one = F.transform(F.sort_array(children), lambda c: F.concat(F.hex(c["hash"]), F.lit("x"), c["n"].cast("string")))
    return F.unhex(F.sha2(F.array_join(one, ","), 256))


def tree(records: DataFrame, low: int, levels: int, fanout: int = FANOUT) -> list[DataFrame]:
    """Nodes (id, hash) from the leaf ranges (level 0) to the root."""
    one, place = F.lit(1).cast("long").alias("n"), F.coalesce(F.col("k") - low, F.lit(-1)).alias("i")
    ranged = records.groupBy(_range(low, fanout).alias("id"), place, F.col("leaf").alias("hash")).agg(F.count(F.lit(1)).alias("n"))
    at = ranged.groupBy("id").agg(_node(F.collect_list(F.struct("i", "hash", "n"))).alias("hash"))
    out = [at]
    for _ in range(levels):
        at = at.groupBy(F.floor(F.col("id") / fanout).cast("long").alias("up")).agg(
            _node(F.collect_list(F.struct(F.col("id").alias("i"), "hash", one))).alias("hash")).withColumnRenamed("up", "id")
        out.append(at)
    return out


def _range(low: int, fanout: int) -> Column:
    return F.coalesce(F.floor((F.col("k") - low) / fanout).cast("long"), F.lit(0).cast("long"))


def audit(first: DataFrame, second: DataFrame, scratch: Scratch, fanout: int = FANOUT, **names) -> DataFrame:
    """Per record of either replica: k, start and n_bytes in the first replica
    (in the second for an extra one), leaf (hex), and status: ok, corrupt,
    missing (in the second) or extra."""
    a, b = (scratch.cut(placed(leaves(x, **names), scratch)) for x in (first, second))
    low, high = a.select("k").union(b.select("k")).agg(F.min("k"), F.max("k")).first()
    low, ranges, levels = low or 0, ((high or 0) - (low or 0)) // fanout + 1, 0
    while fanout ** levels < ranges:
        levels += 1
    ta, tb = tree(a, low, levels, fanout), tree(b, low, levels, fanout)
    differ = None
    for level in range(levels, -1, -1):
        x, y = ta[level], tb[level]
        if differ is not None:
            up = F.floor(F.col("id") / fanout).cast("long")
            x, y = (t.join(differ, up == F.col("bad"), "left_semi") for t in (x, y))
        pairs = x.alias("x").join(y.alias("y"), F.col("x.id") == F.col("y.id"), "full_outer")
        differ = scratch.cut(pairs.filter(~F.col("x.hash").eqNullSafe(F.col("y.hash"))).select(F.coalesce("x.id", "y.id").alias("bad")))
    inside = _range(low, fanout) == F.col("bad")
    found = _locate(*(t.join(differ, inside, "left_semi") for t in (a, b)))
    fine = a.join(differ, inside, "left_anti").select("k", "start", "n_bytes", "leaf", F.lit("ok").alias("status"))
    return fine.unionByName(found).withColumn("leaf", F.lower(F.hex("leaf")))


def _locate(a: DataFrame, b: DataFrame) -> DataFrame:
    """Compares the records of the differing ranges; equal keys pair up in the
    order of their leaves."""
    nth = F.row_number().over(Window.partitionBy("k").orderBy("leaf", "start"))
    a, b = a.withColumn("nth", nth).alias("a"), b.withColumn("nth", nth).alias("b")
    both = a.join(b, F.col("a.k").eqNullSafe(F.col("b.k")) & (F.col("a.nth") == F.col("b.nth")), "full_outer")
    status = F.when(F.col("b.nth").isNull(), "missing").when(F.col("a.nth").isNull(), "extra") \
        .when(F.col("a.leaf") == F.col("b.leaf"), "ok").otherwise("corrupt")
    pick = lambda c: F.when(F.col("a.nth").isNull(), F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c)
    return both.select(pick("k"), pick("start"), pick("n_bytes"), pick("leaf"), status.alias("status"))
