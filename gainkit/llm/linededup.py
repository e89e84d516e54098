"""Operator 12: lines that repeat across documents, by levelled sorted runs of
line hashes, with DataFrame functions only.

A line's key is the line stripped of white space at both ends and with A-Z in
lower case; keys of at least ``LEAST_CHARS`` code points count. What is known
about keys is kept in runs: tables of (two 64-bit hashes of the key, number of
documents, largest document id), one row for each key, bucketed and sorted by
the hashes. Each new batch of documents is reduced to such rows, merge-anti-
joined with the runs, and what is left becomes a run of its own. Left out are
the keys that a run has settled: found in enough documents, with an id at
least as large. Level 0 takes the new run; a level that holds a run already
is merged with it into the next level, so a run of level l stands for 2**l
batches and a batch meets a logarithmic number of runs. The runs share one
bucketing, so neither anti-joins nor merges shuffle them.

In the end the runs are merged, keys in enough documents are *common*, and each
of their lines goes from every document but the one with the largest id.

Batches are told apart by a hash of the id, so all rows of an id fall into one
batch and the documents of two runs add up. A hot line is counted per (key,
id) first and per key in each task before keys meet.

Defined results: null and empty texts are one empty line; rows of equal ids
count as one document; all null ids are one document, with the smallest id;
rows with the same id and text lose the same lines; an empty table gives an
empty one; ``clean`` keeps every column of ``docs``.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gainkit.session import Scratch

LEAST_CHARS = 20
LEAST_DOCS = 3
BATCHES = 4
WHITE = "\t\n\x0b\x0c\r "
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["h1", "h2"]
#: characters outside ASCII that have a lower case are all of these kinds
CASED = r"[\p{Lu}\p{Lt}\p{Nl}\p{So}&&[^\x00-\x7F]]"


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def lowered(line: Column) -> Column:
    """A-Z in lower case, nothing else. The plain function does that, unless
    there is a letter outside ASCII that it would change as well."""
    return F.when((F.octet_length(line) == F.char_length(line)) | ~F.rlike(line, F.lit(CASED)), F.lower(line)) \
        .otherwise(F.translate(line, UPPER, LOWER))


def hashed_keys(text: Column, least_chars: int = LEAST_CHARS) -> Column:
    """For each line the two hashes of its key, null for keys that don't count."""
    key = F.transform(lines(text), lambda x: F.btrim(x, F.lit(WHITE)))
    low = F.transform(key, lambda x: F.when(F.char_length(x) >= least_chars, lowered(x)))
    return F.transform(low, lambda x: F.when(x.isNotNull(), F.struct(F.xxhash64(x).alias("h1"), F.xxhash64(F.lit(12), x).alias("h2"))))


def counted(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(h1, h2, id): a row for each document and key that counts."""
    return docs.select("id", F.explode(F.array_distinct(hashed_keys(F.col("text"), least_chars))).alias("h")) \
        .filter("h IS NOT NULL").select("h.*", "id")


def summed(pairs: DataFrame) -> DataFrame:
    """(h1, h2, n, top) from (h1, h2, id): a hot key is one row for each task
    when its documents meet."""
    return pairs.distinct().groupBy(*HASH).agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))


class Runs:
    """The runs under a scratch folder; one at most for each level."""

    def __init__(self, spark: SparkSession, scratch: Scratch, least_docs: int = LEAST_DOCS):
        self.spark, self.scratch, self.least_docs = spark, scratch, least_docs
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: dict[int, str] = {}

    def _written(self, rows: DataFrame) -> str:
        name = f"gainkit_run_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).option("path", f"{self.scratch.path}/{name}").saveAsTable(name)
        return name

    def _dropped(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.scratch.delete(f"{self.scratch.path}/{name}")

    def add(self, batch: DataFrame) -> None:
        """``batch``: (h1, h2, n, top) of documents that no run has seen."""
        for name in self.levels.values():
            run = self.spark.table(name).filter(F.col("n") >= self.least_docs).alias("r")
            settled = (F.col("b.h1") == F.col("r.h1")) & (F.col("b.h2") == F.col("r.h2")) & \
                (F.col("b.top").isNull() | (F.col("r.top") >= F.col("b.top")))
            batch = batch.alias("b").join(run, settled, "left_anti")
        new, level = self._written(batch), 0
        while level in self.levels:
            old = self.levels.pop(level)
            both = self._written(merged(self.spark.table(old), self.spark.table(new)))
            self._dropped(old)
            self._dropped(new)
            new, level = both, level + 1
        self.levels[level] = new

    def common(self) -> DataFrame | None:
        """(h1, h2, top) of the keys found in enough documents."""
        if not self.levels:
            return None
        return reduce(merged, map(self.spark.table, self.levels.values())).filter(F.col("n") >= self.least_docs).select(*HASH, "top")

    def close(self) -> None:
        for name in self.levels.values():
            self._dropped(name)
        self.levels.clear()


def merged(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two runs as one: counts add up, the larger id stays."""
    zero = F.lit(0).cast("long")
    return a.alias("a").join(b.alias("b"), HASH, "full_outer").select(
        *HASH, (F.coalesce("a.n", zero) + F.coalesce("b.n", zero)).alias("n"), F.greatest("a.top", "b.top").alias("top"))


def common_lines(docs: DataFrame, scratch: Scratch, batches: int = BATCHES, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(h1, h2, top) of the keys found in at least ``least_docs`` of ``docs``
    (id, text), which come in ``batches`` by a hash of their id."""
    spark = docs.sparkSession
    pairs = scratch.cut(counted(docs, least_chars).withColumn("batch", F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(batches))))
    runs = Runs(spark, scratch, least_docs)
    try:
        for n in range(batches):
            runs.add(summed(pairs.filter(F.col("batch") == n).drop("batch")))
        return scratch.cut(runs.common())
    finally:
        runs.close()
        scratch.drop(pairs)


def _row_key() -> list[Column]:
    return [F.col("id"), F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(5), "text").alias("t2")]


def dropped_places(docs: DataFrame, common: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(id, t1, t2, gone): for each row of (id, text) that loses lines, by its
    id and text hashes, their 0-based places."""
    each = docs.select(*_row_key(), F.posexplode(hashed_keys(F.col("text"), least_chars)).alias("pos", "h")) \
        .filter("h IS NOT NULL").select("id", "t1", "t2", "pos", "h.*")
    return each.join(common, HASH).filter(~F.col("id").eqNullSafe(F.col("top"))) \
        .groupBy("id", "t1", "t2").agg(F.collect_set("pos").alias("gone"))


def deduplicate(docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", keep: list[str] | None = None,
                batches: int = BATCHES, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """A row for each row of ``docs``: struct ``_doc`` (the row's columns
    ``keep``, all by default), ``_text`` (its text without the dropped lines),
    ``_lines`` (how many it had) and ``_dropped`` (how many went)."""
    d = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    gone = scratch.cut(dropped_places(d, common_lines(d, scratch, batches, least_chars, least_docs), least_chars))
    whole = docs.select(F.struct(*(keep or ["*"])).alias("_doc"), F.col(key).alias("id"), F.col(text).alias("text")).select("_doc", "text", *_row_key())
    same = reduce(lambda a, b: a & b, [F.col(f"d.{c}").eqNullSafe(F.col(f"g.{c}")) for c in ("id", "t1", "t2")])
    every = lines(F.col("d.text"))
    joined = whole.alias("d").join(gone.alias("g"), same, "left").select("d._doc", every.alias("_all"), F.col("g.gone"))
    places = F.array_except(F.sequence(F.lit(0), F.size("_all") - 1), F.col("gone"))     # in order, without the dropped
    stay = F.when(F.col("gone").isNull(), F.col("_all")).otherwise(F.transform(places, lambda i: F.get(F.col("_all"), i)))
    return joined.select("_doc", F.array_join(stay, "\n").alias("_text"), F.size("_all").cast("long").alias("_lines"),
                         F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("_dropped"))


def clean(docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with the dropped lines taken out of their texts."""
    d = deduplicate(docs, scratch, key, text, **options)
    return d.select(*[F.col("_text").alias(c) if c == text else F.col(f"_doc.`{c}`") for c in docs.columns])
