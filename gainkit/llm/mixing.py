"""Operator 9: mix sources to target weights by systematic sampling, with
DataFrame functions only.

Each source's target is its weight's share of the mix, held at ``most`` times
the source's size; what that cuts off is shared again by weight. Every
document of a source expects ``target / size`` copies. Within a source the
expected copies are summed along a fixed order, one offset drawn from the seed
is added, and a document is emitted once for every integer its interval
crosses. The order runs through strata of like size, so the words taken stay
near the target, and within a stratum by a hash of the id (of the text, where
the id is null), the id and a hash of the text.

Positions come from counts per (source, stratum, hash bucket): buckets grow in
number with the rows (to 4096 for each stratum of each source), so a hot source
is ranked in many small windows, and only the counts meet in one window per
source.

Defined results: null sources are one source, last; null and empty texts have
size 0, expect copies like the others and take no words; rows of equal ids, or
without one, are told apart by their texts, so reruns agree on them; rows of
equal id, source and text are alike; an empty table gives an empty one;
``mix`` keeps every column of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gainkit.session import Scratch

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
ROWS_PER_BUCKET = 20_000
CELL_BITS = 12
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """From one row per source (_source, _words, ...): its target, by filling
    shares up to the limits in the order in which the limits are reached. One
    row per source goes through the windows."""
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    named = sizes.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1))
    full = Window.orderBy((F.col("_words") / F.col("_w")), F.col("_source").asc_nulls_last())
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    rest = full.rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # the level at which this source would be the first that is not held
    level = named.select("*", (((F.sum("_words").over(every) * F.lit(share)) - F.coalesce(F.sum("_words").over(before), F.lit(0)) * most)
                               / F.sum("_w").over(rest)).alias("_level"))
    held = F.col("_words") * most <= F.col("_level") * F.col("_w")
    first = F.min(F.when(~held, F.struct(F.col("_words") / F.col("_w"), F.col("_level")))).over(every)
    return level.withColumn("_target", F.when(held, (F.col("_words") * most).cast("double"))
                            .otherwise(F.least(first["_level"] * F.col("_w"), (F.col("_words") * most).cast("double")))).drop("_w", "_level")


def _hash(seed: int) -> Column:
    """A 32-bit hash of the id, or of the text where there is none."""
    drawn = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_key").cast("string"), F.col("_own"))))
    return F.conv(F.substring(drawn, 1, 8), 16, 10).cast("long")


def _bucket(cell: Column, buckets: Column) -> Column:
    return F.floor(cell * buckets / F.lit(1 << CELL_BITS)).cast("long")


def _same(a: str, b: str, *names: str) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}"))
    return cond


def strata(sized: DataFrame, scratch: Scratch, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per (source, stratum): ``_offsets``, the number of the source's
    documents before each hash bucket of the stratum, and the source's size
    and target. The texts are read once for it; everything is derived from
    counts per (source, stratum, leading ``CELL_BITS`` bits of the hash)."""
    cells = sized.groupBy("_source", "_stratum", F.shiftright("_hash", 32 - CELL_BITS).alias("_cell")) \
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_words"))
    cells = scratch.cut(cells)
    counts = cells.groupBy("_source", "_stratum").agg(F.sum("_n").alias("_rows"), F.sum("_words").alias("_words")) \
        .withColumn("_buckets", F.least(F.ceil(F.col("_rows") / ROWS_PER_BUCKET), F.lit(1 << CELL_BITS)))
    few = counts.select("_source", "_stratum", "_buckets")
    filled = cells.alias("n").join(few.alias("s"), _same("n", "s", "_source", "_stratum")) \
        .select("n._source", "n._stratum", _bucket(F.col("_cell"), F.col("_buckets")).alias("_bucket"), "_n") \
        .groupBy("_source", "_stratum", "_bucket").agg(F.sum("_n").alias("_n"))
    every = few.select("_source", "_stratum", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_buckets") - 1)).alias("_bucket"))
    every = every.alias("c").join(filled.alias("f"), _same("c", "f", "_source", "_stratum", "_bucket"), "left") \
        .select("c.*", F.coalesce(F.col("f._n"), F.lit(0)).alias("_n"))
    order = Window.partitionBy("_source").orderBy("_stratum", "_bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = every.select("*", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_before")) \
        .groupBy("_source", "_stratum").agg(F.sort_array(F.collect_list(F.struct("_bucket", "_before"))).alias("_places")) \
        .select("_source", "_stratum", F.transform("_places", lambda x: x["_before"]).alias("_offsets"))
    aims = targets(counts.groupBy("_source").agg(F.sum("_words").alias("_words")), weights, share, most)
    return scratch.cut(placed.alias("p").join(aims.alias("a"), _same("p", "a", "_source")).select(
        "p.*", F.col("a._words").alias("_source_size"), F.col("a._target").alias("_target")))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", seed: int = 0,
        weights=WEIGHTS, share: float = SHARE, most: int = MOST, keep: list[str] | None = None) -> DataFrame:
    """A row for each row of ``docs``: struct ``_doc`` (the row's columns
    ``keep``, all by default), _size, _source_size, _target and _copies (how
    often the mix holds it)."""
    digits = F.col("_size").cast("string")

    def sized(*payload):
        own = F.when(F.col(key).isNull(), F.md5(F.coalesce(F.col(text), F.lit(""))))
        d = docs.select(*payload, F.col(key).alias("_key"), F.col(source).alias("_source"), word_count(F.col(text)).alias("_size"),
                        own.alias("_own"), F.xxhash64(text).alias("_tie"))
        return d.withColumn("_stratum", F.length(digits) * 100 + F.substring(digits, 1, 2).cast("int")).withColumn("_hash", _hash(seed))

    with Scratch(docs.sparkSession, "mix") as scratch:
        d, s = sized(F.struct(*(keep or ["*"])).alias("_doc")), strata(sized(), scratch, weights, share, most)
    cell = F.shiftright("_hash", 32 - CELL_BITS)
    whole = d.alias("d").join(s.alias("s"), _same("d", "s", "_source", "_stratum")).select(
        "d.*", _bucket(cell, F.size("_offsets")).alias("_bucket"), "_offsets", "_source_size", "_target")
    whole = whole.withColumn("_before", F.get("_offsets", F.col("_bucket").cast("int"))).drop("_offsets")
    ranked = whole.withColumn("_rank", F.col("_before") + F.row_number().over(
        Window.partitionBy("_source", "_stratum", "_bucket").orderBy("_hash", "_key", "_tie")))
    return ranked.select("_doc", "_size", "_source_size", "_target", copies(seed).alias("_copies"))


def copies(seed: int) -> Column:
    """Integers crossed by the document's interval of expected copies. The
    offset is a multiple of 2**-20, so whole expectations stay exact."""
    step = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(F.lit(0.0))
    draw = F.md5(F.concat(F.lit(f"offset:{seed}:"), F.coalesce(F.col("_source"), F.lit("\u0000null"))))
    offset = F.conv(F.substring(draw, 1, 5), 16, 10).cast("double") / F.lit(float(1 << 20))
    return (F.floor(step * F.col("_rank") + offset) - F.floor(step * (F.col("_rank") - 1) + offset)).cast("int")


def sample(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is emitted."""
    m = mix(docs, **options).filter("_copies > 0")
    return m.select("_doc", F.explode(F.array_repeat(F.lit(0), F.col("_copies")))).select("_doc.*")
