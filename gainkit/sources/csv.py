"""The match CSV layout: typed scan, header handling, feature derivation and
the append sink (A1-A3, A7, A8).

The file has a header line and at least 44 columns; they are read by
position.  Column 0 is a running row number named ``index``.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gainkit.operators.rows import drop_header_rows, row_range
from gainkit.operators.sampling import hash_split, random_split
from gainkit.spec import CONTINUOUS, DISCRETE, FeatureSpec

# ---------------------------------------------------------------------------
# Fixed values of the match layout (must equal the source file's layout).
INDEX_ORDINAL = 0
HEADER_TEXT = "index"
CLASS_ORDINAL = 4
FLAG_ORDINALS = [5, 6, 7, 8, 9, 10]
FLAG_NAMES = ["team1_firstBlood", "team1_firstTower", "team1_firstInhibitor",
              "team1_firstBaron", "team1_firstDragon", "team1_firstRiftHerald"]
PLAYER_STAT_ORDINALS = {
    "player_kills": [12, 19, 26, 33, 40],
    "player_deaths": [13, 20, 27, 34, 41],
    "player_assists": [14, 21, 28, 35, 42],
    "player_goldEarned": [15, 22, 29, 36, 43],
}
# ---------------------------------------------------------------------------

MATCH_SPEC = [FeatureSpec(n, DISCRETE) for n in FLAG_NAMES] + \
             [FeatureSpec(n, CONTINUOUS) for n in PLAYER_STAT_ORDINALS]


def read_csv_text(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """A1: every column as text; without a header columns are named _c0, _c1, ..."""
    return spark.read.option("header", str(header).lower()).option("inferSchema", "false").csv(path)


def read_csv_typed(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A2: header line + inferred (or given) types."""
    r = spark.read.option("header", "true")
    return (r.schema(schema) if schema is not None else r.option("inferSchema", "true")).csv(path)


def match_features(raw: DataFrame) -> DataFrame:
    """B2-B6 on a text scan: drop repeated header lines, keep class + six
    flags, add up the four player statistics over the five players (cast to
    numbers first), name the columns.  Result: class, 6 flags, 4 ints, index."""
    cols = raw.columns
    raw = drop_header_rows(raw, cols[INDEX_ORDINAL], HEADER_TEXT)
    sums = [reduce(add, [F.col(cols[i]).cast("long") for i in ords]).cast("int").alias(name)
            for name, ords in PLAYER_STAT_ORDINALS.items()]
    return raw.select(
        F.col(cols[CLASS_ORDINAL]).cast("string").alias("class"),
        *[F.col(cols[i]).cast("string").alias(n) for i, n in zip(FLAG_ORDINALS, FLAG_NAMES)],
        *sums,
        F.col(cols[INDEX_ORDINAL]).cast("long").alias("index"),
    )


def read_match_features(spark: SparkSession, path: str, begin: int | None = None, end: int | None = None,
                        header: bool = True):
    """(spec, features) for the rows whose index lies in [begin, end)."""
    df = match_features(read_csv_text(spark, path, header))
    if begin is not None or end is not None:
        df = row_range(df, begin if begin is not None else -(1 << 62), end if end is not None else 1 << 62)
    return MATCH_SPEC, df


def match_holdout(spark: SparkSession, path: str, weights=(4, 1), seed: int = 100, split: str = "hash",
                  header: bool = True):
    """(spec, train, test): load, split (keyed on ``index`` by default,
    Spark's Bernoulli split with ``split='random'``), derive features."""
    df = match_features(read_csv_text(spark, path, header))
    if split == "hash":
        train, test = hash_split(df, "index", weights, seed)
    else:
        train, test = random_split(df, weights, seed)
    return MATCH_SPEC, train, test


def append_csv(df: DataFrame, path: str, header: bool = False) -> None:
    """A3: append rows to a CSV folder (no header, as the scale-up does)."""
    df.write.mode("append").option("header", str(header).lower()).csv(path)
