"""Row and column steps around the tree."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gainkit.operators.ordered import numbered


def rank_index(df: DataFrame, order: list, name: str = "row_number") -> DataFrame:
    """B1: the table with 0-based row numbers over ``order`` (columns or sort
    expressions), from the sizes of sorted ranges: no window over the table.
    Written once, so any number of ranges can be read from it."""
    return numbered(df, order, name)


def rows_at(df: DataFrame, order: list, begin: int, end: int, name: str | None = None) -> DataFrame:
    """The rows at positions [begin, end) of ``order``; with ``name`` their
    positions too. For many ranges of one table keep its :func:`rank_index`."""
    at = name or "_at"
    found = rank_index(df, order, at).where((F.col(at) >= F.lit(begin)) & (F.col(at) < F.lit(end)))
    return found if name else found.drop(at)


def preview(df: DataFrame, n: int = 20, order: list | None = None) -> DataFrame:
    """The first ``n`` rows of ``order``, as a table; any rows without one."""
    return (df.orderBy(*order) if order else df).limit(n)


def row_range(df: DataFrame, begin: int, end: int, index: str = "index") -> DataFrame:
    """Half-open range [begin, end) of an index column (pushed to the scan)."""
    return df.where((F.col(index) >= F.lit(begin)) & (F.col(index) < F.lit(end)))


def drop_header_rows(df: DataFrame, column: str = "_c0", header_text: str = "index") -> DataFrame:
    """B2: drop header lines that were read as data (e.g. in appended CSV files)."""
    return df.where(F.col(column).isNull() | (F.col(column) != F.lit(header_text)))


def project_ordinals(df: DataFrame, ordinals: list[int]) -> DataFrame:
    """Select columns by position."""
    cols = df.columns
    return df.select(*[F.col(cols[i]) for i in ordinals])


def rename_positional(df: DataFrame, names: list[str]) -> DataFrame:
    """Rename all columns by position."""
    return df.toDF(*names)


def horizontal_sum(df: DataFrame, groups: dict[str, list[str]], cast: str | None = None,
                   drop_inputs: bool = False) -> DataFrame:
    """One new column per group, the sum of its member columns.  With
    ``cast`` the members are cast first (text columns must be numbers before
    they are added under ANSI rules)."""
    out = df
    for name, members in groups.items():
        terms = [F.col(m).cast(cast) if cast else F.col(m) for m in members]
        out = out.withColumn(name, reduce(add, terms))
    if drop_inputs:
        out = out.drop(*sorted({m for ms in groups.values() for m in ms}))
    return out


def cast_columns(df: DataFrame, columns: list[str], to: str = "int", strict: bool = True) -> DataFrame:
    """Cast columns; ``strict=False`` gives null for text that is not a number."""
    conv = (lambda c: F.col(c).cast(to)) if strict else (lambda c: F.expr(f"try_cast(`{c}` AS {to})"))
    return df.withColumns({c: conv(c) for c in columns})


def parse_flag(c) -> Column:
    """B7: 'True' -> 1, 'False' -> 0, otherwise the text as an integer (null if not one)."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.when(c == F.lit("True"), F.lit(1)).when(c == F.lit("False"), F.lit(0))
            .otherwise(c.try_cast("int")))


def union_rows(df: DataFrame, other: DataFrame) -> DataFrame:
    """Append rows matched by column name."""
    return df.unionByName(other)


def positional_features(df: DataFrame, label: str, names: list[str]) -> DataFrame:
    """Name the non-label columns of a positional table."""
    cols = [c for c in df.columns if c != label]
    if len(cols) != len(names):
        raise ValueError(f"{len(cols)} feature columns for {len(names)} names")
    return df.select(F.col(label), *[F.col(c).alias(n) for c, n in zip(cols, names)])


def replicate(df: DataFrame, k: int, key: str) -> DataFrame:
    """A4: the table k times; copy c shifts ``key`` by c * count(key), so keys
    stay unique when they were.  One pass: each row is expanded in place (no
    join)."""
    if k < 1:
        raise ValueError(f"k must be 1 or more, not {k}")
    n = df.agg(F.count(F.col(key)).alias("n")).first()["n"]
    rest = [c for c in df.columns if c != key]
    out = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("copy"))
    return out.select((F.col(key) + F.col("copy") * F.lit(n)).alias(key), *rest, F.col("copy").cast("int"))
