"""Parquet tables of a scale-factor folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gainkit.session import table_path

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def register_tables(spark: SparkSession, sf_dir: str, names=None) -> None:
    """A5: temp views over the Parquet files, queried by ``spark.sql``."""
    for name in names or TABLES:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)


def query(spark: SparkSession, text: str, params: dict | None = None) -> DataFrame:
    """H5: SQL over the registered views; values go in as named parameters
    (``:name``), never as part of the text."""
    return spark.sql(text, args=params or {})
