"""Labelled views over the driver tables, each with its feature spec and the
same view written for DuckDB (used by the oracle queries).

Every view puts ``class`` (a string label) first, then the features in spec
order, then (where the table has one) a unique key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gainkit.sources.tables import read_table
from gainkit.spec import CONTINUOUS, DISCRETE, FeatureSpec


@dataclass(frozen=True)
class View:
    name: str
    spec: tuple
    key: str | None
    sql: str          # DuckDB text over the registered tables

    @property
    def features(self) -> list[str]:
        return [s.name for s in self.spec]


def _d(n):
    return FeatureSpec(n, DISCRETE)


def _c(n):
    return FeatureSpec(n, CONTINUOUS)


V_RULE = View(
    "v_rule", (_d("l_returnflag"), _d("l_linestatus"), _c("l_quantity"), _c("l_discount"), _c("l_tax"),
               _c("l_extendedprice")), None,
    "SELECT CASE WHEN l_quantity * l_discount > 0.995 THEN '1' ELSE '0' END AS class, "
    "l_returnflag, l_linestatus, l_quantity, l_discount, l_tax, l_extendedprice FROM lineitem")

V_LINES = View(
    "v_lines", V_RULE.spec, "l_orderkey",
    "SELECT CASE WHEN l_quantity * l_discount > 0.995 THEN '1' ELSE '0' END AS class, "
    "l_returnflag, l_linestatus, l_quantity, l_discount, l_tax, l_extendedprice, l_orderkey FROM lineitem")

V_NOISE = View(
    "v_noise", (_d("l_linestatus"), _c("l_quantity"), _c("l_extendedprice"), _c("l_tax")), None,
    "SELECT CASE WHEN l_returnflag = 'R' THEN '1' ELSE '0' END AS class, "
    "l_linestatus, l_quantity, l_extendedprice, l_tax FROM lineitem")

V_MULTI = View(
    "v_multi", (_d("l_linestatus"), _c("l_quantity"), _c("l_discount")), None,
    "SELECT l_returnflag AS class, l_linestatus, l_quantity, l_discount FROM lineitem")

V_ORDERS = View(
    "v_orders", (_d("o_orderpriority"), _d("c_mktsegment"), _c("o_totalprice"), _c("c_acctbal")), "o_orderkey",
    "SELECT CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END AS class, o_orderpriority, c_mktsegment, "
    "o_totalprice, c_acctbal, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey")

V_DOCS = View(
    "v_docs", (_d("lang"), _d("source"), _c("n_chars")), "doc_id",
    "SELECT CAST(l.quality AS VARCHAR) AS class, d.lang, d.source, d.n_chars, d.doc_id "
    "FROM labels l JOIN documents d ON l.doc_id = d.doc_id")

V_GAPS = View(
    "v_gaps", (_d("lang"), _d("source"), _c("n_chars")), "doc_id",
    "SELECT CAST(l.quality AS VARCHAR) AS class, CASE WHEN d.n_chars % 5 > 0 THEN d.lang END AS lang, "
    "CASE WHEN d.doc_id % 4 > 0 THEN d.source END AS source, d.n_chars, d.doc_id FROM labels l JOIN documents d ON l.doc_id = d.doc_id")

V_EVENTS = View(
    "v_events", (_d("user_bucket"), _c("value"), _c("k")), "event_id",
    "SELECT CASE WHEN event_type = 'purchase' THEN '1' ELSE '0' END AS class, "
    "CAST(user_id % 7 AS VARCHAR) AS user_bucket, value, "
    "CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, event_id FROM events")

VIEWS = {v.name: v for v in (V_RULE, V_LINES, V_NOISE, V_MULTI, V_ORDERS, V_DOCS, V_GAPS, V_EVENTS)}


def _flag(cond) -> F.Column:
    return F.when(cond, F.lit("1")).otherwise(F.lit("0"))


def load_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The labelled view as a DataFrame (columns exactly as in its SQL)."""
    if name in ("v_rule", "v_lines"):
        li = read_table(spark, sf_dir, "lineitem")
        return li.select(_flag(F.col("l_quantity") * F.col("l_discount") > 0.995).alias("class"),
                         "l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax", "l_extendedprice",
                         *(["l_orderkey"] if name == "v_lines" else []))
    if name == "v_noise":
        li = read_table(spark, sf_dir, "lineitem")
        return li.select(_flag(F.col("l_returnflag") == "R").alias("class"),
                         "l_linestatus", "l_quantity", "l_extendedprice", "l_tax")
    if name == "v_multi":
        li = read_table(spark, sf_dir, "lineitem")
        return li.select(F.col("l_returnflag").alias("class"), "l_linestatus", "l_quantity", "l_discount")
    if name == "v_orders":
        o = read_table(spark, sf_dir, "orders")
        c = read_table(spark, sf_dir, "customer")
        return o.join(c, o.o_custkey == c.c_custkey).select(
            _flag(F.col("o_orderstatus") == "F").alias("class"), "o_orderpriority", "c_mktsegment",
            "o_totalprice", "c_acctbal", "o_orderkey")
    if name == "v_docs":
        lab = read_table(spark, sf_dir, "labels")
        d = read_table(spark, sf_dir, "documents")
        return lab.join(d, "doc_id").select(F.col("quality").cast("string").alias("class"),
                                            "lang", "source", "n_chars", "doc_id")
    if name == "v_gaps":
        return load_view(spark, sf_dir, "v_docs").withColumns({
            "lang": F.when(F.col("n_chars") % 5 > 0, F.col("lang")), "source": F.when(F.col("doc_id") % 4 > 0, F.col("source"))})
    if name == "v_events":
        e = read_table(spark, sf_dir, "events")
        return e.select(_flag(F.col("event_type") == "purchase").alias("class"),
                        F.pmod(F.col("user_id"), F.lit(7)).cast("string").alias("user_bucket"), "value",
                        F.get_json_object("props", "$.k").cast("double").alias("k"), "event_id")
    raise KeyError(name)
