"""Registered queries: one Spark query per operator family, each over the
driver tables, with the DuckDB SQL that must give the same rows.

Every Spark callable takes (spark, sf_dir) and returns a DataFrame whose
column names and types match its SQL.  Measures are rounded to
``REPORT_DIGITS`` on both sides; thresholds are compared exactly (both
engines compute the same midpoint of the same two doubles).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gainkit.functions.curve import fixed_weights, minmax_scale, network_score, network_sql, squared_loss
from gainkit.functions.measures import REPORT_DIGITS as RD
from gainkit.operators.aggregates import majority_class
from gainkit.operators.impurity import entropy, gain_ratio, intrinsic_value
from gainkit.operators.rows import (cast_columns, drop_header_rows, horizontal_sum, parse_flag, project_ordinals,
                                    preview, rename_positional, replicate, row_range, rows_at, union_rows)
from gainkit.operators.sampling import exact_rank, exact_split, hash_side, kfold_assign
from gainkit.operators.split_search import all_thresholds, best_split, best_threshold
from gainkit.operators.tree import build_dictionary
from gainkit.plans import oracle as O
from gainkit.plans.views import VIEWS, load_view
from gainkit.sources.tables import query, read_table, register_tables
from gainkit.spec import DISCRETE, FeatureSpec

BIN = ["0", "1"]
FLAGS = ["A", "N", "R"]


def _r(c: str):
    return F.round(F.col(c), RD).alias(c)


def _spec(name):
    return list(VIEWS[name].spec)


def _tuples(name):
    return [(s.name, s.kind) for s in VIEWS[name].spec]


# --- E1 ---------------------------------------------------------------------

def q_entropy(spark, sf):
    e = entropy(load_view(spark, sf, "v_rule"), "class", by=["l_returnflag"])
    return e.select("l_returnflag", "n_rows", "n_classes", _r("entropy"))


SQL_ENTROPY = O.entropy_sql(VIEWS["v_rule"].sql, ["l_returnflag"])


# --- E2 / E3 / E4 / E5 / E6 ---------------------------------------------------

def _measure_cols(df, by):
    return df.select(*by, _r("gain"), _r("intrinsic_value"), _r("gain_ratio"), "n_values", "n_rows")


def q_info_gain(spark, sf):
    df = gain_ratio(load_view(spark, sf, "v_rule"), "class", "l_linestatus", by=["l_returnflag"], classes=BIN)
    return _measure_cols(df, ["l_returnflag"])


SQL_INFO_GAIN = O.measure_sql(VIEWS["v_rule"].sql, ["l_returnflag"], "l_linestatus", "l_linestatus", BIN)


def q_info_gain_threshold(spark, sf):
    df = gain_ratio(load_view(spark, sf, "v_rule"), "class", "l_quantity", by=["l_linestatus"],
                    threshold=14.5, classes=BIN)
    return _measure_cols(df, ["l_linestatus"])


SQL_INFO_GAIN_THRESHOLD = O.measure_sql(VIEWS["v_rule"].sql, ["l_linestatus"], "l_quantity", "side", BIN,
                                        threshold=14.5)


def q_intrinsic_value(spark, sf):
    df = intrinsic_value(load_view(spark, sf, "v_orders"), "o_orderpriority", by=["c_mktsegment"])
    return df.select("c_mktsegment", _r("intrinsic_value"), "n_values", "n_rows")


SQL_INTRINSIC_VALUE = (
    "SELECT c_mktsegment, intrinsic_value, n_values, n_rows FROM ("
    + O.measure_sql(VIEWS["v_orders"].sql, ["c_mktsegment"], "o_orderpriority", "o_orderpriority", ["1"],
                    label="'1'") + ")")


def q_intrinsic_value_threshold(spark, sf):
    df = intrinsic_value(load_view(spark, sf, "v_rule"), "l_discount", by=["l_returnflag"], threshold=0.025)
    return df.select("l_returnflag", _r("intrinsic_value"), "n_values", "n_rows")


SQL_INTRINSIC_VALUE_THRESHOLD = (
    "SELECT l_returnflag, intrinsic_value, n_values, n_rows FROM ("
    + O.measure_sql(VIEWS["v_rule"].sql, ["l_returnflag"], "l_discount", "side", ["1"], threshold=0.025,
                    label="'1'") + ")")


def q_gain_ratio(spark, sf):
    df = gain_ratio(load_view(spark, sf, "v_docs"), "class", "source", by=["lang"], classes=BIN)
    return _measure_cols(df, ["lang"])


SQL_GAIN_RATIO = O.measure_sql(VIEWS["v_docs"].sql, ["lang"], "source", "source", BIN)


# --- E7 / E8 -----------------------------------------------------------------

def _bt(df, by):
    return df.select(*by, "feature", "threshold", _r("gain"), _r("intrinsic_value"), _r("gain_ratio"),
                     "n_values", "n_candidates")


RULE_CONT = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]


def q_best_threshold(spark, sf):
    return _bt(best_threshold(load_view(spark, sf, "v_rule"), "class", RULE_CONT, classes=BIN), [])


SQL_BEST_THRESHOLD = O.best_threshold_sql(VIEWS["v_rule"].sql, [], RULE_CONT, BIN)


def q_best_threshold_by_group(spark, sf):
    by = ["l_returnflag", "l_linestatus"]
    df = best_threshold(load_view(spark, sf, "v_rule"), "class", ["l_quantity", "l_extendedprice"], by=by,
                        classes=BIN)
    return _bt(df, by)


SQL_BEST_THRESHOLD_BY_GROUP = O.best_threshold_sql(VIEWS["v_rule"].sql, ["l_returnflag", "l_linestatus"],
                                                   ["l_quantity", "l_extendedprice"], BIN)


def q_best_threshold_events(spark, sf):
    df = best_threshold(load_view(spark, sf, "v_events"), "class", ["value", "k"], by=["user_bucket"],
                        classes=BIN)
    return _bt(df, ["user_bucket"])


SQL_BEST_THRESHOLD_EVENTS = O.best_threshold_sql(VIEWS["v_events"].sql, ["user_bucket"], ["value", "k"], BIN)


def q_best_threshold_multi(spark, sf):
    return _bt(best_threshold(load_view(spark, sf, "v_multi"), "class", ["l_quantity", "l_discount"],
                              classes=FLAGS), [])


SQL_BEST_THRESHOLD_MULTI = O.best_threshold_sql(VIEWS["v_multi"].sql, [], ["l_quantity", "l_discount"], FLAGS)


# --- E9 / E10 ----------------------------------------------------------------

def _ranked(df, by):
    return df.select(*by, "feature", "kind", "threshold", _r("gain"), _r("intrinsic_value"), _r("gain_ratio"),
                     "n_values", "n_rows", _r("mean_gain"), "qualified", F.col("rank").cast("long").alias("rank"))


def q_rank_splits(spark, sf):
    return _ranked(best_split(load_view(spark, sf, "v_rule"), "class", _spec("v_rule"), classes=BIN,
                              all_candidates=True), [])


SQL_RANK_SPLITS = O.ranked_sql(VIEWS["v_rule"].sql, [], _tuples("v_rule"), BIN)


def q_rank_splits_noise(spark, sf):
    return _ranked(best_split(load_view(spark, sf, "v_noise"), "class", _spec("v_noise"), classes=BIN,
                              all_candidates=True), [])


SQL_RANK_SPLITS_NOISE = O.ranked_sql(VIEWS["v_noise"].sql, [], _tuples("v_noise"), BIN)


ORDERS_FEATS = [("c_mktsegment", "discrete"), ("o_totalprice", "continuous"), ("c_acctbal", "continuous")]


def q_best_split_by_group(spark, sf):
    from gainkit.spec import FeatureSpec
    spec = [FeatureSpec(n, k) for n, k in ORDERS_FEATS]
    df = best_split(load_view(spark, sf, "v_orders"), "class", spec, by=["o_orderpriority"], classes=BIN)
    return _ranked(df, ["o_orderpriority"])


SQL_BEST_SPLIT_BY_GROUP = O.ranked_sql(VIEWS["v_orders"].sql, ["o_orderpriority"], ORDERS_FEATS, BIN,
                                       only_best=True)


def q_best_split_docs(spark, sf):
    from gainkit.spec import FeatureSpec
    spec = [FeatureSpec("source", "discrete"), FeatureSpec("n_chars", "continuous")]
    df = best_split(load_view(spark, sf, "v_docs"), "class", spec, by=["lang"], classes=BIN, all_candidates=True)
    return _ranked(df, ["lang"])


SQL_BEST_SPLIT_DOCS = O.ranked_sql(VIEWS["v_docs"].sql, ["lang"], [("source", "discrete"),
                                                                  ("n_chars", "continuous")], BIN)


def q_best_split_multi(spark, sf):
    return _ranked(best_split(load_view(spark, sf, "v_multi"), "class", _spec("v_multi"), classes=FLAGS,
                              all_candidates=True), [])


SQL_BEST_SPLIT_MULTI = O.ranked_sql(VIEWS["v_multi"].sql, [], _tuples("v_multi"), FLAGS)


# --- D8 ----------------------------------------------------------------------

def q_majority(spark, sf):
    return majority_class(load_view(spark, sf, "v_multi"), "class", by=["l_linestatus"], classes=FLAGS)


SQL_MAJORITY = (
    f"WITH src AS ({VIEWS['v_multi'].sql}), c AS (SELECT l_linestatus, class, count(*) AS n FROM src GROUP BY ALL), "
    "r AS (SELECT *, sum(n) OVER (PARTITION BY l_linestatus) AS n_rows, "
    "row_number() OVER (PARTITION BY l_linestatus ORDER BY n DESC, class ASC) AS rk FROM c) "
    "SELECT l_linestatus, CAST(n_rows AS BIGINT) AS n_rows, class AS majority FROM r WHERE rk = 1")


# --- D1 / D2 / D4 / D5 ---------------------------------------------------------

def q_class_counts(spark, sf):
    from gainkit.operators.impurity import class_counts
    return class_counts(load_view(spark, sf, "v_multi"), "class", by=["l_linestatus"])


SQL_CLASS_COUNTS = (f"SELECT l_linestatus, class, count(*) AS n_rows FROM ({VIEWS['v_multi'].sql}) "
                    "GROUP BY l_linestatus, class")


def q_distinct_counts(spark, sf):
    from gainkit.operators.aggregates import distinct_counts
    return distinct_counts(load_view(spark, sf, "v_rule"), ["l_quantity", "l_discount", "l_tax"],
                           by=["l_returnflag"])


SQL_DISTINCT_COUNTS = (
    "SELECT l_returnflag, "
    + ", ".join(f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS {c}_distinct"
                for c in ["l_quantity", "l_discount", "l_tax"])
    + f" FROM ({VIEWS['v_rule'].sql}) GROUP BY l_returnflag")


# --- C2 / C3 / C5 --------------------------------------------------------------

def q_hash_split(spark, sf):
    o = read_table(spark, sf, "orders")
    return o.select("o_orderkey", hash_side("o_orderkey", [4, 1], 100).alias("side"))


SQL_HASH_SPLIT = ("SELECT o_orderkey, CASE WHEN ('0x' || substr(md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), "
                  "'100')), 1, 8))::BIGINT / 4294967296.0 < 0.8 THEN 0 ELSE 1 END AS side FROM orders")


def q_exact_split(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey")
    ranked = exact_rank(o, "o_orderkey", 100)
    n_train = int(o.count() * 4 / 5)
    return ranked.select("o_orderkey", F.col("_rank").alias("rank"),
                         F.when(F.col("_rank") < n_train, 0).otherwise(1).alias("side"))


SQL_EXACT_SPLIT = (
    "WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY ('0x' || substr(md5(concat_ws('|', "
    "CAST(o_orderkey AS VARCHAR), '100')), 1, 15))::BIGINT, o_orderkey) - 1 AS rank, count(*) OVER () AS n "
    "FROM orders) SELECT o_orderkey, rank, CASE WHEN rank < floor(n * 4 / 5) THEN 0 ELSE 1 END AS side FROM r")


def q_kfold(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey")
    return kfold_assign(o, "o_orderkey", 5, 100)


SQL_KFOLD = ("SELECT o_orderkey, CAST(('0x' || substr(md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), '100')), "
             "1, 8))::BIGINT % 5 AS INTEGER) AS fold FROM orders")


# --- A4 / B1 / B5 ---------------------------------------------------------------

def q_replicate(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return replicate(o, 3, "o_orderkey")


SQL_REPLICATE = ("WITH n AS (SELECT count(o_orderkey) AS n FROM orders) "
                 "SELECT o.o_orderkey + c.copy * n.n AS o_orderkey, o.o_totalprice, CAST(c.copy AS INTEGER) AS copy "
                 "FROM orders o CROSS JOIN (SELECT unnest(range(3)) AS copy) c CROSS JOIN n")


def q_row_range(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return row_range(o, 1000, 9000, "o_orderkey")


SQL_ROW_RANGE = ("SELECT o_orderkey, o_custkey, o_totalprice FROM orders "
                 "WHERE o_orderkey >= 1000 AND o_orderkey < 9000")


def q_horizontal_sum(spark, sf):
    li = read_table(spark, sf, "lineitem")
    out = horizontal_sum(li, {"units": ["l_quantity", "l_linenumber"],
                              "charges": ["l_extendedprice", "l_tax", "l_discount"]})
    return out.select("l_orderkey", "l_linenumber", F.round("units", 6).alias("units"),
                      F.round("charges", 6).alias("charges"))


SQL_HORIZONTAL_SUM = ("SELECT l_orderkey, l_linenumber, round(l_quantity + l_linenumber, 6) AS units, "
                      "round(l_extendedprice + l_tax + l_discount, 6) AS charges FROM lineitem")


# --- B2 / B3 / B4 / B6 / B7 / B11 / C2b -------------------------------------------

def q_drop_header_rows(spark, sf):
    o = read_table(spark, sf, "orders")
    first = F.when(F.col("o_orderkey") % 7 == 0, "index").otherwise(F.col("o_orderkey").cast("string"))
    return drop_header_rows(o.select(first.alias("_c0"), "o_totalprice"))


SQL_DROP_HEADER_ROWS = "SELECT CAST(o_orderkey AS VARCHAR) AS _c0, o_totalprice FROM orders WHERE o_orderkey % 7 <> 0"


def q_project_ordinals(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return project_ordinals(o, [3, 0])


SQL_PROJECT_ORDINALS = "SELECT o_totalprice, o_orderkey FROM orders"


def q_rename_positional(spark, sf):
    return rename_positional(read_table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["key", "customer"])


SQL_RENAME_POSITIONAL = "SELECT o_orderkey AS key, o_custkey AS customer FROM orders"


def q_cast_columns(spark, sf):
    k = F.when(F.col("event_id") % 5 == 0, "n/a").otherwise(F.get_json_object("props", "$.k"))
    return cast_columns(read_table(spark, sf, "events").select("event_id", k.alias("k")), ["k"], "double", strict=False)


SQL_CAST_COLUMNS = ("SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k "
                    "FROM events")


def q_parse_flag(spark, sf):
    i = F.col("event_id")
    text = F.when(i % 4 == 0, "True").when(i % 4 == 1, "False").when(i % 4 == 2, (i % 10).cast("string")).otherwise(F.col("event_type"))
    return read_table(spark, sf, "events").select("event_id", parse_flag(text).alias("flag"))


SQL_PARSE_FLAG = ("SELECT event_id, CAST(CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN event_id % 10 END AS INTEGER) AS flag "
                  "FROM events")


def q_union_rows(spark, sf):
    o = read_table(spark, sf, "orders")
    return union_rows(o.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"), o.select("o_totalprice", "o_orderkey"))


SQL_UNION_ROWS = ("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' "
                  "UNION ALL SELECT o_orderkey, o_totalprice FROM orders")


def q_exact_split_total(spark, sf):
    """An exact 4:1 split of the first half of the lines, in hash order of
    their key."""
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    train, test = exact_split(li, ["l_orderkey", "l_linenumber"], total=li.count() // 2)
    return train.withColumn("side", F.lit(0)).unionByName(test.withColumn("side", F.lit(1)))


SQL_EXACT_SPLIT_TOTAL = (
    "WITH r AS (SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY ('0x' || substr(md5(concat_ws('|', "
    "CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), '100')), 1, 15))::BIGINT, l_orderkey, l_linenumber) - 1 AS rank, "
    "count(*) OVER () // 2 AS n FROM lineitem) "
    "SELECT l_orderkey, l_linenumber, CASE WHEN rank < floor(n * 4 / 5) THEN 0 ELSE 1 END AS side FROM r WHERE rank < n")


# --- I1 / I2 / I4 / I5 -----------------------------------------------------------

W = fixed_weights()
NET = network_sql("value_scaled", *W)


def _scaled_events(spark, sf):
    e = read_table(spark, sf, "events").select("event_id", "value",
                                               F.get_json_object("props", "$.k").cast("double").alias("k"))
    return minmax_scale(e, ["value", "k"])


def q_minmax(spark, sf):
    s = _scaled_events(spark, sf)
    return s.select("event_id", F.round("value_scaled", 9).alias("value_scaled"),
                    F.round("k_scaled", 9).alias("k_scaled"))


SQL_EVENTS_SCALED = (
    "WITH e AS (SELECT event_id, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events), "
    "b AS (SELECT min(value) AS mv, max(value) - min(value) AS sv, min(k) AS mk, max(k) - min(k) AS sk FROM e), "
    "s AS (SELECT event_id, value, k, CASE WHEN sv <> 0 THEN (value - mv) / sv END AS value_scaled, "
    "CASE WHEN sk <> 0 THEN (k - mk) / sk END AS k_scaled, mk, sk FROM e CROSS JOIN b)")
SQL_MINMAX = (SQL_EVENTS_SCALED + " SELECT event_id, round(value_scaled, 9) AS value_scaled, "
              "round(k_scaled, 9) AS k_scaled FROM s")


def q_network(spark, sf):
    s = _scaled_events(spark, sf)
    return s.select("event_id", F.round(network_score("value_scaled", *W), 9).alias("yhat"))


SQL_NETWORK = SQL_EVENTS_SCALED + f" SELECT event_id, round({NET}, 9) AS yhat FROM s"


def q_network_loss(spark, sf):
    s = _scaled_events(spark, sf).withColumn("yhat", network_score("value_scaled", *W))
    return squared_loss(s, "k_scaled", "yhat").select(F.round("loss", 9).alias("loss"), F.lit(s.count()).alias("n_rows"))


SQL_NETWORK_LOSS = (SQL_EVENTS_SCALED + f" SELECT round(avg(pow(k_scaled - {NET}, 2)), 9) AS loss, "
                    "count(*) AS n_rows FROM s")


def q_inverse_scaled(spark, sf):
    """Scaled k mapped back to its own units."""
    from gainkit.functions.curve import inverse_minmax, minmax_bounds
    e = read_table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("double").alias("k"))
    b = minmax_bounds(e, ["k"]).first()
    s = minmax_scale(e, ["k"])
    return s.select("event_id", F.round(inverse_minmax("k_scaled", b["min_k"], b["span_k"]), 6).alias("k_back"))


SQL_INVERSE_SCALED = SQL_EVENTS_SCALED + " SELECT event_id, round(k_scaled * sk + mk, 6) AS k_back FROM s"


# ---------------------------------------------------------------------------

# --- rows by position, previews, dictionaries, every threshold ---------------

def q_rows_at(spark, sf):
    """B1: positions [100, 5000) of the orders, dearest first."""
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return rows_at(o, [F.desc("o_totalprice"), F.col("o_orderkey")], 100, 5000, "position")


SQL_ROWS_AT = ("SELECT * FROM (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS position FROM orders) "
               "WHERE position >= 100 AND position < 5000")


def q_preview(spark, sf):
    """The 20 latest events."""
    return preview(read_table(spark, sf, "events").select("event_id", "event_type", "value"), 20, [F.desc("event_id")])


SQL_PREVIEW = "SELECT event_id, event_type, value FROM events ORDER BY event_id DESC LIMIT 20"


def q_dictionary(spark, sf):
    """Codes of every order key (as text) and every return flag, in value order."""
    spec = [FeatureSpec("l_orderkey", DISCRETE), FeatureSpec("l_returnflag", DISCRETE)]
    d = build_dictionary(read_table(spark, sf, "lineitem"), spec)
    return d.select(F.when(F.col("_p") == 0, "l_orderkey").otherwise("l_returnflag").alias("feature"), "value", "code")


SQL_DICTIONARY = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, v AS value, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM lineitem)"
    for c in ("l_orderkey", "l_returnflag"))


def q_all_thresholds(spark, sf):
    """Every threshold of two features of the rule view, one with nearly as many values as rows."""
    t = all_thresholds(load_view(spark, sf, "v_rule"), "class", ["l_extendedprice", "l_tax"], classes=BIN)
    return t.select("feature", "value", "next_value", "threshold", _r("gain"), _r("intrinsic_value"), _r("gain_ratio"))


SQL_ALL_THRESHOLDS = O.all_thresholds_sql(VIEWS["v_rule"].sql, ["l_extendedprice", "l_tax"], BIN)


ORDERS_SINCE = """
SELECT c.c_mktsegment, count(*) AS n_orders, round(sum(o.o_totalprice), 2) AS total
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE o.o_totalprice >= {least} AND o.o_orderpriority <> {other}
GROUP BY c.c_mktsegment"""


def q_sql_over_views(spark, sf):
    """A5/H5: SQL over the registered tables, with parameters."""
    register_tables(spark, sf, ["orders", "customer"])
    return query(spark, ORDERS_SINCE.format(least=":least", other=":other"), {"least": 150000.0, "other": "it's none"})


SQL_OVER_VIEWS = ORDERS_SINCE.format(least="150000.0", other="'it''s none'")


QUERIES = {
    "a5_sql_over_views": (q_sql_over_views, SQL_OVER_VIEWS),
    "a6_preview": (q_preview, SQL_PREVIEW),
    "b1_rows_at": (q_rows_at, SQL_ROWS_AT),
    "f1_dictionary_codes": (q_dictionary, SQL_DICTIONARY),
    "e7_all_thresholds": (q_all_thresholds, SQL_ALL_THRESHOLDS),
    "e1_entropy": (q_entropy, SQL_ENTROPY),
    "e2_info_gain": (q_info_gain, SQL_INFO_GAIN),
    "e3_info_gain_threshold": (q_info_gain_threshold, SQL_INFO_GAIN_THRESHOLD),
    "e4_intrinsic_value": (q_intrinsic_value, SQL_INTRINSIC_VALUE),
    "e5_intrinsic_value_threshold": (q_intrinsic_value_threshold, SQL_INTRINSIC_VALUE_THRESHOLD),
    "e6_gain_ratio": (q_gain_ratio, SQL_GAIN_RATIO),
    "e8_best_threshold": (q_best_threshold, SQL_BEST_THRESHOLD),
    "e8_best_threshold_by_group": (q_best_threshold_by_group, SQL_BEST_THRESHOLD_BY_GROUP),
    "e8_best_threshold_events": (q_best_threshold_events, SQL_BEST_THRESHOLD_EVENTS),
    "e8_best_threshold_multiclass": (q_best_threshold_multi, SQL_BEST_THRESHOLD_MULTI),
    "e9_rank_splits": (q_rank_splits, SQL_RANK_SPLITS),
    "e9_rank_splits_noise": (q_rank_splits_noise, SQL_RANK_SPLITS_NOISE),
    "e10_best_split_by_group": (q_best_split_by_group, SQL_BEST_SPLIT_BY_GROUP),
    "e10_best_split_docs": (q_best_split_docs, SQL_BEST_SPLIT_DOCS),
    "e10_best_split_multiclass": (q_best_split_multi, SQL_BEST_SPLIT_MULTI),
    "d2_class_counts": (q_class_counts, SQL_CLASS_COUNTS),
    "d5_distinct_counts": (q_distinct_counts, SQL_DISTINCT_COUNTS),
    "d8_majority": (q_majority, SQL_MAJORITY),
    "c3_hash_split": (q_hash_split, SQL_HASH_SPLIT),
    "c2_exact_split": (q_exact_split, SQL_EXACT_SPLIT),
    "c5_kfold": (q_kfold, SQL_KFOLD),
    "a4_replicate": (q_replicate, SQL_REPLICATE),
    "b1_row_range": (q_row_range, SQL_ROW_RANGE),
    "b2_drop_header_rows": (q_drop_header_rows, SQL_DROP_HEADER_ROWS),
    "b3_project_ordinals": (q_project_ordinals, SQL_PROJECT_ORDINALS),
    "b4_rename_positional": (q_rename_positional, SQL_RENAME_POSITIONAL),
    "b6_cast_columns": (q_cast_columns, SQL_CAST_COLUMNS),
    "b7_parse_flag": (q_parse_flag, SQL_PARSE_FLAG),
    "b11_union_rows": (q_union_rows, SQL_UNION_ROWS),
    "c2b_exact_split_total": (q_exact_split_total, SQL_EXACT_SPLIT_TOTAL),
    "b5_horizontal_sum": (q_horizontal_sum, SQL_HORIZONTAL_SUM),
    "i1_minmax_scale": (q_minmax, SQL_MINMAX),
    "i2_inverse_scale": (q_inverse_scaled, SQL_INVERSE_SCALED),
    "i4_network_score": (q_network, SQL_NETWORK),
    "i5_squared_loss": (q_network_loss, SQL_NETWORK_LOSS),
}
