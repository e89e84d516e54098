"""Split search (information gain, intrinsic value, gain ratio, best threshold,
candidate ranking) for many groups at once.

Everything is keyed by a group column ``_g``: the user's ``by`` columns packed
in a struct for the standalone operators, or ``node_id`` while a tree grows.
One scan of the input builds a value x class histogram for every (group,
feature) pair; one ordered scan of it (see ``ordered``) gives the sums of
discrete features and, from running counts over the distinct values, every
threshold of the continuous ones.

Tie and rounding rules (fixed so that results do not depend on summation
order or partitioning):
* gains are clamped at 0 and, like ratios and the mean gain, rounded to
  ``COMPARE_DIGITS`` before any comparison;
* best threshold of a feature: largest gain, ties -> largest threshold;
* ranking: candidates whose gain >= mean gain of all candidates qualify; the
  largest gain ratio wins, ties -> the feature that comes last in spec order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gainkit.functions.measures import rounded, safe_ratio, sum_sql, xl_sql
from gainkit.operators.ordered import G, P, RANGE_ROWS, TOTALS, VD, VS, Y, ThresholdScan
from gainkit.session import cut_lineage
from gainkit.spec import CONTINUOUS, DISCRETE, FeatureSpec


def cnames(k: int) -> list[str]:
    return [f"c{i}" for i in range(k)]


# ---------------------------------------------------------------------------
# histogram
# ---------------------------------------------------------------------------

def value_class_counts(df: DataFrame, key: Column, y: Column, feats: list[tuple[int, str, str]],
                       k: int, with_totals: bool = True, coded: bool = False, only: str | None = None, always: tuple = ()) -> DataFrame:
    """(_g, _p, _vs, _vd, c0..c{k-1}): rows per class for every distinct value
    of every feature in every group.  ``feats`` holds (position, column, kind).
    Discrete values are kept as text in ``_vs`` (with ``coded`` they are
    dictionary codes in ``_vd`` and there is no ``_vs``), continuous ones in ``_vd``.  With ``with_totals`` the pseudo feature ``TOTALS`` carries the
    class totals of each group.  With ``only`` (a condition on the rows) other
    rows count for the feature positions ``always`` alone."""
    row = lambda pos, vs, vd: f"named_struct('{P}', {pos}" + ("" if coded else f", '{VS}', {vs}") + f", '{VD}', {vd})"
    none = ("CAST(NULL AS STRING)", "CAST(NULL AS DOUBLE)")
    each = []
    for pos, col, kind in feats:
        col = "`" + col.replace("`", "``") + "`"
        text = kind == DISCRETE and not coded
        each.append(row(pos, f"CAST({col} AS STRING)" if text else none[0], none[1] if text else f"CAST({col} AS DOUBLE)"))
    if with_totals:
        each.append(row(TOTALS, *none))
    if only is not None:
        at = [pos for pos, _, _ in feats] + [TOTALS]
        each = [e if pos in always else f"CASE WHEN {only} THEN {e} END" for pos, e in zip(at, each)]
    wide = df.select(key.alias(G), y.alias(Y), *[F.expr(e).alias(f"_s{i}") for i, e in enumerate(each)])
    long = wide.unpivot([G, Y], [f"_s{i}" for i in range(len(each))], "_f", "_s").where("_s IS NOT NULL").selectExpr(G, Y, "_s.*")
    return long.groupBy(G, P, *([] if coded else [VS]), VD).agg(*[F.expr(f"count_if({Y} = {i}) AS {c}") for i, c in enumerate(cnames(k))])


# ---------------------------------------------------------------------------
# discrete features
# ---------------------------------------------------------------------------

def discrete_stats(vc: DataFrame, k: int) -> DataFrame:
    """Per (_g, _p): n, class totals, gain, iv, ratio, n_values for discrete
    features.  Values absent from a group add nothing (0 * H(empty) = 0)."""
    cs = cnames(k)
    n_v = sum_sql(cs)
    agg = vc.groupBy(G, P).agg(
        *[F.sum(c).alias(f"t{c}") for c in cs],
        F.expr(f"sum({xl_sql(n_v)})").alias("_sv"),
        F.expr(f"sum({sum_sql(xl_sql(c) for c in cs)})").alias("_svk"),
        F.count(F.lit(1)).alias("n_values"),
    )
    n = sum_sql(f"t{c}" for c in cs)
    s_k = sum_sql(xl_sql(f"t{c}") for c in cs)
    return agg.selectExpr(
        G, P, f"{n} AS n",
        f"greatest(({xl_sql(n)} - {s_k} - _sv + _svk) / {n}, 0D) AS gain",
        f"({xl_sql(n)} - _sv) / {n} AS iv",
        f"CASE WHEN n_values > 1 AND ({xl_sql(n)} - _sv) > 0 "
        f"THEN (({xl_sql(n)} - {s_k} - _sv + _svk) / {n}) / (({xl_sql(n)} - _sv) / {n}) ELSE 0D END AS ratio",
        "n_values",
        f"array({', '.join(f't{c}' for c in cs)}) AS class_counts",
    )


# ---------------------------------------------------------------------------
# ranking
# ---------------------------------------------------------------------------

def rank_candidates(cands: DataFrame, key: str = G) -> DataFrame:
    """Adds mean_gain, qualified and rank (1 = chosen) per group.
    ``cands`` needs key, _p, gain, ratio; a candidate is every discrete
    feature and every continuous feature with at least two values."""
    w = Window.partitionBy(key)
    g_r, r_r = rounded(F.col("gain")), rounded(F.col("ratio"))
    out = cands.withColumn("mean_gain", F.avg(g_r).over(w))
    out = out.withColumn("qualified", g_r >= rounded(F.col("mean_gain")))
    order = Window.partitionBy(key).orderBy(F.col("qualified").desc(), r_r.desc(), F.col(P).desc())
    return out.withColumn("rank", F.row_number().over(order))


# ---------------------------------------------------------------------------
# the standalone operators (any grouping)
# ---------------------------------------------------------------------------

def labels_of(df: DataFrame, label: str, classes=None, max_classes: int = 10_000) -> list[str]:
    """The ordered label domain: given, or the sorted distinct labels."""
    if classes is not None:
        return [str(c) for c in classes]
    rows = (df.select(F.col(label).cast("string").alias("l")).where(F.col("l").isNotNull())
            .distinct().orderBy("l").limit(max_classes + 1).collect())
    if len(rows) > max_classes:
        raise ValueError(f"more than {max_classes} distinct labels in {label!r}")
    return [r["l"] for r in rows]


def label_index(label: str, classes: list[str]) -> Column:
    """0-based position of the label in ``classes`` (null when unknown)."""
    arr = F.array(*[F.lit(c) for c in classes]).cast("array<string>")
    pos = F.array_position(arr, F.col(label).cast("string"))
    return F.when(pos > 0, (pos - 1).cast("int"))


def known_label(label: str, classes: list[str]) -> Column:
    """As :func:`label_index`; a null or unlisted label fails the query, as in ``fit``."""
    name = F.coalesce(F.col(label).cast("string"), F.lit("null"))
    return F.coalesce(label_index(label, classes), F.raise_error(
        F.concat(F.lit(f"{label}: label outside the {len(classes)} classes: "), name)).cast("int"))


def without_nulls(df: DataFrame, features: list[str], handle_null: str, discrete: list[str] = ()) -> DataFrame:
    """Null features by the rule of ``fit``: 'error' fails the query, 'drop'
    leaves out rows with a null in any of them, 'bucket' keeps nulls of the
    ``discrete`` ones as a value and fails for others."""
    if handle_null not in ("error", "drop", "bucket"):
        raise ValueError("handle_null must be 'error', 'drop' or 'bucket'")
    features = list(dict.fromkeys(features))
    if handle_null == "drop":
        return df.dropna(subset=features)
    for f in features:
        if handle_null == "bucket" and f in discrete:
            continue
        stop = F.raise_error(F.lit(f"{f}: null feature; use handle_null='drop' or clean the input")).cast(df.schema[f].dataType)
        df = df.withColumn(f, F.coalesce(F.col(f), stop))
    return df


def _group_key(by: list[str]) -> Column:
    if not by:
        return F.struct(F.lit(0).alias("_all"))
    return F.struct(*[F.col(b) for b in by])


def _expand_key(df: DataFrame, by: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c != G]
    if not by:
        return df.select(*rest)
    return df.select(*[F.col(f"{G}.{b}").alias(b) for b in by], *rest)


def _scanned(counts: DataFrame, k: int, discrete: list[int], rows: int, range_rows: int, take) -> DataFrame:
    """What ``take`` gets from the scan, written, as the scan's ranges go."""
    scan = ThresholdScan(counts, k, discrete, rows, range_rows)
    try:
        return cut_lineage(take(scan))
    finally:
        scan.close()


def _normalise_spec(spec) -> list[FeatureSpec]:
    out = []
    for s in spec:
        out.append(s if isinstance(s, FeatureSpec) else FeatureSpec(s, CONTINUOUS))
    return out


def split_candidates(df: DataFrame, label: str, spec, by: list[str] | None = None, classes=None,
                     range_rows: int = RANGE_ROWS, handle_null: str = "error",
                     keep_position: bool = False) -> DataFrame:
    """One row per (by..., feature) candidate with
    kind, threshold (continuous), gain, intrinsic_value, gain_ratio, n_values,
    n_rows.  Continuous features with one value give no candidate.  Null
    features and labels outside ``classes`` fail unless ``handle_null`` is
    'drop' (rows with a null feature go; unknown labels still fail).  With
    ``keep_position`` the group (a struct ``_g``) and the feature's place
    (``_p``) stay in, as :func:`rank_splits` needs them."""
    by = list(by or [])
    spec = _normalise_spec(spec)
    df = without_nulls(df, [s.name for s in spec], handle_null, [s.name for s in spec if s.discrete])
    classes = labels_of(df, label, classes)
    k = len(classes)
    feats = [(i, s.name, s.kind) for i, s in enumerate(spec)]
    names = F.array(*[F.lit(s.name) for s in spec])
    kinds = F.array(*[F.lit(s.kind) for s in spec])
    d_pos = [i for i, s in enumerate(spec) if s.discrete]
    vc = value_class_counts(df, _group_key(by), known_label(label, classes), feats, k, with_totals=len(d_pos) < len(spec))
    if len(d_pos) == len(spec):
        out = discrete_stats(vc, k).withColumn("threshold", F.lit(None).cast("double"))
    else:
        out = _scanned(vc, k, d_pos, df.count() * (len(spec) + 1), range_rows, ThresholdScan.stats).where(F.col("gain").isNotNull())
    out = out.withColumnsRenamed({"iv": "intrinsic_value", "ratio": "gain_ratio"}) \
        .withColumn("n", F.aggregate("class_counts", F.lit(0).cast("long"), lambda a, x: a + x))
    out = out.select(G, P, F.element_at(names, F.col(P) + 1).alias("feature"),
                     F.element_at(kinds, F.col(P) + 1).alias("kind"),
                     "threshold", "gain", "intrinsic_value", "gain_ratio", "n_values",
                     F.col("n").alias("n_rows"))
    return out if keep_position else _expand_key(out.drop(P), by)


def rank_splits(cands: DataFrame, by: list[str] | None = None) -> DataFrame:
    """E9 over the output of :func:`split_candidates` (keeps its columns, adds
    mean_gain, qualified, rank).  Pass what ``split_candidates(...,
    keep_position=True)`` returns: ties go by the feature's place."""
    by = list(by or [])
    keyed = cands.withColumn(G, _group_key(by)) if G not in cands.columns else cands
    ranked = rank_candidates(keyed.withColumnRenamed("gain_ratio", "ratio")).withColumnRenamed("ratio", "gain_ratio")
    return ranked


def best_split(df: DataFrame, label: str, spec, by: list[str] | None = None, classes=None,
               range_rows: int = RANGE_ROWS, all_candidates: bool = False,
               handle_null: str = "error") -> DataFrame:
    """The chosen split of each group (or every candidate with its rank)."""
    by = list(by or [])
    ranked = rank_splits(split_candidates(df, label, spec, by, classes, range_rows, handle_null, True))
    if not all_candidates:
        ranked = ranked.where(F.col("rank") == 1)
    return _expand_key(ranked.drop(P), by)


def best_threshold(df: DataFrame, label: str, features, by: list[str] | None = None, classes=None,
                   range_rows: int = RANGE_ROWS, handle_null: str = "error") -> DataFrame:
    """Best threshold of each continuous feature per group:
    (by..., feature, threshold, gain, intrinsic_value, gain_ratio, n_values,
    n_candidates).  Features with one value in a group are left out."""
    by = list(by or [])
    names = [f.name if isinstance(f, FeatureSpec) else f for f in features]
    df = without_nulls(df, names, handle_null)
    classes = labels_of(df, label, classes)
    k = len(classes)
    feats = [(i, n, CONTINUOUS) for i, n in enumerate(names)]
    vc = value_class_counts(df, _group_key(by), known_label(label, classes), feats, k)
    cb = _scanned(vc, k, [], df.count() * (len(names) + 1), range_rows, ThresholdScan.stats).where(F.col("threshold").isNotNull()) \
        .withColumn("n_candidates", F.col("n_values") - 1)
    arr = F.array(*[F.lit(n) for n in names])
    out = cb.select(G, F.element_at(arr, F.col(P) + 1).alias("feature"), "threshold", "gain",
                    F.col("iv").alias("intrinsic_value"), F.col("ratio").alias("gain_ratio"),
                    "n_values", "n_candidates")
    return _expand_key(out, by)


def all_thresholds(df: DataFrame, label: str, features, by: list[str] | None = None, classes=None,
                   range_rows: int = RANGE_ROWS, handle_null: str = "error") -> DataFrame:
    """E3/E5/E7 for every candidate: (by..., feature, value, next_value,
    threshold, gain, intrinsic_value, gain_ratio)."""
    by = list(by or [])
    names = [f.name if isinstance(f, FeatureSpec) else f for f in features]
    df = without_nulls(df, names, handle_null)
    classes = labels_of(df, label, classes)
    k = len(classes)
    feats = [(i, n, CONTINUOUS) for i, n in enumerate(names)]
    vc = value_class_counts(df, _group_key(by), known_label(label, classes), feats, k)
    th = _scanned(vc, k, [], df.count() * (len(names) + 1), range_rows, ThresholdScan.candidates)
    arr = F.array(*[F.lit(n) for n in names])
    out = th.select(G, F.element_at(arr, F.col(P) + 1).alias("feature"), F.col(VD).alias("value"),
                    F.col("_next").alias("next_value"), "threshold", "gain",
                    F.col("iv").alias("intrinsic_value"), safe_ratio(F.col("gain"), F.col("iv")).alias("gain_ratio"))
    return _expand_key(out, by)
