"""DuckDB SQL for whole trees, unrolled level by level: every level has its
rows by node, the candidates of its nodes, their decisions and the rows of the
next. Nodes go by the path of their branch numbers ('0' is the root, '0.2' its
third child), which does not depend on how ids are given."""

from __future__ import annotations

from gainkit.functions.measures import REPORT_DIGITS as RD
from gainkit.plans.oracle import _majority_sql, candidates_sql

LEVELS = 21     # splits at depths 0 .. 20


def _branch(spec, rows: str, split: str) -> tuple[str, str]:
    """(joins, expression) for the branch of the rows ``rows`` at ``split``."""
    joins, cases = [], []
    for p, (name, kind) in enumerate(spec):
        if kind == "discrete":
            joins.append(f"LEFT JOIN dict{p} ON CAST({rows}.{name} AS VARCHAR) IS NOT DISTINCT FROM dict{p}.v")
            cases.append(f"WHEN {p} THEN dict{p}.code")
        else:
            cases.append(f"WHEN {p} THEN CASE WHEN {rows}.{name} >= {split}.threshold THEN 0 WHEN {rows}.{name} < {split}.threshold THEN 1 END")
    return " ".join(joins), f"CASE {split}.p {' '.join(cases)} END"


def _levels(src: str, spec, classes, max_depth: int) -> list[str]:
    """CTEs dict{p}, r{d} (rows), c{d} (candidates, ranked) and n{d} (nodes)."""
    names = [n for n, _ in spec]
    counts = ", ".join(f"count_if(class = '{c}') AS c{i}" for i, c in enumerate(classes))
    n_classes = " + ".join(f"CAST(k.c{i} > 0 AS INTEGER)" for i in range(len(classes)))
    out = [f"src AS MATERIALIZED ({src})"]
    for p, (name, kind) in enumerate(spec):
        if kind == "discrete":
            out.append(f"dict{p} AS MATERIALIZED (SELECT v, CAST(row_number() OVER (ORDER BY v NULLS LAST) - 1 AS INTEGER) AS code "
                       f"FROM (SELECT DISTINCT CAST({name} AS VARCHAR) AS v FROM src))")
    out.append(f"r0 AS MATERIALIZED (SELECT '0' AS node, 0 AS used, class, {', '.join(names)} FROM src)")
    for d in range(max_depth + 2):
        out.append(f"k{d} AS MATERIALIZED (SELECT node, used, count(*) AS n, {counts} FROM r{d} GROUP BY node, used)")
        settled = f"CASE WHEN ({n_classes}) = 1 THEN 'pure' WHEN {d} > {max_depth} THEN 'depth' END"
        if d > max_depth:
            out.append(f"n{d} AS MATERIALIZED (SELECT k.*, {settled} AS stop_reason, CAST(NULL AS INTEGER) AS p, CAST(NULL AS VARCHAR) AS feature, "
                       f"CAST(NULL AS DOUBLE) AS threshold, CAST(NULL AS DOUBLE) AS gain, CAST(NULL AS DOUBLE) AS ratio FROM k{d} k)")
            break
        out.append(f"o{d} AS MATERIALIZED (SELECT r.* FROM r{d} r JOIN k{d} k ON r.node = k.node WHERE {settled} IS NULL)")
        out.append(candidates_sql(f"SELECT * FROM o{d}", ["node"], spec, classes, tag=f"x{d}_")[len("WITH "):])
        left = f"(k.used & (1 << x.p)) = 0"
        out.append(f"m{d} AS (SELECT x.*, avg(round(gain, 12)) OVER (PARTITION BY x.node) AS mean_gain FROM candsx{d}_ x JOIN k{d} k ON x.node = k.node WHERE {left})")
        out.append(f"q{d} AS (SELECT *, round(gain, 12) >= round(mean_gain, 12) AS qualified FROM m{d})")
        out.append(f"c{d} AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY node ORDER BY qualified DESC, round(ratio, 12) DESC, p DESC) AS rk FROM q{d})")
        values = " UNION ALL ".join(f"SELECT node, {p} AS p, count(DISTINCT {n}) + CAST(count({n}) < count(*) AS INTEGER) AS nv FROM o{d} GROUP BY node" for p, n in enumerate(names))
        out.append(f"v{d} AS (SELECT x.node, arg_min(x.nv, x.p) AS first_nv FROM ({values}) x JOIN k{d} k ON x.node = k.node WHERE {left} GROUP BY x.node)")
        stop = f"coalesce({settled}, CASE WHEN v.first_nv = 1 THEN 'constant' WHEN c.p IS NULL THEN 'no_candidate' END)"
        pick = ", ".join(f"CASE WHEN {stop} IS NULL THEN c.{x} END AS {x}" for x in ("p", "feature", "threshold", "gain", "ratio"))
        out.append(f"n{d} AS MATERIALIZED (SELECT k.*, {stop} AS stop_reason, {pick} FROM k{d} k LEFT JOIN v{d} v ON k.node = v.node "
                   f"LEFT JOIN c{d} c ON k.node = c.node AND c.rk = 1)")
        joins, branch = _branch(spec, "r", "n")
        uses = "CASE n.p " + " ".join(f"WHEN {p} THEN {(1 << p) if k == 'discrete' else 0}" for p, (_, k) in enumerate(spec)) + " END"
        out.append(f"r{d + 1} AS MATERIALIZED (SELECT r.node || '.' || {branch} AS node, r.used | {uses} AS used, r.class, "
                   f"{', '.join('r.' + n for n in names)} FROM r{d} r JOIN n{d} n ON r.node = n.node AND n.p IS NOT NULL {joins})")
    return out


def tree_sql(src: str, spec, classes, max_depth: int = LEVELS - 1) -> str:
    """All nodes: (path, depth, is_leaf, stop_reason, split_feature, threshold,
    gain, gain_ratio, n_rows, majority, prediction)."""
    majority, rows = _majority_sql(classes), []
    for d in range(max_depth + 2):
        rows.append(f"SELECT node AS path, {d} AS depth, p IS NULL AS is_leaf, stop_reason, feature AS split_feature, threshold, round(gain, {RD}) AS gain, "
                    f"round(ratio, {RD}) AS gain_ratio, n AS n_rows, {majority} AS majority, CASE WHEN p IS NULL THEN {majority} END AS prediction FROM n{d}")
        if d > max_depth:
            break
        for p, (_, kind) in enumerate(spec):
            if kind == "discrete":
                rows.append(f"SELECT n.node || '.' || x.code, {d + 1}, true, 'empty', NULL, NULL, NULL, NULL, 0, NULL, {_majority_sql(classes, 'n.c')} FROM n{d} n "
                            f"JOIN dict{p} x ON n.p = {p} WHERE n.node || '.' || x.code NOT IN (SELECT node FROM n{d + 1})")
    return "WITH " + ",\n".join(_levels(src, spec, classes, max_depth)) + "\n" + "\nUNION ALL\n".join(rows)


def branch_values_sql(src: str, spec, classes, max_depth: int) -> str:
    """Nodes with the value of the branch that leads to them: (path,
    branch_value, is_leaf, stop_reason, split_feature, threshold, n_rows, prediction)."""
    last = "CAST(regexp_extract(t.path, '([0-9]+)$', 1) AS INTEGER)"
    parents = " UNION ALL ".join(f"SELECT node, p FROM n{d}" for d in range(max_depth + 2))
    values = " ".join(f"WHEN a.p = {p} THEN " + (f"(SELECT v FROM dict{p} WHERE code = {last})" if kind == "discrete" else f"CASE WHEN {last} = 0 THEN '>=' ELSE '<' END")
                      for p, (_, kind) in enumerate(spec))
    with_, body = tree_sql(src, spec, classes, max_depth).split("\nSELECT node AS path", 1)
    return (f"{with_},\nwhole AS (SELECT node AS path{body}),\nparents AS ({parents})\nSELECT t.path, CASE {values} END AS branch_value, t.is_leaf, t.stop_reason, "
            "t.split_feature, t.threshold, t.n_rows, t.prediction FROM whole t LEFT JOIN parents a ON a.node = regexp_replace(t.path, '[.][0-9]+$', '') AND t.path <> '0'")


def ledger_sql(src: str, spec, classes, max_depth: int = LEVELS - 1) -> str:
    """The candidates of all nodes: (path, depth, rank, feature, kind, threshold,
    gain, intrinsic_value, gain_ratio, n_values, mean_gain, qualified, chosen)."""
    rows = [f"SELECT c.node AS path, {d} AS depth, CAST(c.rk AS INTEGER) AS rank, c.feature, c.kind, c.threshold, round(c.gain, {RD}) AS gain, "
            f"round(c.iv, {RD}) AS intrinsic_value, round(c.ratio, {RD}) AS gain_ratio, c.n_values, round(c.mean_gain, {RD}) AS mean_gain, c.qualified, "
            f"c.rk = 1 AND n.p IS NOT NULL AS chosen FROM c{d} c JOIN n{d} n ON c.node = n.node" for d in range(max_depth + 1)]
    return "WITH " + ",\n".join(_levels(src, spec, classes, max_depth)) + "\n" + "\nUNION ALL\n".join(rows)


def _routed(test: str, key: str, spec, classes, max_depth: int) -> list[str]:
    """CTEs t{d}: the rows of ``test`` at the nodes of depth d; s{d}: those at
    split nodes (``here``) with the child they go to (null: unseen value) and the
    split's majority."""
    names, majority = ", ".join(n for n, _ in spec), _majority_sql(classes, "n.c")
    out = [f"t0 AS MATERIALIZED (SELECT {key}, class, '0' AS node, {names} FROM ({test}))"]
    for d in range(max_depth + 1):
        joins, branch = _branch(spec, "t", "n")
        out.append(f"s{d} AS MATERIALIZED (SELECT t.{key}, t.class, t.node AS here, t.node || '.' || ({branch}) AS node, {', '.join('t.' + n for n, _ in spec)}, "
                   f"{majority} AS fallback FROM t{d} t JOIN n{d} n ON t.node = n.node AND n.p IS NOT NULL {joins})")
        out.append(f"t{d + 1} AS MATERIALIZED (SELECT {key}, class, node, {names} FROM s{d} WHERE node IN (SELECT node FROM n{d + 1}))")
    return out


def predictions_sql(src: str, test: str, key: str, spec, classes, max_depth: int = LEVELS - 1) -> str:
    """(key, class, path, prediction) of every row of ``test``: where it stopped
    in the tree of ``src``. An unseen value stops at an inner node and has no
    prediction; a value without rows at its node has the node's majority."""
    rows, majority = [], _majority_sql(classes, "n.c")
    for d in range(max_depth + 2):
        rows.append(f"SELECT t.{key}, t.class, t.node AS path, {majority} AS prediction FROM t{d} t JOIN n{d} n ON t.node = n.node AND n.p IS NULL")
        if d <= max_depth:
            rows.append(f"SELECT {key}, class, here, NULL FROM s{d} WHERE node IS NULL")
            rows.append(f"SELECT {key}, class, node, fallback FROM s{d} WHERE node IS NOT NULL AND node NOT IN (SELECT node FROM n{d + 1})")
    return "WITH " + ",\n".join(_levels(src, spec, classes, max_depth) + _routed(test, key, spec, classes, max_depth)) + "\n" + "\nUNION ALL\n".join(rows)


def pruned_sql(src: str, test: str, key: str, spec, classes, max_depth: int = LEVELS - 1) -> str:
    """The tree of ``src`` pruned on ``test``, folded from the deepest level up:
    (path, depth, is_leaf, stop_reason, split_feature, threshold, n_rows, prediction)."""
    up, ctes = "regexp_replace(node, '[.][0-9]+$', '')", _routed(test, key, spec, classes, max_depth)
    for d in range(max_depth + 1, -1, -1):
        right = f"SELECT n.node, count_if(t.class = {_majority_sql(classes, 'n.c')}) AS ok FROM n{d} n JOIN t{d} t ON t.node = n.node GROUP BY n.node"
        parts = "SELECT NULL AS node, 0 AS ok WHERE false"
        if d <= max_depth:
            parts = (f"SELECT {up} AS node, ok FROM f{d + 1} UNION ALL SELECT here, count_if(class = fallback) FROM s{d} "
                     f"WHERE node IS NOT NULL AND node NOT IN (SELECT node FROM n{d + 1}) GROUP BY here")
        ctes.append(f"f{d} AS MATERIALIZED (SELECT n.node, CASE WHEN n.p IS NULL THEN coalesce(a.ok, 0) ELSE greatest(coalesce(a.ok, 0), coalesce(b.ok, 0)) END AS ok, "
                    f"n.p IS NOT NULL AND coalesce(a.ok, 0) >= coalesce(b.ok, 0) AS pruned FROM n{d} n LEFT JOIN ({right}) a ON n.node = a.node "
                    f"LEFT JOIN (SELECT node, sum(ok) AS ok FROM ({parts}) GROUP BY node) b ON n.node = b.node)")
    ctes.append("cut AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT node FROM f{d} WHERE pruned" for d in range(max_depth + 2)) + ")")
    with_, body = tree_sql(src, spec, classes, max_depth).split("\nSELECT node AS path", 1)
    if_ = lambda a, b: f"CASE WHEN c.node IS NULL THEN w.{a} ELSE {b} END AS {a}"
    return (f"{with_},\n" + ",\n".join(ctes) + f",\nwhole AS (SELECT node AS path{body})\nSELECT w.path, w.depth, {if_('is_leaf', 'true')}, {if_('stop_reason', chr(39) + 'pruned' + chr(39))}, "
            f"{if_('split_feature', 'NULL')}, {if_('threshold', 'NULL')}, w.n_rows, {if_('prediction', 'w.majority')} FROM whole w LEFT JOIN cut c ON w.path = c.node "
            "WHERE NOT EXISTS (SELECT 1 FROM cut x WHERE starts_with(w.path, x.node || '.'))")


def accuracy_of_sql(predictions: str) -> str:
    return f"SELECT count(*) AS n_rows, count_if(prediction = class) AS n_correct, count_if(prediction = class) / count(*) AS accuracy FROM ({predictions})"
