"""DuckDB SQL for the correctness oracle: the same definitions written as
plain SQL over the pre-registered tables, so every Spark result can be
compared with an independent engine.  Measures are rounded to
``REPORT_DIGITS`` on both sides."""

from __future__ import annotations

from gainkit.functions.measures import REPORT_DIGITS as RD


def xl(x: str) -> str:
    return f"(CASE WHEN {x} > 0 THEN CAST({x} AS DOUBLE) * log2({x}) ELSE 0 END)"


def _by(by, prefix=""):
    return [f"{prefix}{b}" for b in by]


def _sel(by, extra=""):
    cols = list(by)
    return ", ".join(cols) + (", " if cols and extra else "") + extra


def _part(by):
    return f"PARTITION BY {', '.join(by)}" if by else ""


def _using(by):
    return f"USING ({', '.join(by)})" if by else "ON TRUE"


def candidates_sql(src: str, by: list[str], spec: list[tuple[str, str]], classes: list[str],
                   tag: str = "") -> str:
    """(by..., p, feature, kind, threshold, gain, iv, ratio, n_values, n) for
    every discrete feature and every continuous feature with >= 2 values."""
    ctes = [f"src{tag} AS ({src})",
            f"tot{tag} AS (SELECT {_sel(by, 'class, count(*) AS c')} FROM src{tag} GROUP BY ALL)",
            f"gt{tag} AS (SELECT {_sel(by, f'sum(c) AS n, sum({xl('c')}) AS sk')} FROM tot{tag} GROUP BY ALL)"]
    parts = []
    for pos, (name, kind) in enumerate(spec):
        if kind == "discrete":
            ctes.append(f"h{tag}{pos} AS (SELECT {_sel(by, f'CAST({name} AS VARCHAR) AS v, class, count(*) AS c')} "
                        f"FROM src{tag} GROUP BY ALL)")
            ctes.append(f"pv{tag}{pos} AS (SELECT {_sel(by, f'v, sum(c) AS nv, sum({xl('c')}) AS svk')} "
                        f"FROM h{tag}{pos} GROUP BY ALL)")
            ctes.append(f"a{tag}{pos} AS (SELECT {_sel(by, f'sum({xl('nv')}) AS sv, sum(svk) AS svk, '
                                                 f'count(*) AS n_values')} FROM pv{tag}{pos} GROUP BY ALL)")
            gain = f"greatest(({xl('n')} - sk - sv + svk) / n, 0)"
            iv = f"(({xl('n')} - sv) / n)"
            parts.append(
                f"SELECT {_sel(by, f'{pos} AS p')}, '{name}' AS feature, 'discrete' AS kind, "
                f"CAST(NULL AS DOUBLE) AS threshold, {gain} AS gain, {iv} AS iv, "
                f"CASE WHEN n_values > 1 AND {iv} > 0 THEN {gain} / {iv} ELSE 0 END AS ratio, "
                f"n_values, n FROM a{tag}{pos} JOIN gt{tag} {_using(by)}")
        else:
            cnt = ", ".join(f"count_if(class = '{c}') AS c{i}" for i, c in enumerate(classes))
            ctes.append(f"h{tag}{pos} AS (SELECT {_sel(by, f'CAST({name} AS DOUBLE) AS v, {cnt}')} "
                        f"FROM src{tag} GROUP BY ALL)")
            w = f"({_part(by)} ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
            run = ", ".join(f"sum(c{i}) OVER {w} AS l{i}" for i in range(len(classes)))
            tot = ", ".join(f"sum(c{i}) OVER ({_part(by)}) AS t{i}" for i in range(len(classes)))
            ctes.append(f"pre{tag}{pos} AS (SELECT {_sel(by, f'v, {run}, {tot}, lead(v) OVER ({_part(by)} ORDER BY v) AS nxt, '
                                                 f'count(*) OVER ({_part(by)}) AS n_values')} FROM h{tag}{pos})")
            n = "(" + " + ".join(f"t{i}" for i in range(len(classes))) + ")"
            nl = "(" + " + ".join(f"l{i}" for i in range(len(classes))) + ")"
            sxt = " + ".join(xl(f"t{i}") for i in range(len(classes)))
            sxl = " + ".join(xl(f"l{i}") for i in range(len(classes)))
            sxg = " + ".join(xl(f"(t{i} - l{i})") for i in range(len(classes)))
            gain = (f"greatest((({xl(n)} - ({sxt})) - ({xl(nl)} - ({sxl}) + {xl(f'({n} - {nl})')} - ({sxg}))) "
                    f"/ {n}, 0)")
            iv = f"(({xl(n)} - {xl(nl)} - {xl(f'({n} - {nl})')}) / {n})"
            ctes.append(
                f"th{tag}{pos} AS (SELECT {_sel(by, 'v, nxt, n_values')}, "
                f"CASE WHEN (v + nxt) / 2 > v AND (v + nxt) / 2 <= nxt THEN (v + nxt) / 2 ELSE nxt END AS threshold, "
                f"{gain} AS gain, {iv} AS iv, {n} AS n FROM pre{tag}{pos} WHERE nxt IS NOT NULL)")
            ctes.append(
                f"b{tag}{pos} AS (SELECT * FROM (SELECT *, row_number() OVER ({_part(by)} ORDER BY round(gain, 12) DESC, "
                f"threshold DESC) AS rk FROM th{tag}{pos}) WHERE rk = 1)")
            parts.append(
                f"SELECT {_sel(by, f'{pos} AS p')}, '{name}' AS feature, 'continuous' AS kind, threshold, gain, iv, "
                f"CASE WHEN iv > 0 THEN gain / iv ELSE 0 END AS ratio, n_values, n FROM b{tag}{pos}")
    ctes.append(f"cands{tag} AS (" + " UNION ALL ".join(parts) + ")")
    return "WITH " + ",\n".join(ctes)


def ranked_sql(src, by, spec, classes, only_best=False) -> str:
    head = candidates_sql(src, by, spec, classes)
    q = (f"{head},\nranked AS (SELECT *, avg(round(gain, 12)) OVER ({_part(by)}) AS mean_gain FROM cands),\n"
         f"ranked2 AS (SELECT *, round(gain, 12) >= round(mean_gain, 12) AS qualified FROM ranked),\n"
         f"ranked3 AS (SELECT *, row_number() OVER ({_part(by)} ORDER BY qualified DESC, round(ratio, 12) DESC, "
         f"p DESC) AS rk FROM ranked2)\n"
         f"SELECT {_sel(by, 'feature, kind, threshold')}, round(gain, {RD}) AS gain, "
         f"round(iv, {RD}) AS intrinsic_value, round(ratio, {RD}) AS gain_ratio, n_values, "
         f"CAST(n AS BIGINT) AS n_rows, round(mean_gain, {RD}) AS mean_gain, qualified, "
         f"CAST(rk AS BIGINT) AS rank FROM ranked3")
    if only_best:
        q += " WHERE rk = 1"
    return q


def best_threshold_sql(src, by, features, classes) -> str:
    spec = [(f, "continuous") for f in features]
    head = candidates_sql(src, by, spec, classes)
    return (f"{head}\nSELECT {_sel(by, 'feature, threshold')}, round(gain, {RD}) AS gain, "
            f"round(iv, {RD}) AS intrinsic_value, round(ratio, {RD}) AS gain_ratio, n_values, "
            f"n_values - 1 AS n_candidates FROM cands")


def all_thresholds_sql(src, features, classes) -> str:
    head = candidates_sql(src, [], [(f, "continuous") for f in features], classes)
    return head + "\n" + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, v AS value, nxt AS next_value, threshold, round(gain, {RD}) AS gain, round(iv, {RD}) AS intrinsic_value, "
        f"round(CASE WHEN iv > 0 THEN gain / iv ELSE 0 END, {RD}) AS gain_ratio FROM th{p}" for p, f in enumerate(features))


def entropy_sql(src, by) -> str:
    return (f"WITH src AS ({src}), c AS (SELECT {_sel(by, 'class, count(*) AS n')} FROM src GROUP BY ALL)\n"
            f"SELECT {_sel(by, 'CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_classes')}, "
            f"round(({xl('sum(n)')} - sum({xl('n')})) / sum(n), {RD}) AS entropy FROM c GROUP BY ALL")


def measure_sql(src, by, feature_expr, feature_name, classes, threshold=None, label="class") -> str:
    """Discrete measure (or a threshold's two parts) of one feature per group."""
    v = feature_expr if threshold is None else \
        f"CASE WHEN {feature_expr} >= {threshold!r} THEN '>=' WHEN {feature_expr} < {threshold!r} THEN '<' END"
    src2 = f"SELECT {_sel(by, f'{label} AS class, {v} AS {feature_name}')} FROM ({src})"
    head = candidates_sql(src2, by, [(feature_name, "discrete")], classes)
    return (f"{head}\nSELECT {_sel(by, f'round(gain, {RD}) AS gain, round(iv, {RD}) AS intrinsic_value, '
                                       f'round(ratio, {RD}) AS gain_ratio, n_values, CAST(n AS BIGINT) AS n_rows')} "
            f"FROM cands")


def _majority_sql(classes, prefix="c") -> str:
    """Label with the largest count; ties -> earliest label."""
    cs = [f"{prefix}{i}" for i in range(len(classes))]
    mx = f"greatest({', '.join(cs)})" if len(cs) > 1 else cs[0]
    out = "CASE " + " ".join(f"WHEN {c} = {mx} THEN '{lab}'" for c, lab in zip(cs, classes)) + " END"
    return out


def tree_depth0_ctes(src: str, spec, classes) -> str:
    """CTEs ``dec`` (root split), ``routed`` (rows of src with their branch)
    and ``kids`` (branch, branch_value, counts, prediction) for a tree whose
    splits stop at the root (max_depth = 0)."""
    head = candidates_sql(src, [], spec, classes)
    ctes = [head[len("WITH "):],
            "ranked AS (SELECT *, avg(round(gain, 12)) OVER () AS mean_gain FROM cands)",
            "ranked2 AS (SELECT *, round(gain, 12) >= round(mean_gain, 12) AS qualified FROM ranked)",
            "dec AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY qualified DESC, round(ratio, 12) DESC, "
            "p DESC) AS rk FROM ranked2) WHERE rk = 1)"]
    joins, cases, values = [], [], []
    for pos, (name, kind) in enumerate(spec):
        if kind == "discrete":
            ctes.append(f"dict{pos} AS (SELECT v AS dv{pos}, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) "
                        f"AS code{pos} FROM (SELECT DISTINCT CAST({name} AS VARCHAR) AS v FROM src))")
            joins.append(f"LEFT JOIN dict{pos} ON CAST(s.{name} AS VARCHAR) = dict{pos}.dv{pos}")
            cases.append(f"WHEN {pos} THEN code{pos}")
            values.append(f"WHEN {pos} THEN dv{pos}")
        else:
            cases.append(f"WHEN {pos} THEN CASE WHEN s.{name} >= dec.threshold THEN 0 "
                         f"WHEN s.{name} < dec.threshold THEN 1 END")
            values.append(f"WHEN {pos} THEN CASE WHEN s.{name} >= dec.threshold THEN '>=' ELSE '<' END")
    ctes.append(f"routed AS (SELECT s.*, CASE dec.p {' '.join(cases)} END AS branch, "
                f"CASE dec.p {' '.join(values)} END AS branch_value FROM src s CROSS JOIN dec {' '.join(joins)})")
    cnt = ", ".join(f"count_if(class = '{c}') AS c{i}" for i, c in enumerate(classes))
    ctes.append(f"kids AS (SELECT branch, branch_value, count(*) AS n, {cnt} FROM routed GROUP BY ALL)")
    ctes.append(f"rootc AS (SELECT count(*) AS n, {cnt} FROM src)")
    return "WITH " + ",\n".join(ctes)


def tree_depth0_sql(src: str, spec, classes) -> str:
    """The whole max_depth = 0 tree: root row + one leaf per branch."""
    k = len(classes)
    n_cls = " + ".join(f"CASE WHEN c{i} > 0 THEN 1 ELSE 0 END" for i in range(k))
    return (tree_depth0_ctes(src, spec, classes) +
            f"\nSELECT CAST(0 AS BIGINT) AS node_id, CAST(NULL AS BIGINT) AS parent_id, 0 AS depth, "
            f"CAST(NULL AS INTEGER) AS branch, CAST(NULL AS VARCHAR) AS branch_value, false AS is_leaf, "
            f"CAST(NULL AS VARCHAR) AS stop_reason, dec.feature AS split_feature, dec.threshold AS threshold, "
            f"round(dec.gain, {RD}) AS gain, round(dec.ratio, {RD}) AS gain_ratio, rootc.n AS n_rows, "
            f"{_majority_sql(classes)} AS majority, CAST(NULL AS VARCHAR) AS prediction FROM dec, rootc\n"
            f"UNION ALL\n"
            f"SELECT CAST(1 + branch AS BIGINT), CAST(0 AS BIGINT), 1, CAST(branch AS INTEGER), branch_value, true, "
            f"CASE WHEN ({n_cls}) = 1 THEN 'pure' ELSE 'depth' END, NULL, NULL, NULL, NULL, n, "
            f"{_majority_sql(classes)}, {_majority_sql(classes)} FROM kids")


def holdout_accuracy_depth0_sql(view_sql: str, key: str, spec, classes, seed=100, train_frac=0.8) -> str:
    """Fit a max_depth = 0 tree on the keyed train side, score the test side."""
    side = (f"('0x' || substr(md5(concat_ws('|', CAST({key} AS VARCHAR), '{seed}')), 1, 8))::BIGINT "
            f"/ 4294967296.0 < {train_frac!r}")
    train = f"SELECT * FROM ({view_sql}) WHERE {side}"
    test = f"SELECT * FROM ({view_sql}) WHERE NOT ({side})"
    ctes = tree_depth0_ctes(train, spec, classes)
    joins, cases = [], []
    for pos, (name, kind) in enumerate(spec):
        if kind == "discrete":
            joins.append(f"LEFT JOIN dict{pos} ON CAST(t.{name} AS VARCHAR) = dict{pos}.dv{pos}")
            cases.append(f"WHEN {pos} THEN code{pos}")
        else:
            cases.append(f"WHEN {pos} THEN CASE WHEN t.{name} >= dec.threshold THEN 0 "
                         f"WHEN t.{name} < dec.threshold THEN 1 END")
    return (ctes + f",\ntest AS ({test}),\n"
            f"scored AS (SELECT t.class, CASE dec.p {' '.join(cases)} END AS branch FROM test t CROSS JOIN dec "
            f"{' '.join(joins)}),\n"
            f"leaf AS (SELECT branch, {_majority_sql(classes)} AS prediction FROM kids)\n"
            f"SELECT count(*) AS n_rows, count_if(l.prediction = s.class) AS n_correct, "
            f"count_if(l.prediction = s.class) / count(*) AS accuracy "
            f"FROM scored s LEFT JOIN leaf l ON s.branch = l.branch")


def tree_depth1_sql(src: str, spec, classes) -> str:
    """The whole max_depth = 1 tree: root, its children (split again unless
    pure / first remaining feature constant / no candidate) and their leaves.
    Node numbering follows the library: children of the root are 1..B0, and
    children of level-1 node 1+b start at 1 + B0 + b * B1 (B = widest split
    of the level)."""
    k = len(classes)
    cs = [f"c{i}" for i in range(k)]
    cnt = ", ".join(f"count_if(class = '{c}') AS c{i}" for i, c in enumerate(classes))
    n_cls = " + ".join(f"CASE WHEN c{i} > 0 THEN 1 ELSE 0 END" for i in range(k))
    maj = _majority_sql(classes)
    head = tree_depth0_ctes(src, spec, classes)
    lvl1 = candidates_sql("SELECT * FROM routed", ["branch"], spec, classes, tag="l1")
    ctes = [head[len("WITH "):], lvl1[len("WITH "):]]
    nb = []
    for pos, (name, kind) in enumerate(spec):
        nb.append(f"SELECT {pos} AS p, " + (f"(SELECT count(*) FROM dict{pos})" if kind == "discrete" else "2")
                  + " AS nbr")
    ctes.append("nbr AS (" + " UNION ALL ".join(nb) + ")")
    ctes.append("radix0 AS (SELECT nbr AS b0 FROM nbr JOIN dec USING (p))")
    # features still offered below the root: all but a discrete root feature
    ctes.append("rem1 AS (SELECT c.* FROM candsl1 c CROSS JOIN dec "
                "WHERE NOT (dec.kind = 'discrete' AND c.p = dec.p))")
    nv = " UNION ALL ".join(f"SELECT branch, {pos} AS p, count(DISTINCT {name}) AS nv FROM routed GROUP BY branch"
                            for pos, (name, _) in enumerate(spec))
    ctes.append(f"nv1 AS (SELECT n.* FROM ({nv}) n CROSS JOIN dec WHERE NOT (dec.kind = 'discrete' AND n.p = dec.p))")
    ctes.append("first1 AS (SELECT branch, arg_min(nv, p) AS first_nv FROM nv1 GROUP BY branch)")
    ctes.append("r1 AS (SELECT *, avg(round(gain, 12)) OVER (PARTITION BY branch) AS mean_gain FROM rem1)")
    ctes.append("r1b AS (SELECT *, round(gain, 12) >= round(mean_gain, 12) AS qualified FROM r1)")
    ctes.append("dec1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY branch ORDER BY qualified DESC, "
                "round(ratio, 12) DESC, p DESC) AS rk FROM r1b) WHERE rk = 1)")
    ctes.append(f"node1 AS (SELECT kids.branch, kids.branch_value, kids.n, {', '.join('kids.' + c for c in cs)}, "
                f"CASE WHEN ({n_cls.replace('c', 'kids.c')}) = 1 THEN 'pure' WHEN first1.first_nv = 1 THEN 'constant' "
                f"WHEN dec1.p IS NULL THEN 'no_candidate' END AS stop_reason, "
                f"dec1.p AS sp, dec1.feature AS sf, dec1.kind AS sk, dec1.threshold AS st, dec1.gain AS sg, "
                f"dec1.ratio AS sr FROM kids LEFT JOIN first1 USING (branch) LEFT JOIN dec1 USING (branch))")
    ctes.append("radix1 AS (SELECT max(nbr) AS b1 FROM node1 JOIN nbr ON node1.sp = nbr.p WHERE stop_reason IS NULL)")
    cases, values, joins = [], [], []
    for pos, (name, kind) in enumerate(spec):
        if kind == "discrete":
            joins.append(f"LEFT JOIN dict{pos} ON CAST(r.{name} AS VARCHAR) = dict{pos}.dv{pos}")
            cases.append(f"WHEN {pos} THEN code{pos}")
        else:
            cases.append(f"WHEN {pos} THEN CASE WHEN r.{name} >= n.st THEN 0 WHEN r.{name} < n.st THEN 1 END")
    ctes.append(f"routed2 AS (SELECT r.class, r.branch, CASE n.sp {' '.join(cases)} END AS b2 FROM routed r "
                f"JOIN node1 n ON r.branch = n.branch AND n.stop_reason IS NULL {' '.join(joins)})")
    ctes.append(f"cnt2 AS (SELECT branch, b2, count(*) AS n, {cnt} FROM routed2 GROUP BY ALL)")
    kid_rows = []
    for pos, (name, kind) in enumerate(spec):
        if kind == "discrete":
            kid_rows.append(f"SELECT n.branch, d.code{pos} AS b2, d.dv{pos} AS bv FROM node1 n JOIN dict{pos} d "
                            f"ON TRUE WHERE n.stop_reason IS NULL AND n.sp = {pos}")
        else:
            kid_rows.append(f"SELECT n.branch, x.b2, CASE WHEN x.b2 = 0 THEN '>=' ELSE '<' END AS bv FROM node1 n "
                            f"JOIN (SELECT unnest([0, 1]) AS b2) x ON TRUE WHERE n.stop_reason IS NULL AND n.sp = {pos}")
    ctes.append("kids2 AS (" + " UNION ALL ".join(kid_rows) + ")")
    ctes.append(f"leaf2 AS (SELECT k.branch, k.b2, k.bv, coalesce(c.n, 0) AS n, "
                f"{', '.join(f'coalesce(c.c{i}, 0) AS c{i}' for i in range(k))} "
                f"FROM kids2 k LEFT JOIN cnt2 c USING (branch, b2))")
    n1 = "node1.n"
    return ("WITH " + ",\n".join(ctes) +
            f"\nSELECT CAST(0 AS BIGINT) AS node_id, CAST(NULL AS BIGINT) AS parent_id, 0 AS depth, "
            f"CAST(NULL AS INTEGER) AS branch, CAST(NULL AS VARCHAR) AS branch_value, false AS is_leaf, "
            f"CAST(NULL AS VARCHAR) AS stop_reason, dec.feature AS split_feature, dec.threshold AS threshold, "
            f"round(dec.gain, {RD}) AS gain, round(dec.ratio, {RD}) AS gain_ratio, rootc.n AS n_rows, "
            f"{maj} AS majority, CAST(NULL AS VARCHAR) AS prediction FROM dec, rootc\n"
            f"UNION ALL\n"
            f"SELECT CAST(1 + branch AS BIGINT), CAST(0 AS BIGINT), 1, CAST(branch AS INTEGER), branch_value, "
            f"stop_reason IS NOT NULL, stop_reason, CASE WHEN stop_reason IS NULL THEN sf END, "
            f"CASE WHEN stop_reason IS NULL THEN st END, CASE WHEN stop_reason IS NULL THEN round(sg, {RD}) END, "
            f"CASE WHEN stop_reason IS NULL THEN round(sr, {RD}) END, {n1}, {maj}, "
            f"CASE WHEN stop_reason IS NOT NULL THEN {maj} END FROM node1\n"
            f"UNION ALL\n"
            f"SELECT CAST(1 + b0.b0 + l.branch * b1.b1 + l.b2 AS BIGINT), CAST(1 + l.branch AS BIGINT), 2, "
            f"CAST(l.b2 AS INTEGER), l.bv, true, "
            f"CASE WHEN l.n = 0 THEN 'empty' WHEN ({n_cls.replace('c', 'l.c')}) = 1 THEN 'pure' ELSE 'depth' END, "
            f"NULL, NULL, NULL, NULL, l.n, CASE WHEN l.n > 0 THEN {_majority_sql(classes, 'l.c')} END, "
            f"CASE WHEN l.n > 0 THEN {_majority_sql(classes, 'l.c')} ELSE "
            f"{_majority_sql(classes, 'p.c')} END "
            f"FROM leaf2 l CROSS JOIN radix0 b0 CROSS JOIN radix1 b1 JOIN node1 p ON p.branch = l.branch")
