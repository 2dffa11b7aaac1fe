"""Registered queries for profiling."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..columns import round_all
from ..operators import profile as p
from ..operators import sketches as sk
from ..session import scratch_path
from .registry import make_registry
from .tables import table, view, with_views

Q, q = make_registry()

LINE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CONST_COLS = ["id", "same", "varying", "empty"]
PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
PNAMES = ["q0", "q10", "q25", "q50", "q75", "q90", "q100"]


def r6(e: str, d: int = 6) -> str:
    return f"round({e}, {d})"


def _long(tbl: str, cols, keys=()) -> str:
    k = "".join(f"{x}, " for x in keys)
    return " UNION ALL ".join(f"SELECT {k}'{c}' AS column_name, CAST({c} AS DOUBLE) AS v FROM {tbl}"
                              for c in cols)


def _skew(v="v"):
    return (f"CASE WHEN count({v}) < 3 THEN NULL WHEN var_samp({v}) = 0 THEN 0 "
            f"ELSE skewness({v}) END")


def _kurt(v="v"):
    return (f"CASE WHEN count({v}) < 4 THEN NULL WHEN var_samp({v}) = 0 THEN 0 "
            f"ELSE kurtosis({v}) END")


def _moments_sql(tbl, cols):
    return (f"SELECT column_name, CAST(count(v) AS BIGINT) AS n, {r6('avg(v)')} AS mean, "
            f"{r6('stddev_samp(v)')} AS std, {r6('min(v)')} AS min, {r6('max(v)')} AS max, "
            f"{r6(_skew())} AS skew, {r6(_kurt())} AS kurt FROM ({_long(tbl, cols)}) u "
            f"GROUP BY column_name")


@q("moments", _moments_sql("lineitem", LINE_COLS))
def _moments(spark, sf):
    return round_all(p.moments(table(spark, sf, "lineitem"), LINE_COLS))


@q("moments_constants", with_views(_moments_sql("constants", CONST_COLS), "constants"))
def _moments_constants(spark, sf):
    return round_all(p.moments(view(spark, sf, "constants"), CONST_COLS))


def _q_cols(v, keys=""):
    return ", ".join(f"{r6(f'quantile_cont({v}, {pr})')} AS {nm}" for pr, nm in zip(PROBS, PNAMES))


@q("quantiles", f"SELECT {_q_cols('l_extendedprice')} FROM lineitem")
def _quantiles(spark, sf):
    return round_all(p.quantiles(table(spark, sf, "lineitem"), "l_extendedprice", PROBS,
                                 names=PNAMES))


@q("quantiles_by_group",
   f"SELECT l_returnflag, {_q_cols('l_extendedprice')} FROM lineitem GROUP BY l_returnflag")
def _quantiles_by_group(spark, sf):
    return round_all(p.quantiles(table(spark, sf, "lineitem"), "l_extendedprice", PROBS,
                                 by=["l_returnflag"], names=PNAMES))


def _describe_num_sql(tbl, cols, keys=()):
    k = "".join(f"{x}, " for x in keys)
    qs = ", ".join(f"{r6(f'quantile_cont(v, {pr})')} AS {nm}"
                   for pr, nm in [(0.25, "q25"), (0.5, "q50"), (0.75, "q75")])
    return (f"SELECT {k}column_name, CAST(count(v) AS BIGINT) AS count, {r6('avg(v)')} AS mean, "
            f"{r6('stddev_samp(v)')} AS std, {r6('min(v)')} AS min, {qs}, {r6('max(v)')} AS max "
            f"FROM ({_long(tbl, cols, keys)}) u WHERE v IS NOT NULL GROUP BY {k}column_name")


def _describe_all_sql():
    num = ["c_custkey", "c_nationkey", "c_acctbal"]
    txt = ["c_name", "c_mktsegment"]
    nulls = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}"
                      for c in ["mean", "std", "min", "q25", "q50", "q75", "max"])
    parts = [f"SELECT column_name, count, CAST(NULL AS BIGINT) AS \"unique\", "
             f"CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq, mean, std, min, q25, "
             f"q50, q75, max FROM ({_describe_num_sql('customer', num)}) n"]
    for c in txt:
        parts.append(
            f"SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS count, "
            f"CAST(count(DISTINCT {c}) AS BIGINT) AS \"unique\", (SELECT {c} FROM customer WHERE "
            f"{c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top, "
            f"(SELECT CAST(count(*) AS BIGINT) FROM customer WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY count(*) DESC LIMIT 1) AS freq, {nulls} FROM customer")
    return " UNION ALL ".join(parts)


@q("describe_all", _describe_all_sql())
def _describe_all(spark, sf):
    return round_all(p.describe_all(table(spark, sf, "customer")))


@q("describe_by_group", _describe_num_sql("lineitem", ["l_extendedprice", "l_quantity"],
                                          ["l_returnflag"]))
def _describe_by_group(spark, sf):
    return round_all(p.describe_numeric(table(spark, sf, "lineitem"),
                                        ["l_extendedprice", "l_quantity"], by=["l_returnflag"]))


def _central_sql(tbl, cols):
    T, S, C, X = p.CV_TEXT, p.SKEW_TEXT, p.CENTRAL_TEXT, p.TRANSFORM_TEXT
    esc = lambda s: "'" + s.replace("'", "''") + "'"
    cv = "cv"
    lvl = ("CASE WHEN abs(skew) <= 0.3 THEN 'low' WHEN abs(skew) <= 0.6 THEN 'moderate' "
           "WHEN abs(skew) <= 1.0 THEN 'high' ELSE 'very_high' END")
    cvm = (f"CASE WHEN {cv} <= 10 THEN {esc(T[0])} WHEN {cv} <= 20 THEN {esc(T[1])} "
           f"WHEN {cv} <= 30 THEN {esc(T[2])} ELSE {esc(T[3])} END")
    skm = (f"CASE lvl WHEN 'low' THEN {esc(S[0])} WHEN 'moderate' THEN {esc(S[1])} "
           f"WHEN 'high' THEN {esc(S[2])} ELSE {esc(S[3])} END")
    pick = (f"CASE WHEN {cv} > 30 OR lvl IN ('high', 'very_high') THEN 0 "
            f"WHEN {cv} > 20 OR lvl = 'moderate' THEN 1 ELSE 2 END")
    central = f"CASE {pick} " + " ".join(f"WHEN {i} THEN {esc(c[0])}" for i, c in enumerate(C)) + " END"
    reason = f"CASE {pick} " + " ".join(f"WHEN {i} THEN {esc(c[1])}" for i, c in enumerate(C)) + " END"
    right = (f"{esc(X['right'])} || CASE WHEN min > 0 THEN {esc(X['right_pos'])} WHEN min >= 0 "
             f"THEN {esc(X['right_zero'])} ELSE {esc(X['right_neg'])} END")
    left = (f"{esc(X['left'])} || CASE WHEN min >= 0 THEN {esc(X['left_nonneg'])} "
            f"ELSE {esc(X['left_neg'])} END")
    trans = (f"CASE WHEN lvl IN ('high', 'very_high') THEN (CASE WHEN skew > 0 THEN {right} "
             f"ELSE {left} END) || CASE WHEN abs(skew) > 1.5 OR max > 10 * median THEN "
             f"{esc(X['extreme'])} ELSE '' END END")
    zm = "mean = 0"
    inner = (f"SELECT column_name, CAST(count(v) AS BIGINT) AS n, avg(v) AS mean, "
             f"stddev_samp(v) AS std, quantile_cont(v, 0.5) AS median, min(v) AS min, "
             f"max(v) AS max, {_skew()} AS skew FROM ({_long(tbl, cols)}) u WHERE v IS NOT NULL "
             f"GROUP BY column_name")
    mid = (f"SELECT *, CASE WHEN mean <> 0 THEN std / mean * 100.0 END AS cv, {lvl} AS lvl "
           f"FROM ({inner}) a")
    return (f"SELECT column_name, n, {r6('mean')} AS mean, {r6('std')} AS std, "
            f"{r6('median')} AS median, {r6('cv')} AS cv, {r6('abs(cv)')} AS cv_abs, "
            f"{r6('skew')} AS skew, CASE WHEN {zm} THEN NULL ELSE {cvm} END AS cv_message, "
            f"CASE WHEN {zm} THEN NULL ELSE lvl END AS skew_level, "
            f"CASE WHEN {zm} THEN NULL ELSE {skm} END AS skew_message, "
            f"CASE WHEN {zm} THEN 'undefined' ELSE {central} END AS central, "
            f"CASE WHEN {zm} THEN NULL ELSE {reason} END AS reason, "
            f"CASE WHEN {zm} THEN NULL ELSE {trans} END AS transform FROM ({mid}) b")


@q("central_trend", _central_sql("lineitem", LINE_COLS))
def _central_trend(spark, sf):
    return round_all(p.central_trend(table(spark, sf, "lineitem"), LINE_COLS))


@q("central_trend_events", _central_sql("events", ["value", "user_id"]))
def _central_trend_events(spark, sf):
    return round_all(p.central_trend(table(spark, sf, "events"), ["value", "user_id"]))


_IQR = ("SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) "
        "AS upper FROM (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 "
        "FROM events) x")


@q("iqr_bounds", f"SELECT {', '.join(r6(c) + ' AS ' + c for c in ['q1','q3','iqr','lower','upper'])} "
                 f"FROM ({_IQR}) b")
def _iqr_bounds(spark, sf):
    return round_all(p.iqr_bounds(table(spark, sf, "events"), "value"))


@q("iqr_outliers", f"SELECT e.*, CASE WHEN e.value < b.lower THEN 'lower' ELSE 'upper' END AS side "
                   f"FROM events e, ({_IQR}) b WHERE e.value < b.lower OR e.value > b.upper")
def _iqr_outliers(spark, sf):
    return p.iqr_outliers(table(spark, sf, "events"), "value")


@q("sigma_bands", "SELECT CAST(n AS BIGINT) AS n, " + ", ".join(
    [r6("mean") + " AS mean", r6("std") + " AS std"]
    + [r6(f"mean - {k} * std") + f" AS lower_{k}s" for k in (1, 2, 3)]
    + [r6(f"mean + {k} * std") + f" AS upper_{k}s" for k in (1, 2, 3)]
    + [r6(f"(SELECT avg(CASE WHEN abs(value - s.mean) <= {k} * s.std THEN 1.0 ELSE 0.0 END) "
          f"FROM events WHERE value IS NOT NULL)") + f" AS share_{k}s" for k in (1, 2, 3)])
   + " FROM (SELECT avg(value) AS mean, stddev_samp(value) AS std, count(value) AS n FROM events) s")
def _sigma_bands(spark, sf):
    return round_all(p.sigma_bands(table(spark, sf, "events"), "value"))


@q("sigma_outliers", "SELECT e.*, round((e.value - s.m) / s.s, 6) AS z FROM events e, "
                     "(SELECT avg(value) AS m, stddev_samp(value) AS s FROM events) s "
                     "WHERE abs(e.value - s.m) > 3.0 * s.s")
def _sigma_outliers(spark, sf):
    out = p.sigma_outliers(table(spark, sf, "events"), "value")
    return out.withColumn("z", F.round("z", 6))


@q("normality_heuristic",
   f"SELECT column_name, n, {r6('skew')} AS skew, {r6('kurt')} AS kurt, abs(skew) < 0.5 AND "
   f"abs(kurt) < 1 AS approx_normal, n > 5000 AS large_sample FROM (SELECT column_name, "
   f"CAST(count(v) AS BIGINT) AS n, {_skew()} AS skew, {_kurt()} AS kurt FROM "
   f"({_long('lineitem', LINE_COLS)}) u GROUP BY column_name) m")
def _normality_heuristic(spark, sf):
    return round_all(p.normality_heuristic(table(spark, sf, "lineitem"), LINE_COLS))


def _pairs_sql(tbl, cols, ordered, what):
    parts = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if not ordered and i >= j:
                continue
            both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
            xa = f"CASE WHEN {both} THEN CAST({a} AS DOUBLE) END"
            xb = f"CASE WHEN {both} THEN CAST({b} AS DOUBLE) END"
            cov = f"covar_samp({xa}, {xb})"
            r = f"{cov} / nullif(stddev_samp({xa}) * stddev_samp({xb}), 0)"
            sel = {"cov": f"{r6(cov)} AS cov", "r": f"{r6(r)} AS r"}[what]
            extra = ""
            if what == "r" and not ordered:
                extra = (f", CASE WHEN {r} > 0 THEN 'positive' WHEN {r} < 0 THEN 'negative' WHEN "
                         f"{r} = 0 THEN 'neutral' END AS direction, CASE WHEN ({r}) IS NULL THEN "
                         f"'Undefined' WHEN abs({r}) > 0.7 THEN 'Strong' WHEN abs({r}) > 0.3 THEN "
                         f"'Moderate' WHEN abs({r}) = 0 THEN 'No linear relationship' ELSE 'Weak' "
                         f"END AS strength")
            parts.append(f"SELECT '{a}' AS x, '{b}' AS y, {sel}{extra} FROM {tbl}")
    return " UNION ALL ".join(parts)


@q("covariance_matrix", _pairs_sql("lineitem", LINE_COLS, True, "cov"))
def _covariance_matrix(spark, sf):
    return round_all(p.covariance_matrix(table(spark, sf, "lineitem"), LINE_COLS))


@q("correlation_matrix", _pairs_sql("lineitem", LINE_COLS, True, "r"))
def _correlation_matrix(spark, sf):
    return round_all(p.correlation_matrix(table(spark, sf, "lineitem"), LINE_COLS))


@q("correlation_pairs", _pairs_sql("lineitem", LINE_COLS, False, "r"))
def _correlation_pairs(spark, sf):
    return round_all(p.correlation_pairs(table(spark, sf, "lineitem"), LINE_COLS))


@q("correlation_constants", with_views(_pairs_sql("constants", CONST_COLS, False, "r"),
                                       "constants"))
def _correlation_constants(spark, sf):
    return round_all(p.correlation_pairs(view(spark, sf, "constants"), CONST_COLS))


@q("value_counts", "SELECT p_type AS value, CAST(count(*) AS BIGINT) AS n FROM part "
                   "WHERE p_type IS NOT NULL GROUP BY p_type")
def _value_counts(spark, sf):
    return p.value_counts(table(spark, sf, "part"), "p_type")


@q("group_mean", "SELECT event_type, round(avg(value), 2) AS mean FROM events GROUP BY event_type")
def _group_mean(spark, sf):
    return p.group_mean(table(spark, sf, "events"), ["event_type"], "value")


@q("group_mean_sorted", "SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 2) AS mean "
                        "FROM lineitem GROUP BY l_returnflag, l_linestatus")
def _group_mean_sorted(spark, sf):
    return p.group_mean(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"],
                        "l_quantity").orderBy("mean")


@q("group_multi_mean", "SELECT l_returnflag, " + ", ".join(
    f"{r6(f'avg({c})')} AS mean_{c}" for c in LINE_COLS[:3]) + " FROM lineitem GROUP BY l_returnflag")
def _group_multi_mean(spark, sf):
    return round_all(p.group_multi_mean(table(spark, sf, "lineitem"), "l_returnflag",
                                        LINE_COLS[:3]))


@q("group_mean_ci",
   "SELECT l_returnflag, l_linestatus, n, " + ", ".join(
       [r6("mean") + " AS mean", r6("sd") + " AS sd", r6("mean - 1.96 * sd / sqrt(n)") + " AS ci_low",
        r6("mean + 1.96 * sd / sqrt(n)") + " AS ci_high"])
   + " FROM (SELECT l_returnflag, l_linestatus, CAST(count(l_extendedprice) AS BIGINT) AS n, "
     "avg(l_extendedprice) AS mean, stddev_samp(l_extendedprice) AS sd FROM lineitem "
     "GROUP BY l_returnflag, l_linestatus) g")
def _group_mean_ci(spark, sf):
    return round_all(p.group_mean_ci(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus",
                                     "l_extendedprice"))


@q("pivot_table", "SELECT l_returnflag, "
                  f"{r6(chr(39).join(['avg(CASE WHEN l_linestatus = ', 'F', ' THEN l_extendedprice END)']))} AS F, "
                  f"{r6(chr(39).join(['avg(CASE WHEN l_linestatus = ', 'O', ' THEN l_extendedprice END)']))} AS O "
                  "FROM lineitem GROUP BY l_returnflag")
def _pivot_table(spark, sf):
    return round_all(p.pivot_table(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus",
                                   "l_extendedprice", ["F", "O"]))


@q("compare_two_measures",
   "SELECT o_orderpriority, round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 4) AS "
   "measure_a, round(sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END), 4) AS measure_b "
   "FROM orders GROUP BY o_orderpriority")
def _compare_two_measures(spark, sf):
    return round_all(p.compare_two_measures(table(spark, sf, "orders"), "o_orderpriority",
                                            "o_orderstatus", "F", "O", "o_totalprice"), 4)


@q("start_end_segments",
   "SELECT user_id, arg_min(value, ts) AS start_value, arg_max(value, ts) AS end_value, "
   "min(ts) AS start_at, max(ts) AS end_at, round(arg_max(value, ts) - arg_min(value, ts), 6) "
   "AS change FROM events GROUP BY user_id")
def _start_end_segments(spark, sf):
    out = p.start_end_segments(table(spark, sf, "events"), "user_id", "ts", "value")
    return out.withColumn("change", F.round("change", 6))


_BOX_LONG = ("SELECT 'customer' AS grp, c_acctbal AS v FROM customer UNION ALL "
             "SELECT 'supplier' AS grp, s_acctbal AS v FROM supplier")


@q("box_stats",
   "SELECT q.grp AS \"group\", " + ", ".join(r6(f"q.{c}") + f" AS {c}" for c in
                                          ["q1", "median", "q3", "lower_fence", "upper_fence"])
   + ", CAST(count(*) AS BIGINT) AS n, " + r6("avg(l.v)") + " AS mean, "
   + r6("min(CASE WHEN l.v >= q.lower_fence AND l.v <= q.upper_fence THEN l.v END)")
   + " AS whisker_low, "
   + r6("max(CASE WHEN l.v >= q.lower_fence AND l.v <= q.upper_fence THEN l.v END)")
   + " AS whisker_high, CAST(count(*) FILTER (WHERE NOT (l.v >= q.lower_fence AND l.v <= "
     "q.upper_fence)) AS BIGINT) AS n_outliers FROM (" + _BOX_LONG + ") l JOIN (SELECT grp, q1, "
     "median, q3, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM "
     "(SELECT grp, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, "
     "quantile_cont(v, 0.75) AS q3 FROM (" + _BOX_LONG + ") a WHERE v IS NOT NULL GROUP BY grp) b) q "
     "ON l.grp = q.grp WHERE l.v IS NOT NULL GROUP BY q.grp, q.q1, q.median, q.q3, q.lower_fence, "
     "q.upper_fence")
def _box_stats(spark, sf):
    s = p.stack_series([("customer", table(spark, sf, "customer"), "c_acctbal"),
                        ("supplier", table(spark, sf, "supplier"), "s_acctbal")])
    return round_all(p.box_stats(s))


@q("box_outlier_points",
   f"SELECT e.value, CASE WHEN e.value < b.lower THEN 'lower' ELSE 'upper' END AS side, "
   f"CAST(count(*) AS BIGINT) AS n FROM events e, ({_IQR}) b WHERE e.value < b.lower OR "
   f"e.value > b.upper GROUP BY 1, 2")
def _box_outlier_points(spark, sf):
    return p.box_outlier_points(table(spark, sf, "events"), "value")


def _tskew_sql():
    ts = {"none": "x", "log": "CASE WHEN x > 0 THEN ln(x) END",
          "sqrt": "CASE WHEN x >= 0 THEN sqrt(x) END",
          "reciprocal": "CASE WHEN x <> 0 THEN 1.0 / x END", "square": "x * x",
          "reflect_log": "CASE WHEN mx + 1 - x > 0 THEN ln(mx + 1 - x) END"}
    parts = [f"SELECT '{k}' AS transform, CAST(count({e}) AS BIGINT) AS n, "
             f"{r6(_skew(e))} AS skew FROM (SELECT value AS x, (SELECT max(value) FROM events) "
             f"AS mx FROM events WHERE value IS NOT NULL) t" for k, e in ts.items()]
    return " UNION ALL ".join(parts)


@q("transform_skew", _tskew_sql())
def _transform_skew(spark, sf):
    return round_all(p.transform_skew(table(spark, sf, "events"), "value"))


def _lambda_sql():
    parts = []
    for lam in p.lambda_grid():
        bc = "ln(x)" if lam == 0 else f"(pow(x, {lam}) - 1) / {lam}"
        pos = "ln(1 + x)" if lam == 0 else f"(pow(x + 1, {lam}) - 1) / {lam}"
        neg = "-ln(1 - x)" if lam == 2 else f"-(pow(1 - x, {2 - lam}) - 1) / {2 - lam}"
        yj = f"CASE WHEN x >= 0 THEN {pos} ELSE {neg} END"
        parts.append(
            f"SELECT CAST({lam} AS DOUBLE) AS lambda, "
            f"round(({lam} - 1) * sum(CASE WHEN x > 0 THEN ln(x) END) - count(CASE WHEN x > 0 "
            f"THEN x END) / 2.0 * ln(var_pop(CASE WHEN x > 0 THEN {bc} END)), 4) AS boxcox_llf, "
            f"round(({lam} - 1) * sum(sign(x) * ln(1 + abs(x))) - count(x) / 2.0 * "
            f"ln(var_pop({yj})), 4) AS yeojohnson_llf FROM (SELECT value AS x FROM events WHERE "
            f"value IS NOT NULL) t")
    return " UNION ALL ".join(parts)


@q("power_lambda_grid", _lambda_sql())
def _power_lambda_grid(spark, sf):
    return round_all(p.power_lambda_grid(table(spark, sf, "events"), "value"), 4)


def _rank_score_sql() -> str:
    from .q_stat import _ppf_sql
    return ("WITH v AS (SELECT event_id, value, CASE WHEN isnan(value) THEN NULL ELSE value END AS x FROM events), "
            "r AS (SELECT x, (min(rn) + max(rn)) / 2.0 AS mean_rank FROM (SELECT x, row_number() OVER (ORDER BY x) AS rn FROM v "
            "WHERE x IS NOT NULL) t GROUP BY x), n AS (SELECT count(x) AS n FROM v) SELECT event_id, value, "
            f"round({_ppf_sql('((mean_rank - 0.5) / n.n)')}, 7) AS normal_score FROM v LEFT JOIN r USING (x), n")


@q("rank_normal_score", _rank_score_sql())
def _rank_normal_score(spark, sf):
    out = p.rank_normal_score(table(spark, sf, "events").select("event_id", "value"), "value")
    return out.withColumn("normal_score", F.round("normal_score", 7))


def _power_sql(family: str) -> str:
    """Halving of the slope of the likelihood, 30 times."""
    log = "ln(x)" if family == "boxcox" else "ln(1 + abs(x))"
    side = "1" if family == "boxcox" else "CASE WHEN x >= 0 THEN 1 ELSE -1 END"
    m = "l.mid" if family == "boxcox" else "CASE WHEN x >= 0 THEN l.mid ELSE 2 - l.mid END"
    return (f"WITH RECURSIVE e AS MATERIALIZED (SELECT {log} AS g, {side} AS s, value AS x FROM (SELECT value, value AS x FROM events "
            f"WHERE value IS NOT NULL AND NOT isnan(value)) t {'WHERE x > 0' if family == 'boxcox' else ''}), "
            "h(i, mid, w) AS (SELECT 0, 0.0::DOUBLE, 5.0::DOUBLE UNION ALL "
            "SELECT i + 1, mid + CASE WHEN up THEN w / 2 ELSE -w / 2 END, w / 2 FROM ("
            "SELECT l.i, l.mid, l.w, avg(s * g) - covar_pop(y, d) / var_pop(y) > 0 AS up FROM (SELECT l.i, l.mid, l.w, s, g, "
            f"s * CASE WHEN {m} = 0 THEN g ELSE (exp({m} * g) - 1) / ({m}) END AS y, "
            f"CASE WHEN {m} = 0 THEN g * g / 2 ELSE (({m}) * g * exp(({m}) * g) - exp(({m}) * g) + 1) / (({m}) * ({m})) END AS d "
            "FROM h l, e WHERE l.i < 30) l GROUP BY l.i, l.mid, l.w) z) "
            f"SELECT '{family}' AS family, round(mid, 6) AS lambda FROM h WHERE i = 30")


@q("power_fit", f"SELECT * FROM ({_power_sql('boxcox')}) a UNION ALL SELECT * FROM ({_power_sql('yeojohnson')}) b")
def _power_fit(spark, sf):
    ev = table(spark, sf, "events")
    best = [(f, p.power_fit(ev, "value", f)) for f in ("boxcox", "yeojohnson")]
    return spark.createDataFrame(best, "family string, lambda double").withColumn("lambda", F.round("lambda", 6))


_PROBS = [0.01, 0.25, 0.5, 0.75, 0.99]


@q("quantiles_sketch",
   "SELECT event_type, p, count(value)::BIGINT AS n, true AS within, true AS merged_within FROM events, "
   f"(SELECT unnest({_PROBS}::DOUBLE[]) AS p) x GROUP BY event_type, p")
def _quantiles_sketch(spark, sf):
    """Whether the ranks of sketched quantiles lie within twice the bound, for sketches of the whole and merged of days."""
    ev = table(spark, sf, "events").select("event_type", F.to_date("ts").alias("day"), "value")
    folder = scratch_path(spark, f"sketches-{uuid.uuid4().hex}")
    sk.store_sketches(ev, "day", folder, ["value"], ["event_type"])
    merged = sk.merge_sketches(sk.read_sketches(spark, folder), ["event_type"])
    names = [f"q{i}" for i in range(len(_PROBS))]
    rows = F.explode(F.arrays_zip(F.array(*map(F.lit, _PROBS)).alias("p"), F.array(*names).alias("q"))).alias("r")

    def checked(sketches, name):
        found = sk.sketch_quantiles(sketches, _PROBS, names).select("event_type", "n", rows).select("event_type", "n", "r.*")
        met = found.join(ev.select("event_type", "value"), "event_type").groupBy("event_type", "p", "n").agg(
            (F.sum((F.col("value") < F.col("q")).cast("int")) / F.count("*")).alias("lo"),
            (F.sum((F.col("value") <= F.col("q")).cast("int")) / F.count("*")).alias("hi"))
        most = 2 * sk.rank_error()
        return met.select("event_type", "p", "n", ((F.col("lo") <= F.col("p") + most) & (F.col("hi") >= F.col("p") - most)).alias(name))

    whole = checked(sk.quantile_sketches(ev, ["value"], ["event_type"]), "within")
    return whole.join(checked(merged, "merged_within"), ["event_type", "p", "n"])
