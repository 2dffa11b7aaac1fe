"""Registered queries for hypothesis tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..columns import round_all
from ..functions import special as sp
from ..operators import stat_tests as st
from .registry import make_registry
from .tables import table, view, with_views

Q, q = make_registry()


# --- SQL forms of published algorithms, written from their definitions -------------------------

def _horner(coefs, x: str) -> str:
    out = f"({coefs[-1]!r}::DOUBLE)"
    for c in reversed(coefs[:-1]):
        out = f"({out} * {x} + {c!r})"
    return out


def _ppf_sql(p: str) -> str:
    """Inverse normal CDF (AS 241) in SQL."""
    q = f"(({p}) - 0.5)"
    centre = f"{q} * {_horner(sp._A, f'(0.180625 - {q} * {q})')} / {_horner(sp._B, f'(0.180625 - {q} * {q})')}"
    r = f"sqrt(-ln(least({p}, 1 - ({p}))))"
    mid = f"{_horner(sp._C, f'({r} - 1.6)')} / {_horner(sp._D, f'({r} - 1.6)')}"
    far = f"{_horner(sp._E, f'({r} - 5.0)')} / {_horner(sp._F, f'({r} - 5.0)')}"
    return (f"(CASE WHEN abs({q}) <= 0.425 THEN {centre} ELSE sign({q}) * "
            f"(CASE WHEN {r} <= 5 THEN {mid} ELSE {far} END) END)")


def _log_cdf_sql(z: str) -> str:
    """ln of the normal CDF, from the tail approximation of Hart as published by West (|z| < 7.07; the
    continued fraction beyond)."""
    a = f"abs({z})"
    near = f"{_horner(sp._HART_NUM, a)} / {_horner(sp._HART_DEN, a)}"
    frac = f"({a} + 0.65)"
    for k in (4, 3, 2, 1):
        frac = f"({a} + {k} / {frac})"
    tail = (f"(exp(-{a} * {a} / 2) * (CASE WHEN {a} < 7.07106781186547 THEN {near} "
            f"ELSE 1 / ({frac} * 2.506628274631) END))")
    return f"(CASE WHEN {z} > 0 THEN ln(1 - {tail}) ELSE ln({tail}) END)"


@q("levene_stat", with_views(
    "WITH med AS (SELECT grp, quantile_cont(val, 0.5) AS m FROM spans WHERE val IS NOT NULL "
    "GROUP BY grp), z AS (SELECT grp, abs(val - m) AS z FROM spans JOIN med USING (grp) WHERE val "
    "IS NOT NULL), g AS (SELECT grp, count(z) AS n, avg(z) AS zb, var_pop(z) * count(z) AS ss FROM z "
    "GROUP BY grp), t AS (SELECT sum(n) AS nn, count(*) AS k, sum(n * zb) / sum(n) AS zbar FROM g) "
    "SELECT CAST(t.k AS BIGINT) AS k, CAST(t.nn AS BIGINT) AS n, round((t.nn - t.k) / (t.k - 1) * "
    "sum(g.n * (g.zb - t.zbar) * (g.zb - t.zbar)) / sum(g.ss), 6) AS statistic, "
    "CAST(t.k - 1 AS DOUBLE) AS df1, CAST(t.nn - t.k AS DOUBLE) AS df2 FROM g, t "
    "GROUP BY t.k, t.nn, t.zbar", "spans"))
def _levene_stat(spark, sf):
    out = st.levene(view(spark, sf, "spans"), "grp", "val").drop("p_value")
    return round_all(out)


def _t_sql(pooled: bool) -> str:
    base = ("SELECT count(CASE WHEN grp = 'BUILDING' THEN val END) AS n1, count(CASE WHEN grp = "
            "'MACHINERY' THEN val END) AS n2, avg(CASE WHEN grp = 'BUILDING' THEN val END) AS mean1, "
            "avg(CASE WHEN grp = 'MACHINERY' THEN val END) AS mean2, var_samp(CASE WHEN grp = "
            "'BUILDING' THEN val END) AS var1, var_samp(CASE WHEN grp = 'MACHINERY' THEN val END) AS "
            "var2 FROM spans WHERE grp IN ('BUILDING', 'MACHINERY')")
    if pooled:
        t = ("(mean1 - mean2) / sqrt(((n1 - 1) * var1 + (n2 - 1) * var2) / (n1 + n2 - 2) * "
             "(1.0 / n1 + 1.0 / n2))")
        d = "CAST(n1 + n2 - 2 AS DOUBLE)"
    else:
        t = "(mean1 - mean2) / sqrt(var1 / n1 + var2 / n2)"
        d = ("(var1 / n1 + var2 / n2) * (var1 / n1 + var2 / n2) / ((var1 / n1) * (var1 / n1) / "
             "(n1 - 1) + (var2 / n2) * (var2 / n2) / (n2 - 1))")
    return with_views(
        f"SELECT CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, round(mean1, 6) AS mean1, "
        f"round(mean2, 6) AS mean2, round(var1, 6) AS var1, round(var2, 6) AS var2, "
        f"round({t}, 6) AS t, round({d}, 6) AS df FROM ({base}) s", "spans")


@q("ttest_pooled", _t_sql(True))
def _ttest_pooled(spark, sf):
    out = st.ttest(view(spark, sf, "spans"), "grp", "val", "BUILDING", "MACHINERY", True)
    return round_all(out.drop("p_value"))


@q("ttest_welch", _t_sql(False))
def _ttest_welch(spark, sf):
    out = st.ttest(view(spark, sf, "spans"), "grp", "val", "BUILDING", "MACHINERY", False)
    return round_all(out.drop("p_value"))


@q("ttest_decision")
def _ttest_decision(spark, sf):
    return st.ttest_decision(view(spark, sf, "spans"), "grp", "val", "BUILDING", "MACHINERY")


@q("levene_by_segment",
   "WITH med AS (SELECT l_linestatus, l_returnflag, quantile_cont(l_extendedprice, 0.5) AS m FROM lineitem WHERE "
   "l_extendedprice IS NOT NULL GROUP BY ALL), z AS (SELECT l_linestatus, l_returnflag, abs(l_extendedprice - m) AS z "
   "FROM lineitem JOIN med USING (l_linestatus, l_returnflag) WHERE l_extendedprice IS NOT NULL), g AS (SELECT l_linestatus, "
   "l_returnflag, count(z) AS n, avg(z) AS zb, var_pop(z) * count(z) AS ss FROM z GROUP BY ALL), t AS (SELECT l_linestatus, "
   "sum(n) AS nn, count(*) AS k, sum(n * zb) / sum(n) AS zbar FROM g GROUP BY ALL) SELECT l_linestatus, "
   "CAST(t.k AS BIGINT) AS k, CAST(t.nn AS BIGINT) AS n, round(((t.nn - t.k) / nullif(t.k - 1, 0)) * sum(g.n * (g.zb - t.zbar) * "
   "(g.zb - t.zbar)) / nullif(sum(g.ss), 0), 6) AS statistic, CAST(t.k - 1 AS DOUBLE) AS df1, CAST(t.nn - t.k AS DOUBLE) AS df2 "
   "FROM g JOIN t USING (l_linestatus) GROUP BY l_linestatus, t.k, t.nn, t.zbar")
def _levene_by_segment(spark, sf):
    """Per-segment Levene: returnflag groups of extendedprice within each line status. The p-value is
    checked in pytest against published tails."""
    out = st.levene(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice", by=["l_linestatus"])
    return round_all(out.drop("p_value"))


_EV = "SELECT value AS x FROM events WHERE value IS NOT NULL AND NOT isnan(value)"
_POS = (f"SELECT row_number() OVER (ORDER BY x) AS i, count(*) OVER () AS n, x AS sample "
        f"FROM ({_EV}) e")
_FILL = ("CASE WHEN i = n THEN pow(0.5, 1.0 / n) WHEN i = 1 THEN 1.0 - pow(0.5, 1.0 / n) "
         "ELSE (i - 0.3175) / (n + 0.365) END")


@q("qq_positions", f"SELECT CAST(i AS BIGINT) AS i, round({_FILL}, 12) AS p, sample FROM ({_POS}) t")
def _qq_positions(spark, sf):
    out = st.qq_positions(table(spark, sf, "events"), "value")
    return out.withColumn("p", F.round("p", 12))


def _qq_sql(theoretical: str, src: str = _POS, values: str = _EV) -> str:
    return (f"WITH b AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM ({values}) e), "
            f"f AS (SELECT i, sample, {_FILL} AS p FROM ({src}) t) SELECT CAST(i AS BIGINT) AS i, "
            f"round({theoretical}, 7) AS theoretical, sample, sample < q1 - 1.5 * (q3 - q1) OR "
            f"sample > q3 + 1.5 * (q3 - q1) AS is_outlier FROM f, b")


@q("qq_points", _qq_sql(_ppf_sql("p")))
def _qq_points(spark, sf):
    out = st.qq_points(table(spark, sf, "events"), "value")
    return out.withColumn("theoretical", F.round("theoretical", 7))


@q("qq_points_expon",
   f"WITH b AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM ({_EV}) e) "
   f"SELECT CAST(i AS BIGINT) AS i, round(2.0 - 30.0 * ln(1 - ({_FILL})), 9) AS theoretical, sample, "
   f"sample < q1 - 1.5 * (q3 - q1) OR sample > q3 + 1.5 * (q3 - q1) AS is_outlier FROM ({_POS}) t, b")
def _qq_points_expon(spark, sf):
    out = st.qq_points(table(spark, sf, "events"), "value", "expon", {"loc": 2.0, "scale": 30.0})
    return out.withColumn("theoretical", F.round("theoretical", 9))


@q("qq_points_uniform",
   f"WITH b AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM ({_EV}) e) "
   f"SELECT CAST(i AS BIGINT) AS i, round(0.0 + 500.0 * ({_FILL}), 9) AS theoretical, sample, "
   f"sample < q1 - 1.5 * (q3 - q1) OR sample > q3 + 1.5 * (q3 - q1) AS is_outlier FROM ({_POS}) t, b")
def _qq_points_uniform(spark, sf):
    out = st.qq_points(table(spark, sf, "events"), "value", "uniform", {"loc": 0.0, "scale": 500.0})
    return out.withColumn("theoretical", F.round("theoretical", 9))


@q("qq_points_weibull",
   f"WITH b AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM ({_EV}) e) "
   f"SELECT CAST(i AS BIGINT) AS i, round(40.0 * pow(-ln(1 - ({_FILL})), 1.0 / 1.5), 9) AS "
   f"theoretical, sample, sample < q1 - 1.5 * (q3 - q1) OR sample > q3 + 1.5 * (q3 - q1) AS "
   f"is_outlier FROM ({_POS}) t, b")
def _qq_points_weibull(spark, sf):
    out = st.qq_points(table(spark, sf, "events"), "value", "weibull_min",
                       {"c": 1.5, "scale": 40.0})
    return out.withColumn("theoretical", F.round("theoretical", 9))


@q("qq_points_lognorm", _qq_sql(f"20.0 * exp({_ppf_sql('p')})"))
def _qq_points_lognorm(spark, sf):
    out = st.qq_points(table(spark, sf, "events"), "value", "lognorm", {"s": 1.0, "scale": 20.0})
    return out.withColumn("theoretical", F.round("theoretical", 7))


@q("qq_points_gamma")
def _qq_points_gamma(spark, sf):
    return st.qq_points(table(spark, sf, "customer"), "c_acctbal", "gamma", {"a": 2.0})


@q("qq_points_beta")
def _qq_points_beta(spark, sf):
    return st.qq_points(table(spark, sf, "customer"), "c_acctbal", "beta", {"a": 2.0, "b": 3.0})


@q("qq_points_chi2")
def _qq_points_chi2(spark, sf):
    return st.qq_points(table(spark, sf, "customer"), "c_acctbal", "chi2", {"df": 4.0})


@q("qq_points_t")
def _qq_points_t(spark, sf):
    return st.qq_points(table(spark, sf, "customer"), "c_acctbal", "t", {"df": 5.0})


@q("qq_fit", f"WITH pts AS (SELECT {_ppf_sql('p')} AS x, sample AS y FROM (SELECT sample, {_FILL} AS p FROM ({_POS}) t) f) "
             "SELECT round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept, "
             "round(corr(y, x), 9) AS r FROM pts")
def _qq_fit(spark, sf):
    out = st.qq_fit(st.qq_points(table(spark, sf, "events"), "value"))
    return out.select(F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"), F.round("r", 9).alias("r"))


_BAL = "SELECT c_acctbal AS x FROM customer WHERE c_acctbal IS NOT NULL"


def _shapiro_sql(src: str) -> str:
    """W by Royston's weights, for n > 5."""
    poly = lambda c: _horner(c, "u")
    return (
        f"WITH o AS (SELECT x, row_number() OVER (ORDER BY x) AS i, count(*) OVER () AS n FROM ({src}) s), "
        f"m AS (SELECT x, i, n, {_ppf_sql('(i - 0.375) / (n + 0.25)')} AS m FROM o), "
        "t AS (SELECT n, 1 / sqrt(n) AS u, sum(m * m) AS mm, max(CASE WHEN i = n THEN m END) AS mn, "
        "max(CASE WHEN i = n - 1 THEN m END) AS mn1, avg(x) AS mu FROM m GROUP BY n), "
        f"w AS (SELECT *, mn / sqrt(mm) + {poly(st._SW_C1)} AS an, mn1 / sqrt(mm) + {poly(st._SW_C2)} AS an1 FROM t), "
        "f AS (SELECT *, sqrt((mm - 2 * mn * mn - 2 * mn1 * mn1) / (1 - 2 * an * an - 2 * an1 * an1)) AS phi FROM w) "
        "SELECT CAST(f.n AS BIGINT) AS n, round(power(sum(x * (CASE WHEN i = f.n THEN an WHEN i = 1 THEN -an "
        "WHEN i = f.n - 1 THEN an1 WHEN i = 2 THEN -an1 ELSE m / phi END)), 2) / sum((x - mu) * (x - mu)), 8) AS statistic, "
        "f.n <= 5000 AS calibrated FROM m, f GROUP BY f.n")


@q("shapiro", _shapiro_sql(_BAL))
def _shapiro(spark, sf):
    """W over all rows; the p-value is checked in pytest against published values."""
    out = st.shapiro_wilk(table(spark, sf, "customer"), "c_acctbal")
    return out.select("n", F.round("statistic", 8).alias("statistic"), "calibrated")


def _dagostino_sql() -> str:
    mom = (f"SELECT count(x) * 1.0 AS n, avg(power(x - mu, 3)) / power(var_pop(x), 1.5) AS g1, "
           f"avg(power(x - mu, 4)) / power(var_pop(x), 2) AS b2 FROM (SELECT x, avg(x) OVER () AS mu "
           f"FROM ({_EV}) e) t")
    y = "g1 * sqrt((n + 1) * (n + 3) / (6 * (n - 2)))"
    beta2 = "3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))"
    w2 = f"(sqrt(2 * ({beta2} - 1)) - 1)"
    delta = f"(1 / sqrt(0.5 * ln({w2})))"
    alpha = f"sqrt(2 / ({w2} - 1))"
    ya = f"(({y}) / {alpha})"
    z1 = f"({delta} * ln({ya} + sqrt({ya} * {ya} + 1)))"
    e = "(3 * (n - 1) / (n + 1))"
    var = "(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5)))"
    x = f"((b2 - {e}) / sqrt({var}))"
    sb = ("(6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / "
          "(n * (n - 2) * (n - 3))))")
    a = f"(6 + 8 / {sb} * (2 / {sb} + sqrt(1 + 4 / ({sb} * {sb}))))"
    term = f"((1 - 2 / {a}) / (1 + {x} * sqrt(2 / ({a} - 4))))"
    cube = f"(sign({term}) * pow(abs({term}), 1.0 / 3.0))"
    z2 = f"((1 - 2 / (9 * {a}) - {cube}) / sqrt(2 / (9 * {a})))"
    k2 = f"({z1} * {z1} + {z2} * {z2})"
    return (f"SELECT CAST(n AS BIGINT) AS n, round({z1}, 6) AS skew_z, round({z2}, 6) AS kurt_z, "
            f"round({k2}, 6) AS statistic, round(exp(-{k2} / 2), 9) AS p_value FROM ({mom}) m")


@q("dagostino", _dagostino_sql())
def _dagostino(spark, sf):
    out = st.dagostino_pearson(table(spark, sf, "events"), "value")
    return round_all(out, skip=["p_value"]).withColumn("p_value", F.round("p_value", 9))


@q("anderson_darling",
   f"WITH s AS (SELECT avg(x) AS mu, stddev_samp(x) AS sd FROM ({_EV}) e), z AS (SELECT (x - mu) / sd AS z, "
   f"row_number() OVER (ORDER BY x) AS i, count(*) OVER () AS n FROM ({_EV}) e, s), a AS (SELECT n, -n - sum((2 * i - 1) * "
   f"{_log_cdf_sql('z')} + (2 * (n - i) + 1) * {_log_cdf_sql('(-z)')}) / n AS a2, "
   "round(0.787 / (1 + 4 / n - 25 / (n * n)), 3) AS crit FROM z GROUP BY n) SELECT CAST(n AS BIGINT) AS n, "
   "round(a2, 5) AS statistic, crit AS critical_5pct, a2 > crit AS reject_h0 FROM a")
def _anderson_darling(spark, sf):
    out = st.anderson_darling(table(spark, sf, "events"), "value")
    return out.withColumn("statistic", F.round("statistic", 5))


@q("normality_summary")
def _normality_summary(spark, sf):
    return st.normality_summary(table(spark, sf, "customer"), "c_acctbal")


@q("ttest_by_segment",
   "SELECT l_linestatus, CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, round(mean1, 6) AS "
   "mean1, round(mean2, 6) AS mean2, round(var1, 6) AS var1, round(var2, 6) AS var2, "
   "round((mean1 - mean2) / sqrt(var1 / n1 + var2 / n2), 6) AS t, round((var1 / n1 + var2 / n2) * "
   "(var1 / n1 + var2 / n2) / ((var1 / n1) * (var1 / n1) / (n1 - 1) + (var2 / n2) * (var2 / n2) / "
   "(n2 - 1)), 6) AS df FROM (SELECT l_linestatus, count(CASE WHEN l_returnflag = 'A' THEN "
   "l_extendedprice END) AS n1, count(CASE WHEN l_returnflag = 'N' THEN l_extendedprice END) AS n2, "
   "avg(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END) AS mean1, avg(CASE WHEN l_returnflag "
   "= 'N' THEN l_extendedprice END) AS mean2, var_samp(CASE WHEN l_returnflag = 'A' THEN "
   "l_extendedprice END) AS var1, var_samp(CASE WHEN l_returnflag = 'N' THEN l_extendedprice END) "
   "AS var2 FROM lineitem WHERE l_returnflag IN ('A', 'N') GROUP BY l_linestatus) s "
   "WHERE n1 > 1 AND n2 > 1")
def _ttest_by_segment(spark, sf):
    """Welch t-test of returnflag A against N within each line status (segments with two
    non-trivial samples)."""
    out = st.ttest(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice", "A", "N",
                   equal_var=False, by=["l_linestatus"])
    return round_all(out.where((F.col("n1") > 1) & (F.col("n2") > 1)).drop("p_value"))
