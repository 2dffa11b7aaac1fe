"""Hypothesis tests (T1-T12) as Spark aggregates.

Statistics are aggregates over any number of rows, optionally per segment. P-values of t and F
need the incomplete beta function; they are computed by an Arrow UDF over the aggregated rows
(one row per segment), so the driver never loops. Normal-based p-values (Shapiro-Wilk,
D'Agostino) stay Catalyst expressions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import nan_to_null, two_groups
from ..functions import special as sp
from ..functions.special import log_norm_cdf, norm_ppf, norm_tail
from .rank import exact_quantiles, ranked_counts

# Conclusion texts and table labels of the normality summary.
REJECT = "Reject H₀ (Not Normal)"
KEEP = "Fail to Reject H₀ (Possibly Normal)"
TEST_ROWS = [("Shapiro-Wilk", "n ≤ 5000", "General deviations"),
             ("D’Agostino-Pearson", "n > 500", "Skewness & Kurtosis"),
             ("Anderson-Darling", "All sample sizes", "Tail behavior")]


@F.pandas_udf(T.DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p-value of Student's t, on aggregated rows."""
    return pd.Series([sp.t_sf2(a, b) if pd.notna(a) and pd.notna(b) else float("nan")
                      for a, b in zip(t, df)])


@F.pandas_udf(T.DoubleType())
def f_pvalue(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    """Upper-tail p-value of the F distribution, on aggregated rows."""
    return pd.Series([sp.f_sf(a, b, c) if pd.notna(a) else float("nan")
                      for a, b, c in zip(f, d1, d2)])


def _val(df: DataFrame, value: str) -> Column:
    return nan_to_null(F.col(value).cast("double"), T.DoubleType())


# --- T1 ------------------------------------------------------------------------------------

def levene(df: DataFrame, group: str, value: str, by: Sequence[str] = (),
           center: str = "median") -> DataFrame:
    """Levene / Brown-Forsythe test for equal variances across any k >= 2 groups.

    Per-group centre (exact distributed median, or mean) joined back on the group key,
    z = |x - centre|, then one grouped aggregate. Output: (by..., k, n, statistic, df1, df2,
    p_value).
    """
    by = list(by)
    keys = [*by, group]
    v = df.select(*keys, _val(df, value).alias("_x")).where(F.col("_x").isNotNull())
    if center == "median":
        c = exact_quantiles(v, "_x", [0.5], keys, ["_c"])
    elif center == "mean":
        c = v.groupBy(*keys).agg(F.avg("_x").alias("_c"))
    else:
        raise ValueError("center must be 'median' or 'mean'")
    z = v.join(c, keys).select(*keys, F.abs(F.col("_x") - F.col("_c")).alias("_z"))
    g = z.groupBy(*keys).agg(F.count("_z").alias("_n"), F.avg("_z").alias("_zb"),
                             (F.var_pop("_z") * F.count("_z")).alias("_ss"))
    # pooled mean of z per segment: a one-row table (broadcast) or a per-segment join
    tot = g.groupBy(*by).agg(F.sum("_n").alias("_ntot"),
                             (F.sum(F.col("_n") * F.col("_zb")) / F.sum("_n")).alias("_zbar"))
    g = g.join(tot, by) if by else g.crossJoin(F.broadcast(tot))
    s = g.groupBy(*by).agg(
        F.count(F.lit(1)).alias("k"), F.first("_ntot").alias("n"),
        F.sum(F.col("_n") * (F.col("_zb") - F.col("_zbar")) ** 2).alias("_between"),
        F.sum("_ss").alias("_within"))
    stat = F.try_divide(F.col("n") - F.col("k"), F.col("k") - 1) * F.try_divide(
        F.col("_between"), F.col("_within"))
    out = s.select(*by, "k", F.col("n").cast("long").alias("n"), stat.alias("statistic"),
                   (F.col("k") - 1).cast("double").alias("df1"),
                   (F.col("n") - F.col("k")).cast("double").alias("df2"))
    return out.withColumn("p_value", f_pvalue("statistic", "df1", "df2"))


# --- T2 / T3 / T4 --------------------------------------------------------------------------

def _two_sample_stats(df: DataFrame, group: str, value: str, a, b, by: Sequence[str]):
    v = two_groups(df, group, a, b).select(*by, group, _val(df, value).alias("_x"))
    sel = lambda g, e: F.when(F.col(group) == g, e)
    x = F.col("_x")
    return v.groupBy(*by).agg(
        F.count(sel(a, x)).alias("n1"), F.count(sel(b, x)).alias("n2"),
        F.avg(sel(a, x)).alias("mean1"), F.avg(sel(b, x)).alias("mean2"),
        F.var_samp(sel(a, x)).alias("var1"), F.var_samp(sel(b, x)).alias("var2"))


def ttest(df: DataFrame, group: str, value: str, a, b, equal_var: bool = True,
          by: Sequence[str] = ()) -> DataFrame:
    """T2 (pooled) / T3 (Welch) two-sample t-test of group a against group b.

    Output: (by..., n1, n2, mean1, mean2, var1, var2, t, df, p_value).
    """
    by = list(by)
    s = _two_sample_stats(df, group, value, a, b, by)
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    v1, v2 = F.col("var1"), F.col("var2")
    diff = F.col("mean1") - F.col("mean2")
    if equal_var:
        dof = n1 + n2 - 2
        sp2 = ((n1 - 1) * v1 + (n2 - 1) * v2) / dof
        t = F.try_divide(diff, F.sqrt(sp2 * (1 / n1 + 1 / n2)))
    else:
        se2 = v1 / n1 + v2 / n2
        t = F.try_divide(diff, F.sqrt(se2))
        dof = F.try_divide(se2 * se2, (v1 / n1) ** 2 / (n1 - 1) + (v2 / n2) ** 2 / (n2 - 1))
    out = s.select(*by, "n1", "n2", "mean1", "mean2", "var1", "var2", t.alias("t"),
                   dof.alias("df"))
    return out.withColumn("p_value", t_pvalue("t", "df"))


def ttest_decision(df: DataFrame, group: str, value: str, a, b, alpha: float = 0.05,
                   by: Sequence[str] = ()) -> DataFrame:
    """T4: Levene first; p < alpha -> Welch, else pooled; then reject or keep H0."""
    by = list(by)
    two = two_groups(df, group, a, b)
    lev = levene(two, group, value, by).select(
        *by, F.col("statistic").alias("levene_stat"), F.col("p_value").alias("levene_p"))
    pooled = ttest(df, group, value, a, b, True, by).select(
        *by, F.col("t").alias("t_pooled"), F.col("df").alias("df_pooled"),
        F.col("p_value").alias("p_pooled"))
    welch = ttest(df, group, value, a, b, False, by).select(
        *by, F.col("t").alias("t_welch"), F.col("df").alias("df_welch"),
        F.col("p_value").alias("p_welch"))
    j = (lev.crossJoin(pooled).crossJoin(welch) if not by
         else lev.join(pooled, by).join(welch, by))
    eq = F.col("levene_p") >= alpha
    p = F.when(eq, F.col("p_pooled")).otherwise(F.col("p_welch"))
    return j.select(
        *by, "levene_stat", "levene_p", eq.alias("equal_var"),
        F.when(eq, "pooled").otherwise("welch").alias("test"),
        F.when(eq, F.col("t_pooled")).otherwise(F.col("t_welch")).alias("t"),
        F.when(eq, F.col("df_pooled")).otherwise(F.col("df_welch")).alias("df"),
        p.alias("p_value"), F.lit(alpha).alias("alpha"), (p < alpha).alias("reject_h0"))


# --- T5 / T6 / T10 / T12 -------------------------------------------------------------------

RUN = 10_000  # positions that one row may expand to


def _positions(df: DataFrame, value: str) -> DataFrame:
    """Every non-null value with its 1-based position i in sorted order and n.

    Built from the collapsed (value, count) ranking: a run of equal values expands to its
    consecutive positions. Runs are first cut into stretches of at most `RUN` positions, which are
    dealt out anew, so a value that most rows hold expands in many tasks.
    """
    v = df.select(_val(df, value).alias("_x")).where(F.col("_x").isNotNull())
    rc = ranked_counts(v, "_x")
    cut = rc.select(F.col("_x").alias("sample"), "n", (F.col("start") + F.col("cnt")).alias("_end"), F.explode(
        F.sequence(F.col("start") + 1, F.col("start") + F.col("cnt"), F.lit(RUN).cast("long"))).alias("_from"))
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut.repartition(width, "_from").select("sample", "n", F.explode(F.sequence(
        F.col("_from"), F.least(F.col("_end"), F.col("_from") + (RUN - 1)))).alias("i"))


def filliben(i: Column, n: Column) -> Column:
    """Filliben's order-statistic medians used for probability plots."""
    last = F.pow(F.lit(0.5), 1.0 / n)
    return (F.when(i == n, last).when(i == 1, 1.0 - last)
            .otherwise((i - 0.3175) / (n + 0.365)))


def ppf(dist: str, p: Column, params: dict | None = None) -> Column:
    """Inverse CDF of a family at probability p (closed forms; others via an Arrow UDF)."""
    prm = dict(params or {})
    loc, scale = float(prm.get("loc", 0.0)), float(prm.get("scale", 1.0))
    if dist == "norm":
        return loc + scale * norm_ppf(p)
    if dist == "expon":
        return loc - scale * F.log1p(-p)
    if dist == "uniform":
        return loc + scale * p
    if dist == "weibull_min":
        c = float(prm["c"])
        return loc + scale * F.pow(-F.log1p(-p), F.lit(1.0 / c))
    if dist == "lognorm":
        s = float(prm["s"])
        return loc + scale * F.exp(s * norm_ppf(p))
    if dist in ("gamma", "chi2", "beta", "t"):
        return loc + scale * _ppf_udf(dist, prm)(p)
    raise ValueError(f"unsupported distribution {dist}")


def _ppf_udf(dist: str, prm: dict):
    """Arrow UDF inverting an incomplete-function CDF (gamma, chi2, beta, t), a batch at a time:
    bisection over all probabilities of the batch at once."""
    if dist == "gamma":
        a = float(prm["a"])
        cdf, bounds = (lambda x: sp.gammainc_lower_array(a, x)), (0.0, None)
    elif dist == "chi2":
        k = float(prm["df"])
        cdf, bounds = (lambda x: sp.gammainc_lower_array(k / 2.0, x / 2.0)), (0.0, None)
    elif dist == "beta":
        a, b = float(prm["a"]), float(prm["b"])
        cdf, bounds = (lambda x: sp.betainc_array(a, b, x)), (0.0, 1.0)
    else:
        nu = float(prm["df"])

        def cdf(x):
            tail = 0.5 * sp.betainc_array(nu / 2.0, 0.5, nu / (nu + x * x))
            return np.where(x > 0, 1.0 - tail, tail)
        bounds = (None, None)

    def invert(p: np.ndarray) -> np.ndarray:
        lo = np.full(p.shape, -1.0 if bounds[0] is None else bounds[0])
        hi = np.full(p.shape, 1.0 if bounds[1] is None else bounds[1])
        while bounds[0] is None and (out := cdf(lo) > p).any():
            lo[out] *= 2.0
        while bounds[1] is None and (out := cdf(hi) < p).any():
            hi[out] *= 2.0
        for _ in range(200):
            mid = 0.5 * (lo + hi)
            below = cdf(mid) < p
            lo, hi = np.where(below, mid, lo), np.where(below, hi, mid)
            if (hi - lo <= 1e-13 * np.maximum(1.0, np.abs(mid))).all():
                break
        return 0.5 * (lo + hi)

    @F.pandas_udf(T.DoubleType())
    def _inv(ps: pd.Series) -> pd.Series:
        p = ps.to_numpy(float)
        out, good = np.full(len(p), np.nan), (p > 0) & (p < 1)
        if good.any():
            out[good] = invert(p[good])
        return pd.Series(out)

    return _inv


def qq_positions(df: DataFrame, value: str) -> DataFrame:
    """T5 positions: (i, p, sample) with Filliben plotting positions."""
    pos = _positions(df, value)
    n = F.col("n").cast("double")
    return pos.select("i", filliben(F.col("i").cast("double"), n).alias("p"), "sample")


def qq_points(df: DataFrame, value: str, dist: str = "norm", params: dict | None = None
              ) -> DataFrame:
    """(i, theoretical, sample, is_outlier); outliers by 1.5 IQR of the sample."""
    pos = qq_positions(df, value)
    v = df.select(_val(df, value).alias("_x"))
    q = exact_quantiles(v.where(F.col("_x").isNotNull()), "_x", [0.25, 0.75], (), ["_q1", "_q3"])
    iqr = F.col("_q3") - F.col("_q1")
    j = pos.crossJoin(F.broadcast(q))
    out = ((F.col("sample") < F.col("_q1") - 1.5 * iqr) | (F.col("sample") > F.col("_q3") + 1.5 * iqr))
    return j.select("i", ppf(dist, F.col("p"), params).alias("theoretical"), "sample",
                    out.alias("is_outlier"))


def qq_fit(points: DataFrame) -> DataFrame:
    """Least-squares line of sample on theoretical quantiles, and r (NULL when constant)."""
    x, y = F.col("theoretical"), F.col("sample")
    return points.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                      F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))
                      .alias("r"))


# --- T7 ------------------------------------------------------------------------------------

def _poly(coefs, x: Column) -> Column:
    acc = F.lit(0.0)
    for c in reversed(coefs):
        acc = acc * x + F.lit(c)
    return acc


# Royston (1995) AS R94 polynomial coefficients for the Shapiro-Wilk test.
_SW_C1 = [0.0, 0.221157, -0.147981, -2.07119, 4.434685, -2.706056]
_SW_C2 = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
_SW_SMALL_GAMMA = [-2.273, 0.459]
_SW_SMALL_MEAN = [0.544, -0.39978, 0.025054, -6.714e-4]
_SW_SMALL_SD = [1.3822, -0.77857, 0.062767, -0.0020322]
_SW_LARGE_MEAN = [-1.5861, -0.31082, -0.083751, 0.0038915]
_SW_LARGE_SD = [-0.4803, -0.082676, 0.0030302]


def shapiro_wilk(df: DataFrame, value: str, calibrated_n: int = 5000) -> DataFrame:
    """Shapiro-Wilk W and p (Royston 1995) over all rows, at any n.

    The approximation of p is calibrated up to n = 5,000; `calibrated` says whether n is within.
    Positions come from the distributed ranking; weights, W and p are column expressions and
    aggregates. Output: one row (n, statistic, p_value, calibrated); statistic and p are NULL for
    n < 3 and for a constant column.
    """
    v = df.select(_val(df, value).alias("_x")).where(F.col("_x").isNotNull())
    n = v.count()
    if n < 3:
        return df.sparkSession.range(1).select(
            F.lit(n).cast("long").alias("n"), F.lit(None).cast("double").alias("statistic"),
            F.lit(None).cast("double").alias("p_value"), F.lit(False).alias("calibrated"))
    df, value = v, "_x"
    pos = _positions(df, value)
    nn = float(n)
    m = norm_ppf((F.col("i") - 0.375) / (nn + 0.25))
    pos = pos.withColumn("_m", m)
    tot = pos.agg(F.sum(F.col("_m") * F.col("_m")).alias("_mm"),
                  F.max(F.when(F.col("i") == n, F.col("_m"))).alias("_mn"),
                  F.max(F.when(F.col("i") == n - 1, F.col("_m"))).alias("_mn1"),
                  F.avg("sample").alias("_mean"))
    j = pos.crossJoin(F.broadcast(tot))
    u = 1.0 / math.sqrt(nn)
    an = F.col("_mn") / F.sqrt("_mm") + _poly(_SW_C1, F.lit(u))
    an1 = F.col("_mn1") / F.sqrt("_mm") + _poly(_SW_C2, F.lit(u))
    if n > 5:
        phi = ((F.col("_mm") - 2 * F.col("_mn") ** 2 - 2 * F.col("_mn1") ** 2)
               / (1 - 2 * an ** 2 - 2 * an1 ** 2))
        inner = F.col("_m") / F.sqrt(phi)
        i = F.col("i")
        a = (F.when(i == n, an).when(i == 1, -an).when(i == n - 1, an1).when(i == 2, -an1)
             .otherwise(inner))
    elif n > 3:
        phi = (F.col("_mm") - 2 * F.col("_mn") ** 2) / (1 - 2 * an ** 2)
        i = F.col("i")
        a = F.when(i == n, an).when(i == 1, -an).otherwise(F.col("_m") / F.sqrt(phi))
    else:
        i = F.col("i")
        a = F.when(i == 3, math.sqrt(0.5)).when(i == 1, -math.sqrt(0.5)).otherwise(0.0)
    s = j.agg(F.sum(a * F.col("sample")).alias("_ax"),
              F.sum((F.col("sample") - F.col("_mean")) ** 2).alias("_ss"))
    # `least` would skip a NULL W (constant column)
    w = F.try_divide(F.col("_ax") ** 2, F.col("_ss"))
    w = F.when(w > 1, F.lit(1.0)).otherwise(w)
    s = s.select(w.alias("statistic"))
    y = F.log1p(-F.col("statistic"))
    if n == 3:
        p = F.greatest(F.lit(0.0), 6.0 / math.pi * (F.asin(F.sqrt("statistic"))
                                                    - math.asin(math.sqrt(0.75))))
    elif n <= 11:
        gamma = _SW_SMALL_GAMMA[0] + _SW_SMALL_GAMMA[1] * nn
        mu = sum(c * nn ** k for k, c in enumerate(_SW_SMALL_MEAN))
        sd = math.exp(sum(c * nn ** k for k, c in enumerate(_SW_SMALL_SD)))
        yy = -F.log(F.lit(gamma) - y)
        p = F.when(y >= gamma, F.lit(1e-99)).otherwise(_upper((yy - mu) / sd))
    else:
        ln = math.log(nn)
        mu = sum(c * ln ** k for k, c in enumerate(_SW_LARGE_MEAN))
        sd = math.exp(sum(c * ln ** k for k, c in enumerate(_SW_LARGE_SD)))
        p = _upper((y - mu) / sd)
    return s.select(F.lit(n).cast("long").alias("n"), "statistic",
                    F.when(F.col("statistic").isNotNull(), p).alias("p_value"),
                    F.lit(n <= calibrated_n).alias("calibrated"))


def _upper(z: Column) -> Column:
    """P(Z > z)."""
    return F.when(z > 0, norm_tail(z)).otherwise(1.0 - norm_tail(z))


# --- T8 / T9 -------------------------------------------------------------------------------

def dagostino_pearson(df: DataFrame, value: str) -> DataFrame:
    """D'Agostino-Pearson K^2 from population skewness and kurtosis; p = exp(-K^2/2).

    Output: one row (n, skew_z, kurt_z, statistic, p_value), NULL but for n below 8 values, for which
    the transformation of the skewness is not defined, and for a constant column.
    """
    v = df.select(_val(df, value).alias("_x")).where(F.col("_x").isNotNull())
    s = v.agg(F.count("_x").cast("double").alias("n"), F.skewness("_x").alias("g1"),
              (F.kurtosis("_x") + 3).alias("b2"))
    n, g1, b2 = F.when(F.col("n") >= 8, F.col("n")), F.col("g1"), F.col("b2")
    y = g1 * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (beta2 - 1)) - 1
    delta = 1 / F.sqrt(0.5 * F.log(w2))
    alpha = F.sqrt(2 / (w2 - 1))
    ya = y / alpha
    z1 = delta * F.log(ya + F.sqrt(ya * ya + 1))
    e = 3 * (n - 1) / (n + 1)
    var = 24 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))
    x = (b2 - e) / F.sqrt(var)
    sb = (6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9))
          * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))))
    a = 6 + 8 / sb * (2 / sb + F.sqrt(1 + 4 / (sb * sb)))
    term = (1 - 2 / a) / (1 + x * F.sqrt(2 / (a - 4)))
    cube = F.signum(term) * F.pow(F.abs(term), F.lit(1.0 / 3.0))
    z2 = (1 - 2 / (9 * a) - cube) / F.sqrt(2 / (9 * a))
    k2 = z1 * z1 + z2 * z2
    return s.select(F.col("n").cast("long").alias("n"), z1.alias("skew_z"), z2.alias("kurt_z"),
                    k2.alias("statistic"), F.exp(-k2 / 2).alias("p_value"))


def anderson_darling(df: DataFrame, value: str) -> DataFrame:
    """Anderson-Darling A^2 against the normal with estimated mean and sd (ddof 1), and
    the 5 % critical value 0.787 / (1 + 4/n - 25/n^2) rounded to 3 decimals.

    Works on the collapsed (value, count) ranking: for a run of equal values at positions
    s+1..s+c the weights (2i-1) and (2(n-i)+1) are summed in closed form, so n is unbounded.
    Output: one row (n, statistic, critical_5pct, reject_h0). The statistic is NULL for a constant column, the
    critical value for n below 4, where the factor is negative, and the decision where either is.
    """
    v = df.select(_val(df, value).alias("_x")).where(F.col("_x").isNotNull())
    st = v.agg(F.avg("_x").alias("_mu"), F.stddev_samp("_x").alias("_sd"))
    rc = ranked_counts(v, "_x").crossJoin(F.broadcast(st))
    s, c, n = F.col("start"), F.col("cnt"), F.col("n")
    z = F.try_divide(F.col("_x") - F.col("_mu"), F.col("_sd"))
    # products of positions in double: they pass the range of a long near 3e9 rows
    s, c, n = s.cast("double"), c.cast("double"), n.cast("double")
    w_lo = c * (2 * s + c)
    w_hi = c * (2 * n + 1) - c * (2 * s + c + 1)
    term = w_lo * log_norm_cdf(z) + w_hi * log_norm_cdf(-z)
    agg = rc.agg(F.sum(term).alias("_t"), F.max("n").cast("double").alias("_n"))
    nn = F.col("_n")
    a2 = -nn - F.try_divide(F.col("_t"), nn)
    factor = 1 + F.try_divide(F.lit(4.0), nn) - F.try_divide(F.lit(25.0), nn * nn)
    crit = F.round(F.try_divide(F.lit(0.787), F.when(factor > 0, factor)), 3)
    return agg.select(nn.cast("long").alias("n"), a2.alias("statistic"),
                      crit.alias("critical_5pct"), (a2 > crit).alias("reject_h0"))


# --- T11 -----------------------------------------------------------------------------------

def normality_summary(df: DataFrame, value: str, alpha: float = 0.05) -> DataFrame:
    """Shapiro-Wilk, D'Agostino-Pearson and Anderson-Darling rows, always all three.

    Output: (test, statistic, p_value, critical_value, conclusion, recommended_for,
    sensitive_to). A statistic that cannot be had (constant column, too few rows) is NULL, and so
    is its conclusion.
    """
    spark = df.sparkSession
    verdict = lambda rejects: F.when(rejects, REJECT).when(~rejects, KEEP).alias("conclusion")
    parts = [shapiro_wilk(df, value).select(
        F.lit(TEST_ROWS[0][0]).alias("test"), "statistic", "p_value",
        F.lit(None).cast("double").alias("critical_value"), verdict(F.col("p_value") < alpha))]
    parts.append(dagostino_pearson(df, value).select(
        F.lit(TEST_ROWS[1][0]).alias("test"), "statistic", "p_value",
        F.lit(None).cast("double").alias("critical_value"),
        verdict(F.col("p_value") < alpha)))
    parts.append(anderson_darling(df, value).select(
        F.lit(TEST_ROWS[2][0]).alias("test"), "statistic",
        F.lit(None).cast("double").alias("p_value"), F.col("critical_5pct").alias("critical_value"),
        verdict(F.col("reject_h0"))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    labels = spark.createDataFrame([(t, r, s) for t, r, s in TEST_ROWS],
                                   "test string, recommended_for string, sensitive_to string")
    return out.join(F.broadcast(labels), "test")
