"""Distribution chart data (H1-H13): small tables a plotting front end would draw.

The work scales with the data and runs on Spark; results are bounded by the number of bins or
grid points. Bounds (min, max, quartiles) are one-row aggregates broadcast to the scan.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import nan_to_null, numeric_columns
from .profile import adjusted_kurt, adjusted_skew, quantiles
from .rank import _search, ranked_counts

BIN_METHODS = ("sturges", "sqrt", "rice", "fd", "auto")


def _values(df: DataFrame, column: str, by: Sequence[str] = (), finite: bool = False) -> DataFrame:
    x = nan_to_null(F.col(column).cast("double"), T.DoubleType())
    v = df.select(*by, x.alias("_x")).where(F.col("_x").isNotNull())
    return v.where(F.abs("_x") < F.lit(float("inf"))) if finite else v


# --- H1 ------------------------------------------------------------------------------------

def bin_counts(df: DataFrame, column: str, methods: Sequence[str] = BIN_METHODS) -> DataFrame:
    """H1: number of histogram bins by each rule. IQR 0 in `fd` falls back to sturges;
    `auto` = max(sturges, fd). Infinite values do not count. Raises on an unknown rule. Output: (method, bins)."""
    bad = [m for m in methods if m not in BIN_METHODS]
    if bad:
        raise ValueError(f"no bin rule called {bad}; the rules are {BIN_METHODS}")
    v = _values(df, column, finite=True)
    st = v.agg(F.count("_x").alias("n"), F.min("_x").alias("mn"), F.max("_x").alias("mx"))
    q = quantiles(v, "_x", [0.25, 0.75], names=["q25", "q75"])
    j = st.crossJoin(q)
    n = F.col("n").cast("double")
    sturges = F.ceil(F.log2(n) + 1).cast("long")
    iqr = F.col("q75") - F.col("q25")
    fd_raw = F.floor((F.col("mx") - F.col("mn")) / (2 * iqr * F.pow(n, F.lit(-1.0 / 3.0))))
    fd = F.when(iqr > 0, fd_raw.cast("long")).otherwise(sturges)
    rules = {"sturges": sturges, "sqrt": F.floor(F.sqrt(n)).cast("long"),
             "rice": F.floor(2 * F.pow(n, F.lit(1.0 / 3.0))).cast("long"), "fd": fd,
             "auto": F.greatest(sturges, fd)}
    rows = [F.struct(F.lit(m).alias("method"), F.when(F.col("n") > 0, rules[m]).alias("bins"))
            for m in methods]
    return j.select(F.inline(F.array(*rows)))


# --- H2 - H6 -------------------------------------------------------------------------------

def with_bin(df: DataFrame, x: str, lo: str, hi: str, bins: int, out: str,
             null_safe: bool = False) -> DataFrame:
    """Add the bin of column x for `bins` equal bins over [lo, hi], last bin closed (numpy's rule).

    Edges are lo + i*(hi-lo)/bins; the first guess is corrected against its own edges as numpy
    does, so a value on an edge lands in the same bin. Staged projections keep each step a
    small expression.
    """
    X, L, H = F.col(x), F.col(lo), F.col(hi)
    step = (H - L) / bins
    edge = lambda i: F.when(i == bins, H).otherwise(L + i * step)
    g = F.col(out + "_g")
    first = F.when(H == L, F.lit(0)).otherwise(
        F.least(F.floor((X - L) / step), F.lit(bins - 1)).cast("int"))
    if null_safe:
        # `least` skips NULL arguments, so a missing value is guarded explicitly. Callers
        # whose values are already non-null leave this off: a nullable bin would let the
        # optimizer push an inferred IS NOT NULL (with the whole bin expression) into the
        # join with the bounds row.
        first = F.when(X.isNull(), F.lit(None).cast("int")).otherwise(first)
    df = df.withColumn(out + "_g", first)
    df = df.withColumn(out + "_d", F.when((g > 0) & (X < edge(g)), g - 1).otherwise(g))
    d = F.col(out + "_d")
    # a constant column has no width: all of it is in the first bin, without corrections
    df = df.withColumn(out, F.when((H > L) & (d < bins - 1) & (X >= edge(d + 1)), d + 1).otherwise(d))
    return df.drop(out + "_g", out + "_d")


def histogram(df: DataFrame, column: str, bins: int = 10, by: Sequence[str] = (),
              shared_edges: bool = True, density: bool = False, center: bool = False) -> DataFrame:
    """H2 / H4 / H5 / H6: equal-width histogram over [min, max], zero-filled.

    by + shared_edges -> stacked histogram by hue (one set of edges); by without shared edges ->
    one set of edges per group (overlapping histograms). density -> count / (n * width).
    center -> the mean and the median (per group where edges are per group), which a chart draws
    as lines. Infinite values have no bin and are left out, as missing ones are. Output: (by..., bin, bin_left, bin_right, n[, density][, mean, median]).
    """
    by = list(by)
    v = _values(df, column, by, finite=True)
    edge_keys = [] if shared_edges else by
    bounds = v.groupBy(*edge_keys).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"),
                                       F.count("_x").alias("_n"))
    if edge_keys:
        j = v.join(bounds, edge_keys)
    else:
        j = v.crossJoin(F.broadcast(bounds))
    counts = (with_bin(j, "_x", "_lo", "_hi", bins, "bin")
              .groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n")))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    if by:
        groups = v.select(*by).distinct()
        frame = groups.crossJoin(F.broadcast(grid))
        frame = frame.join(bounds, edge_keys) if edge_keys else frame.crossJoin(F.broadcast(bounds))
    else:
        frame = grid.crossJoin(F.broadcast(bounds))
    step = (F.col("_hi") - F.col("_lo")) / bins
    out = frame.join(counts, [*by, "bin"], "left").select(
        *by, "bin", (F.col("_lo") + F.col("bin") * step).alias("bin_left"),
        F.when(F.col("bin") == bins - 1, F.col("_hi"))
        .otherwise(F.col("_lo") + (F.col("bin") + 1) * step).alias("bin_right"),
        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"), F.col("_n").alias("_total"))
    if density:
        out = out.withColumn("density", F.try_divide(
            F.col("n"), F.col("_total") * (F.col("bin_right") - F.col("bin_left"))))
    if center:
        mean = v.groupBy(*edge_keys).agg(F.avg("_x").alias("mean"))
        median = quantiles(v, "_x", [0.5], edge_keys, names=["median"])
        if edge_keys:
            out = out.join(mean, edge_keys).join(median, edge_keys)
        else:
            out = out.crossJoin(F.broadcast(mean)).crossJoin(F.broadcast(median))
    return out.drop("_total")


def histogram_edges(df: DataFrame, column: str, edges: Sequence[float]) -> DataFrame:
    """H3: histogram with given edges: half-open bins, last closed, values outside dropped.

    The bin is found by a balanced comparison tree over the literal edges (no join).
    Output: (bin, bin_left, bin_right, n), zero-filled.
    """
    e = [float(x) for x in edges]
    if len(e) < 2 or any(b <= a for a, b in zip(e, e[1:])):
        raise ValueError("edges must be increasing, at least two")
    v = _values(df, column)
    x = F.col("_x")
    idx = _search(x, [F.lit(b) for b in e]) - 1
    idx = F.when(x == e[-1], F.lit(len(e) - 2)).otherwise(idx)
    inside = (x >= e[0]) & (x <= e[-1])
    counts = v.where(inside).groupBy(idx.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    grid = spark.createDataFrame([(i, e[i], e[i + 1]) for i in range(len(e) - 1)],
                                 "bin int, bin_left double, bin_right double")
    return grid.join(counts, "bin", "left").select(
        "bin", "bin_left", "bin_right", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def arange_edges(start: float, stop: float, step: float) -> list[float]:
    """Edges like numpy.arange(start, stop, step)."""
    n = int(math.ceil((stop - start) / step))
    return [start + i * step for i in range(n)]


# --- H7 ------------------------------------------------------------------------------------

def kde_curve(df: DataFrame, column: str, points: int = 500, lo: float | None = None,
              hi: float | None = None, scale_counts_width: float | None = None) -> DataFrame:
    """H7: Gaussian KDE (Scott bandwidth h = sd * n^(-1/5)) on an even grid of `points`.

    Rows are collapsed to (value, weight). Each task adds its values' kernels up on the grid
    (a kernel is 0 in double precision beyond 39 bandwidths, so only the grid points within are
    touched), and the tasks' grids are summed: every value counts exactly, at any size.
    Output: (i, x, density); empty for fewer than two rows or a constant column.
    """
    v = _values(df, column)
    st = v.agg(F.count("_x").alias("_n"), F.stddev_samp("_x").alias("_sd"),
               F.min("_x").alias("_mn"), F.max("_x").alias("_mx")).first()
    n, sd = st["_n"], st["_sd"]
    if not n or sd is None or sd == 0:
        return df.sparkSession.createDataFrame([], "i int, x double, density double")
    g_lo = st["_mn"] if lo is None else lo
    g_hi = st["_mx"] if hi is None else hi
    h = sd * n ** (-0.2)
    step = (g_hi - g_lo) / (points - 1) if points > 1 else 0.0
    grid = [float(g_lo) + i * step for i in range(points - 1)] + [float(g_hi)]
    pts = v.groupBy(F.col("_x").alias("_v")).agg(F.count(F.lit(1)).alias("_w"))

    def kernels(frames):
        g, total = np.array(grid), np.zeros(points)
        for f in frames:
            x, w = f["_v"].to_numpy(float), f["_w"].to_numpy(float)
            order = np.argsort(x, kind="stable")
            x, w = x[order], w[order]
            for k in range(0, len(x), 2000):
                xs, ws = x[k:k + 2000], w[k:k + 2000]
                a, b = np.searchsorted(g, [xs[0] - 39 * h, xs[-1] + 39 * h])
                z = (g[a:b, None] - xs[None, :]) / h
                total[a:b] += np.exp(-0.5 * z * z) @ ws
        yield pd.DataFrame({"i": np.arange(points, dtype=np.int32), "x": g, "_s": total})

    dens = pts.mapInPandas(kernels, "i int, x double, _s double").groupBy("i", "x").agg(F.sum("_s").alias("_s"))
    out = dens.select("i", "x", (F.col("_s") / (n * h * math.sqrt(2 * math.pi))).alias("density"))
    if scale_counts_width:
        out = out.withColumn("density", F.col("density") * n * scale_counts_width)
    return out


# --- H8 ------------------------------------------------------------------------------------

def ecdf(df: DataFrame, column: str) -> DataFrame:
    """H8: step curve P(X <= x) at every distinct value, from the distributed ranking."""
    rc = ranked_counts(_values(df, column), "_x")
    return rc.select(F.col("_x").alias("value"), (F.col("start") + F.col("cnt")).alias("n_le"),
                     ((F.col("start") + F.col("cnt")) / F.col("n")).alias("ecdf"))


def ecdf_markers(df: DataFrame, column: str, threshold: float | None = None) -> DataFrame:
    """H8 lines: quartiles and the share of values <= threshold."""
    v = _values(df, column)
    q = quantiles(v, "_x", [0.25, 0.5, 0.75], names=["q1", "q2", "q3"])
    if threshold is None:
        return q
    share = v.agg(F.avg(F.when(F.col("_x") <= threshold, 1.0).otherwise(0.0)).alias("share_le"))
    return q.crossJoin(share).withColumn("threshold", F.lit(float(threshold)))


# --- H9 / H10 ------------------------------------------------------------------------------

def dispersion_summary(df: DataFrame, column: str, bins_method: str = "fd",
                       shapiro: bool = False) -> DataFrame:
    """H9 / H10 summary row: n, bins, mean, median, std, skew, kurt, sigma bands, 3 sigma
    outlier count and the large-sample normality heuristic; with `shapiro` (the H9 report) also
    the Shapiro-Wilk p-value. The rug is `rug_points`; curves are `histogram` / `kde_curve`."""
    v = _values(df, column)
    agg = v.agg(F.count("_x").alias("n"), F.avg("_x").alias("mean"),
                F.stddev_samp("_x").alias("std"), F.var_samp("_x").alias("_var"),
                F.skewness("_x").alias("_g1"), F.kurtosis("_x").alias("_g2"))
    n = F.col("n").cast("double")
    m = agg.select("n", "mean", "std", adjusted_skew(n, F.col("_g1"), F.col("_var")).alias("skew"),
                   adjusted_kurt(n, F.col("_g2"), F.col("_var")).alias("kurt"))
    med = quantiles(v, "_x", [0.5], names=["median"])
    b = bin_counts(df, column, [bins_method]).select(F.col("bins"))
    out = m.crossJoin(med).crossJoin(b)
    out3 = v.crossJoin(F.broadcast(m.select("mean", "std"))).agg(
        F.count_if(F.abs(F.col("_x") - F.col("mean")) > 3 * F.col("std")).alias("n_outliers_3s"))
    out = out.crossJoin(out3)
    extra = []
    if shapiro:
        from .stat_tests import shapiro_wilk
        out = out.crossJoin(F.broadcast(shapiro_wilk(v, "_x").select(F.col("p_value").alias("shapiro_p"))))
        extra = ["shapiro_p"]
    return out.select(
        "n", "bins", "mean", "median", "std", "skew", "kurt",
        *[(F.col("mean") - k * F.col("std")).alias(f"lower_{k}s") for k in (1, 2, 3)],
        *[(F.col("mean") + k * F.col("std")).alias(f"upper_{k}s") for k in (1, 2, 3)],
        "n_outliers_3s",
        ((F.abs("skew") < 0.5) & (F.abs("kurt") < 1)).alias("approx_normal"),
        (F.col("n") <= 5000).alias("small_sample"), *extra)


def rug_points(df: DataFrame, column: str) -> DataFrame:
    """H10 rug: every distinct value with its count."""
    return _values(df, column).groupBy(F.col("_x").alias("value")).agg(F.count(F.lit(1)).alias("n"))


# --- H11 - H13 -----------------------------------------------------------------------------

def scatter_bins(df: DataFrame, x: str, y: str, hue: str | None = None, bins: int = 50
                 ) -> DataFrame:
    """2-D binned counts (bin_x, bin_y[, hue], n) over each axis' [min, max]; any data size. Points with a missing
    or infinite side are left out."""
    xs = nan_to_null(F.col(x).cast("double"), T.DoubleType())
    ys = nan_to_null(F.col(y).cast("double"), T.DoubleType())
    keys = [hue] if hue else []
    v = df.select(*keys, xs.alias("_x"), ys.alias("_y")).where(
        (F.abs("_x") < F.lit(float("inf"))) & (F.abs("_y") < F.lit(float("inf"))))
    b = v.agg(F.min("_x").alias("_xl"), F.max("_x").alias("_xh"), F.min("_y").alias("_yl"),
              F.max("_y").alias("_yh"))
    j = with_bin(with_bin(v.crossJoin(F.broadcast(b)), "_x", "_xl", "_xh", bins, "bin_x"),
                 "_y", "_yl", "_yh", bins, "bin_y")
    return j.groupBy("bin_x", "bin_y", *keys).agg(F.count(F.lit(1)).alias("n"))


def scatter_points(df: DataFrame, x: str, y: str, hue: str | None = None) -> DataFrame:
    """H11 raw points: (x, y[, hue]) of every row that has both."""
    xs = nan_to_null(F.col(x).cast("double"), T.DoubleType())
    ys = nan_to_null(F.col(y).cast("double"), T.DoubleType())
    keys = [F.col(hue)] if hue else []
    return df.select(xs.alias("x"), ys.alias("y"), *keys).where("x is not null and y is not null")


def pair_bins(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 20,
              both_triangles: bool = False) -> DataFrame:
    """Binned scatter for every pair of numeric columns in one pass.

    Each row is exploded into one (x_col, y_col, bx, by) entry per pair (pairs with a missing
    or infinite side dropped), then counted; per-column bounds come from one broadcast aggregate.
    Output: (x_col, y_col, bin_x, bin_y, n).
    """
    cols = numeric_columns(df, columns)
    if len(cols) < 2:
        raise ValueError("need at least two numeric columns")
    vals = {c: nan_to_null(F.col(c).cast("double"), T.DoubleType()) for c in cols}
    vals = {c: F.when(F.abs(x) < F.lit(float("inf")), x) for c, x in vals.items()}
    b = df.agg(*[F.min(vals[c]).alias(f"lo{i}") for i, c in enumerate(cols)],
               *[F.max(vals[c]).alias(f"hi{i}") for i, c in enumerate(cols)])
    j = df.select(*[vals[c].alias(f"v{i}") for i, c in enumerate(cols)]).crossJoin(F.broadcast(b))
    for k in range(len(cols)):  # one bin per column, shared by every pair it takes part in
        j = with_bin(j, f"v{k}", f"lo{k}", f"hi{k}", bins, f"b{k}", null_safe=True)
    entries = []
    for i, cy in enumerate(cols):
        for k, cx in enumerate(cols):
            if (i > k) or (both_triangles and i != k):
                entries.append(F.struct(F.lit(cx).alias("x_col"), F.lit(cy).alias("y_col"),
                                        F.col(f"b{k}").alias("bin_x"),
                                        F.col(f"b{i}").alias("bin_y")))
    # one entry per pair; a missing side gives a NULL bin, dropped after the unpivot
    ex = j.select(F.inline(F.array(*entries))).where(
        F.col("bin_x").isNotNull() & F.col("bin_y").isNotNull())
    return ex.groupBy("x_col", "y_col", "bin_x", "bin_y").agg(F.count(F.lit(1)).alias("n"))


def pair_correlation(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """R for every pair (lower triangle) on pair-complete rows."""
    from .profile import correlation_pairs
    return correlation_pairs(df, columns).select("x", "y", "r")
