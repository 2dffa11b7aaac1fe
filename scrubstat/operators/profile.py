"""Aggregation and profiling.

Multi-column reports unpivot the columns into one long (column_name, value) table first, so
one aggregation (or one distributed ranking for quantiles) serves every column at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import dtype, is_numeric, is_string, nan_to_null, numeric_columns
from ..functions.special import norm_ppf
from .rank import exact_quantiles, ranked_counts

# --- shared helpers ------------------------------------------------------------------------


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (),
                as_type: str = "double") -> DataFrame:
    """Unpivot columns into (by..., column_name, value), NaN -> NULL, NULL values dropped."""
    exprs = [F.struct(F.lit(c).alias("column_name"),
                      nan_to_null(F.col(c).cast(as_type), T.DoubleType()
                                  if as_type == "double" else T.StringType()).alias("value"))
             for c in columns]
    return (df.select(*by, F.inline(F.array(*exprs)))
            .where(F.col("value").isNotNull()))


def stack_series(parts: Iterable[tuple[str, DataFrame, str]]) -> DataFrame:
    """Labelled series -> one long table (group, value); the reference's list of series."""
    out = None
    for label, df, col in parts:
        s = df.select(F.lit(label).alias("group"),
                      nan_to_null(F.col(col).cast("double"), T.DoubleType()).alias("value"))
        out = s if out is None else out.unionByName(s)
    if out is None:
        raise ValueError("no series given")
    return out


def adjusted_skew(n: Column, g1: Column, var: Column) -> Column:
    """Sample skewness G1 (pandas / DuckDB definition). NULL for n < 3, 0 for constant."""
    adj = g1 * F.sqrt(n * (n - 1)) / (n - 2)
    return F.when(n < 3, F.lit(None).cast("double")).when(var == 0, F.lit(0.0)).otherwise(adj)


def adjusted_kurt(n: Column, g2: Column, var: Column) -> Column:
    """Sample excess kurtosis G2. NULL for n < 4, 0 for constant."""
    adj = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)
    return F.when(n < 4, F.lit(None).cast("double")).when(var == 0, F.lit(0.0)).otherwise(adj)


def _moment_aggs(v: Column) -> list[Column]:
    return [F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
            F.var_samp(v).alias("_var"), F.skewness(v).alias("_g1"),
            F.kurtosis(v).alias("_g2"), F.min(v).alias("min"), F.max(v).alias("max")]


def _finish_moments(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    n = F.col("n").cast("double")
    return df.select(*keys, "n", "mean", "std", "min", "max",
                     adjusted_skew(n, F.col("_g1"), F.col("_var")).alias("skew"),
                     adjusted_kurt(n, F.col("_g2"), F.col("_var")).alias("kurt"))


def moments(df: DataFrame, columns: Sequence[str] | None = None,
            by: Sequence[str] = ()) -> DataFrame:
    """A3: n, mean, std (n-1), min, max, adjusted skew and kurtosis per column (per group).

    Output: (by..., column_name, n, mean, std, min, max, skew, kurt). Every column in `columns`
    appears, also when it holds no value.
    """
    cols = numeric_columns(df, columns)
    lv = long_values(df, cols, by)
    agg = lv.groupBy(*by, "column_name").agg(*_moment_aggs(F.col("value")))
    out = _finish_moments(agg, [*by, "column_name"])
    if not by:
        names = df.sparkSession.createDataFrame([(c,) for c in cols], "column_name string")
        out = F.broadcast(names).join(out, "column_name", "left").select(
            "column_name", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"),
            "mean", "std", "min", "max", "skew", "kurt")
    return out


# --- A1 / A2 / A5 --------------------------------------------------------------------------

def quantiles(df: DataFrame, column: str, probs: Sequence[float], by: Sequence[str] = (),
              names: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """A5: exact quantiles with linear interpolation, distributed (see rank.exact_quantiles); with `exact=False` values
    within a bounded rank error, from one sketch a group (see `sketches`; a group without values has no row)."""
    if not exact:
        from .sketches import quantile_sketches, sketch_quantiles
        return sketch_quantiles(quantile_sketches(df, [column], by), probs, names).drop("column_name", "n")
    tmp = df.select(*by, nan_to_null(F.col(column).cast("double"), T.DoubleType()).alias("_x"))
    out = exact_quantiles(tmp, "_x", probs, by, names)
    return out


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None,
                     by: Sequence[str] = ()) -> DataFrame:
    """A2: count, mean, std, min, 25 %, 50 %, 75 %, max per numeric column (per group)."""
    cols = numeric_columns(df, columns)
    lv = long_values(df, cols, by)
    keys = [*by, "column_name"]
    base = lv.groupBy(*keys).agg(F.count("value").alias("count"), F.avg("value").alias("mean"),
                                 F.stddev_samp("value").alias("std"),
                                 F.min("value").alias("min"), F.max("value").alias("max"))
    qs = exact_quantiles(lv, "value", [0.25, 0.5, 0.75], keys, ["q25", "q50", "q75"])
    return base.join(qs, keys, "left").select(*keys, "count", "mean", "std", "min", "q25",
                                              "q50", "q75", "max")


def describe_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A1 text part: count, unique, top (most frequent; ties -> smallest value), freq."""
    cols = [c for c in (columns or df.columns) if is_string(dtype(df, c))]
    lv = long_values(df, cols, (), as_type="string")
    counts = lv.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("_c"))
    return counts.groupBy("column_name").agg(
        F.sum("_c").cast("long").alias("count"), F.count(F.lit(1)).cast("long").alias("unique"),
        F.min_by("value", F.struct((-F.col("_c")).alias("a"), F.col("value").alias("b")))
        .alias("top"), F.max("_c").cast("long").alias("freq"))


def describe_all(df: DataFrame) -> DataFrame:
    """A1: `describe(include='all')` in long form, one row per column, columns without values included
    (count 0). Dates and timestamps are described as numbers, in seconds since 1970 UTC; booleans as text."""
    kinds = {c: dtype(df, c) for c in df.columns}
    when = [c for c, t in kinds.items() if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType))]
    num = [c for c, t in kinds.items() if is_numeric(t)] + when
    txt = [c for c, t in kinds.items() if is_string(t) or isinstance(t, T.BooleanType)]
    flat = df.select(*[F.col(c).cast("timestamp").cast("double").alias(c) if c in when else F.col(c) for c in num],
                     *[F.col(c).cast("string").alias(c) for c in txt])
    stats = ["mean", "std", "min", "q25", "q50", "q75", "max"]
    parts = []
    if num:
        parts.append(describe_numeric(flat, num).select(
            "column_name", F.col("count").cast("long").alias("count"),
            F.lit(None).cast("long").alias("unique"), F.lit(None).cast("string").alias("top"),
            F.lit(None).cast("long").alias("freq"), *stats))
    if txt:
        parts.append(describe_text(flat, txt).select(
            "column_name", "count", "unique", "top", "freq",
            *[F.lit(None).cast("double").alias(c) for c in stats]))
    if not parts:
        raise ValueError("no column that can be described")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    every = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in num + txt])).alias("column_name"))
    return every.join(out, "column_name", "left").select(
        "column_name", F.coalesce("count", F.lit(0)).cast("long").alias("count"), "unique", "top", "freq", *stats)


# --- A4 ------------------------------------------------------------------------------------

# Report texts of the central-tendency evaluation.
CV_TEXT = ["Very low variability: highly reliable mean.",
           "Moderate variability: reasonably reliable mean.",
           "Considerable variability: mean may be biased.",
           "High variability: mean may be misleading."]
SKEW_TEXT = ["Low skewness: distribution is nearly symmetric.",
             "Moderate skewness: some asymmetry present.",
             "High skewness: strong asymmetry detected.",
             "Very high skewness: distribution is heavily distorted."]
CENTRAL_TEXT = [("median", "due to high variability or strong skewness"),
                ("median (with caution)", "due to moderate variability or skewness"),
                ("mean", "distribution is stable and symmetric")]
TRANSFORM_TEXT = {
    "right": "To reduce right skew:",
    "right_pos": " [log(x), sqrt(x), reciprocal(x), Box-Cox].",
    "right_zero": " [sqrt(x), reciprocal(x), Yeo-Johnson (handles zeros)].",
    "right_neg": " [Yeo-Johnson, quantile or rank-based transforms (handles negatives)].",
    "left": "To reduce left skew:",
    "left_nonneg": " [square(x), exp(x), reflect+log(x), Yeo-Johnson].",
    "left_neg": " [Yeo-Johnson or rank-based transforms (handles negatives)].",
    "extreme": " For extreme skew or heavy-tailed distributions, consider quantile or normal "
               "score transforms instead of classical ones.",
}


def central_trend(df: DataFrame, columns: Sequence[str] | None = None,
                  by: Sequence[str] = ()) -> DataFrame:
    """A4: CV, skew bands, recommended central measure and transform suggestion per column.

    mean 0 -> CV NULL and central 'undefined'; no value -> central 'empty'.
    """
    cols = numeric_columns(df, columns)
    lv = long_values(df, cols, by)
    keys = [*by, "column_name"]
    agg = lv.groupBy(*keys).agg(*_moment_aggs(F.col("value")))
    m = _finish_moments(agg, keys)
    med = exact_quantiles(lv, "value", [0.5], keys, ["median"])
    m = m.join(med, keys, "left")
    cv = F.try_divide(F.col("std"), F.col("mean")) * 100.0
    m = m.withColumn("cv", F.when(F.col("mean") != 0, cv))
    a = F.abs(F.col("skew"))
    level = (F.when(a <= 0.3, "low").when(a <= 0.6, "moderate").when(a <= 1.0, "high")
             .otherwise("very_high"))
    m = m.withColumn("skew_level", level)
    c = F.col("cv")
    cv_msg = (F.when(c <= 10, CV_TEXT[0]).when(c <= 20, CV_TEXT[1]).when(c <= 30, CV_TEXT[2])
              .otherwise(CV_TEXT[3]))
    lv_ = F.col("skew_level")
    sk_msg = (F.when(lv_ == "low", SKEW_TEXT[0]).when(lv_ == "moderate", SKEW_TEXT[1])
              .when(lv_ == "high", SKEW_TEXT[2]).otherwise(SKEW_TEXT[3]))
    strong = lv_.isin("high", "very_high")
    pick = (F.when((c > 30) | strong, 0).when((c > 20) | (lv_ == "moderate"), 1).otherwise(2))
    central = F.element_at(F.array(*[F.lit(t[0]) for t in CENTRAL_TEXT]), pick + 1)
    reason = F.element_at(F.array(*[F.lit(t[1]) for t in CENTRAL_TEXT]), pick + 1)
    tt = TRANSFORM_TEXT
    right = F.concat(F.lit(tt["right"]), F.when(F.col("min") > 0, tt["right_pos"])
                     .when(F.col("min") >= 0, tt["right_zero"]).otherwise(tt["right_neg"]))
    left = F.concat(F.lit(tt["left"]), F.when(F.col("min") >= 0, tt["left_nonneg"])
                    .otherwise(tt["left_neg"]))
    base_t = F.when(F.col("skew") > 0, right).otherwise(left)
    extreme = (a > 1.5) | (F.col("max") > 10 * F.col("median"))
    transform = F.when(strong, F.concat(base_t, F.when(extreme, tt["extreme"]).otherwise("")))
    # a column without values keeps its row
    every = (df.select(*by).distinct() if by else df.sparkSession.range(1).select()).select(
        *[F.col(b).alias(f"_{b}") for b in by], F.explode(F.array(*[F.lit(c) for c in cols])).alias("_column"))
    on = F.col("column_name") == F.col("_column")
    for b in by:
        on = on & F.col(b).eqNullSafe(F.col(f"_{b}"))
    m = every.join(m, on, "left").select(
        *[F.col(f"_{b}").alias(b) for b in by], F.col("_column").alias("column_name"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
        *[F.col(x) for x in m.columns if x not in (*keys, "n")])
    empty = F.col("n") == 0
    zero_mean = (F.col("mean") == 0) | empty
    return m.select(
        *keys, "n", "mean", "std", "median", "cv", F.abs(F.col("cv")).alias("cv_abs"), "skew",
        F.when(zero_mean, None).otherwise(cv_msg).alias("cv_message"),
        F.when(zero_mean, None).otherwise(lv_).alias("skew_level"),
        F.when(zero_mean, None).otherwise(sk_msg).alias("skew_message"),
        F.when(empty, "empty").when(zero_mean, "undefined").otherwise(central).alias("central"),
        F.when(zero_mean, None).otherwise(reason).alias("reason"),
        F.when(zero_mean, None).otherwise(transform).alias("transform"))


# --- A6 / A7 / A8 --------------------------------------------------------------------------

def iqr_bounds(df: DataFrame, column: str, clamp_zero: bool = False,
               by: Sequence[str] = ()) -> DataFrame:
    """A6 bounds: Q1, Q3, IQR and the 1.5 IQR fences (lower clamped at 0 on request)."""
    q = quantiles(df, column, [0.25, 0.75], by, ["q1", "q3"])
    iqr = F.col("q3") - F.col("q1")
    lower = F.col("q1") - 1.5 * iqr
    if clamp_zero:
        lower = F.greatest(lower, F.lit(0.0))
    return q.select(*by, "q1", "q3", iqr.alias("iqr"), lower.alias("lower"),
                    (F.col("q3") + 1.5 * iqr).alias("upper"))


def iqr_outliers(df: DataFrame, column: str, bound: str = "both", clamp_zero: bool = False
                 ) -> DataFrame:
    """Rows strictly outside the fences, labelled `lower` / `upper`.

    The one-row bounds table is broadcast (its size is one row); an empty frame, never None.
    """
    if bound not in ("both", "lower", "upper"):
        raise ValueError("bound must be 'both', 'lower' or 'upper'")
    b = iqr_bounds(df, column, clamp_zero).select("lower", "upper")
    x = nan_to_null(F.col(column), dtype(df, column))  # NaN is missing, not large
    j = df.crossJoin(F.broadcast(b))
    side = F.when(x < F.col("lower"), "lower").when(x > F.col("upper"), "upper")
    keep = {"both": side.isNotNull(), "lower": x < F.col("lower"), "upper": x > F.col("upper")}
    return j.where(keep[bound]).select(*df.columns, side.alias("side"))


def sigma_bands(df: DataFrame, column: str) -> DataFrame:
    """Mean and the 1, 2, 3 sigma bands, with the share of values inside each."""
    v = nan_to_null(F.col(column).cast("double"), T.DoubleType())
    stats = df.agg(F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                   F.count(v).alias("n"))
    j = df.select(v.alias("_x")).where(F.col("_x").isNotNull()).crossJoin(F.broadcast(stats))
    inside = [F.avg(F.when(F.abs(F.col("_x") - F.col("mean")) <= k * F.col("std"), 1.0)
                    .otherwise(0.0)).alias(f"share_{k}s") for k in (1, 2, 3)]
    shares = j.agg(*inside)
    out = stats.crossJoin(shares)
    return out.select("n", "mean", "std",
                      *[(F.col("mean") - k * F.col("std")).alias(f"lower_{k}s") for k in (1, 2, 3)],
                      *[(F.col("mean") + k * F.col("std")).alias(f"upper_{k}s") for k in (1, 2, 3)],
                      "share_1s", "share_2s", "share_3s")


def sigma_outliers(df: DataFrame, column: str, k: float = 3.0) -> DataFrame:
    """Rows further than k sigma from the mean."""
    v = nan_to_null(F.col(column).cast("double"), T.DoubleType())
    stats = df.agg(F.avg(v).alias("_mean"), F.stddev_samp(v).alias("_std"))
    j = df.crossJoin(F.broadcast(stats))
    z = (v - F.col("_mean")) / F.col("_std")
    return j.where(F.abs(v - F.col("_mean")) > k * F.col("_std")).select(
        *df.columns, z.alias("z"))


def normality_heuristic(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """|skew| < 0.5 and |kurtosis| < 1 (used for n > 5000 instead of Shapiro-Wilk)."""
    m = moments(df, columns)
    return m.select("column_name", "n", "skew", "kurt",
                    ((F.abs("skew") < 0.5) & (F.abs("kurt") < 1)).alias("approx_normal"),
                    (F.col("n") > 5000).alias("large_sample"))


# --- A9 / A10 / A11 ------------------------------------------------------------------------

def _pairs_long(df: DataFrame, cols: Sequence[str], ordered: bool) -> DataFrame:
    """Pairwise-complete (n, cov, r) for column pairs in one fused aggregate.

    Only unordered pairs (i < j) are aggregated, with both inputs masked to rows where both
    exist; the diagonal needs single-column statistics only; ordered output mirrors the rest.
    """
    vals = {c: nan_to_null(F.col(c).cast("double"), T.DoubleType()) for c in cols}
    pairs = [(a, b) for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j]
    aggs = []
    for k, (a, b) in enumerate(pairs):
        x, y = vals[a], vals[b]
        both = x.isNotNull() & y.isNotNull()
        xp, yp = F.when(both, x), F.when(both, y)
        aggs += [F.covar_samp(xp, yp).alias(f"cov{k}"), F.stddev_samp(xp).alias(f"sx{k}"),
                 F.stddev_samp(yp).alias(f"sy{k}"), F.count(xp).alias(f"n{k}")]
    if ordered:
        for i, c in enumerate(cols):
            aggs += [F.var_samp(vals[c]).alias(f"v{i}"), F.count(vals[c]).alias(f"c{i}")]
    one = df.agg(*aggs)
    rows = []
    for k, (a, b) in enumerate(pairs):
        r = F.try_divide(F.col(f"cov{k}"), F.col(f"sx{k}") * F.col(f"sy{k}"))
        rows.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"n{k}").alias("n"),
                             F.col(f"cov{k}").alias("cov"), r.alias("r")))
        if ordered:
            rows.append(F.struct(F.lit(b).alias("x"), F.lit(a).alias("y"),
                                 F.col(f"n{k}").alias("n"), F.col(f"cov{k}").alias("cov"),
                                 r.alias("r")))
    if ordered:
        for i, c in enumerate(cols):
            v = F.col(f"v{i}")
            rows.append(F.struct(F.lit(c).alias("x"), F.lit(c).alias("y"),
                                 F.col(f"c{i}").alias("n"), v.alias("cov"),
                                 F.try_divide(v, v).alias("r")))
    return one.select(F.inline(F.array(*rows)))


def covariance_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pairwise-complete sample covariance, long form (x, y, cov), all ordered pairs."""
    cols = numeric_columns(df, columns)
    return _pairs_long(df, cols, True).select("x", "y", "cov")


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A10: pairwise-complete Pearson r, NULL where a side is constant (no ANSI error)."""
    cols = numeric_columns(df, columns)
    return _pairs_long(df, cols, True).select("x", "y", "r")


def correlation_pairs(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Each unordered pair once, with direction and strength labels."""
    cols = numeric_columns(df, columns)
    r = F.col("r")
    a = F.abs(r)
    strength = (F.when(r.isNull(), "Undefined").when(a > 0.7, "Strong")
                .when(a > 0.3, "Moderate").when(a == 0, "No linear relationship")
                .otherwise("Weak"))
    direction = (F.when(r > 0, "positive").when(r < 0, "negative").when(r == 0, "neutral"))
    return _pairs_long(df, cols, False).select("x", "y", "r", direction.alias("direction"),
                                               strength.alias("strength"))


# --- A12 - A20 -----------------------------------------------------------------------------

def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Non-null counts per value, the most frequent first (ties: smaller value first)."""
    return (df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value"))


def group_mean(df: DataFrame, keys: Sequence[str], value: str, digits: int = 2) -> DataFrame:
    """Mean of `value` per key (one or two keys), rounded."""
    v = nan_to_null(F.col(value).cast("double"), T.DoubleType())
    return df.groupBy(*keys).agg(F.round(F.avg(v), digits).alias("mean"))


def group_multi_mean(df: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Several means per group in one aggregate."""
    return df.groupBy(key).agg(*[
        F.avg(nan_to_null(F.col(v).cast("double"), T.DoubleType())).alias(f"mean_{v}")
        for v in values])


def group_mean_ci(df: DataFrame, x: str, hue: str, y: str, z: float = 1.96) -> DataFrame:
    """Mean with the normal-approximation interval mean +- z*sd/sqrt(n) per (x, hue)."""
    v = nan_to_null(F.col(y).cast("double"), T.DoubleType())
    g = df.groupBy(x, hue).agg(F.count(v).alias("n"), F.avg(v).alias("mean"),
                               F.stddev_samp(v).alias("sd"))
    half = z * F.col("sd") / F.sqrt(F.col("n"))
    return g.select(x, hue, "n", "mean", "sd", (F.col("mean") - half).alias("ci_low"),
                    (F.col("mean") + half).alias("ci_high"))


def pivot_table(df: DataFrame, rows: str, cols: str, value: str, values: Sequence,
                agg: str = "avg") -> DataFrame:
    """Rows x columns table of an aggregate; the column values are given (no extra job)."""
    fn = {"avg": F.avg, "sum": F.sum, "count": F.count, "max": F.max, "min": F.min}[agg]
    return df.groupBy(rows).pivot(cols, list(values)).agg(fn(F.col(value)))


def compare_two_measures(df: DataFrame, x: str, split: str, a, b, value: str) -> DataFrame:
    """Two series side by side per category (sum of `value` where split = a, = b)."""
    return df.groupBy(x).agg(
        F.sum(F.when(F.col(split) == a, F.col(value))).alias("measure_a"),
        F.sum(F.when(F.col(split) == b, F.col(value))).alias("measure_b"))


def start_end_segments(df: DataFrame, entity: str, when_col: str, value: str) -> DataFrame:
    """First and last value per entity along `when_col`, and the change."""
    g = df.groupBy(entity).agg(F.min_by(value, when_col).alias("start_value"),
                               F.max_by(value, when_col).alias("end_value"),
                               F.min(when_col).alias("start_at"), F.max(when_col).alias("end_at"))
    return g.withColumn("change", F.col("end_value") - F.col("start_value"))


def box_stats(long_df: DataFrame, group: str = "group", value: str = "value") -> DataFrame:
    """Box-plot numbers per group: quartiles, mean, fences, whiskers, outliers.

    Whiskers are the most extreme values inside the fences; the fence table (one row per group)
    is joined back on the group key.
    """
    lv = long_df.select(group, nan_to_null(F.col(value).cast("double"), T.DoubleType())
                        .alias("_x")).where(F.col("_x").isNotNull())
    q = exact_quantiles(lv, "_x", [0.25, 0.5, 0.75], [group], ["q1", "median", "q3"])
    iqr = F.col("q3") - F.col("q1")
    q = q.select(group, "q1", "median", "q3", (F.col("q1") - 1.5 * iqr).alias("lower_fence"),
                 (F.col("q3") + 1.5 * iqr).alias("upper_fence"))
    j = lv.join(q, group)
    inside = (F.col("_x") >= F.col("lower_fence")) & (F.col("_x") <= F.col("upper_fence"))
    agg = j.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.avg("_x").alias("mean"),
        F.min(F.when(inside, F.col("_x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_x"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"))
    return q.join(agg, group)


def box_outlier_points(df: DataFrame, column: str) -> DataFrame:
    """Outlier values (outside 1.5 IQR) with their counts, for drawing the points."""
    o = iqr_outliers(df.select(column), column)
    return o.groupBy(F.col(column).alias("value"), "side").agg(F.count(F.lit(1)).alias("n"))


def box_inlier_points(df: DataFrame, column: str) -> DataFrame:
    """Values within the fences with their counts, for drawing all points."""
    x = nan_to_null(F.col(column).cast("double"), T.DoubleType())
    b = iqr_bounds(df, column).select("lower", "upper")
    j = df.select(x.alias("value")).where("value is not null").crossJoin(F.broadcast(b))
    return j.where("value between lower and upper").groupBy("value").agg(F.count(F.lit(1)).alias("n"))


# --- A21 -----------------------------------------------------------------------------------

def transform_expr(x: Column, name: str, max_x: Column | None = None) -> Column:
    """Skew-reducing transforms with domain guards (out of domain -> NULL)."""
    if name == "log":
        return F.when(x > 0, F.log(x))
    if name == "sqrt":
        return F.when(x >= 0, F.sqrt(x))
    if name == "reciprocal":
        return F.try_divide(F.lit(1.0), x)
    if name == "square":
        return x * x
    if name == "exp":
        return F.when(x < 700, F.exp(x))
    if name == "reflect_log":
        return F.when(max_x + 1 - x > 0, F.log(max_x + 1 - x))
    raise ValueError(f"unknown transform {name}")


def boxcox_expr(x: Column, lam: float) -> Column:
    if lam == 0:
        return F.when(x > 0, F.log(x))
    return F.when(x > 0, (F.pow(x, F.lit(lam)) - 1) / lam)


def yeojohnson_expr(x: Column, lam: float) -> Column:
    pos = F.log1p(x) if lam == 0 else (F.pow(x + 1, F.lit(lam)) - 1) / lam
    neg = -F.log1p(-x) if lam == 2 else -(F.pow(1 - x, F.lit(2 - lam)) - 1) / (2 - lam)
    return F.when(x >= 0, pos).otherwise(neg)


def lambda_grid(lo: float = -2.0, hi: float = 2.0, step: float = 0.25) -> list[float]:
    k = int(round((hi - lo) / step))
    return [round(lo + i * step, 10) for i in range(k + 1)]


def power_lambda_grid(df: DataFrame, column: str, grid: Sequence[float] | None = None
                      ) -> DataFrame:
    """Box-Cox and Yeo-Johnson log-likelihood for every lambda of a grid in one aggregate.

    Box-Cox uses positive values only. Output: (lambda, boxcox_llf, yeojohnson_llf). `power_fit` finds the best lambda.
    """
    grid = list(grid or lambda_grid())
    x = nan_to_null(F.col(column).cast("double"), T.DoubleType())
    base = df.select(x.alias("_x")).where(F.col("_x").isNotNull())
    xp = F.when(F.col("_x") > 0, F.col("_x"))
    aggs = [F.count(xp).alias("n_pos"), F.sum(F.log(xp)).alias("slog"),
            F.count(F.col("_x")).alias("n_all"),
            F.sum(F.signum("_x") * F.log1p(F.abs("_x"))).alias("syj")]
    for i, lam in enumerate(grid):
        aggs += [F.var_pop(boxcox_expr(xp, lam)).alias(f"bc{i}"),
                 F.var_pop(yeojohnson_expr(F.col("_x"), lam)).alias(f"yj{i}")]
    one = base.agg(*aggs)
    rows = []
    for i, lam in enumerate(grid):
        bc = ((lam - 1) * F.col("slog") - F.col("n_pos") / 2.0 * F.log(F.col(f"bc{i}")))
        yj = ((lam - 1) * F.col("syj") - F.col("n_all") / 2.0 * F.log(F.col(f"yj{i}")))
        rows.append(F.struct(F.lit(lam).alias("lambda"), bc.alias("boxcox_llf"),
                             yj.alias("yeojohnson_llf")))
    return one.select(F.inline(F.array(*rows)))


def _power_slopes(x: Column, family: str) -> tuple[Column, Column, Callable]:
    """The values a family takes, the derivative by lambda of log |d y / d x|, and a function of lambda that gives y and
    its derivative by lambda."""
    if family == "boxcox":
        v = F.when(x > 0, x)
        log = F.log(v)

        def both(lam: float):
            if lam == 0:
                return log, log * log / 2
            p = F.exp(lam * log)
            return (p - 1) / lam, (lam * log * p - p + 1) / (lam * lam)
        return v, log, both
    if family != "yeojohnson":
        raise ValueError(f"no family called {family}; there are boxcox and yeojohnson")
    log = F.log1p(F.abs(x))

    def both(lam: float):
        sides = []
        for m, sign in ((lam, 1.0), (2 - lam, -1.0)):  # each side is a Box-Cox transform of 1 + |x|
            p = F.exp(m * log)
            y, d = (log, log * log / 2) if m == 0 else ((p - 1) / m, (m * log * p - p + 1) / (m * m))
            sides.append((sign * y, d))
        (y0, d0), (y1, d1) = sides
        return F.when(x >= 0, y0).otherwise(y1), F.when(x >= 0, d0).otherwise(d1)
    return x, F.signum(x) * log, both


def power_fit(df: DataFrame, column: str, family: str = "yeojohnson", low: float = -5.0, high: float = 5.0,
              tolerance: float = 1e-9) -> float | None:
    """The lambda of largest likelihood between `low` and `high`, by nested sections of the likelihood's slope: each
    pass over the data is one aggregate that takes the slope at nine places, so the range shrinks tenfold a pass. None
    for a column without two different values. Box-Cox uses positive values only."""
    x = nan_to_null(F.col(column).cast("double"), T.DoubleType())
    v, jacobian, both = _power_slopes(F.col("_x"), family)
    base = df.select(x.alias("_x")).select(v.alias("_x")).where(F.col("_x").isNotNull() & (F.abs("_x") < float("inf")))
    ends = base.agg(F.min("_x").alias("a"), F.max("_x").alias("b")).first()
    if ends["a"] is None or ends["a"] == ends["b"]:
        return None
    while high - low > tolerance:
        at = [low + (high - low) * i / 10 for i in range(1, 10)]
        aggs = [F.avg(jacobian).alias("j")]
        for i, lam in enumerate(at):
            y, d = both(lam)
            aggs += [F.covar_pop(y, d).alias(f"c{i}"), F.var_pop(y).alias(f"v{i}")]
        r = base.agg(*aggs).first()
        rising = [i for i in range(9) if r[f"v{i}"] and r["j"] - r[f"c{i}"] / r[f"v{i}"] > 0]
        k = max(rising) + 1 if rising else 0  # the slope falls through 0 beyond the last place where it rises
        low, high = low + (high - low) * k / 10, low + (high - low) * (k + 1) / 10
    return (low + high) / 2


def power_transform(df: DataFrame, column: str, family: str = "yeojohnson", lam: float | None = None,
                    out: str | None = None, **options) -> DataFrame:
    """Df with `out` (by default the column itself) transformed with `lam`, or with the fitted lambda. Values
    outside the family's domain, and all values where nothing can be fitted, give NULL."""
    lam = power_fit(df, column, family, **options) if lam is None else lam
    x = nan_to_null(F.col(column).cast("double"), T.DoubleType())
    if lam is None:
        y = F.lit(None).cast("double")
    else:
        y = boxcox_expr(x, lam) if family == "boxcox" else yeojohnson_expr(x, lam)
    return df.withColumn(out or column, y)


def transform_skew(df: DataFrame, column: str,
                   transforms: Sequence[str] = ("log", "sqrt", "reciprocal", "square",
                                                "reflect_log")) -> DataFrame:
    """Skew before and after each transform, one aggregate over all transforms."""
    x = nan_to_null(F.col(column).cast("double"), T.DoubleType())
    mx = df.agg(F.max(x).alias("_max"))
    j = df.select(x.alias("_x")).where(F.col("_x").isNotNull()).crossJoin(F.broadcast(mx))
    names = ["none", *transforms]
    exprs = {"none": F.col("_x")}
    for t in transforms:
        exprs[t] = transform_expr(F.col("_x"), t, F.col("_max"))
    aggs = []
    for i, t in enumerate(names):
        e = exprs[t]
        aggs += [F.count(e).alias(f"n{i}"), F.skewness(e).alias(f"g{i}"),
                 F.var_samp(e).alias(f"v{i}")]
    one = j.agg(*aggs)
    rows = [F.struct(F.lit(t).alias("transform"), F.col(f"n{i}").alias("n"),
                     adjusted_skew(F.col(f"n{i}").cast("double"), F.col(f"g{i}"),
                                   F.col(f"v{i}")).alias("skew"))
            for i, t in enumerate(names)]
    return one.select(F.inline(F.array(*rows)))


def rank_normal_score(df: DataFrame, column: str, name: str = "normal_score") -> DataFrame:
    """Rank-based normal score Phi^-1((rank - 0.5) / n), ties get their mean rank.

    Ranks come from the collapsed (value, count) table of the distributed ranking, joined back
    on the value.
    """
    x = nan_to_null(F.col(column).cast("double"), T.DoubleType())
    base = df.withColumn("_x", x)
    rc = ranked_counts(base.select("_x"), "_x")
    mean_rank = F.col("start") + (F.col("cnt") + 1) / 2.0
    scores = rc.select("_x", norm_ppf((mean_rank - 0.5) / F.col("n")).alias(name))
    return base.join(scores, "_x", "left").drop("_x")
