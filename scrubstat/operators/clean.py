"""Null handling (C1-C5, C23), duplicates (C6, C7), value recodes (C16-C18), text.

Every operator is DataFrame -> DataFrame. Whole-table reports are one fused aggregate over all
columns (one scan), turned into long form with `stack` on the single result row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import dtype, is_integral, is_numeric, is_string, scope
from ..functions.text import normalize_header, normalize_text
from .rank import exact_quantiles, global_rank

# Placeholder texts that mean "missing" (exact, case-sensitive match).
PLACEHOLDERS = ["", " ", "N/A", "none", "None", "null", "NULL", "NaN", "nan", "NAN", "nat", "NaT"]

# Day names for the numbers 0 to 6, week starting on Sunday.
DAY_NAMES = ["sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"]


def _stack(row_exprs: list[list[Column]], names: list[str]) -> Column:
    """Unpivot the one-row result of a fused aggregate: one output row per inner list."""
    return F.inline(F.array(*[F.struct(*[e.alias(nm) for e, nm in zip(r, names)])
                              for r in row_exprs]))


def _is_missing(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    if isinstance(dtype(df, name), (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


# --- C1 / C2 -------------------------------------------------------------------------------

def sentinel_scan(df: DataFrame, placeholders: Iterable[str] = PLACEHOLDERS) -> DataFrame:
    """Per column, how many values are placeholder texts and which ones occur.

    One aggregate for the whole table; non-text columns report 0 and an empty list.
    Output: (column_name, n_matches, matched_values).
    """
    ph = list(placeholders)
    aggs = []
    for i, name in enumerate(df.columns):
        if is_string(dtype(df, name)):
            hit = F.col(name).isin(ph)
            aggs += [F.count_if(hit).alias(f"n{i}"),
                     F.array_sort(F.collect_set(F.when(hit, F.col(name)))).alias(f"v{i}")]
        else:
            aggs += [F.lit(0).cast("long").alias(f"n{i}"),
                     F.array().cast("array<string>").alias(f"v{i}")]
    one = df.agg(*aggs)
    rows = [[F.lit(name), F.col(f"n{i}"), F.col(f"v{i}")] for i, name in enumerate(df.columns)]
    return one.select(_stack(rows, ["column_name", "n_matches", "matched_values"]))


def replace_placeholders(df: DataFrame, include=None, exclude=None,
                         placeholders: Iterable[str] = PLACEHOLDERS) -> DataFrame:
    """Placeholder texts become NULL in string columns; a new frame, one projection."""
    ph = list(placeholders)
    cols = set(scope(df, include, exclude))
    return df.select(*[
        F.when(F.col(c).isin(ph), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
        if c in cols and is_string(dtype(df, c)) else F.col(c) for c in df.columns])


# --- C3 / C5 -------------------------------------------------------------------------------

def missing_rate(df: DataFrame, include=None, exclude=None, digits: int = 2) -> DataFrame:
    """Per column total rows, missing values (NULL or NaN) and percent (0 when empty)."""
    cols = scope(df, include, exclude)
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(_is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(cols)])
    rows = [[F.lit(c), F.col("_n"), F.col(f"m{i}"),
             F.round(F.coalesce(F.try_divide(F.col(f"m{i}") * 100.0, F.col("_n")), F.lit(0.0)),
                     digits)] for i, c in enumerate(cols)]
    return one.select(_stack(rows, ["column_name", "total", "missing", "pct"]))


def column_info(df: DataFrame) -> DataFrame:
    """Type and non-null count per column (`df.info()`)."""
    one = df.agg(*[F.count(F.when(~_is_missing(df, c), 1)).alias(f"c{i}")
                   for i, c in enumerate(df.columns)])
    rows = [[F.lit(i).cast("int"), F.lit(c), F.lit(dtype(df, c).simpleString()), F.col(f"c{i}")]
            for i, c in enumerate(df.columns)]
    return one.select(_stack(rows, ["position", "column_name", "data_type", "non_null"]))


# --- C4 ------------------------------------------------------------------------------------

def null_heatmap(df: DataFrame, order_by: str, buckets: int = 50, include=None,
                 exclude=None) -> DataFrame:
    """C4: missing values per (row bucket, column) along an ordering column.

    Rows are numbered with the distributed global rank, bucket = floor((rank-1)*B/n).
    Output: (bucket, column_name, n_rows, n_null, null_rate).
    """
    cols = scope(df, include, exclude)
    ranked = global_rank(df, [order_by], name="_r")
    total = ranked.agg(F.count(F.lit(1)).alias("_n"))
    with_b = ranked.crossJoin(F.broadcast(total)).withColumn(
        "bucket", F.floor((F.col("_r") - 1) * buckets / F.col("_n")).cast("int"))
    agg = with_b.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(_is_missing(with_b, c)).alias(f"m{i}") for i, c in enumerate(cols)])
    rows = [[F.lit(c), F.col("_rows"), F.col(f"m{i}"),
             F.round(F.col(f"m{i}") / F.col("_rows"), 6)] for i, c in enumerate(cols)]
    return agg.select("bucket", _stack(rows, ["column_name", "n_rows", "n_null", "null_rate"]))


# --- C23 -----------------------------------------------------------------------------------

def _mode_table(df: DataFrame, col: str, by: list[str]) -> DataFrame:
    """Most frequent non-null value (ties: smallest value), per group."""
    counts = (df.where(~_is_missing(df, col)).groupBy(*by, col)
              .agg(F.count(F.lit(1)).alias("_cnt")))
    return counts.groupBy(*by).agg(
        F.min_by(F.col(col), F.struct((-F.col("_cnt")).alias("a"), F.col(col).alias("b")))
        .alias(f"_fill_{col}"))


def fill_missing(df: DataFrame, spec: Mapping[str, object], by: Iterable[str] | None = None
                 ) -> DataFrame:
    """Fill NULL / NaN per column with a constant or 'mean' | 'median' | 'mode'.

    An integer column filled with its mean or median becomes double, as the statistic may have a fraction.
    Statistics are aggregates (per `by` group when given) joined back once: a one-row table is
    broadcast; a per-group table is joined on the group keys (AQE broadcasts it when small).
    """
    by = list(by or [])
    stats: list[DataFrame] = []
    consts: dict[str, object] = {}
    means = [c for c, how in spec.items() if how == "mean"]
    medians = [c for c, how in spec.items() if how == "median"]
    modes = [c for c, how in spec.items() if how == "mode"]
    for c, how in spec.items():
        if how not in ("mean", "median", "mode"):
            consts[c] = how
    if means:
        stats.append(df.groupBy(*by).agg(*[
            F.avg(F.when(~_is_missing(df, c), F.col(c))).alias(f"_fill_{c}") for c in means]))
    for c in medians:
        stats.append(exact_quantiles(df, c, [0.5], by, names=[f"_fill_{c}"]))
    for c in modes:
        stats.append(_mode_table(df, c, by))
    out = df
    for s in stats:
        # one-row statistics: broadcast (size is one row); per-group: equi-join on the keys
        out = out.crossJoin(F.broadcast(s)) if not by else out.join(s, on=by, how="left")
    sel = []
    for c in df.columns:
        col = F.when(~_is_missing(df, c), F.col(c))
        if c in consts:
            sel.append(F.coalesce(col, F.lit(consts[c]).cast(dtype(df, c))).alias(c))
        elif c in spec:
            kind = "double" if is_integral(dtype(df, c)) and spec[c] != "mode" else dtype(df, c)
            sel.append(F.coalesce(col.cast(kind), F.col(f"_fill_{c}").cast(kind)).alias(c))
        else:
            sel.append(F.col(c))
    return out.select(*sel)


# --- C6 / C7 -------------------------------------------------------------------------------

def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows equal to an earlier row over all columns (nulls equal). One-row result."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(F.sum("_c").cast("long").alias("n_rows"),
                 F.count(F.lit(1)).cast("long").alias("n_distinct"),
                 F.sum(F.col("_c") - 1).cast("long").alias("n_duplicates"))


def drop_duplicates(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """Keep one row of each group of equal rows."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


# --- C16 / C17 / C18 -----------------------------------------------------------------------

def int_to_bool(df: DataFrame, include=None, exclude=None) -> DataFrame:
    """Integer columns become boolean (non-zero true); null stays null."""
    cols = set(scope(df, include, exclude))
    return df.select(*[(F.col(c) != 0).alias(c) if c in cols and is_integral(dtype(df, c))
                       else F.col(c) for c in df.columns])


def recode(df: DataFrame, mapping: Mapping[str, str], include=None, exclude=None) -> DataFrame:
    """Exact value replacement in string columns."""
    cols = [c for c in scope(df, include, exclude) if is_string(dtype(df, c))]
    return df.replace(dict(mapping), subset=cols) if cols else df


def standardize_gender(df: DataFrame, include=None, exclude=None) -> DataFrame:
    """C17: exact `f` -> female, `m` -> male; other values unchanged."""
    return recode(df, {"f": "female", "m": "male"}, include, exclude)


def day_names(df: DataFrame, include=None, exclude=None) -> DataFrame:
    """Numbers 0-6 become day names (0 = sunday), for numeric columns whose non-null values
    all lie in 0..6; other columns are left as they are. One guard aggregate for all columns."""
    cand = [c for c in scope(df, include, exclude) if is_numeric(dtype(df, c))
            and not isinstance(dtype(df, c), T.BooleanType)]
    if not cand:
        return df
    guard = df.agg(*[F.bool_and(F.col(c).isNull() | F.col(c).isin(*range(7))).alias(f"g{i}")
                     for i, c in enumerate(cand)]).first()
    ok = {c for i, c in enumerate(cand) if guard[f"g{i}"] in (True, None)}
    names = F.array(*[F.lit(d) for d in DAY_NAMES])
    return df.select(*[
        # guard the NULL index explicitly: element_at on a literal array does not return NULL
        # for a NULL index under whole-stage codegen in this Spark version
        F.when(F.col(c).isNotNull(), F.element_at(names, (F.col(c).cast("int") + 1))).alias(c)
        if c in ok else F.col(c)
        for c in df.columns])


# --- C10 / P3 ------------------------------------------------------------------------------

def normalize_string_format(df: DataFrame, include=None, exclude=None) -> DataFrame:
    """C10 on every string column in scope, one projection."""
    cols = set(scope(df, include, exclude))
    return df.select(*[normalize_text(F.col(c)).alias(c)
                       if c in cols and is_string(dtype(df, c)) else F.col(c)
                       for c in df.columns])


def normalize_headers(df: DataFrame) -> DataFrame:
    """Rename every header with the header rule (schema only, no job)."""
    new = [normalize_header(c) for c in df.columns]
    if len(set(new)) != len(new):
        raise ValueError(f"normalised headers collide: {new}")
    return df.toDF(*new)
