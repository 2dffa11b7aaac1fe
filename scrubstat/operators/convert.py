"""Type, date and value conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..columns import dtype, is_numeric, is_string, scope
from ..functions.parsing import (number_text, parse_in_zone, strftime_to_java,
                                 strict_double)
from .rank import global_rank


def _classify(c, decimal_comma: bool = True, thousands: str | None = None):
    d = strict_double(c, decimal_comma, thousands)
    return (F.when(c.isNull(), F.lit(None))
            .when(d.isNull(), F.lit("non_numeric"))
            .when(d % 1 != 0, F.lit("non_integer"))), d


def numeric_failures(df: DataFrame, column: str, decimal_comma: bool = True,
                     thousands: str | None = None) -> DataFrame:
    """C14: values that do not parse as numbers, and parsed values with a fraction.

    Output: (failure, value, n) with one row per distinct failing value and its count.
    """
    cls, _ = _classify(F.col(column), decimal_comma, thousands)
    return (df.select(cls.alias("failure"), F.col(column).cast("string").alias("value"))
            .where(F.col("failure").isNotNull())
            .groupBy("failure", "value").agg(F.count(F.lit(1)).alias("n")))


def convert_to_numeric(df: DataFrame, mode: str | None = None, include=None, exclude=None,
                       decimal_comma: bool = True, thousands: str | None = None) -> DataFrame:
    """Text -> number after `,` -> `.` and strip.

    mode 'float' / 'Float64': double, unparseable -> NULL.
    mode 'integer' / 'Int64': long when every non-null value is a whole number, else the column
    is left unchanged (see `numeric_failures` for the report).
    mode None (auto): long when every non-null value is a whole number, else double.
    Whole numbers beyond the range of a long count as not whole: double, or unchanged.
    Integer and auto modes run one guard aggregate over all columns in scope.
    """
    cols = [c for c in scope(df, include, exclude)]
    if mode in ("float", "Float64"):
        conv = {c: strict_double(F.col(c), decimal_comma, thousands) for c in cols}
        return df.select(*[conv[c].alias(c) if c in conv else F.col(c) for c in df.columns])
    if mode not in (None, "auto", "integer", "Int64"):
        raise ValueError(f"unknown numeric mode: {mode}")
    aggs = []
    for i, c in enumerate(cols):
        cls, d = _classify(F.col(c), decimal_comma, thousands)
        aggs += [F.count_if(F.abs(d) >= 9.2e18).alias(f"large{i}"),
                 F.count_if(cls == "non_numeric").alias(f"bad{i}"),
                 F.count_if(cls == "non_integer").alias(f"frac{i}")]
    guard = df.agg(*aggs).first() if aggs else None
    sel = []
    for c in df.columns:
        if c not in cols:
            sel.append(F.col(c))
            continue
        i = cols.index(c)
        whole = guard[f"bad{i}"] == 0 and guard[f"frac{i}"] == 0 and guard[f"large{i}"] == 0
        d = strict_double(F.col(c), decimal_comma, thousands)
        if whole:
            sel.append(number_text(F.col(c), decimal_comma, thousands)
                       .try_cast("decimal(38,10)").cast("long").alias(c))
        elif mode in ("integer", "Int64"):
            sel.append(F.col(c))
        else:
            sel.append(d.alias(c))
    return df.select(*sel)


def int_to_boolean_any(df: DataFrame, cols: list[str]) -> DataFrame:
    """Boolean cast of numeric (or numeric text) columns: non-zero -> true, null kept."""
    out = []
    for c in df.columns:
        if c in cols:
            v = F.col(c) if is_numeric(dtype(df, c)) else strict_double(F.col(c))
            out.append((v != 0).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def category_codes(df: DataFrame, column: str, code_name: str | None = None) -> DataFrame:
    """Category codes: 0-based position of the value among the sorted distinct values, -1 for
    NULL. Distinct values are numbered with the distributed rank, then joined back (AQE
    broadcasts the code table when it is small)."""
    name = code_name or f"{column}_code"
    distinct = df.select(F.col(column).alias("_v")).where(F.col("_v").isNotNull()).distinct()
    codes = global_rank(distinct, ["_v"], name="_code").select(
        "_v", (F.col("_code") - 1).cast("int").alias(name))
    joined = df.join(codes, df[column].eqNullSafe(codes["_v"]), "left")
    return joined.select(*[df[c] for c in df.columns],
                         F.coalesce(F.col(name), F.lit(-1)).alias(name))


def normalize_datetime(df: DataFrame, include=None, exclude=None, fmt: str | None = None,
                       time_zone: str = "UTC") -> DataFrame:
    """Parse string columns with a strftime format (bad values -> NULL).

    Wall-clock values are read in `time_zone`; values with an offset or zone (`%z`, `%Z`, or at
    the end of the text without a format) are instants already, also in a column that mixes
    both. All are returned as the UTC wall clock (timestamp_ntz). With a time-only format (`%H:%M:%S`, `%H:%M`) the result is the time of
    day as an `HH:mm:ss` string (C22).
    """
    cols = [c for c in scope(df, include, exclude) if is_string(dtype(df, c))]
    out = []
    for c in df.columns:
        if c not in cols:
            out.append(F.col(c))
            continue
        if fmt in ("%H:%M:%S", "%H:%M"):
            t = F.try_to_timestamp(F.col(c), F.lit(strftime_to_java(fmt)))
            out.append(F.date_format(t, "HH:mm:ss").alias(c))
        else:
            out.append(parse_in_zone(F.col(c), fmt, time_zone or "UTC").alias(c))
    return df.select(*out)


def time_of_day(df: DataFrame, column: str, fmt: str = "%H:%M:%S") -> DataFrame:
    """Keep only the time of day, as `HH:mm:ss` text."""
    return normalize_datetime(df, include=[column], fmt=fmt)


def cast_datatypes(df: DataFrame, cast_type: str, numeric_type: str | None = None,
                   date_format: str | None = None, time_zone: str | None = None,
                   include=None, exclude=None) -> DataFrame:
    """One dispatcher for string, numeric, category, boolean and datetime casts."""
    cols = scope(df, include, exclude)
    if cast_type == "string":
        return df.select(*[F.col(c).cast("string").alias(c) if c in cols else F.col(c)
                           for c in df.columns])
    if cast_type == "numeric":
        return convert_to_numeric(df, numeric_type, include, exclude)
    if cast_type == "category":
        out = df.select(*[F.col(c).cast("string").alias(c) if c in cols else F.col(c)
                          for c in df.columns])
        for c in cols:
            out = category_codes(out, c)
        return out
    if cast_type == "boolean":
        return int_to_boolean_any(df, cols)
    if cast_type == "datetime":
        return normalize_datetime(df, include, exclude, date_format, time_zone or "UTC")
    raise ValueError(f"Unsupported cast_type: {cast_type}")
