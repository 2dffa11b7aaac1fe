"""Column scoping (P1, P2) and the small expression helpers every operator shares."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                 T.DecimalType)
INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL_TYPES = (T.FloatType, T.DoubleType, T.DecimalType)


def _as_list(x) -> list[str] | None:
    if x is None:
        return None
    if isinstance(x, str):
        return [x]
    return list(x)


def scope(df: DataFrame, include: Iterable[str] | str | None = None,
          exclude: Iterable[str] | str | None = None, lenient: bool = False) -> list[str]:
    """Columns to work on. `include=None` means all, `exclude` always wins.

    An unknown name in `include` raises, unless `lenient` (the token-duplicate detector drops
    unknown names silently).
    """
    inc = _as_list(include)
    exc = set(_as_list(exclude) or [])
    if inc is None:
        chosen = list(df.columns)
    else:
        missing = [c for c in inc if c not in df.columns]
        if missing and not lenient:
            raise KeyError(f"columns not found: {missing}")
        chosen = [c for c in inc if c in df.columns]
    return [c for c in chosen if c not in exc]


def dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC_TYPES)


def is_integral(dt: T.DataType) -> bool:
    return isinstance(dt, INTEGRAL_TYPES)


def is_string(dt: T.DataType) -> bool:
    return isinstance(dt, T.StringType)


def numeric_columns(df: DataFrame, columns: Iterable[str] | None = None,
                    require: bool = True) -> list[str]:
    """Numeric columns among `columns` (default all); raise when there are none."""
    names = list(columns) if columns is not None else list(df.columns)
    out = [c for c in names if is_numeric(dtype(df, c))]
    if require and not out:
        raise ValueError("no numeric column to work on")
    return out


def nan_to_null(c: Column | str, dt: T.DataType | None = None) -> Column:
    """Treat float NaN as missing, like pandas does. Non-float types pass through."""
    col = F.col(c) if isinstance(c, str) else c
    if dt is not None and not isinstance(dt, (T.FloatType, T.DoubleType)):
        return col
    return F.when(~F.isnan(col), col)


def num(df: DataFrame, name: str) -> Column:
    """A numeric column as double with NaN turned into null."""
    dt = dtype(df, name)
    if not is_numeric(dt):
        raise TypeError(f"column {name} is not numeric ({dt.simpleString()})")
    return nan_to_null(F.col(name).cast("double"), T.DoubleType())


def round_all(df: DataFrame, digits: int = 6, skip: Iterable[str] = ()) -> DataFrame:
    """Round every floating column of a (small) result, except those in `skip`."""
    skip = set(skip)
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)) and f.name not in skip
        else F.col(f.name)
        for f in df.schema])


def move_to_end(df: DataFrame, name: str) -> DataFrame:
    """Put one column last."""
    return df.select(*[c for c in df.columns if c != name], name)


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows where `column` is missing (NaN counts as missing)."""
    c = F.col(column)
    cond = c.isNull()
    if isinstance(dtype(df, column), (T.FloatType, T.DoubleType)):
        cond = cond | F.isnan(c)
    return df.where(cond)


def two_groups(df: DataFrame, group_col: str, a, b) -> DataFrame:
    """P5: keep the rows of two groups (the two samples of a test)."""
    return df.where(F.col(group_col).isin(a, b))
