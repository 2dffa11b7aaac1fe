"""Approximate quantiles from mergeable sketches (A5 with `exact=False`).

One KLL sketch of fixed size per group and column takes any number of values in one pass with partial aggregation,
and sketches of parts (days, sources) merge into that of the whole: a report over a year reads 365 small rows a group
instead of the data. Quantiles are values of the data without interpolation, whose rank lies within
`rank_error(k)` of the wanted one in 99 of 100 cases; sketches draw at random, so repeated runs may differ within that
bound. Missing values (NULL, NaN) do not count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..columns import numeric_columns
from ..session import join_uri
from .profile import long_values

K = 400  # size of a sketch, about 8 k bytes at most
MERGED = ["n", "low", "high", "sketch"]


def rank_error(k: int = K) -> float:
    """Bound of the rank error of a sketch, as a share of the values (fixed values of the sketch's authors)."""
    return 2.296 / k ** 0.9021


def quantile_sketches(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """(by..., column_name, n, low, high, sketch): one row per group and column that has values."""
    cols = numeric_columns(df, columns)
    v = F.col("value").cast("double")
    return long_values(df, cols, by).where("value is not null").groupBy(*by, "column_name").agg(
        F.count("*").alias("n"), F.min(v).alias("low"), F.max(v).alias("high"), F.expr(f"kll_sketch_agg_double(cast(value as double), {k})").alias("sketch"))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of coarser groups: `by` is a part of the columns that the sketches were made by."""
    return sketches.groupBy(*by, "column_name").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.expr("kll_merge_agg_double(sketch)").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probs: Sequence[float], names: Sequence[str] | None = None) -> DataFrame:
    """The sketches' rows with a column per probability instead of the sketch; 0 and 1 are the exact ends."""
    names = names or [f"q{p:g}" for p in probs]
    inner = [p for p in probs if 0 < p < 1]
    found = F.expr(f"kll_sketch_get_quantile_double(sketch, array({', '.join(f'{p!r}D' for p in inner)}))") if inner else F.lit(None)
    out = sketches.withColumn("_q", found)
    value = lambda p: F.col("low") if p <= 0 else F.col("high") if p >= 1 else F.col("_q")[inner.index(p)]
    keys = [c for c in sketches.columns if c not in MERGED]
    return out.select(*keys, "n", *[value(p).alias(name) for p, name in zip(probs, names)])


def store_sketches(df: DataFrame, day: str, folder: str, columns: Sequence[str] | None = None, by: Sequence[str] = (),
                   k: int = K) -> None:
    """Write the sketches of the days in df to a table partitioned by `day`, replacing those days and no others; a day
    is expected whole."""
    keyed = df.withColumn(day, F.to_date(day))
    made = quantile_sketches(keyed, [c for c in numeric_columns(keyed, columns) if c != day], [*by, day], k)
    made.repartition(day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(folder)


def read_sketches(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(join_uri(folder))
