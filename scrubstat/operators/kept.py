"""Tables that later runs go on from: category codes (C19) and lookups.

A kept table is a folder of versions. A run reads the newest complete one, finds by an anti-join which keys are new, works
on those alone and appends them; known keys keep their answers. Where appends have left many files, the table is
compacted into a new version and the old one removed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..columns import move_to_end
from ..session import _hadoop, drop_scratch, join_uri, write_through
from .enrich import lookup_keys, lookup_years
from .rank import global_rank

MOST_FILES = 64
CODES = "column_name string, value string, code int"


def newest(spark: SparkSession, folder: str) -> int:
    """The newest complete version, 0 if there is none."""
    fs, p = _hadoop(spark, folder)
    if not fs.exists(p):
        return 0
    path = spark._jvm.org.apache.hadoop.fs.Path
    names = [s.getPath() for s in fs.listStatus(p)]
    return max([int(q.getName()[1:]) for q in names if q.getName()[:1] == "v" and fs.exists(path(q, "_SUCCESS"))], default=0)


def read_kept(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    v = newest(spark, folder)
    return spark.read.schema(schema).parquet(join_uri(folder, f"v{v}")) if v else spark.createDataFrame([], schema)


def append_kept(rows: DataFrame, folder: str, schema: str, most_files: int = MOST_FILES) -> DataFrame:
    """Add rows and return the whole table."""
    spark = rows.sparkSession
    v = newest(spark, folder)
    rows.write.mode("append").parquet(join_uri(folder, f"v{max(v, 1)}"))
    whole = read_kept(spark, folder, schema)
    files = len(whole.inputFiles())
    if files > most_files:
        whole.coalesce(max(1, files // most_files)).write.mode("overwrite").parquet(join_uri(folder, f"v{max(v, 1) + 1}"))
        drop_scratch(spark, join_uri(folder, f"v{max(v, 1)}"))
        whole = read_kept(spark, folder, schema)
    return whole


def _values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct values of all columns as text, in one pass."""
    cells = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]))
    return df.select(cells).where("value is not null").distinct()


def _ranked(values: DataFrame) -> DataFrame:
    """(column_name, value, code) of distinct (column_name, value), from one ranking of the values of all columns."""
    ranked = write_through(global_rank(values, ["column_name", "value"], name="_at"), "category-ranks")
    first = ranked.groupBy("column_name").agg(F.min("_at").alias("_first"))  # one row a column
    return ranked.join(first, "column_name").select("column_name", "value", (F.col("_at") - F.col("_first")).cast("int").alias("code"))


def category_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, code): per column the 0-based places of its distinct values in order."""
    return _ranked(_values(df, columns))


def extend_codes(df: DataFrame, columns: Sequence[str], folder: str) -> DataFrame:
    """The kept codes of the columns, values not seen before added behind the known ones in their own order. A code
    once given stays."""
    spark = df.sparkSession
    known = read_kept(spark, folder, CODES)
    top = known.groupBy("column_name").agg((F.max("code") + 1).alias("_top"))
    fresh = _values(df, columns).join(known.select("column_name", "value"), ["column_name", "value"], "left_anti")
    rows = write_through(_ranked(fresh).join(top, "column_name", "left").select(
        "column_name", "value", (F.col("code") + F.coalesce("_top", F.lit(0))).cast("int").alias("code")), "category-new")
    return known if rows.isEmpty() else append_kept(rows, folder, CODES)


def encode(df: DataFrame, columns: Sequence[str], codes: DataFrame) -> DataFrame:
    """df with `<column>_code` for each column, -1 for NULL and for values without a code."""
    for c in columns:
        mine = codes.where(F.col("column_name") == c).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        df = df.join(mine, F.col(c).cast("string") == F.col("_value"), "left").withColumn(
            f"{c}_code", F.coalesce("_code", F.lit(-1))).drop("_value", "_code")
    return df


def enrich_kept(df: DataFrame, name: str, platform: str, pages: DataFrame, folder: str, out: str = "release_year",
                **options) -> DataFrame:
    """`enrich.enrich_lookup` with a kept table of answers, misses among them: only keys that no earlier run has asked
    for are looked up. Keys with a NULL are not looked up."""
    spark = df.sparkSession
    schema = f"`{name}` string, `{platform}` string, year int"
    known = read_kept(spark, folder, schema)
    fresh = lookup_keys(df, [name, platform]).where(F.col(name).isNotNull() & F.col(platform).isNotNull()).join(
        known.select(name, platform), [name, platform], "left_anti")
    fresh = write_through(fresh.select(F.col(name).cast("string").alias(name), F.col(platform).cast("string").alias(platform)), "lookup-keys")
    if not fresh.isEmpty():
        found = lookup_years(fresh, name, platform, pages, **options)
        answers = write_through(fresh.join(found, [name, platform], "left").select(name, platform, F.col("_year").alias("year")), "lookup-new")
        known = append_kept(answers, folder, schema)
    j = df.join(known.withColumnRenamed("year", "_year"), [name, platform], "left")
    res = j.select(*df.columns, F.coalesce(F.col("_year").cast("string"), F.lit("unknown")).alias(out), F.col("_year").alias(f"{out}_int"))
    return move_to_end(move_to_end(res, out), f"{out}_int")
