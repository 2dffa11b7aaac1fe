"""Flat-file sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parsing import parse_timestamp, strict_double
from ..session import join_uri


def _path(path: str | Path, filename: str | Path | None = None) -> str:
    """The path as text; URIs of any store stay whole."""
    return str(path) if filename is None else join_uri(str(path), str(filename))


def read_csv(spark: SparkSession, path: str | Path, filename: str | Path | None = None, *,
             sep: str = ",", header: bool = True, schema: T.StructType | str | None = None,
             decimal: str = ".", keep_empty: bool = False,
             numeric_columns: Sequence[str] = (), parse_dates: Sequence[str] = (),
             date_format: str | None = None, encoding: str = "UTF-8") -> DataFrame:
    """Read CSV files (a file, a folder or a glob) lazily.

    * `schema`: explicit types (no inference pass). Without it every column is text.
    * `decimal=','`: the listed `numeric_columns` are read as text and converted with the
      strict number rule after the decimal comma is replaced (the CSV reader has no decimal
      option for doubles).
    * `keep_empty`: empty fields stay '' instead of NULL (quoted empties are kept by the
      reader; unquoted ones are restored with coalesce).
    * `parse_dates`: columns parsed to timestamp_ntz (bad values -> NULL).
    A path that does not exist raises FileNotFoundError.
    """
    p = _path(path, filename)
    r = (spark.read.option("header", header).option("sep", sep).option("encoding", encoding)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .option("mode", "PERMISSIVE"))
    if keep_empty:
        r = r.option("nullValue", "\u0001").option("emptyValue", "")
    if schema is not None and decimal == ".":
        r = r.schema(schema)
    try:
        df = r.csv(p)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            raise FileNotFoundError(p) from e
        raise
    if keep_empty:
        df = df.select(*[F.coalesce(F.col(f.name), F.lit("")).alias(f.name)
                         if isinstance(f.dataType, T.StringType) else F.col(f.name)
                         for f in df.schema])
    if decimal != ".":
        conv = set(numeric_columns)
        df = df.select(*[strict_double(F.col(c), decimal_comma=(decimal == ",")).alias(c)
                         if c in conv else F.col(c) for c in df.columns])
        if schema is not None:
            st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
            df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in st])
    if parse_dates:
        pd_ = set(parse_dates)
        df = df.select(*[parse_timestamp(F.col(c), date_format).alias(c) if c in pd_
                         else F.col(c) for c in df.columns])
    return df


def write_csv(df: DataFrame, path: str | Path, sep: str = ",", header: bool = True,
              mode: str = "overwrite") -> str:
    """Write a stage hand-off as CSV (one folder of part files)."""
    p = str(path)
    (df.write.mode(mode).option("header", header).option("sep", sep)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("emptyValue", '""').csv(p))
    return p


def write_parquet(df: DataFrame, path: str | Path, mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> str:
    """Preferred stage hand-off: parquet keeps the types."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(str(path))
    return str(path)
