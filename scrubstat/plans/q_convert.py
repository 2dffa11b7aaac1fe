"""Registered queries for conversion."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.parsing import NUMBER_PATTERN
from ..operators import convert as cv
from .registry import make_registry
from .tables import view, with_views

Q, q = make_registry()

_T = "trim(replace(amount_raw, ',', '.'))"
_D = f"CASE WHEN regexp_matches({_T}, '{NUMBER_PATTERN}') THEN CAST({_T} AS DOUBLE) END"


@q("numeric_failures", with_views(
    f"SELECT failure, value, CAST(count(*) AS BIGINT) AS n FROM (SELECT CASE WHEN amount_raw IS "
    f"NULL THEN NULL WHEN ({_D}) IS NULL THEN 'non_numeric' WHEN fmod({_D}, 1) <> 0 THEN "
    f"'non_integer' END AS failure, amount_raw AS value FROM dirty) x WHERE failure IS NOT NULL "
    f"GROUP BY failure, value", "dirty"))
def _numeric_failures(spark, sf):
    return cv.numeric_failures(view(spark, sf, "dirty"), "amount_raw")


@q("to_numeric_float", with_views(f"SELECT id, {_D} AS amount_raw FROM dirty", "dirty"))
def _to_numeric_float(spark, sf):
    d = view(spark, sf, "dirty").select("id", "amount_raw")
    return cv.convert_to_numeric(d, "float", include=["amount_raw"])


@q("to_numeric_integer", with_views(
    "SELECT id, CAST(trim(whole_raw) AS BIGINT) AS whole_raw, amount_raw FROM dirty", "dirty"))
def _to_numeric_integer(spark, sf):
    d = view(spark, sf, "dirty").select("id", "whole_raw", "amount_raw")
    return cv.convert_to_numeric(d, "integer", include=["whole_raw", "amount_raw"])


@q("to_numeric_auto", with_views(
    f"SELECT id, CAST(trim(whole_raw) AS BIGINT) AS whole_raw, {_D} AS amount_raw FROM dirty",
    "dirty"))
def _to_numeric_auto(spark, sf):
    d = view(spark, sf, "dirty").select("id", "whole_raw", "amount_raw")
    return cv.convert_to_numeric(d, None, include=["whole_raw", "amount_raw"])


@q("cast_string", with_views(
    "SELECT CAST(id AS VARCHAR) AS id, CAST(day_num AS VARCHAR) AS day_num, label_raw FROM dirty",
    "dirty"))
def _cast_string(spark, sf):
    d = view(spark, sf, "dirty").select("id", "day_num", "label_raw")
    return cv.cast_datatypes(d, "string", include=["id", "day_num"])


@q("cast_boolean", with_views(
    "SELECT id, flag_int <> 0 AS flag_int, day_bad <> 0 AS day_bad FROM dirty", "dirty"))
def _cast_boolean(spark, sf):
    d = view(spark, sf, "dirty").select("id", "flag_int", "day_bad")
    return cv.cast_datatypes(d, "boolean", include=["flag_int", "day_bad"])


@q("category_codes", with_views(
    "SELECT d.id, d.segment_raw, CAST(coalesce(c.code, -1) AS INTEGER) AS segment_raw_code "
    "FROM dirty d LEFT JOIN (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM "
    "(SELECT DISTINCT segment_raw AS v FROM dirty WHERE segment_raw IS NOT NULL) s) c "
    "ON d.segment_raw = c.v", "dirty"))
def _category_codes(spark, sf):
    d = view(spark, sf, "dirty").select("id", "segment_raw")
    return cv.cast_datatypes(d, "category", include=["segment_raw"])


@q("parse_datetime", with_views(
    "SELECT id, try_strptime(ts_raw, '%Y-%m-%d %H:%M:%S') AS ts_raw FROM dirty", "dirty"))
def _parse_datetime(spark, sf):
    d = view(spark, sf, "dirty").select("id", "ts_raw")
    return cv.normalize_datetime(d, include=["ts_raw"], fmt="%Y-%m-%d %H:%M:%S")


@q("parse_datetime_infer", with_views(
    "SELECT id, try_strptime(ts_raw, '%Y-%m-%d %H:%M:%S') AS ts_raw FROM dirty", "dirty"))
def _parse_datetime_infer(spark, sf):
    d = view(spark, sf, "dirty").select("id", "ts_raw")
    return cv.normalize_datetime(d, include=["ts_raw"])


@q("localize_datetime", with_views(
    "SELECT id, CAST(timezone('UTC', timezone('Asia/Kolkata', try_strptime(ts_raw, "
    "'%Y-%m-%d %H:%M:%S'))) AS TIMESTAMP) AS ts_raw FROM dirty", "dirty"))
def _localize_datetime(spark, sf):
    d = view(spark, sf, "dirty").select("id", "ts_raw")
    return cv.cast_datatypes(d, "datetime", date_format="%Y-%m-%d %H:%M:%S",
                             time_zone="Asia/Kolkata", include=["ts_raw"])


def _zoned(d):
    """Wall clocks, instants with three forms of an offset, and fractions in one column."""
    mark = F.element_at(F.array(*map(F.lit, ["+0200", "Z", "-05:30", ".250", "", ".5+01"])), (F.col("id") % 6 + 1).cast("int"))
    return d.select("id", F.concat("ts_raw", mark).alias("ts_raw"))


_WALL = "SELECT id, CAST(id % 6 AS INTEGER) AS k, try_strptime(ts_raw, '%Y-%m-%d %H:%M:%S') AS w FROM dirty"
_MADRID = "CAST(timezone('UTC', timezone('Europe/Madrid', {})) AS TIMESTAMP)"


@q("localize_aware", with_views(
    "SELECT id, CASE k WHEN 0 THEN w - INTERVAL 2 HOUR WHEN 1 THEN w WHEN 2 THEN w + INTERVAL 330 MINUTE "
    f"WHEN 3 THEN {_MADRID.format('w + INTERVAL 250 MILLISECOND')} WHEN 4 THEN {_MADRID.format('w')} "
    f"ELSE w + INTERVAL 500 MILLISECOND - INTERVAL 1 HOUR END AS ts_raw FROM ({_WALL}) x", "dirty"))
def _localize_aware(spark, sf):
    d = _zoned(view(spark, sf, "dirty"))
    return cv.cast_datatypes(d, "datetime", time_zone="Europe/Madrid", include=["ts_raw"])


@q("parse_offsets", with_views(
    "SELECT id, CASE k WHEN 0 THEN w - INTERVAL 2 HOUR WHEN 1 THEN w WHEN 2 THEN w + INTERVAL 330 MINUTE END AS ts_raw "
    f"FROM ({_WALL}) x", "dirty"))
def _parse_offsets(spark, sf):
    d = _zoned(view(spark, sf, "dirty"))
    return cv.normalize_datetime(d, include=["ts_raw"], fmt="%Y-%m-%d %H:%M:%S%z", time_zone="Asia/Kolkata")


@q("time_of_day", with_views(
    "SELECT id, strftime(try_strptime(substr(ts_raw, 12, 8), '%H:%M:%S'), '%H:%M:%S') AS t "
    "FROM dirty", "dirty"))
def _time_of_day(spark, sf):
    d = view(spark, sf, "dirty").select("id", F.substring("ts_raw", 12, 8).alias("t"))
    return cv.time_of_day(d, "t")
