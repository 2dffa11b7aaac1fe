"""Registered queries over odd inputs (the `edge` view): each oracle is written from the definition."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..columns import round_all
from ..operators import clean, convert, distribution, profile
from .registry import make_registry
from .tables import view, with_views

Q, q = make_registry()

_OK = "SELECT id, noisy FROM edge WHERE NOT isnan(noisy)"


@q("iqr_outliers_nan", with_views(
    f"WITH v AS ({_OK}), b AS (SELECT quantile_cont(noisy, 0.25) AS q1, quantile_cont(noisy, 0.75) AS q3 FROM v) SELECT id, noisy, "
    "CASE WHEN noisy < q1 THEN 'lower' ELSE 'upper' END AS side FROM v, b WHERE noisy < q1 - 1.5 * (q3 - q1) OR noisy > q3 + 1.5 * (q3 - q1)",
    "edge"))
def _iqr_outliers_nan(spark, sf):
    return profile.iqr_outliers(view(spark, sf, "edge").select("id", "noisy"), "noisy")


@q("box_inlier_points", with_views(
    f"WITH v AS ({_OK}), b AS (SELECT quantile_cont(noisy, 0.25) AS q1, quantile_cont(noisy, 0.75) AS q3 FROM v) SELECT noisy AS value, "
    "CAST(count(*) AS BIGINT) AS n FROM v, b WHERE noisy >= q1 - 1.5 * (q3 - q1) AND noisy <= q3 + 1.5 * (q3 - q1) GROUP BY noisy", "edge"))
def _box_inlier_points(spark, sf):
    return profile.box_inlier_points(view(spark, sf, "edge"), "noisy")


@q("histogram_constant", with_views(
    "SELECT CAST(r.range AS INTEGER) AS bin, 5.0::DOUBLE AS bin_left, 5.0::DOUBLE AS bin_right, CASE WHEN r.range = 0 THEN "
    "(SELECT count(*) FROM edge) ELSE 0 END AS n FROM range(4) r", "edge"))
def _histogram_constant(spark, sf):
    return distribution.histogram(view(spark, sf, "edge"), "same", 4)


@q("fill_missing_int", with_views(
    "SELECT id, coalesce(whole::DOUBLE, round((SELECT avg(whole) FROM edge), 9)) AS whole FROM edge", "edge"))
def _fill_missing_int(spark, sf):
    out = clean.fill_missing(view(spark, sf, "edge").select("id", "whole"), {"whole": "mean"})
    return out.select("id", F.round("whole", 9).alias("whole"))


@q("to_numeric_large", with_views("SELECT id, large_raw::DOUBLE AS large_raw FROM edge", "edge"))
def _to_numeric_large(spark, sf):
    return convert.convert_to_numeric(view(spark, sf, "edge").select("id", "large_raw"), None, include=["large_raw"])


@q("central_trend_empty", with_views(
    "SELECT 'nothing' AS column_name, CAST(count(nothing) AS BIGINT) AS n, 'empty' AS central FROM edge", "edge"))
def _central_trend_empty(spark, sf):
    return profile.central_trend(view(spark, sf, "edge"), ["nothing"]).select("column_name", "n", "central")


_SEC = "epoch(day)"


@q("describe_all_types", with_views(
    "SELECT 'nothing' AS column_name, 0::BIGINT AS count, NULL::BIGINT AS \"unique\", NULL::VARCHAR AS top, NULL::BIGINT AS freq, "
    "NULL::DOUBLE AS mean, NULL::DOUBLE AS min, NULL::DOUBLE AS q50, NULL::DOUBLE AS max FROM (SELECT 1) "
    f"UNION ALL SELECT 'day', count(day), NULL, NULL, NULL, round(avg({_SEC}), 6), min({_SEC})::DOUBLE, "
    f"quantile_cont({_SEC}, 0.5)::DOUBLE, max({_SEC})::DOUBLE FROM edge UNION ALL SELECT 'flag', count(flag), count(DISTINCT flag), "
    "CASE WHEN count(*) FILTER (flag) > count(*) FILTER (NOT flag) THEN 'true' ELSE 'false' END, greatest(count(*) FILTER (flag), "
    "count(*) FILTER (NOT flag)), NULL, NULL, NULL, NULL FROM edge", "edge"))
def _describe_all_types(spark, sf):
    out = profile.describe_all(view(spark, sf, "edge").select("nothing", "day", "flag"))
    return round_all(out.select("column_name", "count", "unique", "top", "freq", "mean", "min", "q50", "max"))
