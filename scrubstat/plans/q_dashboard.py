"""Registered queries D1-D8, P6."""

from __future__ import annotations

import uuid

from ..operators import dashboard as d
from ..operators.refresh import read_trend, refresh_trend
from ..session import scratch_path
from .registry import make_registry
from .tables import REGIONS, table, trend, with_views

Q, q = make_registry()


@q("trend_table", with_views("SELECT * FROM trend", "trend"))
def _trend_table(spark, sf):
    return trend(spark, sf, with_record_id=True)


@q("trend_refresh", with_views("SELECT * FROM trend", "trend"))
def _trend_refresh(spark, sf):
    """Three refreshes as the orders come in, the second of them made twice, and late orders in the last."""
    folder = scratch_path(spark, f"trend-{uuid.uuid4().hex}")
    o, c, n, r = (table(spark, sf, t) for t in ("orders", "customer", "nation", "region"))
    first = o.where("o_orderdate < TIMESTAMP_NTZ '1998-01-01' and o_orderkey % 50 != 7")
    second = o.where("o_orderdate < TIMESTAMP_NTZ '2000-01-01' and o_orderkey % 50 != 7")
    for orders in (first, second, second, o):
        refresh_trend(orders, c, n, r, folder)
    return read_trend(spark, folder)


@q("trend_filtered", with_views(
    "SELECT region, category_title, CAST(sum(videos_count) AS BIGINT) AS videos_count FROM trend "
    "WHERE trending_date >= TIMESTAMP '1996-01-01 00:00:00' "
    "AND trending_date <= TIMESTAMP '1998-12-31 00:00:00' AND region IN ('ASIA', 'EUROPE') "
    "GROUP BY region, category_title", "trend"))
def _trend_filtered(spark, sf):
    from pyspark.sql import functions as F
    t = d.trend_filtered(trend(spark, sf), "1996-01-01 00:00:00", "1998-12-31 00:00:00",
                         ["ASIA", "EUROPE"])
    return (t.groupBy("region", "category_title")
            .agg(F.sum("videos_count").cast("long").alias("videos_count")))


@q("trend_history", with_views(
    "SELECT trending_date, category_title, CAST(sum(videos_count) AS BIGINT) AS videos_count "
    "FROM trend GROUP BY trending_date, category_title", "trend"))
def _trend_history(spark, sf):
    return d.trend_history(trend(spark, sf))


@q("trend_history_pct", with_views(
    "SELECT trending_date, category_title, videos_count, "
    "round(videos_count * 100.0 / sum(videos_count) OVER (PARTITION BY trending_date), 6) AS pct "
    "FROM (SELECT trending_date, category_title, CAST(sum(videos_count) AS BIGINT) AS videos_count "
    "FROM trend GROUP BY trending_date, category_title) h", "trend"))
def _trend_history_pct(spark, sf):
    return d.trend_history_pct(trend(spark, sf))


@q("region_share", with_views(
    "SELECT region, category_title, videos_count, "
    "round(videos_count * 100.0 / sum(videos_count) OVER (PARTITION BY region), 6) AS pct "
    "FROM (SELECT region, category_title, CAST(sum(videos_count) AS BIGINT) AS videos_count "
    "FROM trend GROUP BY region, category_title) h", "trend"))
def _region_share(spark, sf):
    return d.region_share(trend(spark, sf))


_PIVOT_COLS = ", ".join(
    f"CAST(coalesce(sum(CASE WHEN region = '{r}' THEN videos_count END), 0) AS BIGINT) AS \"{r}\""
    for r in REGIONS)


@q("category_region_pivot", with_views(
    f"SELECT category_title, {_PIVOT_COLS} FROM trend GROUP BY category_title", "trend"))
def _category_region_pivot(spark, sf):
    return d.category_region_pivot(trend(spark, sf), REGIONS)


@q("trend_weekly", with_views(
    "SELECT date_trunc('week', trending_date) AS week, category_title, "
    "CAST(sum(videos_count) AS BIGINT) AS videos_count FROM trend "
    "GROUP BY date_trunc('week', trending_date), category_title", "trend"))
def _trend_weekly(spark, sf):
    return d.trend_weekly(trend(spark, sf))


@q("region_vs_rest", with_views(
    "SELECT category_title, n_region, n_rest, round(n_region * 100.0 / sum(n_region) OVER (), 6) "
    "AS pct_region, round(n_rest * 100.0 / sum(n_rest) OVER (), 6) AS pct_rest, "
    "round(round(n_region * 100.0 / sum(n_region) OVER (), 6) - round(n_rest * 100.0 / "
    "sum(n_rest) OVER (), 6), 6) AS pct_diff, "
    "CAST(rank() OVER (ORDER BY n_region DESC, category_title) AS INTEGER) AS rank_region FROM ("
    "SELECT category_title, CAST(sum(CASE WHEN region = 'AMERICA' THEN videos_count ELSE 0 END) "
    "AS BIGINT) AS n_region, CAST(sum(CASE WHEN region <> 'AMERICA' THEN videos_count ELSE 0 END) "
    "AS BIGINT) AS n_rest FROM trend GROUP BY category_title) a", "trend"))
def _region_vs_rest(spark, sf):
    return d.region_vs_rest(trend(spark, sf), "AMERICA")


@q("top_categories", with_views(
    "SELECT * FROM (SELECT region, category_title, videos_count, CAST(row_number() OVER "
    "(PARTITION BY region ORDER BY videos_count DESC, category_title) AS INTEGER) AS pos FROM "
    "(SELECT region, category_title, CAST(sum(videos_count) AS BIGINT) AS videos_count FROM trend "
    "GROUP BY region, category_title) a) b WHERE pos <= 3", "trend"))
def _top_categories(spark, sf):
    return d.top_categories(trend(spark, sf), 3)


@q("top_categories_overall", with_views(
    "SELECT category_title, videos_count, CAST(row_number() OVER (ORDER BY videos_count DESC, "
    "category_title) AS INTEGER) AS pos FROM (SELECT category_title, CAST(sum(videos_count) AS "
    "BIGINT) AS videos_count FROM trend GROUP BY category_title) a ORDER BY videos_count DESC, "
    "category_title LIMIT 3", "trend"))
def _top_categories_overall(spark, sf):
    return d.top_categories(trend(spark, sf), 3, per_region=False)
