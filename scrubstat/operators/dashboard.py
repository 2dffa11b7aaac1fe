"""The trend dashboard as aggregations over one table.

Trend table schema: (record_id, region, trending_date, category_title, videos_count).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_through
from .rank import global_rank

TREND_KEYS = ["region", "trending_date", "category_title"]


def trend_table(orders: DataFrame, customer: DataFrame, nation: DataFrame,
                region: DataFrame, with_record_id: bool = True) -> DataFrame:
    """Records per (region, day, category) from the order star schema.

    Orders are first counted per (customer, day) so a customer holding a large share of orders
    reaches the customer join as at most one row per day. Dimension tables are joined as they
    come: the planner broadcasts those whose measured size is under the threshold.
    """
    per_cust_day = (orders.select("o_custkey", "o_orderdate")
                    .groupBy("o_custkey", "o_orderdate").agg(F.count(F.lit(1)).alias("n")))
    geo = (nation.select("n_nationkey", "n_regionkey")
           .join(region.select("r_regionkey", "r_name"),
                 F.col("n_regionkey") == F.col("r_regionkey")))
    cust = (customer.select("c_custkey", "c_nationkey", "c_mktsegment")
            .join(geo, F.col("c_nationkey") == F.col("n_nationkey")))
    joined = per_cust_day.join(cust, F.col("o_custkey") == F.col("c_custkey"))
    agg = (joined.groupBy(F.col("r_name").alias("region"),
                          F.col("o_orderdate").alias("trending_date"),
                          F.col("c_mktsegment").alias("category_title"))
           .agg(F.sum("n").cast("long").alias("videos_count")))
    if not with_record_id:
        return agg
    ranked = global_rank(agg, TREND_KEYS, name="record_id")
    return ranked.select("record_id", *TREND_KEYS, "videos_count")


def trend_filtered(trend: DataFrame, start=None, end=None,
                   regions: Sequence[str] | None = None) -> DataFrame:
    """The common dashboard predicate (date range and region list), applied first."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col("trending_date") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        cond = cond & (F.col("trending_date") <= F.lit(end).cast("timestamp_ntz"))
    if regions:
        cond = cond & F.col("region").isin(list(regions))
    return trend.where(cond)


def trend_history(trend: DataFrame) -> DataFrame:
    """Absolute count by date and category."""
    return (trend.groupBy("trending_date", "category_title")
            .agg(F.sum("videos_count").cast("long").alias("videos_count")))


def _share(df: DataFrame, part_by: Sequence[str], value: str = "videos_count",
           name: str = "pct") -> DataFrame:
    w = Window.partitionBy(*part_by)
    return df.withColumn(name, F.round(F.col(value) * 100.0 / F.sum(value).over(w), 6))


def trend_history_pct(trend: DataFrame) -> DataFrame:
    """D3: a category's share of each day's records, in percent."""
    return _share(trend_history(trend), ["trending_date"])


def region_share(trend: DataFrame) -> DataFrame:
    """A category's share within each region, in percent."""
    agg = (trend.groupBy("region", "category_title")
           .agg(F.sum("videos_count").cast("long").alias("videos_count")))
    return _share(agg, ["region"])


def category_region_pivot(trend: DataFrame, regions: Sequence[str]) -> DataFrame:
    """Counts, category rows x region columns. Region values are given to avoid a job."""
    return (trend.groupBy("category_title").pivot("region", list(regions))
            .agg(F.sum("videos_count").cast("long"))
            .na.fill(0, subset=list(regions)))


def trend_weekly(trend: DataFrame) -> DataFrame:
    """Weekly totals per category (weeks start on Monday)."""
    # date_trunc yields a session-zone TIMESTAMP; back to the wall clock the input uses
    week = F.date_trunc("week", "trending_date").cast("timestamp_ntz")
    return (trend.groupBy(week.alias("week"), "category_title")
            .agg(F.sum("videos_count").cast("long").alias("videos_count")))


def region_vs_rest(trend: DataFrame, focus: str) -> DataFrame:
    """Category shares in one region against all other regions, ranked in the region."""
    in_focus = F.col("region") == F.lit(focus)
    agg = trend.groupBy("category_title").agg(
        F.sum(F.when(in_focus, F.col("videos_count")).otherwise(0)).cast("long").alias("n_region"),
        F.sum(F.when(~in_focus, F.col("videos_count")).otherwise(0)).cast("long").alias("n_rest"))
    tot = agg.agg(F.sum("n_region").alias("_tr"), F.sum("n_rest").alias("_to"))
    out = agg.crossJoin(F.broadcast(tot))  # one-row totals
    out = (out.withColumn("pct_region", F.round(F.try_divide(F.col("n_region") * 100.0,
                                                             F.col("_tr")), 6))
           .withColumn("pct_rest", F.round(F.try_divide(F.col("n_rest") * 100.0,
                                                        F.col("_to")), 6))
           .drop("_tr", "_to"))
    out = out.withColumn("pct_diff", F.round(F.col("pct_region") - F.col("pct_rest"), 6))
    # rank by count (desc), then name: names are unique, so rank = distributed row number.
    # The per-category table is written once so the ranking's passes do not recompute it.
    out = write_through(out, "region-vs-rest")
    ranked = global_rank(out.withColumn("_neg", -F.col("n_region")), ["_neg", "category_title"],
                         name="rank_region")
    return ranked.select(*out.columns, F.col("rank_region").cast("int").alias("rank_region"))


def top_categories(trend: DataFrame, k: int = 3, per_region: bool = True) -> DataFrame:
    """Top-k categories by record count, per region or overall."""
    keys = ["region"] if per_region else []
    agg = (trend.groupBy(*keys, "category_title")
           .agg(F.sum("videos_count").cast("long").alias("videos_count")))
    if not keys:
        # distributed top-k: each task keeps its best k, the driver merges k per task
        order = [F.col("videos_count").desc(), F.col("category_title")]
        top = agg.orderBy(*order).limit(k)
        # at most k rows remain, so numbering them in one window is bounded by k
        return top.withColumn("pos", F.row_number().over(Window.orderBy(*order)))
    w = Window.partitionBy(*keys).orderBy(F.col("videos_count").desc(), F.col("category_title"))
    return agg.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= k)
