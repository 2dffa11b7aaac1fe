"""The trend table kept up to date (D1): only what changed is counted again.

Beside the table, partitioned by month (a day has a few rows only), lies a record of what it was made from: per day the number of orders and a checksum
of their customers, per customer a hash of region and category. A refresh compares both with the present tables. Days
with other orders, and days with orders of customers that moved, are changed; the partitions of changed days are recounted and replaced (dynamic
overwrite), all others keep their files. The record is written last, under a new version, so a refresh
that failed on the way is simply made good by the next one, and a repeated refresh changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import _hadoop, drop_scratch, join_uri, write_through
from .dashboard import TREND_KEYS, trend_table
from .rank import global_rank

DAYS = "day date, orders bigint, checksum decimal(38,0)"
CUSTOMERS = "c_custkey bigint, place bigint"
TREND = "region string, trending_date timestamp_ntz, category_title string, videos_count bigint, part date"


def _versions(spark: SparkSession, folder: str) -> list[int]:
    """The complete versions of the record, ascending."""
    fs, p = _hadoop(spark, join_uri(folder, "record"))
    if not fs.exists(p):
        return []
    found = [s.getPath() for s in fs.listStatus(p)]
    done = lambda q: fs.exists(spark._jvm.org.apache.hadoop.fs.Path(q, "customers/_SUCCESS"))
    return sorted(int(q.getName()[1:]) for q in found if q.getName()[:1] == "v" and done(q))


def _part(day):
    return F.trunc(day, "month")


def _from(since):
    """The first day of the partition of a date: partitions are replaced whole."""
    return _part(F.lit(since).cast("date"))


def day_record(orders: DataFrame, since=None) -> DataFrame:
    """(day, orders, checksum): equal for equal multisets of customers."""
    o = orders.where(F.col("o_orderdate").isNotNull()).select("o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderdate")
    if since is not None:
        o = o.where(F.col("day") >= _from(since))
    return o.groupBy("day").agg(F.count("*").alias("orders"),
                                F.sum(F.xxhash64("o_custkey", "o_orderdate").cast("decimal(38,0)")).alias("checksum"))


def customer_record(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """(c_custkey, place): a hash of what the table takes from a customer."""
    geo = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select("n_nationkey", "r_name")
    c = customer.join(geo, customer["c_nationkey"] == geo["n_nationkey"])
    return c.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), F.xxhash64("r_name", "c_mktsegment").alias("place"))


def refresh_trend(orders: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame, folder: str,
                  since=None) -> DataFrame:
    """Bring the table in `folder` up to date; returns (day, change) with change `added`, `changed` or `removed`.

    With `since`, a date, only days from the start of its month on are looked at: earlier orders and moves of customers
    do not reach the table, and a scan partitioned by date stays short."""
    spark = orders.sparkSession
    versions = _versions(spark, folder)
    at = join_uri(folder, "record", f"v{versions[-1]}") if versions else None
    old_days = spark.read.schema(DAYS).parquet(join_uri(at, "days")) if at else spark.createDataFrame([], DAYS)
    old_customers = spark.read.schema(CUSTOMERS).parquet(join_uri(at, "customers")) if at else spark.createDataFrame([], CUSTOMERS)

    days = write_through(day_record(orders, since), "trend-days")
    customers = write_through(customer_record(customer, nation, region), "trend-customers")
    looked = old_days if since is None else old_days.where(F.col("day") >= _from(since))
    o = looked.select("day", F.col("orders").alias("o"), F.col("checksum").alias("c"))
    change = (F.when(F.col("o").isNull(), "added").when(F.col("orders").isNull(), "removed")
              .when((F.col("o") != F.col("orders")) | (F.col("c") != F.col("checksum")), "changed"))
    by_orders = days.join(o, "day", "full").select("day", change.alias("change")).where("change is not null")
    moved = customers.join(old_customers.withColumnRenamed("place", "was"), "c_custkey", "full").where(
        ~F.col("place").eqNullSafe(F.col("was"))).select("c_custkey")
    dated = orders.withColumn("day", F.to_date("o_orderdate"))
    if since is not None:
        dated = dated.where(F.col("day") >= _from(since))
    by_customers = (dated.join(moved, dated["o_custkey"] == moved["c_custkey"], "left_semi").select("day").distinct()
                    .select("day", F.lit("changed").alias("change")).where("day is not null")) if at else by_orders.limit(0)
    changes = write_through(by_orders.union(by_customers).groupBy("day").agg(F.min("change").alias("change")), "trend-changes")

    parts = changes.select(_part("day").alias("part")).distinct()
    table = join_uri(folder, "trend")
    new = trend_table(dated.withColumn("part", _part("day")).join(parts, "part", "left_semi"), customer, nation, region, with_record_id=False)
    new = write_through(new.withColumn("part", _part(F.to_date("trending_date"))), "trend-new")
    (new.repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(table))
    for r in parts.join(new.select("part").distinct(), "part", "left_anti").toLocalIterator():
        drop_scratch(spark, join_uri(table, f"part={r['part']}"))  # nothing is left of the month

    kept = days if since is None else days.union(old_days.where(F.col("day") < _from(since)))
    version = join_uri(folder, "record", f"v{(versions[-1] if versions else 0) + 1}")
    kept.write.mode("overwrite").parquet(join_uri(version, "days"))
    customers.write.mode("overwrite").parquet(join_uri(version, "customers"))
    for v in versions:
        drop_scratch(spark, join_uri(folder, "record", f"v{v}"))
    return changes


def read_trend(spark: SparkSession, folder: str, with_record_id: bool = True) -> DataFrame:
    """The table as `trend_table` gives it."""
    t = spark.read.schema(TREND).parquet(join_uri(folder, "trend")).select(*TREND_KEYS, "videos_count")
    return global_rank(t, TREND_KEYS, name="record_id").select("record_id", *TREND_KEYS, "videos_count") if with_record_id else t
