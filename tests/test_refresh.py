"""Daily refresh of the trend table."""

import glob
import os

from pyspark.sql import functions as F

from scrubstat.operators.dashboard import trend_table
from scrubstat.operators.refresh import _versions, read_trend, refresh_trend
from scrubstat.plans.tables import table
from scrubstat.session import write_through


def files(folder):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{folder}/trend/part=*/*.parquet")}


def test_refreshes_equal_a_rebuild(spark, sf, tmp_path):
    o, c, n, r = (table(spark, sf, t) for t in ("orders", "customer", "nation", "region"))
    o = write_through(o.where("o_orderdate < TIMESTAMP_NTZ '1995-03-01'").withColumn("day", F.to_date("o_orderdate")), "few-orders")
    folder = str(tmp_path / "t")

    def refresh(orders, customer=c, **options):
        before = files(folder)
        changes = {x["day"].isoformat(): x["change"] for x in refresh_trend(orders, customer, n, r, folder, **options).collect()}
        after = files(folder)
        touched = {p.split("part=")[1][:7] for p in before.keys() | after.keys() if before.get(p) != after.get(p)}
        assert touched <= {d[:7] for d in changes}
        return changes

    def equal(orders, customer=c):
        assert sorted(read_trend(spark, folder).collect()) == sorted(trend_table(orders, customer, n, r).collect())

    jan, feb = o.where("day < '1995-01-20'"), o.where("day < '1995-02-10'")
    assert set(refresh(jan).values()) == {"added"}
    equal(jan)
    added = refresh(feb)
    assert set(added.values()) == {"added"} and min(added) >= "1995-01-20"
    equal(feb)
    assert refresh(feb) == {}  # the same day twice
    equal(feb)

    first = min(x["day"] for x in jan.select("day").distinct().collect())
    late = feb.union(jan.where(F.col("day") == F.lit(first)).limit(1))
    assert refresh(late) == {first.isoformat(): "changed"}
    equal(late)
    without = late.where(F.col("day") != F.lit(first))
    assert refresh(without) == {first.isoformat(): "removed"}
    equal(without)

    # A customer that moves changes the days of its orders.
    who = without.first()["o_custkey"]
    moved = write_through(c.withColumn("c_mktsegment", F.when(F.col("c_custkey") == who, "MOVED").otherwise(F.col("c_mktsegment"))), "moved")
    days = {x["day"].isoformat() for x in without.where(F.col("o_custkey") == who).collect()}
    assert refresh(without, moved) == dict.fromkeys(days, "changed")
    equal(without, moved)
    gone = write_through(moved.where(F.col("c_custkey") != who), "gone")
    refresh(without, gone)
    equal(without, gone)

    # Only recent days are looked at.
    early = o.where("day < '1995-01-05'")  # late orders that come before it
    some = o.where("day >= '1995-01-05'").unionByName(early.union(early))
    changes = refresh(some, gone, since="1995-02-17")
    assert changes and min(changes) >= "1995-02-01"
    assert refresh(some, gone, since="1995-02-17") == {}
    refresh(o, gone)
    equal(o, gone)


def test_a_failed_refresh_is_made_good(spark, sf, tmp_path, monkeypatch):
    o, c, n, r = (table(spark, sf, t) for t in ("orders", "customer", "nation", "region"))
    o = write_through(o.where("o_orderdate < TIMESTAMP_NTZ '1995-01-20'"), "few-orders")
    half = o.where("o_orderdate < TIMESTAMP_NTZ '1995-01-10'")
    folder = str(tmp_path / "t")
    refresh_trend(half, c, n, r, folder)
    kept = _versions(spark, folder)
    from scrubstat.operators import refresh
    with monkeypatch.context() as m:  # the table is written, the record is not
        m.setattr(refresh, "drop_scratch", lambda *a: None)
        refresh_trend(o, c, n, r, folder)
    os.remove(f"{folder}/record/v{kept[-1] + 1}/customers/_SUCCESS")
    assert _versions(spark, folder) == kept
    refresh_trend(o, c, n, r, folder)
    assert sorted(read_trend(spark, folder).collect()) == sorted(trend_table(o, c, n, r).collect())


def test_empty_orders(spark, sf, tmp_path):
    o, c, n, r = (table(spark, sf, t) for t in ("orders", "customer", "nation", "region"))
    folder = str(tmp_path / "t")
    few = o.where("o_orderdate < TIMESTAMP_NTZ '1995-01-05'")
    refresh_trend(few, c, n, r, folder)
    assert set(x["change"] for x in refresh_trend(o.limit(0), c, n, r, folder).collect()) <= {"removed"}
    assert files(folder) == {}
