"""Dates with offsets, zones and fractions (C20, C21) under several session zones."""

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from scrubstat.functions.parsing import parse_zoned
from scrubstat.operators.convert import normalize_datetime

ZONES = ["UTC", "America/New_York", "Asia/Kolkata"]
TARGETS = ["UTC", "Europe/Madrid", "Pacific/Auckland"]
# Hours that one of the zones skips or repeats are among them.
CLOCKS = ["2024-06-01 12:00:00", "2024-03-10 02:30:00", "2024-11-03 01:30:00", "2024-03-31 01:30:00", "1999-12-31 23:59:59"]
OFFSETS = ["+0200", "+02:00", "-0530", "Z", "+0000"]


@pytest.fixture(params=ZONES)
def zone(spark, request):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", old)


def as_utc(text, offset, target):
    wall = datetime.fromisoformat(text)
    if offset:
        h = offset.replace(":", "").replace("Z", "+0000")
        shift = timedelta(hours=int(h[1:3]), minutes=int(h[3:5] or 0))
        return wall - shift if h[0] == "+" else wall + shift
    return wall.replace(tzinfo=ZoneInfo(target)).astimezone(timezone.utc).replace(tzinfo=None)


@pytest.mark.parametrize("target", TARGETS)
def test_offsets_and_walls(spark, zone, target):
    skipped = {("Europe/Madrid", "2024-03-31 01:30:00")}
    rows = [(c + o, c, o) for c in CLOCKS for o in OFFSETS]
    plain = [(c, c, "") for c in CLOCKS if (target, c) not in skipped]
    df = spark.createDataFrame(rows, "t string, c string, o string")
    got = normalize_datetime(df, include=["t"], fmt="%Y-%m-%d %H:%M:%S%z", time_zone=target).collect()
    assert [r["t"] for r in got] == [as_utc(c, o, target) for _, c, o in rows]
    mixed = spark.createDataFrame(rows + plain, "t string, c string, o string")
    got = normalize_datetime(mixed, include=["t"], time_zone=target).collect()
    assert [r["t"] for r in got] == [as_utc(c, o, target) for _, c, o in rows + plain]


def test_forms_without_a_format(spark, zone):
    want = {"2024-06-01T12:00:00+02:00": datetime(2024, 6, 1, 10), "2024-06-01T12:00:00Z": datetime(2024, 6, 1, 12),
            "2024-06-01 12:00:00.5": datetime(2024, 6, 1, 12, 0, 0, 500000), "2024-06-01T12:00:00.123456789Z": datetime(2024, 6, 1, 12, 0, 0, 123456),
            "2024-06-01 12:00 -03": datetime(2024, 6, 1, 15), "2024-06-01 12:00:00 UTC": datetime(2024, 6, 1, 12),
            "2024-06-01 12:00:00 America/New_York": datetime(2024, 6, 1, 16), "2024-06-01": datetime(2024, 6, 1),
            "2024-05-10": datetime(2024, 5, 10), "01/06/2024 07:08:09": datetime(2024, 6, 1, 7, 8, 9),
            "2024-02-30T00:00:00Z": None, "2024-06-01 25:00:00+0100": None, "soon": None, "": None, None: None}
    rows = [(t,) for t in want]
    got = normalize_datetime(spark.createDataFrame(rows, "t string"), include=["t"]).collect()
    assert [r["t"] for r in got] == list(want.values())


def test_the_zone_is_kept(spark, zone):
    df = spark.createDataFrame([("2024-06-01 12:00:00-05:30",), ("2024-06-01 12:00:00",), ("bad",)], "t string")
    got = df.select(parse_zoned(F.col("t")).alias("z")).select("z.*").collect()
    assert [tuple(r) for r in got] == [(datetime(2024, 6, 1, 17, 30), "-05:30"), (datetime(2024, 6, 1, 12), None), (None, None)]
    named = spark.createDataFrame([("2024-06-01 12:00:00 Europe/Madrid",), ("2024-06-01 12:00:00 UTC",)], "t string")
    got = named.select(parse_zoned(F.col("t"), "%Y-%m-%d %H:%M:%S %Z").alias("z")).select("z.*").collect()
    assert [tuple(r) for r in got] == [(datetime(2024, 6, 1, 10), "Europe/Madrid"), (datetime(2024, 6, 1, 12), "UTC")]
