"""Mergeable quantile sketches (A5, exact=False) against the sorted values."""

import bisect
import glob
import os

import pytest
from pyspark.sql import functions as F

from scrubstat.operators import profile as p
from scrubstat.operators import sketches as sk

PROBS = [0.0, 0.01, 0.1, 0.5, 0.9, 0.99, 1.0]


def near(values, q, prob, k=sk.K):
    lo, hi = bisect.bisect_left(values, q) / len(values), bisect.bisect_right(values, q) / len(values)
    return lo - 2 * sk.rank_error(k) <= prob <= hi + 2 * sk.rank_error(k)


@pytest.fixture(scope="module")
def data(spark):
    x = F.pmod(F.xxhash64("id"), F.lit(100003))
    return spark.range(60_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 10).cast("int").alias("part"),
                                      F.when(F.col("id") % 7 == 0, 5.0).otherwise(x / 7).alias("x"), F.lit(None).cast("double").alias("none"))


def test_whole_and_merged_lie_within_the_bound(spark, data):
    values = {}
    for r in data.collect():
        values.setdefault(r["g"], []).append(r["x"])
    values = {g: sorted(v) for g, v in values.items()}
    names = [f"a{i}" for i in range(len(PROBS))]
    parts = sk.quantile_sketches(data, ["x", "none"], ["g", "part"])
    assert parts.count() == 30  # no row for a column without values
    for made in (sk.quantile_sketches(data, ["x"], ["g"]), sk.merge_sketches(parts, ["g"])):
        rows = sk.sketch_quantiles(made, PROBS, names).collect()
        assert len(rows) == 3
        for r in rows:
            v = values[r["g"]]
            assert r["n"] == len(v) and r["a0"] == v[0] and r["a6"] == v[-1]
            assert all(near(v, r[n], q) for n, q in zip(names, PROBS))


def test_the_argument_exact(spark, data):
    r = p.quantiles(data, "x", [0.25, 0.5], names=["a", "b"], exact=False).first()
    v = sorted(x["x"] for x in data.collect())
    assert near(v, r["a"], 0.25) and near(v, r["b"], 0.5)
    some = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    assert tuple(p.quantiles(some, "x", [0.0, 1.0], names=["a", "b"], exact=False).first()) == (1.0, 3.0)
    assert p.quantiles(some.limit(0), "x", [0.5], exact=False).collect() == []


def test_days_are_stored_one_by_one(spark, data, tmp_path):
    folder = str(tmp_path / "s")
    dated = data.withColumn("d", F.date_add(F.lit("2024-01-01").cast("date"), F.col("part")))
    sk.store_sketches(dated.where("part < 8"), "d", folder, ["x"], ["g"])
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/d=*/*.parquet")}
    sk.store_sketches(dated.where("part >= 7"), "d", folder, ["x"], ["g"])  # one day again, two new ones
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/d=*/*.parquet")}
    assert {f for f in before if after.get(f) != before[f]} == {f for f in before if "2024-01-08" in f}
    merged = sk.sketch_quantiles(sk.merge_sketches(sk.read_sketches(spark, folder)), [0.5], ["m"]).first()
    assert merged["n"] == 60_000 and near(sorted(x["x"] for x in data.collect()), merged["m"], 0.5)
