import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scrubstat.operators import profile as p
from scrubstat.operators.rank import exact_quantiles, global_rank


def test_moments_vs_pandas(spark):
    rng = np.random.default_rng(1)
    x = rng.gamma(2.0, 3.0, 500)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    r = p.moments(df, ["x"]).first()
    s = pd.Series(x)
    assert r.n == 500
    assert r.mean == pytest.approx(s.mean(), rel=1e-12)
    assert r.std == pytest.approx(s.std(), rel=1e-12)
    assert r.skew == pytest.approx(s.skew(), rel=1e-9)
    assert r.kurt == pytest.approx(s.kurt(), rel=1e-9)


def test_moments_constant_and_short(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 2.0), (2.0, None), (2.0, None)],
                               "c double, s double")
    rows = {r.column_name: r for r in p.moments(df).collect()}
    assert rows["c"].skew == 0.0 and rows["c"].kurt == 0.0
    assert rows["s"].skew is None and rows["s"].kurt is None


def test_nan_median(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")
    r = p.describe_numeric(df, ["x"]).first()
    assert r.q50 == 2.0 and r["count"] == 2


def test_quantiles_vs_numpy_with_ties_and_groups(spark):
    rng = np.random.default_rng(2)
    vals = np.concatenate([rng.integers(0, 20, 3000), np.full(2000, 7)]).astype(float)
    grp = np.where(np.arange(vals.size) % 3 == 0, "a", "b")
    df = spark.createDataFrame([(g, float(v)) for g, v in zip(grp, vals)], "g string, x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    out = {r.g: r for r in exact_quantiles(df, "x", probs, ["g"], buckets=16).collect()}
    for g in ("a", "b"):
        want = np.quantile(vals[grp == g], probs)
        got = [out[g][f"q{int(round(pr * 100))}"] for pr in probs]
        assert got == pytest.approx(list(want), abs=1e-9)


def test_global_rank_is_row_number(spark):
    rng = np.random.default_rng(3)
    vals = rng.integers(0, 50, 2000)
    df = spark.createDataFrame([(i, int(v)) for i, v in enumerate(vals)], "id long, v long")
    ranked = global_rank(df, ["v", "id"], buckets=16).toPandas().sort_values("rank")
    assert list(ranked["rank"]) == list(range(1, 2001))
    assert list(ranked["v"]) == sorted(vals)


def test_correlation_constant_column(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)], "a double, b double")
    r = p.correlation_pairs(df).first()
    assert r.r is None and r.strength == "Undefined"


def test_central_trend_zero_mean(spark):
    df = spark.createDataFrame([(-1.0,), (1.0,)], "x double")
    r = p.central_trend(df, ["x"]).first()
    assert r.central == "undefined" and r.cv is None


def test_iqr_outliers_invalid_bound(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError):
        p.iqr_outliers(df, "x", bound="middle")


def test_global_rank_reads_its_input_once_and_splits_identical_rows(spark, sf):
    from scrubstat.operators.rank import _search, global_rank
    df = spark.range(3000).selectExpr("cast(7 as int) as x")
    out = global_rank(df, ["x"], buckets=16)
    assert sorted(r["rank"] for r in out.collect()) == list(range(1, 3001))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Range (" not in plan  # only the written table is read
    hit = spark.range(5000).select(_search(F.col("id"), [F.lit(b) for b in range(0, 4000, 4)]).alias("n"), "id")
    assert hit.where("n != least(1000, id div 4 + 1)").count() == 0


def test_trend_table_plan_reads_orders_once(spark, sf):
    from scrubstat.plans.tables import trend
    out = trend(spark, sf, with_record_id=True)
    # orders are read by the job that writes the trend; numbering and totals read what it wrote
    assert out.inputFiles() and not any("orders" in f for f in out.inputFiles())
