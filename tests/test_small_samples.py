"""Tests of normality on very small samples (T8, T9, T11), histograms beside infinite values (H1, H2)."""

import math

import pytest

from scrubstat.operators import distribution as di
from scrubstat.operators import stat_tests as st


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 7])
def test_too_few_rows_give_nulls(spark, n):
    df = frame(spark, [1.0, 2.5, 2.0, 7.0, 3.0, 1.5, 9.0][:n] + [None, float("nan")])
    r = st.dagostino_pearson(df, "x").first()
    assert r["n"] == n and r["statistic"] is None and r["p_value"] is None and r["skew_z"] is None
    a = st.anderson_darling(df, "x").first()
    assert (a["critical_5pct"] is None) == (n < 4)
    assert a["reject_h0"] is None or n >= 4
    if n == 4:
        assert a["critical_5pct"] == round(0.787 / (1 + 4 / 4 - 25 / 16), 3)
    summary = {r["test"]: r for r in st.normality_summary(df, "x").collect()}
    assert len(summary) == 3
    for r in summary.values():
        assert r["statistic"] is None or r["conclusion"] is not None or n < 4


def test_eight_rows_are_enough(spark):
    r = st.dagostino_pearson(frame(spark, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 30.0]), "x").first()
    assert r["statistic"] > 0 and 0 < r["p_value"] < 1
    c = st.dagostino_pearson(frame(spark, [2.0] * 20), "x").first()
    assert c["n"] == 20 and (c["statistic"] is None or math.isnan(c["statistic"]))


@pytest.mark.parametrize("odd", [[float("inf")], [float("-inf"), float("inf")], [float("nan"), None]])
def test_infinite_values_have_no_bin(spark, odd):
    values = [0.0, 1.0, 2.0, 3.0, 4.0]
    plain = [tuple(r) for r in di.histogram(frame(spark, values), "x", bins=4, center=True).orderBy("bin").collect()]
    beside = [tuple(r) for r in di.histogram(frame(spark, values + odd), "x", bins=4, center=True).orderBy("bin").collect()]
    assert beside == plain and [r[3] for r in plain] == [1, 1, 1, 2]
    assert di.bin_counts(frame(spark, values + odd), "x").collect() == di.bin_counts(frame(spark, values), "x").collect()


def test_scatter_and_pairs_leave_infinite_values_out(spark):
    rows = [(float(i % 7), float(i % 5), float(i)) for i in range(40)]
    odd = [(float("inf"), 1.0, 2.0), (1.0, float("-inf"), 2.0), (float("nan"), 1.0, 1.0), (None, 2.0, 3.0)]
    plain, mixed = (spark.createDataFrame(r, "x double, y double, z double") for r in (rows, rows + odd))
    assert sorted(di.scatter_bins(mixed, "x", "y", bins=4).collect()) == sorted(di.scatter_bins(plain, "x", "y", bins=4).collect())
    got, want = ({tuple(r) for r in di.pair_bins(f, ["x", "y"], bins=4).collect()} for f in (mixed, plain))
    assert got == want
