"""Fitted power transforms (A21) against a fine grid of the likelihood."""

import numpy as np
import pytest

from scrubstat.operators import profile as p


def likelihood(x, lam, family):
    if family == "boxcox":
        y, jac = (np.log(x) if lam == 0 else (x ** lam - 1) / lam), np.log(x)
    else:
        a = np.abs(x)
        m = np.where(x >= 0, lam, 2 - lam)
        with np.errstate(divide="ignore", invalid="ignore"):
            y = np.where(m == 0, np.log1p(a), ((1 + a) ** m - 1) / m) * np.where(x >= 0, 1, -1)
        jac = np.sign(x) * np.log1p(a)
    return (lam - 1) * jac.sum() - len(x) / 2 * np.log(y.var())


@pytest.mark.parametrize("family", ["boxcox", "yeojohnson"])
def test_fit_is_the_maximum(spark, family):
    rng = np.random.default_rng(3)
    x = rng.gamma(2.0, 3.0, 400) if family == "boxcox" else rng.gamma(2.0, 3.0, 400) - 4
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),), (float("inf"),)] + [(-1.0,)] * (family == "boxcox"), "x double")
    lam = p.power_fit(df, "x", family)
    grid = lam + np.linspace(-2e-3, 2e-3, 41)  # a parabola through the top is finer than its values
    a, b, _ = np.polyfit(grid - lam, [likelihood(x, g, family) - likelihood(x, lam, family) for g in grid], 2)
    assert a < 0 and abs(-b / (2 * a)) < 1e-6
    out = p.power_transform(df, "x", family, out="y").where("x < 1e300 and x > -1").collect()
    want = {float(v): w for v, w in zip(x, (x ** lam - 1) / lam)} if family == "boxcox" else None
    for r in out:
        assert r["y"] is not None and (want is None or r["y"] == pytest.approx(want[r["x"]], rel=1e-9))


def test_nothing_to_fit(spark):
    for rows in ([], [(None,)], [(2.0,)] * 5):
        df = spark.createDataFrame(rows, "x double")
        assert p.power_fit(df, "x", "yeojohnson") is None
        assert all(r["x"] is None for r in p.power_transform(df, "x").collect())
    assert p.power_fit(spark.createDataFrame([(-1.0,), (-2.0,)], "x double"), "x", "boxcox") is None
    with pytest.raises(ValueError):
        p.power_fit(spark.createDataFrame([(1.0,), (2.0,)], "x double"), "x", "other")
