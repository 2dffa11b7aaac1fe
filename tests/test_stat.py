import numpy as np
import pytest

from scrubstat.functions import special as sp
from scrubstat.operators import stat_tests as st

SAMPLE = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]


@pytest.fixture(scope="module")
def sample(spark):
    return spark.createDataFrame([(float(x),) for x in SAMPLE], "x double")


def test_shapiro_published(sample):
    r = st.shapiro_wilk(sample, "x").first()
    assert r.statistic == pytest.approx(0.788815, abs=1e-6)
    assert r.p_value == pytest.approx(0.006703814, rel=1e-6)


def test_dagostino_published(sample):
    r = st.dagostino_pearson(sample, "x").first()
    assert r.statistic == pytest.approx(13.034263, abs=1e-6)
    assert r.p_value == pytest.approx(0.001477902, rel=1e-6)


def test_anderson_published(sample):
    r = st.anderson_darling(sample, "x").first()
    assert r.statistic == pytest.approx(0.946772, abs=1e-6)
    assert r.critical_5pct == 0.68 and r.reject_h0


def test_anderson_ties_equal_pairwise(spark):
    vals = [1.0, 2.0, 2.0, 2.0, 3.0, 5.0, 5.0, 8.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = st.anderson_darling(df, "x").first()
    x = np.sort(vals)
    z = (x - x.mean()) / x.std(ddof=1)
    n = len(x)
    cdf = np.array([sp.phi(v) for v in z])
    i = np.arange(1, n + 1)
    a2 = -n - np.sum((2 * i - 1) * (np.log(cdf) + np.log(1 - cdf[::-1]))) / n
    assert r.statistic == pytest.approx(a2, rel=1e-9)


def test_shapiro_without_an_answer(spark):
    few = st.shapiro_wilk(spark.createDataFrame([(1.0,), (2.0,)], "x double"), "x").first()
    flat = st.shapiro_wilk(spark.createDataFrame([(1.0,)] * 30, "x double"), "x").first()
    assert (few.n, few.statistic, few.p_value) == (2, None, None) and (flat.n, flat.statistic, flat.p_value) == (30, None, None)
    ad = st.anderson_darling(spark.createDataFrame([(1.0,)] * 30, "x double"), "x").first()
    assert ad.n == 30 and ad.statistic is None


def test_shapiro_and_summary_on_both_sides_of_5000(spark):
    rng = np.random.default_rng(2)
    for n in (4_999, 5_001):
        df = spark.createDataFrame([(float(v),) for v in rng.normal(size=n)], "x double")
        r = st.shapiro_wilk(df, "x").first()
        assert r.n == n and r.calibrated == (n <= 5000) and r.statistic > 0.99 and r.p_value > 1e-4
        rows = st.normality_summary(df, "x").collect()
        assert len(rows) == 3 and all(x.statistic is not None and x.conclusion for x in rows)


def test_positions_of_a_hot_value(spark):
    df = spark.range(90_000).selectExpr("cast(if(id % 3 = 0, 7, id) as double) as x")
    pos = st._positions(df, "x")
    r = pos.selectExpr("count(*)", "count(distinct i)", "min(i)", "max(i)").first()
    assert tuple(r) == (90_000, 90_000, 1, 90_000)
    assert pos.where("sample = 7").count() == 30_001  # 7 itself too
    assert pos.where("sample = 7").selectExpr("max(i) - min(i)").first()[0] == 30_000


def test_array_tails_equal_scalar_ones():
    x = np.array([0.0, 0.1, 0.9, 1.0, 2.5, 7.0, 30.0])
    for a in (0.5, 1.0, 2.0, 9.5):
        assert sp.gammainc_lower_array(a, x) == pytest.approx([1 - sp.gammainc_upper(a, v) for v in x], abs=1e-13)
    y = np.array([0.0, 0.01, 0.3, 0.5, 0.77, 0.999, 1.0])
    for a, b in ((0.5, 0.5), (2.0, 3.0), (2.5, 0.5), (30.0, 4.0)):
        assert sp.betainc_array(a, b, y) == pytest.approx([sp.betainc(a, b, v) for v in y], abs=1e-13)


def test_published_quantiles_of_the_families(spark):
    df = spark.createDataFrame([(0.95,), (0.5,)], "p double")
    want = {("chi2", 4.0): (9.487729036781154, 3.3566939800333233), ("t", 5.0): (2.015048372669157, 0.0),
            ("gamma", 2.0): (4.743864518390577, 1.6783469900166608), ("beta", 2.0): (0.75139546, 0.38572757)}
    for (dist, a), qs in want.items():
        prm = {"df": a} if dist in ("chi2", "t") else {"a": a, "b": 3.0}
        got = [r.v for r in df.select(st.ppf(dist, df["p"], prm).alias("v")).collect()]
        assert got == pytest.approx(list(qs), abs=1e-7)


def test_t_and_levene(spark):
    a, b = [1, 2, 3, 4, 5], [2, 4, 6, 8, 10, 12]
    df = spark.createDataFrame([("a", float(v)) for v in a] + [("b", float(v)) for v in b],
                               "g string, x double")
    lev = st.levene(df, "g", "x").first()
    assert lev.statistic == pytest.approx(4.230174, abs=1e-6)
    pooled = st.ttest(df, "g", "x", "a", "b", True).first()
    assert pooled.t == pytest.approx(-2.2156468, abs=1e-6) and pooled.df == 9
    assert pooled.p_value == pytest.approx(0.0539459, abs=1e-6)
    welch = st.ttest(df, "g", "x", "a", "b", False).first()
    assert welch.df == pytest.approx(6.97225573, abs=1e-6)
    d = st.ttest_decision(df, "g", "x", "a", "b").first()
    assert d.test == "pooled" and d.reject_h0 is False


def test_distribution_tails():
    assert sp.t_sf2(2.0, 10) == pytest.approx(0.0733880348, rel=1e-8)
    assert sp.f_sf(3.0, 2, 20) == pytest.approx(0.0725381503, rel=1e-8)
    assert sp.chi2_sf(3.84145882, 1) == pytest.approx(0.05, rel=1e-6)


def test_qq_positions_and_fit(spark):
    df = spark.createDataFrame([(float(v),) for v in SAMPLE], "x double")
    pts = st.qq_points(df, "x").orderBy("i").collect()
    n = len(SAMPLE)
    assert pts[0].i == 1 and pts[-1].i == n
    assert pts[-1].theoretical == pytest.approx(sp.phi_inv(0.5 ** (1 / n)), rel=1e-12)
    assert [p.sample for p in pts] == sorted(SAMPLE)
    assert pts[-1].is_outlier
    fit = st.qq_fit(st.qq_points(df, "x")).first()
    assert 0.8 < fit.r < 1.0


def test_qq_expon_closed_form(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 11)], "x double")
    pts = st.qq_points(df, "x", "expon").orderBy("i").collect()
    p = (5 - 0.3175) / (10 + 0.365)
    assert pts[4].theoretical == pytest.approx(-np.log1p(-p), rel=1e-12)


def test_gamma_ppf_udf(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 6)], "x double")
    pts = st.qq_points(df, "x", "gamma", {"a": 1.0}).orderBy("i").collect()
    p = (3 - 0.3175) / (5 + 0.365)
    assert pts[2].theoretical == pytest.approx(-np.log1p(-p), rel=1e-9)
