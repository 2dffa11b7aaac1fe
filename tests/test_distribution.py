import numpy as np
import pytest

from scrubstat.operators import distribution as d


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    x = np.round(rng.gamma(2.0, 10.0, 3000), 2)
    return x, spark.createDataFrame([(float(v),) for v in x], "x double")


def test_histogram_matches_numpy(data):
    x, df = data
    counts, edges = np.histogram(x, bins=17)
    rows = d.histogram(df, "x", 17).orderBy("bin").collect()
    assert [r.n for r in rows] == list(counts)
    assert [r.bin_left for r in rows] == pytest.approx(list(edges[:-1]))


def test_last_bin_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "x double")
    rows = d.histogram(df, "x", 5).orderBy("bin").collect()
    assert rows[-1].n == 3 and sum(r.n for r in rows) == 11


def test_histogram_edges(data):
    x, df = data
    edges = d.arange_edges(0, 100, 7.5)
    counts, _ = np.histogram(x, bins=edges)
    rows = d.histogram_edges(df, "x", edges).orderBy("bin").collect()
    assert [r.n for r in rows] == list(counts)


def test_bins_iqr_zero_falls_back(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 1.0, 1.0, 1.0, 9.0]], "x double")
    rows = {r.method: r.bins for r in d.bin_counts(df, "x").collect()}
    assert rows["fd"] == rows["sturges"] == 4
    with pytest.raises(ValueError):
        d.bin_counts(df, "x", ["nope"])


def test_ecdf_ends_at_one(data):
    _, df = data
    rows = d.ecdf(df, "x").orderBy("value").collect()
    assert rows[-1].ecdf == 1.0
    assert all(a.ecdf < b.ecdf for a, b in zip(rows, rows[1:]))


def test_kde_integrates_to_one_and_matches_formula(data):
    x, df = data
    rows = d.kde_curve(df, "x", 400, lo=float(x.min()) - 40, hi=float(x.max()) + 40) \
        .orderBy("i").collect()
    g = np.array([r.x for r in rows])
    f = np.array([r.density for r in rows])
    assert np.trapezoid(f, g) == pytest.approx(1.0, abs=2e-3)
    h = x.std(ddof=1) * len(x) ** -0.2
    want = np.exp(-0.5 * ((g[100] - x) / h) ** 2).sum() / (len(x) * h * np.sqrt(2 * np.pi))
    assert f[100] == pytest.approx(want, rel=1e-9)


def test_kde_is_exact_for_many_distinct_values(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=30_000)
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(6)
    rows = d.kde_curve(df, "x", 50).orderBy("i").collect()
    h = x.std(ddof=1) * len(x) ** -0.2
    for r in rows[::7]:
        want = np.exp(-0.5 * ((r.x - x) / h) ** 2).sum() / (len(x) * h * np.sqrt(2 * np.pi))
        assert r.density == pytest.approx(want, rel=1e-9)


def test_constant_column_is_in_the_first_bin(spark):
    df = spark.createDataFrame([(5.0,)] * 100, "x double")
    assert [r.n for r in d.histogram(df, "x", 4).orderBy("bin").collect()] == [100, 0, 0, 0]
    assert d.kde_curve(df, "x", 4).count() == 0


def test_histogram_centre_and_all_points(data):
    x, df = data
    r = d.histogram(df, "x", 5, center=True).first()
    assert r.mean == pytest.approx(x.mean()) and r.median == pytest.approx(np.median(x))
    assert sum(r.n for r in d.rug_points(df, "x").collect()) == len(x)
    assert d.scatter_points(df, "x", "x").count() == len(x)


def test_pair_bins_counts(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 3.0, 1.0), (3.0, 1.0, 2.0)],
                               "a double, b double, c double")
    rows = d.pair_bins(df, bins=2).collect()
    per_pair = {}
    for r in rows:
        per_pair[(r.x_col, r.y_col)] = per_pair.get((r.x_col, r.y_col), 0) + r.n
    assert per_pair == {("a", "b"): 3, ("a", "c"): 2, ("b", "c"): 2}
