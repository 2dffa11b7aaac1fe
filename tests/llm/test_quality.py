import numpy as np
from pyspark.sql import functions as F

from scrubstat.llm.quality import N_STATS, FourierMap, isotonic, normal_equations, score_quality, text_statistics
from scrubstat.llm.queries import op9_quality, quality_learn

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in op9_quality(spark, SF).collect() if r.held_out and labels.get(r.doc_id) is not None]
    y = np.array([labels[r.doc_id] for r in rows])
    s = np.array([r.score for r in rows])
    assert ((s >= 0.5) == y).mean() > 0.97
    order = s.argsort().argsort()
    auc = (order[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() - 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    print("accuracy", ((s >= 0.5) == y).mean(), "auc", auc, "recall of 0", (s[y == 0] < 0.5).mean())
    assert auc > 0.98


def test_normal_equations_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(300, N_STATS)), rng.integers(0, 2, 300)
    z = FourierMap(np.zeros(N_STATS), np.ones(N_STATS), 16, 1)
    df = spark.createDataFrame([(v.tolist(), float(t)) for v, t in zip(x, y)], "stats array<double>, label double").repartition(5)
    a, b = normal_equations(df, z)
    m = z(x)
    assert np.allclose(a, m.T @ m) and np.allclose(b, m.T @ y)


def test_isotonic_rises():
    xs, ys = isotonic([(0, 10, 1), (1, 10, 5), (2, 10, 3), (3, 10, 9), (4, 5, 5)])
    assert ys == sorted(ys) and xs == sorted(xs) and abs(ys[1] - 0.4) < 1e-12


def test_statistics_of_odd_texts():
    for t in ["", " ", "\n\n", "x", "é" * 9, "a" * 1_000_000, "| | |", "\x00"]:
        v = text_statistics(t)
        assert len(v) == N_STATS and np.isfinite(v).all()


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, None, "s"), (2, "", "s"), (None, "some text", "s"), (3, "a", "s"), (3, "a", "s")],
                               "doc_id long, text string, stats string")
    none = spark.createDataFrame([], "doc_id long, quality int, score double")
    out = score_quality(df, none, quality_learn()).collect()
    assert len(out) == 5 and all(r.score == 0.5 for r in out)
    some = spark.createDataFrame([(i, i % 2 if i else None, 1.0) for i in range(5)], "doc_id long, quality int, score double")
    out = score_quality(df, some, F.lit(True), keep_rows=True).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    assert score_quality(df.limit(0), some, F.lit(True)).count() == 0
