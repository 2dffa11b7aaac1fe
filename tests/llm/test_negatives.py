import numpy as np
import pytest
from pyspark.sql import functions as F

from scrubstat.llm import negatives
from scrubstat.llm.negatives import PAD, Rows, _unit, best_rows, directions, from_code, hard_negatives, order_code

SCHEMA = "vec_id long, label int, embedding array<double>, rank string, score int"


def whole(v):
    return [int(np.floor(x * 256)) if abs(x) < 1e300 else int(x) * 256 for x in v]


def brute(rows, positives=5, negatives=3, every=50):
    good = [(i, y, whole(v)) for i, y, v in rows if i is not None and y is not None and v
            and all(x is not None and np.isfinite(x) for x in v)]
    asked = {(i, y, tuple(v)) for i, y, v in good if i % every == 0}
    out = []
    for i, y, v in asked:
        met = sorted((-sum(a * b for a, b in zip(v, w)), j, z) for j, z, w in good if j != i and len(w) == len(v))
        for s, j, _ in [m for m in met if m[2] == y][:positives]:
            fit = [m for m in met if m[2] != y and 50 * -s <= 100 * -m[0] <= 95 * -s][:negatives]
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k, _) in enumerate(fit)]
    top = (1 << 63) - 1
    return sorted((a, b, r, k, max(min(s, top), -top - 1), max(min(t, top), -top - 1)) for a, b, r, k, s, t in out)


def got(spark, rows, **options):
    df = spark.createDataFrame([(i, y, v, "x", 1) for i, y, v in rows], SCHEMA)
    return sorted(tuple(r) for r in hard_negatives(df, F.col("vec_id") % 50 == 0, **options).collect())


def table(seed, n=300, dim=10):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(6, dim))
    rows = [(i, int(rng.integers(0, 4)), (centre[rng.integers(0, 6)] + 0.4 * rng.normal(size=dim)).tolist()) for i in range(n)]
    rows += [(n + i, i % 2, rows[7][2]) for i in range(80)]  # a common vector: ties
    return rows


@pytest.mark.parametrize("block,anchor_block", [(32, 4), (4096, 8192)])
def test_equals_brute_force(spark, block, anchor_block):
    rows = table(1) + [(1000, None, [1.0] * 10), (1050, 1, None), (1100, 1, [None] * 10), (1150, 1, [float("nan")] * 10),
                       (1200, 1, [float("inf")] + [0.0] * 9), (None, 1, [1.0] * 10), (1250, 1, []), (1300, 1, [0.5, 0.5]),
                       (1301, 1, [0.5, 0.4]), (1302, 2, [0.3, 0.3]), (1350, 1, [0.0] * 10)]
    assert got(spark, rows, block=block, anchor_block=anchor_block) == brute(rows)


def test_repeated_ids_and_rows(spark):
    rows = table(2, 120)
    rows += [(50, 2, rows[3][2]), (50, 2, rows[3][2]), rows[0], rows[5], rows[5], (5, 3, rows[8][2])]
    assert got(spark, rows) == brute(rows)


def test_large_values_are_exact(spark):
    rng = np.random.default_rng(3)
    for size in (1e8, 3e38, 1e306):
        rows = [(i, i % 2, (rng.uniform(0.5, 1, 4) * size).tolist()) for i in range(101)]
        rows += [(200 + i, i % 2, (rng.uniform(0.5, 1, 4)).tolist()) for i in range(20)]
        assert got(spark, rows) == brute(rows)


def test_empty(spark):
    assert got(spark, []) == []
    assert got(spark, [(50, 1, [1.0]), (1, 2, [1.0])]) == []


def test_copies_of_blocks_are_not_broadcast(spark, monkeypatch):
    rows, plans = table(4), []

    def planned(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(negatives, "write_through", lambda df, name, write=negatives.write_through: write(planned(df), name))
    df = spark.createDataFrame([(i, y, v, "x", 1) for i, y, v in rows], SCHEMA)
    out = planned(hard_negatives(df, F.col("vec_id") % 50 == 0, block=8, anchor_block=4))  # more blocks than COPIES
    assert sum(p.count("SortMergeJoin") for p in plans) == 4 and not any("Broadcast" in p for p in plans)
    assert sorted(tuple(r) for r in out.collect()) == brute(rows)


def test_codes_sort_like_numbers():
    numbers = [0, 1, -1, 9, 10, -10, 99, 10 ** 40, -10 ** 40, -(10 ** 40) - 1, 12345, -12345]
    assert [from_code(c) for c in sorted(map(order_code, numbers))] == sorted(numbers)


@pytest.mark.parametrize("seed", range(4))
def test_bounds_hold_and_save_scoring(seed):
    rng = np.random.default_rng(seed)
    x = np.repeat(rng.normal(size=(5, 16)), 60, axis=0) + 0.05 * rng.normal(size=(300, 16))
    x[0] = 0
    ref = directions(list(x[:100]), 16)
    v = np.floor(x * 256)
    rows = Rows(x, np.arccos(np.clip(_unit(v)[0] @ ref.T, -1, 1)), 256)
    at = np.arange(300)
    for k in (0, 1, 70, 299):
        low, high = rows.bounds(at, rows, k)
        exact = v @ v[k]
        assert (low <= exact).all() and (exact <= high).all()
        chosen, score, scored = best_rows(rows, at, at, rows, k, 5)
        assert list(chosen) == sorted(range(300), key=lambda i: (-exact[i], i))[:5] and list(score) == list(exact[chosen].astype(int))
        assert scored < 300 or k == 0  # the clusters tell most rows apart
    assert PAD > 0
