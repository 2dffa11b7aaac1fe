import numpy as np
import pytest
from pyspark.sql import functions as F

from scrubstat.llm.topk import SortedLists, top_k, top_k_search


def brute(rows, k, every):
    good = [(i, np.floor(64 * np.array(v, float)).astype(int)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, v in good:
        if q % every == 0:
            best = sorted((-int(v @ w), i) for i, w in good if i != q and len(w) == len(v))[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    return out


@pytest.mark.parametrize("block,query_block", [(16, 8), (4096, 1024)])
def test_equals_brute_force(spark, block, query_block):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=12).tolist()) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(150)]  # a common vector: ties
    rows += [(600, None), (620, [None] * 12), (640, [float("nan")] * 12), (660, [float("inf")] + [0.0] * 11), (None, [0.1] * 12),
             (680, [0.5, 0.5]), (681, [0.1, 0.2]), (700, []), (720, [0.0] * 12)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, score int, rank string")
    got = {tuple(r) for r in top_k_search(df, F.col("vec_id") % 20 == 0, 20, block=block, query_block=query_block).collect()}
    assert got == brute(rows, 20, 20)


def test_edges(spark):
    schema = "vec_id long, embedding array<float>"
    assert top_k_search(spark.createDataFrame([], schema), F.col("vec_id") % 20 == 0, 20).count() == 0
    few = spark.createDataFrame([(0, [0.5]), (1, [0.25]), (2, [-1.0]), (1, [0.25])], schema)
    assert [tuple(r) for r in top_k_search(few, F.col("vec_id") % 20 == 0, 20).orderBy("rank").collect()] == [
        (0, 1, 1, 512), (0, 2, 1, 512), (0, 3, 2, -2048)]
    with pytest.raises(ValueError):
        top_k_search(spark.createDataFrame([(0, [1e9]), (1, [1.0])], schema), F.lit(True), 5)


@pytest.mark.parametrize("seed", range(5))
def test_bounds_hold_and_close(seed):
    rng = np.random.default_rng(seed)
    v, q = rng.integers(-90, 90, (200, 8)), rng.integers(-90, 90, 8).astype(float)
    lists = SortedLists(v)
    exact = v @ q
    for depth in (1, 5, 50, 200):
        (a, b), (c, d) = lists.read(depth)
        lower = a @ np.maximum(q, 0) + c @ np.minimum(q, 0)
        upper = b @ np.maximum(q, 0) + d @ np.minimum(q, 0)
        assert (lower <= exact).all() and (exact <= upper).all()
    assert (lower == exact).all() and (upper == exact).all()
    (rows, c, s) = top_k(lists, np.arange(200), q[None, :], np.array([-1]), 7)
    assert [(int(-x), int(i)) for x, i in zip(s, c)] == sorted((-int(e), i) for i, e in enumerate(exact))[:7]
