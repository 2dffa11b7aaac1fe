"""Candidate pairs for weak similarity bounds, by character bags.

Where a similarity threshold is too low for shared pieces of text to be sure, a weaker fact still holds: two strings
cannot have more characters in order in common than they have at all. The number of common characters, counted with
repeats, bounds every ratio from above, so pairs that it rules out need no scoring and none that could count is lost.

Strings are sorted by length into blocks of about `BLOCK`. Only blocks whose lengths can meet the bound are compared, one
pair of blocks a group; the common characters of all its pairs are one matrix product (a character that occurs k
times gives k columns), and only the pairs that pass leave the task. The work grows with the square of the number of
distinct strings, as weak bounds ask, but spread over tasks, with no pair written that the bound excludes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_through

BLOCK = 2048
COLUMNS = 4096  # of a product at a time


def common_characters(x: list[str], y: list[str]) -> np.ndarray:
    """Matrix of the numbers of characters, with repeats, that the strings of x share with those of y."""
    sides = []
    for texts in (x, y):
        at = [(i, c, k) for i, t in enumerate(texts) for c, n in Counter(t).items() for k in range(n)]
        sides.append(at)
    keys = {k: j for j, k in enumerate(sorted({(c, k) for _, c, k in sides[0]} & {(c, k) for _, c, k in sides[1]}))}
    out = np.zeros((len(x), len(y)), np.float32)
    places = [np.array([(i, keys[c, k]) for i, c, k in at if (c, k) in keys], np.int64).reshape(-1, 2) for at in sides]
    for lo in range(0, len(keys), COLUMNS):
        parts = []
        for p, texts in zip(places, (x, y)):
            p = p[(p[:, 1] >= lo) & (p[:, 1] < lo + COLUMNS)]
            part = np.zeros((len(texts), min(COLUMNS, len(keys) - lo)), np.float32)
            part[p[:, 0], p[:, 1] - lo] = 1
            parts.append(part)
        out += parts[0] @ parts[1].T
    return out  # whole numbers, exact below 2^24


def ratio_admits(least: float, partial: float | None = None, stretch: float = 1.0):
    """Bound of 2 M / (a + b) >= least, M being at most the common characters; or, if one string is at least
    `stretch` times as long, of M / (shorter length) >= partial."""

    def admits(common, a, b):
        ok = 2 * common >= least * (a + b) - 1e-6
        if partial is not None:
            ok |= (np.maximum(a, b) >= stretch * np.minimum(a, b)) & (common >= partial * np.minimum(a, b) - 1e-6)
        return ok

    def meet(lo_a: Column, hi_a: Column, lo_b: Column, hi_b: Column) -> Column:
        if partial is not None and partial <= 1:
            return F.lit(True)  # a part of any longer string may match
        near = lambda hi, lo: 2 * hi >= F.lit(least) * (hi + lo) - 1e-6  # noqa: E731  the shorter at its longest
        return (hi_a >= lo_b) & (hi_b >= lo_a) | near(hi_a, lo_b) & (hi_a < lo_b) | near(hi_b, lo_a) & (hi_b < lo_a)

    return admits, meet


def edit_admits(least: float):
    """Bound of 1 - (edit distance) / (longer length) >= least: the longer string keeps all but that many characters."""

    def admits(common, a, b):
        return common >= least * np.maximum(a, b) - 1e-6

    def meet(lo_a, hi_a, lo_b, hi_b):
        return (hi_a >= F.lit(least) * lo_b - 1e-6) & (hi_b >= F.lit(least) * lo_a - 1e-6)

    return admits, meet


def bag_candidates(rows: DataFrame, rule: tuple[Callable, Callable], block: str | None = None, size: int = BLOCK) -> DataFrame:
    """Pairs (a, b), a < b, of the ids of rows(id, key[, block]) that `rule` admits; pairs stay within a value of the
    column `block`. An id is expected once."""
    admits, meet = rule
    rows = rows.select("id", "key", (F.col(block) if block else F.lit("")).alias("_k"), F.length("key").alias("_len"))
    rows = write_through(rows, "bag-rows")
    lengths = rows.groupBy("_k", "_len").agg(F.count("*").alias("_m")).withColumn(
        "_o", F.sum("_m").over(Window.partitionBy("_k").orderBy("_len")) - F.col("_m"))
    # A place in the order of length: rows of one length take any, by hash.
    place = F.col("_o") + F.floor(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30) * F.col("_m"))
    placed = rows.join(write_through(lengths, "bag-lengths"), ["_k", "_len"]).withColumn("_b", F.floor(place / size).cast("int"))
    packed = write_through(placed.groupBy("_k", "_b").agg(
        F.collect_list(F.struct("id", "key")).alias("strings"), F.min("_len").alias("_lo"), F.max("_len").alias("_hi")), "bag-blocks")
    x = packed.select("_k", F.col("_b").alias("_i"), F.col("_lo").alias("_xl"), F.col("_hi").alias("_xh"))
    y = packed.select("_k", F.col("_b").alias("_j"), F.col("_lo").alias("_yl"), F.col("_hi").alias("_yh"))
    pairs = x.join(y, "_k").where((F.col("_i") <= F.col("_j")) & meet(F.col("_xl"), F.col("_xh"), F.col("_yl"), F.col("_yh")))
    pairs = write_through(pairs.select("_k", "_i", "_j"), "bag-pairs")
    both = (pairs.join(packed.select("_k", F.col("_b").alias("_i"), F.col("strings").alias("x")), ["_k", "_i"])
            .join(packed.select("_k", F.col("_b").alias("_j"), F.col("strings").alias("y")), ["_k", "_j"]))

    def compare(key, f: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"a": [], "b": []}, dtype=object)]
        for i, j, x, y in zip(f["_i"], f["_j"], f["x"], f["y"]):
            for xs in _parts(x):
                for ys in _parts(y):
                    la, lb = (np.array([len(s["key"]) for s in z], float) for z in (xs, ys))
                    common = common_characters([s["key"] for s in xs], [s["key"] for s in ys])
                    u, v = np.nonzero(admits(common, la[:, None], lb[None, :]))
                    a, b = np.array([s["id"] for s in xs], object)[u], np.array([s["id"] for s in ys], object)[v]
                    keep = a < b if i == j else np.ones(len(a), bool)
                    swap = a > b
                    out.append(pd.DataFrame({"a": np.where(swap, b, a)[keep], "b": np.where(swap, a, b)[keep]}))
        return pd.concat(out, ignore_index=True)

    kind = rows.schema["id"].dataType.simpleString()
    return both.groupBy("_k", "_i", "_j").applyInPandas(compare, f"a {kind}, b {kind}")


def _parts(strings, rows: int = 512) -> Iterator:
    for k in range(0, len(strings), rows):
        yield strings[k:k + rows]
