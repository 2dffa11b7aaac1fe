"""Hard-negative mining by angular triangle filtering.

Vectors become whole numbers floor(scale * x). Some reference directions (means of a bounded sample, refined on the
sphere) are fixed; each row stores its norm and its angle to each of them, once. Angles between directions obey the
triangle inequality, so for an anchor at angles f and a row at angles t the angle between both lies in
[max |f - t|, min(f + t, 2 pi - f - t)]. Its cosines, times both norms, bound the score; angles are widened by `PAD`
and scores by a relative and an absolute slack, far beyond what rounding can change, so that no row is lost.

Positives: rows of the anchor's label are scored from the highest upper bound down until the k-th best score exceeds
the next upper bound. Negatives: each positive score p opens the window of scores [low * p, high * p]; only rows whose
bounds overlap an open window are scored, highest upper bound first; a window closes when its best rows are sure.
Scores are exact integers: products in doubles where the sum of their sizes stays below 2^53, whole Python numbers beyond.

Rows are dealt into blocks, anchors into blocks of their own; blocks meet by an equi-join on their numbers, one pair
of blocks a group, which returns at most a few rows an anchor; those of all blocks are ranked at the end. Nothing but
the sample for the directions (`SAMPLE` vectors) reaches the driver, and results do not depend on it.

Defined results: rows with a null id or label, or a vector that is null or holds a null or non-finite component, take no
part; vectors of another length than the anchor's do not meet it; a zero vector scores 0 with all; rows that repeat
an id are rows each, but none is another row to an anchor of that id; anchors equal in id, label and vector ask once;
ties go to the smaller id; a score beyond a long is compared exactly and returned as the nearest long; an anchor
without positives or negatives gives no rows, an empty table none; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_through

BLOCK, ANCHOR_BLOCK, COPIES = 4096, 8192, 32
SAMPLE, DIRECTIONS = 2048, 16
PAD, SLACK = 1e-6, 1e-9
LONG = (-(1 << 63), (1 << 63) - 1)
_NINES = str.maketrans("0123456789", "9876543210")


def order_code(score: int) -> str:
    """Text that sorts like the whole number, of any size."""
    digits = str(abs(score))
    code = f"{len(digits):04d}{digits}"
    return "p" + code if score >= 0 else "n" + code.translate(_NINES)


def from_code(code: str) -> int:
    return int(code[5:]) if code[0] == "p" else -int(code[5:].translate(_NINES))


def as_long(score: int) -> int:
    return min(max(score, LONG[0]), LONG[1])


def as_float(score: int) -> float:
    try:
        return float(score)
    except OverflowError:
        return np.inf if score > 0 else -np.inf


def reaches(bound: float, score) -> bool:
    return bound == np.inf or (bound != -np.inf and int(np.floor(bound)) >= int(score))


def directions(sample: list[np.ndarray], dim: int, count: int = DIRECTIONS, seed: int = 5) -> np.ndarray:
    """Unit vectors: means of the sample's directions, from seeded random ones. Fixed by its input."""
    rng = np.random.default_rng([seed, dim])
    ref = rng.normal(size=(count, dim))
    ref /= np.linalg.norm(ref, axis=1)[:, None]
    unit, norm = _unit(np.array(sample).reshape(-1, dim))
    unit = unit[norm > 0]
    if len(unit) >= count:
        ref = unit[rng.permutation(len(unit))[:count]]
        for _ in range(8):
            near = np.argmax(unit @ ref.T, axis=1)
            for j in range(count):
                mean = unit[near == j].sum(axis=0)
                if np.linalg.norm(mean) > 1e-6:
                    ref[j] = mean / np.linalg.norm(mean)
    return ref


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and norms; sizes are divided out first, so that large components do not overflow."""
    most = np.abs(x).max(axis=1, initial=0.0)
    scaled = x / np.where(most > 0, most, 1.0)[:, None]
    length = np.sqrt((scaled ** 2).sum(axis=1))
    with np.errstate(over="ignore"):
        return scaled / np.where(length > 0, length, 1.0)[:, None], most * length


class Rows:
    """Rows of a block: whole-number vectors, norms and stored angles to the directions."""

    def __init__(self, x: np.ndarray, angles: np.ndarray, scale: int):
        with np.errstate(over="ignore"):
            self.x, self.v = x, np.floor(x * scale)
        self.scale, self.angles = scale, angles
        self.norm = _unit(self.v)[1] if np.isfinite(self.v).all() else np.full(len(x), np.inf)
        self.most = np.abs(self.v).max(axis=1, initial=0.0)

    def exact(self, k: int) -> list[int]:
        """A vector's whole numbers, of any size."""
        return [int(f) if np.isfinite(f) else int(x) * self.scale for f, x in zip(self.v[k], self.x[k])]

    def bounds(self, at: np.ndarray, other: "Rows", k: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores of the rows `at` with row k of the other block."""
        mine, theirs = self.angles[at], other.angles[k]
        plus = mine + theirs
        far = np.minimum(plus, 2 * np.pi - plus).min(axis=1) + PAD
        near = np.abs(mine - theirs).max(axis=1) - PAD
        with np.errstate(over="ignore"):
            size = self.norm[at] * other.norm[k]
        sure = np.isfinite(size)
        size = np.where(sure, size, 0.0)
        slack = size * SLACK + 1
        return (np.where(sure, size * np.cos(np.minimum(far, np.pi)) - slack, -np.inf),
                np.where(sure, size * np.cos(np.maximum(near, 0.0)) + slack, np.inf))

    def scores(self, at: np.ndarray, other: "Rows", k: int) -> np.ndarray:
        """Integer scores; an array of Python numbers where a double could not hold them."""
        if not len(at) or self.most[at].max() * other.most[k] * self.v.shape[1] < 2.0 ** 53:
            return (self.v[at] @ other.v[k]).astype(np.int64)
        w = other.exact(k)
        return np.array([sum(a * b for a, b in zip(self.exact(i), w)) for i in at] + [0], object)[:-1]


def best_rows(rows: Rows, ids: np.ndarray, at: np.ndarray, anchors: Rows, k: int, count: int):
    """(rows, scores) of the `count` best of `at`, ties to the smaller id, and the number of rows scored."""
    low, high = rows.bounds(at, anchors, k)
    if len(at) > count:
        sure = np.partition(low, len(low) - count)[len(low) - count]
        at, high = at[high >= sure], high[high >= sure]
    by = np.argsort(-high, kind="stable")
    at, high = at[by], high[by]
    chosen, score, done, step = at[:0], rows.scores(at[:0], anchors, k), 0, 8 * count
    while done < len(at) and (len(chosen) < count or reaches(high[done], score[-1])):
        new = at[done:done + step]
        chosen, score = np.concatenate([chosen, new]), np.concatenate([score, rows.scores(new, anchors, k)])
        keep = np.lexsort((ids[chosen], -score))[:count]
        chosen, score = chosen[keep], score[keep]
        done, step = done + len(new), step * 2
    return chosen, score, done


def window_rows(rows: Rows, ids: np.ndarray, at: np.ndarray, anchors: Rows, k: int, positives: list[int], low: int, high: int,
                count: int):
    """Per positive score p the (rows, scores) of the `count` best of `at` with low * p <= 100 * score <= high * p, and
    the number of rows scored."""
    lower, upper = rows.bounds(at, anchors, k)
    floor = [-(-low * p // 100) for p in positives]
    ceiling = [high * p // 100 for p in positives]
    meets = np.zeros(len(at), bool)
    for f, c in zip(floor, ceiling):
        if f <= c:
            meets |= (upper >= as_float(f)) & (lower <= as_float(c))
    at, upper = at[meets], upper[meets]
    by = np.argsort(-upper, kind="stable")
    at, upper = at[by], upper[by]
    out = [(at[:0], rows.scores(at[:0], anchors, k)) for _ in positives]
    # A window is open while rows to come may still fall into it and beat what it has.
    open_ = [j for j in range(len(positives)) if floor[j] <= ceiling[j]]
    done, step = 0, 64
    while done < len(at) and open_:
        new = at[done:done + step]
        score = rows.scores(new, anchors, k)
        for j in open_:
            fit = (score >= floor[j]) & (score <= ceiling[j])
            r, s = np.concatenate([out[j][0], new[fit]]), np.concatenate([out[j][1], score[fit]])
            keep = np.lexsort((ids[r], -s))[:count]
            out[j] = (r[keep], s[keep])
        done, step = done + len(new), step * 2
        if done < len(at):
            open_ = [j for j in open_ if reaches(upper[done], floor[j])
                     and (len(out[j][0]) < count or reaches(upper[done], out[j][1][-1]))]
    return out, done


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256,
                   block: int = BLOCK, anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor (a row that meets
    `is_anchor`, a condition on `vec_id`) and each of its first `positives` other rows of the same label, the
    first `negatives` rows of other labels with low * positive_score <= 100 * score <= high * positive_score."""
    good = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                           F.col(vector_col).cast("array<double>").alias("x"))
            .where("vec_id is not null and label is not null and x is not null and size(x) > 0").where(good)
            .withColumn("dim", F.size("x")))
    asked = rows.where(is_anchor).dropDuplicates(["vec_id", "label", "x"])
    sample: dict[int, list] = {}
    for r in rows.select("dim", "x").orderBy(F.xxhash64("vec_id", "x")).limit(SAMPLE).toLocalIterator():
        sample.setdefault(r["dim"], []).append(np.array(r["x"]))
    refs = vectors.sparkSession.sparkContext.broadcast({d: directions(s, d) for d, s in sample.items()})

    def pack(key, f):
        f = f.sort_values(["label", "vec_id"], kind="stable")
        x, dim = np.stack(f["x"]).astype(float), int(key[0])
        ref = refs.value[dim] if dim in refs.value else directions([], dim)
        angles = np.arccos(np.clip(_unit(x_floor(x, scale))[0] @ ref.T, -1, 1))
        return pd.DataFrame({"dim": [dim], "part": [int(key[1])], "ids": [f["vec_id"].to_numpy(np.int64).tobytes()],
                             "labels": [list(f["label"])], "x": [x.tobytes()], "angles": [angles.tobytes()]})

    def packed(df, size, name):
        parts = max(1, -(-df.count() // size))
        key = F.pmod(F.xxhash64("vec_id", "x"), F.lit(parts))
        out = df.select("vec_id", "label", "x", "dim", key.alias("part")).groupBy("dim", "part").applyInPandas(
            pack, "dim int, part bigint, ids binary, labels array<string>, x binary, angles binary")
        return write_through(out, name), parts

    candidates, blocks = packed(rows, block, "negatives-rows")
    anchors, anchor_blocks = packed(asked, anchor_block, "negatives-anchors")

    def side(r, p):
        ids = np.frombuffer(getattr(r, f"{p}_ids"), np.int64)
        x = np.frombuffer(getattr(r, f"{p}_x")).reshape(len(ids), r.dim)
        angles = np.frombuffer(getattr(r, f"{p}_angles")).reshape(len(ids), -1)
        return ids, np.array(getattr(r, f"{p}_labels"), object), Rows(x, angles, scale)

    def met(left):
        """Pairs of blocks: each of `left` (anchor blocks) with each candidate block of the same length. Spark's estimate
        does not count the copies that `explode` makes, so a small table of anchors would be broadcast with all of them:
        they are merged, and made `COPIES` a row by as many tasks as it takes."""
        name = {c: f"{p}_{c}" for p in "ca" for c in ("ids", "labels", "x", "angles")}
        c = candidates.withColumnsRenamed({k: f"c_{k}" for k in name}).withColumnRenamed("part", "c_part").withColumn(
            "a_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(anchor_blocks - 1).cast("long"))))
        last = F.lit(blocks - 1).cast("long")
        a = left.withColumnsRenamed({k: f"a_{k}" for k in name}).withColumnRenamed("part", "a_part").withColumn(
            "first", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(COPIES).cast("long"))))
        a = a.repartition(anchor_blocks * -(-blocks // COPIES)).withColumn(
            "c_part", F.explode(F.sequence("first", F.least(F.col("first") + (COPIES - 1), last)))).drop("first")
        return c.join(a.hint("merge"), ["dim", "c_part", "a_part"]).groupBy("dim", "c_part", "a_part")

    def find_positives(key, f):
        out = []
        for r in f.itertuples(index=False):
            ids, labels, rows_ = side(r, "c")
            a_ids, a_labels, asks = side(r, "a")
            edge = {}  # rows and anchors are sorted by label
            for i, label in enumerate(labels):
                edge.setdefault(label, [i, i])[1] = i + 1
            for k, label in enumerate(a_labels):
                if label in edge:
                    at = np.arange(*edge[label])
                    chosen, score, _ = best_rows(rows_, ids, at[ids[at] != a_ids[k]], asks, k, positives)
                    out += [(r.dim, r.a_part, k, a_ids[k], ids[c], order_code(int(s))) for c, s in zip(chosen, score)]
        return pd.DataFrame(out, columns=["dim", "part", "k", "anchor_id", "positive_id", "code"])

    near = met(anchors).applyInPandas(find_positives, "dim int, part bigint, k int, anchor_id bigint, positive_id bigint, code string")
    first = Window.partitionBy("dim", "part", "k").orderBy(F.desc("code"), "positive_id")
    near = write_through(near.withColumn("n", F.row_number().over(first)).where(F.col("n") <= positives), "negatives-positives")

    def gather(f):
        codes = f.groupby("k")["code"].agg(lambda c: ",".join(sorted(set(c))))
        return pd.DataFrame({"dim": [f["dim"].iloc[0]], "part": [f["part"].iloc[0]],
                             "ks": [codes.index.to_numpy(np.int64).tobytes()], "codes": [list(codes)]})

    windows = near.groupBy("dim", "part").applyInPandas(gather, "dim int, part bigint, ks binary, codes array<string>")

    def find_negatives(key, f):
        out = []
        for r in f.itertuples(index=False):
            ids, labels, rows_ = side(r, "c")
            a_ids, a_labels, asks = side(r, "a")
            for k, codes in zip(np.frombuffer(r.ks, np.int64), r.codes):
                codes = codes.split(",")
                at = np.flatnonzero((labels != a_labels[k]) & (ids != a_ids[k]))
                found, _ = window_rows(rows_, ids, at, asks, k, [from_code(c) for c in codes], low, high, negatives)
                out += [(r.dim, r.a_part, k, c, ids[i], order_code(int(s)))
                        for c, (chosen, score) in zip(codes, found) for i, s in zip(chosen, score)]
        return pd.DataFrame(out, columns=["dim", "part", "k", "code", "negative_id", "negative_code"])

    far = met(anchors.join(windows.hint("merge"), ["dim", "part"])).applyInPandas(
        find_negatives, "dim int, part bigint, k int, code string, negative_id bigint, negative_code string")
    best = Window.partitionBy("dim", "part", "k", "code").orderBy(F.desc("negative_code"), "negative_id")
    far = far.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)

    @F.pandas_udf("bigint")
    def number(code: pd.Series) -> pd.Series:
        return pd.Series([as_long(from_code(c)) for c in code], dtype="int64")

    return near.join(far.hint("merge"), ["dim", "part", "k", "code"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
        number("code").alias("positive_score"), number("negative_code").alias("negative_score"))


def x_floor(x: np.ndarray, scale: int) -> np.ndarray:
    """The vectors whose directions count: whole numbers, or the values themselves where those overflow."""
    with np.errstate(over="ignore"):
        v = np.floor(x * scale)
    return np.where(np.isfinite(v).all(axis=1)[:, None], v, x)
