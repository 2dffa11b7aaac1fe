"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Each whole text gives a fixed vector of statistics. A seeded random cosine map of the standardised
statistics approximates a Gaussian kernel; each partition sums its normal equations, the sums are
added by row, and the driver solves one small ridge system. Scores of a separate fold of the
learning rows are counted in fixed bins, to which an isotonic (pool adjacent violators) curve is
fitted that turns raw scores into probabilities. All learning rows are used; what reaches the driver
(moments, the D x D system, bins) has a fixed size.

Defined results: null text is empty, and an empty text is scored like any other; null labels are
ignored; a repeated label counts again; null and repeated ids keep their rows (scores are never joined);
without labels of both classes each score is the share of label 1, or 0.5; an empty table gives
no rows; other columns are ignored or, with `keep_rows`, carried in a struct.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import write_through

N_STATS = 22
BINS, LOW, HIGH = 1000, -0.5, 1.5


def text_statistics(text: str) -> list[float]:
    """Shape of a text: lengths, character classes, repetition, line structure."""
    raw = text.encode("utf-8", "replace")
    c = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n, m, k = max(1, len(words)), max(1, len(raw)), max(1, len(lines))
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    upper, lower = int(c[65:91].sum()), int(c[97:123].sum())
    stops, commas = int(c[46]), int(c[44])
    symbols = int(c[33:48].sum() + c[58:65].sum() + c[91:97].sum() + c[123:127].sum()) - stops - commas
    space = int(c[32] + c[9:14].sum())
    per_line = [x.count(b" ") + 1 for x in lines]
    size = (m - space) / n
    return [
        float(np.log1p(len(words))), size, float(np.log1p(len(lines))), float(np.log1p(n / k)),
        upper / max(1, upper + lower), int(c[48:58].sum()) / m, space / m, stops / n, commas / n,
        symbols / m, int(c[33]) / n, int(c[124]) / n, int(c[128:].sum()) / m,
        len(counts) / n, len(counts) / n ** 0.8, max(counts.values(), default=0) / n,
        sum(map(eq, words, words[1:])) / n, 1 - len(pairs) / n if len(words) > 1 else 0.0,
        1 - len(set(lines)) / k, sum(x < 4 for x in per_line) / k,
        sum(w[-1] not in b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ.," and w[-1] < 128 for w in counts) / max(1, len(counts)),
        min(len(w) for w in counts) / 10 if counts else 0.0,
    ]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _statistics(text: pd.Series) -> pd.Series:
    return pd.Series([text_statistics(t) for t in text])


class FourierMap:
    """z(x) = sqrt(2/D) cos(W (x - mean) / std + b), with a constant last component."""

    def __init__(self, mean, std, features: int, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.std = np.array(mean), np.where(np.array(std) > 1e-9, std, 1.0)
        self.w = rng.normal(0, 1 / np.sqrt(len(mean) / 2), (len(mean), features))
        self.b = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, x) -> np.ndarray:
        x = np.clip((np.stack(x) - self.mean) / self.std, -6, 6)
        z = np.sqrt(2 / len(self.b)) * np.cos(x @ self.w + self.b)
        return np.hstack([z, np.ones((len(z), 1))])


def normal_equations(rows: DataFrame, z: FourierMap) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y of a frame (stats, label): summed per partition, then added by row."""
    d = len(z.b) + 1

    def part(frames):
        sums = np.zeros((d, d + 1))
        for f in frames:
            if len(f):
                m, y = z(f["stats"]), f["label"].to_numpy(float)
                sums += m.T @ np.hstack([m, y[:, None]])
        yield pd.DataFrame({"i": range(d), "sums": list(sums)})

    def add(key, f):
        return pd.DataFrame({"i": [int(key[0])], "sums": [np.sum(np.stack(f["sums"]), axis=0)]})

    parts = rows.mapInPandas(part, "i int, sums array<double>")
    total = parts.groupBy("i").applyInPandas(add, "i int, sums array<double>").orderBy("i").collect()
    a = np.array([r["sums"] for r in total]) if total else np.zeros((d, d + 1))
    return a[:, :-1], a[:, -1]


def isotonic(bins: list[tuple[int, int, int]]) -> tuple[list[float], list[float]]:
    """Rising curve through (bin, rows, positives) by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for at, n, pos in sorted(bins):
        x = LOW + (at + 0.5) * (HIGH - LOW) / BINS
        blocks.append([n, pos, n * x])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return [s / n for n, _, s in blocks], [p / n for n, p, _ in blocks]


def train(stats: DataFrame, labels: DataFrame, learn: Column, label: str, features: int = 256,
          ridge: float = 1e-3, seed: int = 7):
    """Model from the rows of stats(doc_id, stats) for which `learn` holds, joined to labels
    (doc_id, label): a function from a series of statistics to scores."""
    known = labels.where(F.col(label).isNotNull()).select(
        F.col("doc_id").alias("_id"), F.col(label).cast("double").alias("label"))
    rows = (stats.where(learn).join(known, F.col("doc_id") == F.col("_id"))
            .select("stats", "label", (F.crc32(F.concat(F.lit("c"), F.col("doc_id").cast("string"))) % 5 == 0).alias("held")))
    rows = write_through(rows, "quality-rows")
    one = rows.where(~F.col("held")).agg(
        F.count("*").alias("n"), F.sum("label").alias("pos"),
        *[f(F.col("stats")[i]).alias(f"{n}{i}") for i in range(N_STATS)
          for f, n in ((F.avg, "m"), (F.stddev_pop, "s"))]).first()
    n, pos = one["n"], one["pos"] or 0.0
    if not 0 < pos < n:
        share = float(pos / n) if n else 0.5
        return lambda x: np.full(len(x), share)
    z = FourierMap([one[f"m{i}"] for i in range(N_STATS)], [one[f"s{i}"] for i in range(N_STATS)], features, seed)
    a, b = normal_equations(rows.where(~F.col("held")).select("stats", "label"), z)
    w = np.linalg.solve(a + ridge * n / features * np.eye(len(b)), b)

    @F.pandas_udf("int")
    def bin_of(s: pd.Series) -> pd.Series:
        return pd.Series(np.clip((z(s) @ w - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(int))

    held = rows.where("held").select(bin_of("stats").alias("bin"), "label").groupBy("bin").agg(
        F.count("*").alias("n"), F.sum("label").alias("pos")).collect()
    xs, ys = isotonic([(r["bin"], r["n"], r["pos"]) for r in held]) if held else ([LOW, HIGH], [0.0, 1.0])

    def score(s) -> np.ndarray:
        if not len(s):
            return np.zeros(0)
        raw = z(s) @ w
        # The curve is flat in places; a thousandth of the raw score keeps the order there.
        return 0.999 * np.interp(raw, xs, ys) + 0.001 * np.clip((raw - LOW) / (HIGH - LOW), 0, 1)

    return score


def score_quality(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id",
                  text_col: str = "text", label_id: str = "doc_id", label: str = "quality",
                  keep_rows: bool = False, **options) -> DataFrame:
    """doc_id and score (0 to 1) for every row of `docs`; `learn` is a condition on doc_id that
    picks the rows whose labels may be learned from. The statistics are written once to the
    shared scratch folder (with `keep_rows`, beside the whole row as a struct)."""
    cols = [F.col(id_col).alias("doc_id"), _statistics(F.coalesce(F.col(text_col), F.lit(""))).alias("stats")]
    if keep_rows:
        cols.append(F.struct("*").alias("row"))
    stats = write_through(docs.select(*cols), "quality-stats")
    known = labels.select(F.col(label_id).alias("doc_id"), F.col(label).alias("label"))
    model = train(stats.select("doc_id", "stats"), known, learn, "label", **options)

    @F.pandas_udf("double")
    def scored(s: pd.Series) -> pd.Series:
        return pd.Series(model(s))

    return stats.select("doc_id", scored("stats").alias("score"), *["row"] * keep_rows)
