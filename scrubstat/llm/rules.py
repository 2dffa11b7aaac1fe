"""Quality rules: fixed counts of a text, then a hashed n-gram classifier against fixed thresholds.

Base rules count words, symbols, repeated lines and words in repeated eight-word windows of each whole text. Texts that
pass them are judged by a logistic regression over hashed word n-grams (1 and 2 words) and character n-grams (2 and 3
code points), each with weight 1 / (number of n-grams of its kind in the text). It is trained by limited-memory BFGS:
each step is one pass of executors over the training features, which sums the gradient of fixed size. Scores of a
separate fold, counted in fixed bins, give the two numbers of a sigmoid that turns scores into probabilities.

Training reads at most about `sample_docs` labelled texts, chosen by a hash of the id over all of them; every text is
scored, in Arrow batches that are worked off in pieces of about `PIECE` bytes; the n-grams of one text are hashed in
pieces too, so a long text needs memory for its words and four bytes a character.

Defined results: null text is empty; null labels are ignored, a repeated label counts again; an empty text, or one without
words, fails the base rules and still has a probability; without labels of both classes every probability is the share
of label 1, or 0.5; null and repeated ids keep their rows (nothing is joined back); an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import write_through

SLOTS = 1 << 15  # of each kind of n-gram
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
PIECE = 1 << 20  # bytes of text, or code points, worked on at once
GAIN = 32.0  # scale of the features
PARTS = 8  # partitions that sum a gradient
BINS, EDGE = 4000, 20.0
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def repeated_words(codes: np.ndarray, owner: np.ndarray, docs: int, window: int = WINDOW) -> np.ndarray:
    """Per document the words in windows that the document has twice or more. `codes` number the words of all
    documents, equal words alike; windows are compared exactly, by numbering runs of 1, 2, 4, 8 words in turn."""
    n = len(codes) - window + 1
    if n <= 0:
        return np.zeros(docs, np.int64)
    run, size = codes.astype(np.int64), 1
    while size < window:
        step = min(size, window - size)
        _, run = np.unique(run[:-step] * (run.max() + 1) + run[step:], return_inverse=True)
        size += step
    inside = np.flatnonzero(owner[:n] == owner[window - 1:])
    _, key, count = np.unique(owner[inside] * (run.max() + 1) + run[inside], return_inverse=True, return_counts=True)
    covered = np.zeros(len(codes) + 1, np.int64)
    twice = inside[count[key] > 1]
    np.add.at(covered, twice, 1)
    np.add.at(covered, twice + window, -1)
    return np.bincount(owner[np.cumsum(covered[:-1]) > 0], minlength=docs)


def _pieces(texts) -> list[tuple[int, int]]:
    """Slices of the texts of about PIECE bytes."""
    out, first, size = [], 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > PIECE:
            out.append((first, i))
            first, size = i, 0
        size += len(t)
    return out + [(first, len(texts))] if len(texts) else []


class Texts:
    """The counts of some texts (UTF-8 bytes), and their hashed n-grams."""

    def __init__(self, raw: list[bytes]):
        self.raw = raw
        words = [r.split() for r in raw]  # ASCII white space
        self.n_words = np.array([len(w) for w in words], np.int64)
        self.codes, self.unique = pd.factorize(np.array([w for ws in words for w in ws] + [b""], object)[:-1])
        self.owner = np.repeat(np.arange(len(raw)), self.n_words)

    def stats(self) -> pd.DataFrame:
        sizes = np.array([np.count_nonzero((np.frombuffer(w, np.uint8) & 0xC0) != 0x80) for w in self.unique], np.int64)
        chars = np.bincount(self.owner, sizes[self.codes] if len(self.codes) else None, minlength=len(self.raw)).astype(np.int64)
        lines = [[x for x in r.split(b"\n") if x.strip()] if b"\n" in r else [] for r in self.raw]
        return pd.DataFrame({
            "n_words": self.n_words, "word_chars": chars,
            "n_symbols": [int(np.bincount(np.frombuffer(r, np.uint8), minlength=256)[_SYMBOLS].sum()) for r in self.raw],
            "n_dup_lines": [len(x) - len(set(x)) for x in lines],
            "n_repeat_words": repeated_words(self.codes, self.owner, len(self.raw))})

    def grams(self):
        """(owners, slots) of all n-grams, in pieces; slots of words below SLOTS, those of characters from there on."""
        h = np.array([xxhash.xxh3_64_intdigest(w) for w in self.unique], np.uint64)[self.codes] if len(self.codes) else np.zeros(0, np.uint64)
        yield self.owner, (h & np.uint64(SLOTS - 1)).astype(np.int64)
        if len(h) > 1:
            inside = np.flatnonzero(self.owner[1:] == self.owner[:-1])
            yield self.owner[inside], (_mix(_mix(h[inside]) + h[inside + 1]) & np.uint64(SLOTS - 1)).astype(np.int64)
        points = [np.frombuffer(r.decode("utf-8", "replace").encode("utf-32-le"), np.uint32) for r in self.raw]
        edge = np.cumsum([len(p) for p in points])
        points = np.concatenate(points) if points else np.zeros(0, np.uint32)
        for at in range(0, len(points), PIECE):
            p = points[at:at + PIECE + 2].astype(np.uint64)
            o = np.searchsorted(edge, np.arange(at, at + len(p)), side="right")
            for n in (2, 3):
                m = min(PIECE, len(p) - n + 1)
                if m > 0:
                    g = p[:m]
                    for k in range(1, n):
                        g = (g << np.uint64(21)) + p[k:m + k]
                    inside = o[:m] == o[n - 1:m + n - 1]
                    yield o[:m][inside], SLOTS + (_mix(g[inside] + np.uint64(n)) & np.uint64(SLOTS - 1)).astype(np.int64)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Weighted sums of the features, the last weight being constant."""
        total, count = np.zeros((2, len(self.raw))), np.zeros((2, len(self.raw)))
        for owner, slots in self.grams():
            kind = int(len(slots) and slots[0] >= SLOTS)
            total[kind] += np.bincount(owner, weights[slots], minlength=len(self.raw))
            count[kind] += np.bincount(owner, minlength=len(self.raw))
        return GAIN * (total / np.maximum(count, 1)).sum(axis=0) + weights[-1]

    def features(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per text the slots that it has and their values."""
        parts = list(self.grams())
        owner, slots = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        key, count = np.unique(owner * (2 * SLOTS) + slots, return_counts=True)
        owner, slots = key // (2 * SLOTS), key % (2 * SLOTS)
        kind = 2 * owner + (slots >= SLOTS)
        value = GAIN * count / np.bincount(kind, count, minlength=2 * len(self.raw))[kind]
        edge = np.searchsorted(owner, np.arange(len(self.raw) + 1))
        return [(slots[a:b].astype(np.int32), value[a:b].astype(np.float32)) for a, b in zip(edge, edge[1:])]


def _raw(texts: pd.Series) -> list[bytes]:
    return [t.encode("utf-8", "replace") if t is not None else b"" for t in texts]


def minimise(loss, start: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """Limited-memory BFGS with halving steps; `loss` gives value and gradient."""
    x = start
    f, g = loss(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d, a = -g, []
        for s, y in reversed(past):
            a.append((s @ d) / (s @ y))
            d = d - a[-1] * y
        d = d * ((past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1])) if past else d / max(1.0, np.linalg.norm(g))
        for (s, y), b in zip(past, reversed(a)):
            d = d + (b - (y @ d) / (s @ y)) * s
        rate = 1.0
        while rate > 1e-3:
            new, new_g = loss(x + rate * d)
            if new <= f + 1e-4 * rate * (g @ d):
                break
            rate /= 2
        else:
            return x
        s, y = rate * d, new_g - g
        if s @ y > 1e-12:
            past = [*past, (s, y)][-memory:]
        done = f - new < 1e-6 * abs(f)
        x, f, g = x + s, new, new_g
        if done:
            break
    return x


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit_sigmoid(bins: list[tuple[int, int, int]]) -> tuple[float, float]:
    """(a, b) of the probability sigmoid(a * score + b), by Newton steps over (bin, rows, positives), with the usual
    softened targets that keep separable folds finite."""
    at, n, pos = (np.array(c, float) for c in zip(*bins))
    x = -EDGE + (at + 0.5) * 2 * EDGE / BINS
    hit, miss = (pos.sum() + 1) / (pos.sum() + 2), 1 / ((n - pos).sum() + 2)
    want = pos * hit + (n - pos) * miss
    m = np.stack([x, np.ones_like(x)])
    loss = lambda w: float((n * np.logaddexp(0, w @ m) - want * (w @ m)).sum())
    w = np.array([0.0, 0.0])
    for _ in range(50):
        p = sigmoid(w @ m)
        step = np.linalg.solve((m * (n * p * (1 - p))) @ m.T + 1e-9 * np.eye(2), m @ (want - n * p))
        rate = 1.0
        while rate > 1e-6 and loss(w + rate * step) > loss(w):
            rate /= 2
        w = w + rate * step
        if np.abs(rate * step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = 8000, steps: int = 25, ridge: float = 1e-4):
    """(weights, a, b) from docs(doc_id, text) and labels(doc_id, label), or (None, share, 0) without both classes."""
    labels = labels.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull())
    known = labels.count()
    key = F.xxhash64(F.col("doc_id").cast("string"), F.lit("rules"))
    share = min(1.0, sample_docs / max(1, known))
    chosen = labels.where(F.pmod(key, F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) if share < 1 else 1 << 20))
    chosen = chosen.select(F.col("doc_id").alias("_id"), F.col("label").cast("double").alias("label"))
    texts = docs.join(chosen, F.col("doc_id") == F.col("_id")).select(
        F.coalesce("text", F.lit("")).alias("text"), "label", (F.pmod(F.shiftright(key, 20), F.lit(5)) == 0).alias("held"))

    def extract(frames):
        for f in frames:
            raw = _raw(f["text"])
            for lo, hi in _pieces(raw):
                found = Texts(raw[lo:hi]).features()
                yield pd.DataFrame({"slots": [s.tobytes() for s, _ in found], "value": [v.tobytes() for _, v in found],
                                    "label": f["label"].iloc[lo:hi].to_numpy(), "held": f["held"].iloc[lo:hi].to_numpy()})

    rows = write_through(texts.mapInPandas(extract, "slots binary, value binary, label double, held boolean"), "rules-rows")
    fold = rows.where("not held").select("slots", "value", "label").coalesce(PARTS)
    n, pos = fold.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < pos < n:
        return None, float(pos / n) if n else 0.5, 0.0

    def gradient(w):
        def part(frames):
            total, grad = 0.0, np.zeros(len(w))
            for f in frames:
                for k in range(0, len(f), 500):
                    g = f.iloc[k:k + 500]
                    slots = [np.frombuffer(s, np.int32) for s in g["slots"]]
                    owner = np.repeat(np.arange(len(g)), [len(s) for s in slots])
                    slots, value = np.concatenate(slots), np.concatenate([np.frombuffer(v, np.float32) for v in g["value"]])
                    z = np.bincount(owner, w[slots] * value, minlength=len(g)) + w[-1]
                    y = g["label"].to_numpy()
                    total += float((np.logaddexp(0, z) - y * z).sum())
                    r = sigmoid(z) - y
                    grad[:-1] += np.bincount(slots, r[owner] * value, minlength=len(w) - 1)
                    grad[-1] += r.sum()
            yield pd.DataFrame({"loss": [total], "grad": [grad.tobytes()]})

        parts = fold.mapInPandas(part, "loss double, grad binary").collect()  # at most PARTS rows
        grad = sum(np.frombuffer(p["grad"]) for p in parts) / n
        body = np.append(w[:-1], 0.0)
        return sum(p["loss"] for p in parts) / n + ridge / 2 * float(body @ body), grad + ridge * body

    w = minimise(gradient, np.zeros(2 * SLOTS + 1), steps)

    @F.pandas_udf("int")
    def bin_of(slots: pd.Series, value: pd.Series) -> pd.Series:
        z = [float(w[np.frombuffer(s, np.int32)] @ np.frombuffer(v, np.float32)) + w[-1] for s, v in zip(slots, value)]
        return pd.Series(np.clip((np.array(z) + EDGE) / (2 * EDGE) * BINS, 0, BINS - 1).astype(np.int32))

    held = rows.where("held").select(bin_of("slots", "value").alias("bin"), "label").groupBy("bin").agg(
        F.count("*").alias("n"), F.sum("label").alias("pos")).collect()  # at most BINS rows
    return w, *(fit_sigmoid([tuple(r) for r in held]) if held else (1.0, 0.0))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
                  label: str = "quality", least: float = 0.5, **options) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, probability, kept) for every row:
    a text is kept if it passes the base rules and its probability of label 1 is at least `least`."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    w, a, b = train(rows, labels.select(F.col(label_id).alias("doc_id"), F.col(label).alias("label")), **options)
    held = docs.sparkSession.sparkContext.broadcast(w)  # a fixed number of weights

    @F.pandas_udf(f"{STATS}, probability double")
    def judged(texts: pd.Series) -> pd.DataFrame:
        raw = _raw(texts)
        out = []
        for lo, hi in _pieces(raw):
            t = Texts(raw[lo:hi])
            p = sigmoid(a * t.scores(held.value) + b) if held.value is not None else np.full(hi - lo, a)
            out.append(t.stats().assign(probability=p))
        return pd.concat(out, ignore_index=True) if out else Texts([]).stats().assign(probability=0.0)

    failed: Column = (F.col("s.n_words") < LEAST_WORDS) | (100 * F.col("s.n_repeat_words") > MOST_REPEATED * F.col("s.n_words"))
    return (rows.select("doc_id", judged("text").alias("s")).select(
                "doc_id", *[F.col(f"s.{c.split()[0]}") for c in STATS.split(", ")], failed.alias("base_failed"), "s.probability")
            .withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= least)))
