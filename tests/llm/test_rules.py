import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from scrubstat.llm import rules
from scrubstat.llm.rules import Texts, fit_sigmoid, minimise, quality_rules, sigmoid

WORD = re.compile("[^\\x20\\x09-\\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    repeated = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), sum(x in lines[:i] for i, x in enumerate(lines)), len(repeated),
            n < 20 or 100 * len(repeated) > 30 * n)


def texts():
    rng = np.random.default_rng(4)
    some = [" ".join(rng.choice(["a", "bé", "c#", "数据", " x"], int(rng.integers(0, 120)))) for _ in range(40)]
    lines = ["one two\none two\n \n\n \none two \nx", "\n\n", "a\tb\x0bc\x0cd\re\x1cf g", None, "", " " * 50, "😀 " * 30]
    eight = " ".join(f"w{i}" for i in range(8))
    return some + lines + [eight, f"{eight} {eight}", f"{eight} x {eight} y w0 w1", "same " * 200, " ".join(f"w{i % 9}" for i in range(40)),
                           " ".join(f"w{i}" for i in range(100)) + " " + eight, "y" * 5000, "z \n" * 3000]


def test_counts_equal_brute_force(spark, monkeypatch):
    rows = [(i if i % 11 else None, t, 1, True) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept boolean")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    out = quality_rules(docs, labels).collect()
    assert sorted(map(repr, ((r[0], *r[1:7]) for r in out))) == sorted(repr((i, *brute(t))) for i, t, *_ in rows)
    assert all(r["probability"] == 0.5 and r["kept"] == (not r["base_failed"]) for r in out)
    assert quality_rules(docs.limit(0), labels).collect() == []


@pytest.mark.parametrize("piece", [1, 50, 1 << 20])
def test_pieces_do_not_change_scores(monkeypatch, piece):
    raw = [(t or "").encode() for t in texts()]
    w = np.random.default_rng(1).normal(size=2 * rules.SLOTS + 1)
    want = Texts(raw).scores(w)
    direct = [sum(w[s] * v for s, v in zip(*f)) + w[-1] for f in Texts(raw).features()]
    assert np.allclose(want, direct, atol=1e-4)
    monkeypatch.setattr(rules, "PIECE", piece)
    assert np.allclose(np.concatenate([Texts(raw[a:b]).scores(w) for a, b in rules._pieces(raw)]), want)


def test_minimise_and_sigmoid():
    rng = np.random.default_rng(2)
    m, want = rng.normal(size=(50, 8)), rng.normal(size=8)
    x = minimise(lambda w: (float(((m @ (w - want)) ** 2).sum()), 2 * m.T @ (m @ (w - want))), np.zeros(8), 60)
    assert np.allclose(x, want, atol=1e-2)
    score = rng.normal(0, 2, 20000)
    hit = rng.random(20000) < sigmoid(1.5 * score - 0.7)
    at = np.clip((score + rules.EDGE) / (2 * rules.EDGE) * rules.BINS, 0, rules.BINS - 1).astype(int)
    a, b = fit_sigmoid([(k, int((at == k).sum()), int(hit[at == k].sum())) for k in np.unique(at)])
    assert abs(a - 1.5) < 0.1 and abs(b + 0.7) < 0.1


def test_verdicts_follow_the_labels(spark, sf):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    seen = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    out = quality_rules(docs, labels.where(seen))
    rows = out.join(labels.where(~seen), "doc_id").select("quality", "probability", "kept", "base_failed").collect()
    good, bad = [r for r in rows if r[0] == 1], [r for r in rows if r[0] == 0]
    print(len(good), len(bad))
    assert np.mean([r["kept"] or r["base_failed"] for r in good]) > 0.95
    assert np.mean([not r["kept"] for r in bad]) > 0.8
    # Calibrated: mean probability near the share of label 1.
    assert abs(np.mean([r["probability"] for r in rows]) - len(good) / len(rows)) < 0.1
