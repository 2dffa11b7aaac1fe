import hashlib

import pytest
from pyspark.sql import functions as F

from scrubstat.llm import sketch as S
from scrubstat.llm.queries import op2_fingerprint


def shingles(t):
    w = [x for x in t.lower().replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if x]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def likeness(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, docs, exact=False):
    docs = sorted(docs, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    texts = [t or "" for _, t in docs]
    nexts = texts[1:] + texts[:1]
    want = []
    for (d, _), t, nx in zip(docs, texts, nexts):
        half = len(t) // 2
        e = t[:len(t) - half] + nx[:half]
        want.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), likeness(t, e), likeness(t, nx)))
    rows = sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_chars, r.edited_sha256))
    want.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
    error = 0.0
    for r, w in zip(rows, want, strict=True):
        assert (r.doc_id, r.n_chars, r.edited_sha256) == w[:3]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        error += abs(r.near_edited - w[3]) + abs(r.near_next - w[4])
        if exact:
            assert abs(r.near_edited - w[3]) < 1e-9 and abs(r.near_next - w[4]) < 1e-9
    return error / max(1, 2 * len(rows))


def test_query_against_brute_force(spark, sf, monkeypatch):
    monkeypatch.setattr(S, "ROWS_PER_RANGE", 7)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = op2_fingerprint(spark, sf).collect()
    assert check(rows, docs) < 0.03
    by_text = {}
    for r in rows:
        assert by_text.setdefault(dict(docs)[r.doc_id], r.fingerprint) == r.fingerprint
    assert len(set(by_text.values())) > 0.95 * len(by_text)


@pytest.mark.parametrize("per_range", [1, 2, 1000])
def test_edges(spark, monkeypatch, per_range):
    monkeypatch.setattr(S, "ROWS_PER_RANGE", per_range)
    monkeypatch.setattr(S, "LIMIT", 1 << 62)
    monkeypatch.setattr(S, "TOP", (1 << 62) - 1)  # all hashes are kept: estimates are exact
    docs = [(5, "one two three"), (-3, ""), (8, None), (9, "é🙂 " * 11), (20, "\t lead and trail \n"), (20, "a second of this id"),
            (21, "x" * 9000), (30, "w1 w2 w3 w4 w5 w6"), (31, "w1 w2 w3 w4 w5 w6"), (None, "no id"), (None, "no id b")]
    df = spark.createDataFrame([(d, t, "s", 1) for d, t in docs], "doc_id long, text string, sketch string, n_chars int")

    def run(df):
        out = S.fingerprint_documents(df)
        return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "near_edited", "near_next").collect()
    check(run(df), docs, exact=True)
    assert run(df.limit(0)) == []
    check(run(df.limit(1)), docs[:1], exact=True)
    check(run(df.where("doc_id is null")), docs[-2:], exact=True)


def test_fraction_and_merge(spark):
    a, b = " ".join(f"w{i}" for i in range(4000)), " ".join(f"w{i}" for i in range(3000, 3400))
    df = spark.createDataFrame([(a, b, a + " " + b)], "a string, b string, c string")
    for c in "abc":
        df = S.add_sketch(df, c, f"s{c}")
    df = S.add_likeness(df, "sb", "sa", "near", "inside", F.col("a") == F.col("b")).withColumn("m", S.merge(F.col("sa"), F.col("sb")))
    r = df.first()
    assert r.inside > 0.95 and abs(r.near - 0.1) < 0.04
    assert abs(len(r.sa) / 3996 - 1 / 2) < 0.03
    assert set(r.sa) | set(r.sb) == set(r.m) and max(r.sa) < S.LIMIT


@pytest.mark.parametrize("n", [3, 60, 120, 140, 400])
def test_one_fraction_for_all_lengths(spark, n):
    """Below and above any length the same share is kept, and the estimate errs as much as its hashes allow."""
    rows = [(k, " ".join(f"k{k}w{i}" for i in range(n)), " ".join(f"k{k}w{i}" for i in range(n // 3, n))) for k in range(60)]
    df = spark.createDataFrame(rows, "k int, a string, b string")
    df = S.add_likeness(S.add_sketch(S.add_sketch(df, "a", "sa"), "b", "sb"), "sb", "sa", "near", "inside", F.lit(False))
    out = df.collect()
    shingles = max(1, n - 4)
    assert abs(sum(len(r.sa) for r in out) / (60 * shingles) - 1 / 2) < 2.5 * 0.5 / (60 * shingles) ** 0.5
    if n > 10:
        want = (n - n // 3 - 4) / shingles
        assert abs(sum(r.near for r in out) / 60 - want) < 0.05
