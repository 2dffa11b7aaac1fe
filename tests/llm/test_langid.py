import itertools

import numpy as np
from pyspark.sql import functions as F

from scrubstat.llm.langid import UNKNOWN, Lattice, count_words, identify, public_lattice
from scrubstat.llm.queries import op4_language

SF = "/root/testdata/sf0.01"


def segmentations(w, pieces, longest):
    if not w:
        yield []
    for k in range(1, min(longest, len(w)) + 1):
        if w[:k] in pieces or (k == 1 and w[0] not in pieces):
            for rest in segmentations(w[k:], pieces, longest):
                yield [w[:k], *rest]


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(1)
    names = ["▁", "a", "b", "ab", "▁a", "ba", "aba", "bab"]
    probs = np.vstack([rng.random((len(names), 3)), np.full(3, UNKNOWN)])
    lat = Lattice(names)
    words = ["".join(w) for n in range(1, 6) for w in itertools.product("abx", repeat=n)]
    got, count = lat.log_probs(words, probs), np.zeros(len(names))
    for w, g in zip(words, got):
        segs = list(segmentations("▁" + w, names, 3))
        each = [np.prod([probs[names.index(p)] if p in names else np.full(3, UNKNOWN) for p in s], axis=0) for s in segs]
        assert np.allclose(g, np.log(np.sum(each, axis=0)))
        for i, p in enumerate(names):
            count[i] += 2.0 * sum(e[1] * s.count(p) for e, s in zip(each, segs)) / sum(e[1] for e in each)
    assert np.allclose(lat.expected(words, np.full(len(words), 2.0), probs[:, 1]), count)


def test_public_pieces_are_found():
    lat = public_lattice()
    for w in ["the", "der", "ñandú", "xyz", "日本", "a" * 31, "🙂"]:
        arcs = lat.arcs(["▁" + w])
        assert {e for e, *_ in arcs} == set(range(1, len(w) + 2))
        assert np.isfinite(lat.log_probs([w], np.full((lat.size + 1, 1), UNKNOWN))).all()


def test_long_runs_become_words():
    assert count_words("A" * 70 + " b") == {"a" * 31: 2, "a" * 8: 1, "b": 1}


def test_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [r for r in op4_language(spark, SF).collect() if lang[r.doc_id] is not None]
    held = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]
    print("held out", len(held), "accuracy", np.mean(held))
    assert len(held) > 150 and np.mean(held) > 0.95


def test_edge_rows(spark):
    df = spark.createDataFrame(
        [(1, None, "en", 1.0), (2, "", "en", 1.0), (3, "123 !!", "en", 1.0), (4, "the cat and the dog", "en", 1.0), (5, "der hund und die katze", "de", 1.0),
         (None, "the dog", None, 1.0), (6, "日本", "de", 1.0), (7, "x" * 50_000, None, 1.0), (4, "the cat and the dog", "en", 1.0)],
        "doc_id long, text string, lang string, score double")
    out = identify(df, F.lit(True)).collect()
    got = {}
    for r in out:
        got[r.doc_id] = r
        assert 0 <= r.score <= 1
    assert len(out) == 9 and got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == "und"
    assert got[None].lang_pred == "en" and got[5].lang_pred == "de"
    assert {r.lang_pred for r in identify(df, F.lit(False)).collect()} == {"und"}
    assert identify(df.limit(0), F.lit(True)).count() == 0
