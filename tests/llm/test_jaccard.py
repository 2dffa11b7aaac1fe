import random
import tracemalloc
from itertools import combinations

import numpy as np
import pandas as pd
import pytest

from scrubstat.llm import jaccard as J
from scrubstat.llm.graph import components
from scrubstat.llm.jaccard import Prefixes, jaccard_classes, jaccard_links, jaccard_pairs, shared_tokens, shingle_set


def brute(docs, n, percent):
    sets = []
    for _, t in docs:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    names = {}
    for i, (d, _) in enumerate(docs):
        names.setdefault(find(i), []).append(d)
    return {d: (len(sets[i]), min(names[find(i)])) for i, (d, _) in enumerate(docs)}


def corpus(seed, size=300):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    passages = [" ".join(rng.choices(vocab, k=40)) for _ in range(4)]
    docs = []
    for i in range(size):
        if docs and rng.random() < 0.6:
            w = rng.choice(docs[-40:])[1].split() or ["x"]
            for _ in range(rng.choice([0, 1, 1, 2, 4, 8])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            t = " ".join(w)
        else:
            t = " ".join(rng.choices(vocab, k=rng.choice([1, 2, 3, 5, 20, 60, 150])))
            if rng.random() < 0.3:
                t += " " + rng.choice(passages)
        docs.append((i * 3 + 1, t))
    return docs


@pytest.mark.parametrize("seed,n,percent", [(1, 4, 85), (2, 5, 80), (3, 4, 50)])
def test_equals_brute_force(spark, seed, n, percent):
    docs = corpus(seed) + [(0, None), (2, ""), (5, "   "), (8, "A  b\tC"), (11, "a b c"), (14, "É x y z"), (17, "é x y z")]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, sig string, token int").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_classes(df, n=n, percent=percent).collect()}
    assert got == brute(docs, n, percent)


def group_of_copies():
    """300 near copies of one text (three blocks), a few far from each other, some repeated; and other texts."""
    rng = random.Random(7)
    base, docs = [f"w{i}" for i in range(120)], corpus(5, 150)
    for i in range(300):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            w[rng.randrange(len(w))] = f"x{rng.randrange(50)}"
        docs.append((10_000 + i, " ".join(w)))
    return docs


def test_every_link_is_found(spark):
    docs = group_of_copies() + [(0, None), (2, ""), (5, "lone words here")]
    sets = {d: {tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))} if (w := (t or "").split()) else set() for d, t in docs}
    links, pairs = dict.fromkeys(sets, 0), set()
    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
            links[a] += 1
            links[b] += 1
            if sets[a] != sets[b]:
                pairs.add(frozenset((frozenset(sets[a]), frozenset(sets[b]))))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    rows = jaccard_links(df, n=4, percent=85).collect()
    assert len(rows) == len(docs) and {r.doc_id: r.n_links for r in rows} == links
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(docs, 4, 85)
    found = jaccard_pairs(df, n=4, percent=85).collect()
    assert {frozenset((frozenset(sets[r.doc_a]), frozenset(sets[r.doc_b]))) for r in found} == pairs
    assert len(found) == len(pairs) > 5_000 and all(r.class_a > r.class_b for r in found)


def test_links_of_edge_rows(spark):
    schema = "doc_id long, text string"
    assert jaccard_links(spark.createDataFrame([], schema)).count() == 0
    assert jaccard_pairs(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (None, None), (9, "lone " * 30_000)]
    got = sorted(((r.doc_id, r.n_links) for r in jaccard_links(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(None, 2), (7, 2), (7, 2), (None, 0), (9, 0)], key=str)


def test_shared_tokens():
    rng = np.random.default_rng(3)
    x, y = ([np.unique(rng.integers(0, 20_000, k).astype(np.uint64)) for k in sizes] for sizes in ((9000, 5, 0, 700), (12_000, 40)))
    assert shared_tokens(x, y).tolist() == [[len(np.intersect1d(a, b)) for b in y] for a in x]


def test_every_similar_pair_meets_in_its_prefixes():
    rng = np.random.default_rng(0)
    for trial in range(300):
        n = int(rng.integers(1, 80))
        a = rng.choice(10**6, n, replace=False).astype(np.uint64)
        edit = a.copy()
        k = int(rng.integers(0, max(1, n // 8) + 1))
        edit[:k] = rng.choice(np.arange(10**6, 2 * 10**6), k, replace=False)
        b = np.unique(edit[int(rng.integers(0, 3)):]) if n > 3 else np.unique(edit)
        a = np.unique(a)
        both = len(np.intersect1d(a, b))
        if 100 * both < 85 * (len(a) + len(b) - both):
            continue
        counts = rng.integers(0, 3, 1 << 18).astype(float)
        counts[rng.choice(1 << 18, 5000)] += 500
        counts[(a[: len(a) // 2] & np.uint64((1 << 18) - 1)).astype(int)] += int(rng.integers(0, 2)) * 1000
        p = Prefixes(85, counts)
        (ta, la), (tb, lb) = p.of(a), p.of(b)
        need = -(-85 * (len(a) + len(b)) // 185)
        for want in {la, lb, 1}:
            if want <= min(-(-85 * len(a) // 100), -(-85 * len(b) // 100)):
                x, y = ta[:len(a) - need + want], tb[:len(b) - need + want]
                assert len(x) == len(a) - need + want and len(y) == len(b) - need + want
                assert len(np.intersect1d(x, y)) >= want


def test_edge_rows(spark):
    schema = "doc_id long, text string"
    assert jaccard_classes(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (None, None), (9, "lone " * 30_000)]
    got = sorted(map(tuple, jaccard_classes(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(None, 3, 7), (7, 3, 7), (7, 3, 7), (None, 0, None), (9, 1, 9)], key=str)
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(None, base), (None, base + " x"), (None, base + " y"), (2**60 + 1, "z " + base)]
    assert {r.component_id for r in jaccard_classes(spark.createDataFrame(rows, schema)).collect()} == {2**60 + 1}


def test_shingle_set_words():
    assert len(shingle_set("a b c d a b c d a b", 4)) == 4
    assert (shingle_set("A b c", 4) == shingle_set("a\tb c ", 4)).all()


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(150)]
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(root[a], root[b])
            if root[a] != m or root[b] != m:
                root[a] = root[b] = m
                changed = True
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in root.items() if k in got} and all(root[k] == k for k in set(root) - set(got))


@pytest.mark.parametrize("piece", [1, 7, 64])
def test_pieces_do_not_change_sets(monkeypatch, piece):
    rng = random.Random(piece)
    parts = ["a", "Zq", "é", " ", "  ", "\n", "\t", "word ", "数"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 120))) for _ in range(150)] + [None, "", " ", "x" * 300 + " y", " " * 90 + "z"]
    want = {n: [J.shingle_set(t, n) for t in texts] for n in (1, 4)}
    monkeypatch.setattr(J, "PIECE", piece)
    monkeypatch.setattr(J, "_POWERS", [])
    for n in (1, 4):
        assert all((a == b).all() and len(a) == len(b) for a, b in zip(J.shingle_sets(texts, n), want[n], strict=True))
        assert all(len(a) == len(b) and (a == b).all() for a, b in zip([J.shingle_set(t, n) for t in texts], want[n]))


def test_a_long_text_takes_bounded_memory():
    text = " ".join(f"w{i}" for i in range(1_500_000)) + " " + "y" * 3_000_000
    tracemalloc.start()
    assert len(J.shingle_set(text, 5)) == 1_500_001 - 4
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 14 * len(text) + (64 << 20)


def test_slices_go_by_characters():
    frame = pd.DataFrame({"text": ["a" * 400_000, "b" * 400_000, None, "c" * 900_000, ""] + ["d"] * 1200})
    cut = list(J.slices([frame, frame.iloc[:0]]))
    assert pd.concat(cut).equals(frame) and max(map(len, cut)) <= 500
    assert all(len(s) == 1 or s["text"].str.len().fillna(0).sum() <= J.PIECE for s in cut)
