import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from scrubstat.llm import trie
from scrubstat.llm.trie import ends_digests, list_ranks, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, n int"


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def brute(rows, shift=True):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), digest(role, text), (role, text)))
    own = {c: [t for *_, t in sorted(ts)] for c, ts in own.items()}
    seq = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if shift else 0
        base = c - int(np.fmod(c, 100))
        seq[c] = tuple(own.get(base, [])[:h] + ts[h:]) if shift else tuple(ts)
    members = defaultdict(list)
    for c, s in seq.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    kids = defaultdict(int)
    for key in members:
        if key:
            kids[key[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for key, m in members.items():
        for d in range(len(key) + 1):
            leaves[key[:d]] += key not in kids
            saved[key[:d]] += (len(m) - 1) * len(key[-1][1]) if key else 0
    return sorted((min(m), len(key), min(members[key[:-1]]) if key else -1, len(m), kids.get(key, 0), leaves[key], saved[key],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if seq[c] == key))).encode()).hexdigest())
                  for key, m in members.items())


def got(spark, rows, shift=True):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    c = F.col("conv_id")
    out = prefix_trie(df, F.crc32(c.cast("string")) % 6, c - c % 100) if shift else prefix_trie(df)
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in out.collect())


def table(seed, convs=150, words=3):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(convs):
        c = int(rng.integers(0, 400)) if c % 3 else c * 2
        rows += [(c, t, "ua"[t % 2], f"w{rng.integers(0, words)} é") for t in range(int(rng.integers(1, 8)))]
    return rows


def test_equals_brute_force(spark):
    rows = table(1)  # ids drawn twice repeat turn numbers
    rows += [(5, None, "u", "first"), (5, None, None, None), (None, 1, "u", "x"), (7, 3, None, "y"), (7, 3, "u", None), (7, 3, "u", None),
             (-250, 0, "u", "neg"), (-200, 0, "u", "base"), (901, 0, "u", "no base")]
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows, shift=False) == brute(rows, shift=False)


def test_long_conversations_and_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 4)
    monkeypatch.setattr(trie, "BLOCK", 16)
    rows = [(c, t, "u", f"t{t if t < 40 * c + 3 else c}") for c in range(5) for t in range(200)] + table(2, 40)
    assert got(spark, rows) == brute(rows)


def test_copies_and_a_hot_first_turn(spark):
    rows = [(c, t, "u", f"t{t if t < 3 or c % 3 else c}") for c in range(300) for t in range(4)]
    assert got(spark, rows) == brute(rows)


def test_edges(spark):
    assert got(spark, []) == []
    for rows in ([(100, 1, "u", "a")], [(1, 1, "u", "a")], [(None, 1, "u", "a")], [(2, 1, "u", "")] * 3):
        assert got(spark, rows) == brute(rows) if rows[0][0] is not None else got(spark, rows) == []


def test_list_ranks(spark):
    n = 300
    at = np.random.default_rng(1).permutation(n).tolist()
    rows = [(0, 1, at[i], i % 5, (0, 1, at[i + 1]) if i + 1 < n else None) for i in range(n)]
    df = spark.createDataFrame(rows, "kind int, conv_id long, at long, w long, next struct<kind:int,conv_id:long,at:long>")
    ranks = {r["at"]: r["rank"] for r in list_ranks(df).collect()}
    assert all(ranks[at[i]] == sum(j % 5 for j in range(i, n)) for i in range(n))


@pytest.mark.parametrize("chunk", [1, 40, 1 << 16])
def test_digests_over_partitions(spark, monkeypatch, chunk):
    monkeypatch.setattr(trie, "CHUNK", chunk)
    rows = [(d, bytes([h]), c) for d, h, n in ((1, 1, 500), (1, 2, 1), (2, 1, 70), (3, 9, 2)) for c in range(n)]
    out = ends_digests(spark.createDataFrame(rows[::-1], "depth long, hash binary, conv_id long"))
    want = {(d, h): hashlib.sha256(",".join(map(str, range(n))).encode()).hexdigest() for d, h, n in ((1, 1, 500), (1, 2, 1), (2, 1, 70), (3, 9, 2))}
    assert {(r[0], r[1][0]): r[2] for r in out.collect()} == want
