import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from scrubstat.llm.packing import pack_documents, pack_lengths, public_bpe, step_groups, token_ids


def encode(text):
    return list(public_bpe().encode_ordinary(text)) + [0]


def check_pieces(rows, docs, window=1024):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(docs)
    for d, text in docs.items():
        ids, at = encode(text or ""), 0
        for p in sorted(by_doc[d], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            cut = np.array(ids[p.start:p.start + p.length], "<u4").tobytes()
            assert bytes(p.ids) == cut and zlib.crc32(cut) == zlib.crc32(bytes(p.ids))
            at += p.length
        assert at == len(ids)
    padding = total = 0
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
        total += at
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding, total


def test_pack_documents_covers_every_id(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    docs = {r.doc_id: r.text for r in df.collect()}
    padding, total = check_pieces(pack_documents(df).collect(), docs)
    assert padding <= 0.02 * total


def test_ids_equal_the_tokenizer_file(spark, sf):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    texts += ["", " ", "\n\n  a", "日本語 ñandú 🙂🙂", "a" * 5000, "<|endoftext|>", "x y\x00z"]
    for x in texts:
        assert list(public_bpe().encode_ordinary(x)) == t.encode(x, add_special_tokens=False).ids


def loaded_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_equal_the_tokenizer_as_loaded(spark, sf):
    t, end = loaded_tokenizer(), "<|endoftext|>"
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    texts += [f"a {end} b", end, end + end, f"\n {end}  x", f"<{end}>", end[:-1], f"é{end}'ll", f"<|endof{end}text|>"]
    for x in texts:
        assert token_ids(x).tolist() == t.encode(x, add_special_tokens=False).ids
    packed = pack_documents(spark.createDataFrame([(1, f"a {end} b")], "doc_id long, text string")).collect()
    assert [np.frombuffer(p.ids, "<u4").tolist() for p in packed] == [[64, 220, 50256, 275, 0]]


def test_runs_of_over_a_million_blanks(spark):
    t, n = loaded_tokenizer(), 1_200_000
    docs = {1: " " * n + "x", 2: "a" + "\n" * n + "<|endoftext|> b", 3: "\u00a0 " * (n // 2) + "é"}
    for x in docs.values():
        assert token_ids(x).tolist() == t.encode(x, add_special_tokens=False).ids
    packed = pack_documents(spark.createDataFrame([(1, docs[1])], "doc_id long, text string")).collect()
    ids = b"".join(bytes(p.ids) for p in sorted(packed, key=lambda p: p.start))
    assert np.frombuffer(ids, "<u4").tolist() == t.encode(docs[1], add_special_tokens=False).ids + [0]


def test_edge_rows(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("bucket", T.StringType()), T.StructField("ids", T.LongType())])
    docs = {1: None, 2: "", 3: "word " * 30_000, 4: "same text", 5: "same text"}
    df = spark.createDataFrame([(d, t, "x", None) for d, t in docs.items()], schema)
    check_pieces(pack_documents(df).collect(), docs)
    assert pack_documents(df.limit(0)).count() == 0
    twice = pack_documents(spark.createDataFrame([(None, "a b", "", 1)] * 2 + [(7, "c", "", 1)] * 2, schema))
    assert twice.where("doc_id is null").count() == 2 and twice.where("doc_id = 7").count() == 2


@pytest.mark.parametrize("seed", range(6))
def test_pack_lengths_exact_cover_and_one_underfull(seed):
    rng = np.random.default_rng(seed)
    n = [int(x) for x in rng.integers(0, 1024, rng.integers(0, 300))]
    seqs = pack_lengths(n, 1024, (128, 256, 512, 1024), 8)
    got = defaultdict(list)
    for tier, pieces in seqs:
        assert sum(p[2] for p in pieces) <= tier
        for i, at, k in pieces:
            got[i].append((at, k))
    for i, k in enumerate(n):
        at = 0
        for a, m in sorted(got[i]):
            assert a == at and m > 0
            at += m
        assert at == k
    for tier, pieces in seqs[:-1]:
        assert tier - sum(p[2] for p in pieces) <= (8 if tier == 1024 else 0)


def test_step_groups_balance():
    costs = list(range(1, 65))
    g = step_groups(costs, 8)
    sums = [sum(c for c, x in zip(costs, g) if x == k) for k in range(8)]
    assert max(g) == 7 and max(sums) - min(sums) <= 0.02 * sum(sums)
