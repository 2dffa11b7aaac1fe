"""Packing: hierarchical multi-length packing of tokenised documents.

Each document becomes its token ids followed by one end id. Whole windows are cut off its front;
the tail (shorter than a window) is routed to the smallest context tier that holds it. Tiers are
packed from the longest down: the longest tail left opens a window of its tier, the gap is
filled with the longest shorter tails that fit, and what then still gapes is filled by cutting a
tail in two, whose rest goes back to its own shorter tier. Sequences of one tier are dealt in
serpentine order of attention cost into step groups of about equal cost.

Documents are dealt by a hash into buckets of about `docs_per_bucket`, each packed on its own, so
no task sees more than a bucket and at most one underfull sequence is left per bucket.

Defined results: null text is the empty text (one end id); null ids are kept; a repeated row is
packed once per repetition; an empty table gives no rows; other columns are ignored. An added token
of the vocabulary that stands in a text is one id.
"""

from __future__ import annotations

import base64
import json
from bisect import bisect_left, bisect_right, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 1024
TIERS = (128, 256, 512, 1024)

_ENCODERS: dict = {}


def public_bpe(vocabulary: str = "byte_bpe_50k.tiktoken"):
    """Encoder of a public byte-level BPE, loaded once per Python worker. The ranks file holds
    the vocabulary of `byte_bpe_50k.json`, whose added tokens it takes as its special ones."""
    if vocabulary not in _ENCODERS:
        import public_tokenizers
        import tiktoken
        with open(public_tokenizers.path(vocabulary), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(_json_file(vocabulary)) as f:
            added = json.load(f)["added_tokens"]
        if any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in added):
            raise ValueError("added tokens that depend on what stands beside them")
        _ENCODERS[vocabulary] = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
            special_tokens={a["content"]: a["id"] for a in added})
    return _ENCODERS[vocabulary]


def _json_file(vocabulary: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(vocabulary.removesuffix(".tiktoken") + ".json")


def _json_encoder(vocabulary: str):
    name = _json_file(vocabulary)
    if name not in _ENCODERS:
        from tokenizers import Tokenizer
        _ENCODERS[name] = Tokenizer.from_file(name)
    return _ENCODERS[name]


def token_ids(text: str, vocabulary: str = "byte_bpe_50k.tiktoken") -> np.ndarray:
    """The ids that `tokenizers` gives with the JSON file (tested), four times as fast: a text is
    split at the added tokens, which get their own ids, and the parts between are encoded. A text
    that exceeds the pattern stack of tiktoken (a run of about a million blanks) goes to `tokenizers`."""
    try:
        return public_bpe(vocabulary).encode_to_numpy(text, allowed_special="all")
    except ValueError:
        return np.array(_json_encoder(vocabulary).encode(text, add_special_tokens=False).ids, np.uint32)


def pack_lengths(lengths: list[int], window: int, tiers: tuple[int, ...], slack: int):
    """Plan of one bucket's tails. Returns sequences [(tier, [(item, start, length), ...])] that
    cover every item exactly once. Only the last sequence may be underfull by more than `slack`
    (and only in the longest tier by up to `slack`)."""
    pool = sorted((n, i, 0) for i, n in enumerate(lengths) if n)
    out = []
    while pool:
        n, i, at = pool.pop()
        tier = tiers[bisect_left(tiers, n)]
        pieces, gap = [(i, at, n)], tier - n
        while gap and pool:
            k = bisect_right(pool, (gap, len(lengths), 0)) - 1
            if k >= 0:  # the longest tail that fits
                n, i, at = pool.pop(k)
                pieces.append((i, at, n))
                gap -= n
            elif tier == window and gap <= slack:
                break
            else:  # cut the shortest of the longer tails
                n, i, at = pool.pop(0)
                pieces.append((i, at, gap))
                insort(pool, (n - gap, i, at + gap))
                gap = 0
        out.append((tier, pieces))
    return out


def step_groups(costs: list[int], per_group: int) -> list[int]:
    """Serpentine deal of sequences, dearest first, into ceil(n / per_group) groups."""
    groups = -(-len(costs) // per_group)
    out = [0] * len(costs)
    for k, s in enumerate(sorted(range(len(costs)), key=lambda s: -costs[s])):
        lap, at = divmod(k, groups)
        out[s] = at if lap % 2 == 0 else groups - 1 - at
    return out


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, tiers: tuple[int, ...] = TIERS, end_id: int = 0,
                   slack: int = 8, group_tokens: int = 16 * WINDOW, docs_per_bucket: int = 500,
                   vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """One row per piece: id, start, length, doc_tokens, sequence_id, offset, tier, step_group
    and `ids` (binary, little-endian unsigned 32-bit token ids)."""
    if tiers[-1] != window or list(tiers) != sorted(tiers):
        raise ValueError("tiers must ascend and end at the window")
    kind = docs.schema[id_col].dataType.simpleString()
    buckets = max(1, -(-docs.count() // docs_per_bucket))
    # pandas would turn whole numbers beside nulls into floats, so ids pass Python as text.
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.pmod(F.xxhash64(id_col, text_col), F.lit(buckets)).alias("bucket"))

    def encode(frames):
        enc = public_bpe(vocabulary)
        narrow = np.uint16 if enc.n_vocab <= 1 << 16 else np.uint32
        for f in frames:
            ids = [np.append(token_ids(t, vocabulary), end_id)
                   .astype(narrow).tobytes() for t in f["text"]]
            yield pd.DataFrame({"doc_id": f["doc_id"], "ids": ids, "bucket": f["bucket"]})

    def pack(key, f):
        enc = public_bpe(vocabulary)
        narrow = np.uint16 if enc.n_vocab <= 1 << 16 else np.uint32
        f = f.assign(ids=[np.frombuffer(b, narrow).astype("<u4") for b in f["ids"]])
        f = f.assign(n=[len(a) for a in f["ids"]], head=[a[:32].tobytes() for a in f["ids"]])
        f = f.sort_values(["doc_id", "n", "head"], kind="stable", ignore_index=True)
        ids, n = list(f["ids"]), list(f["n"])
        seqs = [(window, [(d, b * window, window)]) for d in range(len(ids))
                for b in range(n[d] // window)]
        tails = [k % window for k in n]
        seqs += [(tier, [(d, n[d] - tails[d] + at, k) for d, at, k in pieces])
                 for tier, pieces in pack_lengths(tails, window, tiers, slack)]
        group, first = [0] * len(seqs), 0
        for tier in tiers:
            of = [s for s, (t, _) in enumerate(seqs) if t == tier]
            dealt = step_groups([sum(p[2] ** 2 for p in seqs[s][1]) for s in of],
                                max(1, group_tokens // tier))
            for s, g in zip(of, dealt):
                group[s] = first + g
            first += max(dealt, default=-1) + 1
        base = int(key[0]) << 32
        out, doc_ids = [], list(f["doc_id"])
        for s, (tier, pieces) in enumerate(seqs):
            at = 0
            for d, start, k in pieces:
                out.append((doc_ids[d], start, k, n[d], base + s, at, tier, base + group[s],
                            ids[d][start:start + k].tobytes()))
                at += k
        return pd.DataFrame(out, columns=["doc_id", "start", "length", "doc_tokens", "sequence_id",
                                          "offset", "tier", "step_group", "ids"])

    coded = rows.mapInPandas(encode, "doc_id string, ids binary, bucket bigint")
    return coded.groupBy("bucket").applyInPandas(
        pack, "doc_id string, start bigint, length bigint, doc_tokens bigint, sequence_id bigint,"
              " offset bigint, tier int, step_group bigint, ids binary").withColumn("doc_id", F.col("doc_id").cast(kind))
