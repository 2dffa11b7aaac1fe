"""N-gram Jaccard join with adaptive multi-match prefixes, and its connected components.

A document's set holds its distinct word n-grams as 64-bit hashes, ordered by estimated frequency,
then hash. Two sets of sizes a and b with the wanted similarity share at least need(a, b) tokens, so for any l
the first a - need + l tokens of one and the first b - need + l of the other have l in common. Each document picks
its own l (1 to 4): the estimated cost of its candidates, from a sketch of token frequencies, is weighed against a
longer prefix, which asks for l shared tokens before a pair is verified. A pair goes by the smaller l of the two.

Steps:
1. One pass over the texts gives each document's set size and signature (equal sets form one class)
   and counts tokens into a sketch of fixed size.
2. A second pass emits prefix tokens; tokens that only one class has are dropped.
3. Each class is compared with its likeliest anchors (the most central class of the lists that it is in, and
   the first, if it shares l tokens with them): linear work, which joins large groups of near copies. Links
   give components.
4. Any pair that could still join two components is compared: within a token's list, the classes
   outside the list's largest component against all of other components. So no list of one
   component is paired out, and no link that could change a component is lost.
5. `jaccard_links` and `jaccard_pairs` find every link: none leaves its component, so all pairs of classes within
   each component are verified, large components in pairs of blocks of bounded size. `jaccard_classes` is the short
   way to the components and leaves this step out.

Frequencies only order tokens and choose l; results do not depend on them.

Defined results: null or wordless texts have size 0 and link with nothing; a text of fewer words than
n has one token, the whole sequence; null ids take part but never name a component (unless all
its ids are null); a repeated row is a copy of itself; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_through
from .graph import components

SKETCH = 1 << 18  # counters of the frequency sketch
MOST_MATCHES = 4
USUAL = 0.1  # partners that a token without notable frequency is taken to bring
SLOTS = 1 << 23  # bits of the filter for documents whose sets are wanted
BLOCK = 128  # classes of a component in a block,
BLOCK_TOKENS = 1 << 21  # and tokens, on average
_M = np.uint64(0x9E3779B97F4A7C15)
_POWERS: list[np.ndarray] = []
PIECE = 1 << 19  # bytes hashed at once


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _M
    return h ^ (h >> np.uint64(29))


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2^64, for a piece."""
    if not _POWERS or len(_POWERS[0]) < PIECE + 1:
        inverse = np.uint64(pow(int(_M), -1, 1 << 64))
        _POWERS[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(PIECE, x)])) for x in (_M, inverse)]
    return _POWERS[0], _POWERS[1]


def shingle_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its word n-grams; ASCII letters in lower case, ASCII white
    space. Words are found and hashed over the bytes of many texts at once (a polynomial over each word's bytes)."""
    out: list[np.ndarray] = []
    raw, size = [], 0
    for t in texts:
        r = t.encode() if t is not None else b""
        if raw and size + len(r) > PIECE:
            out += _sets_of(raw, n)
            raw, size = [], 0
        raw.append(r)
        size += len(r) + 1
    return out + (_sets_of(raw, n) if raw else [])


def _word_hashes(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the words of some bytes that end with white space. Bytes are taken in pieces; of a word that
    goes on in the next piece the sum so far and its length are carried."""
    up, down = _powers()
    starts, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    at, sum_, length = 0, np.uint64(0), 0  # the word that is open
    for lo in range(0, len(b), PIECE):
        p = b[lo:lo + PIECE]
        space = (p == 32) | ((p >= 9) & (p <= 13))
        p = np.where((p >= 65) & (p <= 90), p + np.uint8(32), p)
        edge = np.flatnonzero(np.concatenate([[space[0] == (length > 0)], space[1:] != space[:-1]]))
        if length and not space[0]:
            edge = np.concatenate([[0], edge])  # goes on
        sums = np.concatenate([[np.uint64(0)], np.cumsum((p.astype(np.uint64) + np.uint64(1)) * up[:len(p)])])
        if length and space[0]:  # had ended with the last piece
            starts.append(np.array([at]))
            hashes.append(np.array([sum_]))
            edge = edge[1:]
        start, end = edge[0::2], edge[1::2]
        word = (sums[np.append(end, len(p))[:len(start)]] - sums[start]) * down[start]
        if length and len(start) and not space[0]:
            with np.errstate(over="ignore"):
                word[0] = sum_ + np.uint64(pow(int(_M), length, 1 << 64)) * word[0]
        first = start + lo
        if length and len(start) and not space[0]:
            first[0] = at
        if len(start) > len(end):  # open at the end of the piece
            at, sum_, length = first[-1], word[-1], lo + len(p) - int(first[-1])
            word, first = word[:-1], first[:-1]
        else:
            length = 0
        starts.append(first)
        hashes.append(word)
    return np.concatenate(starts), _mix(np.concatenate(hashes))


def _sets_of(raw: list[bytes], n: int) -> list[np.ndarray]:
    start, word = _word_hashes(np.frombuffer(b"\n".join([*raw, b""]), np.uint8))
    bounds = np.cumsum([0] + [len(r) + 1 for r in raw])
    at = np.searchsorted(start, bounds)
    grams = word[:max(0, len(word) - n + 1)]
    for k in range(1, n):
        grams = _mix(grams) + word[k:len(word) - n + 1 + k]
    grams = _mix(grams)
    out = []
    for lo, hi in zip(at, at[1:]):
        if hi - lo >= n:
            g = np.sort(grams[lo:hi - n + 1])
            out.append(g[np.concatenate([[True], g[1:] != g[:-1]])])
        elif hi > lo:  # the whole sequence
            h = np.array([hi - lo], np.uint64)
            for w in word[lo:hi]:
                h = _mix(h) + w
            out.append(_mix(h))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def shingle_set(text: str | None, n: int) -> np.ndarray:
    return shingle_sets([text], n)[0]


def signature(tokens: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes()))))


class Prefixes:
    """Prefix tokens of sets under a similarity of `percent` / 100 and a frequency sketch."""

    def __init__(self, percent: int, counts: np.ndarray):
        self.percent = percent
        mean = counts.mean() if len(counts) else 0.0
        # What a counter holds beyond the usual load is taken for one frequent token.
        self.excess = np.maximum(0.0, counts - mean - 6 * np.sqrt(mean + 1))

    def of(self, tokens: np.ndarray):
        """(prefix tokens for partners of any size, l)."""
        n, p = len(tokens), self.percent
        least = -(-p * n // 100)  # shared with the smallest possible partner
        even = -(-2 * p * n // (100 + p))  # with one of the same size
        often = self.excess[(tokens & np.uint64(SKETCH - 1)).astype(np.int64)]
        if often.any():
            by = np.lexsort((tokens, often))
            tokens, often = tokens[by], often[by]
        most = min(MOST_MATCHES, least)
        length = n - even
        # Entries met, and partners, of which at most one in k is verified (at a cost that grows with n).
        cost = [length + k + (often[:length + k].sum() + USUAL * (length + k)) * (1 + n / k) for k in range(1, most + 1)]
        return tokens[:n - least + most], 1 + int(np.argmin(cost))


def slices(frames, rows: int = 500, chars: int = PIECE):
    """The batches of a task in short pieces (of one text at least), so that few sets are held at a time."""
    for f in frames:
        size = f["text"].str.len().fillna(0).to_numpy(np.int64)
        lo, total = 0, 0
        for k in range(len(f)):
            if k > lo and (k - lo >= rows or total + size[k] > chars):
                yield f.iloc[lo:k]
                lo, total = k, 0
            total += size[k]
        if len(f):
            yield f.iloc[lo:]


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4,
                    percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs."""
    sized, roots, _ = _joined(docs, id_col, text_col, n, percent)
    return _named(sized, roots).select("doc_id", "n_shingles", "component_id")


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4,
                  percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, class, n_links) for every row of docs: `class` is the same for equal sets
    (null for size 0), n_links counts the other rows that the row links with, copies included."""
    sized, roots, sets_for = _joined(docs, id_col, text_col, n, percent)
    copies = write_through(sized.where("n > 0").groupBy("sig").agg(
        F.first("n").alias("n"), F.count("*").alias("copies")), "jaccard-copies")
    linked = _verified(copies, roots, sets_for, percent, pairs=False).groupBy("sig").agg(F.sum("links").alias("links"))
    counts = write_through(copies.join(linked, "sig", "left").select(
        "sig", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "jaccard-counts")
    return _named(sized, roots).join(counts, "sig", "left").select(
        "doc_id", "n_shingles", "component_id", F.when(F.col("n_shingles") > 0, F.col("sig")).alias("class"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"))


def jaccard_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4,
                  percent: int = 85) -> DataFrame:
    """(class_a, class_b, doc_a, doc_b) for every link between different sets, class_a > class_b as in `jaccard_links`;
    doc_a and doc_b are the smallest ids of the classes. As many rows as there are links: their number grows with
    the square of a group's size."""
    sized, roots, sets_for = _joined(docs, id_col, text_col, n, percent)
    copies = write_through(sized.where("n > 0").groupBy("sig").agg(
        F.first("n").alias("n"), F.count("*").alias("copies"), F.min("doc_id").alias("doc_id")), "jaccard-copies")
    out = _verified(copies, roots, sets_for, percent, pairs=True)
    for side in "ab":
        out = out.join(copies.select(F.col("sig").alias(side), F.col("doc_id").alias(f"doc_{side}")), side)
    return out.select(F.col("a").alias("class_a"), F.col("b").alias("class_b"), "doc_a", "doc_b")


def shared_tokens(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Matrix of the numbers of tokens that the sets of x share with those of y."""
    if len(x) * len(y) <= 4:
        return np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in y] for a in x], np.int64)
    vocabulary = np.intersect1d(np.concatenate(x), np.concatenate(y))
    sides = []
    for sets in (x, y):
        tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.searchsorted(vocabulary, tokens)
        hit = np.flatnonzero(at < len(vocabulary))
        hit = hit[vocabulary[at[hit]] == tokens[hit]]
        hit = hit[np.argsort(at[hit], kind="stable")]
        sides.append((at[hit], owner[hit], len(sets)))
    out = np.zeros((len(x), len(y)), np.int64)
    for lo in range(0, len(vocabulary), 4096):
        parts = []
        for at, owner, size in sides:
            here = slice(*np.searchsorted(at, [lo, lo + 4096]))
            part = np.zeros((size, 4096), np.float32)
            part[owner[here], at[here] - lo] = 1
            parts.append(part)
        out += (parts[0] @ parts[1].T).astype(np.int64)  # whole numbers up to 4096
    return out


def _verified(copies: DataFrame, roots: DataFrame, sets_for, percent: int, pairs: bool) -> DataFrame:
    """All pairs of classes within the components, verified: the links (a, b), or the partial counts (sig, links)."""
    members = write_through(roots.select(F.col("node").alias("sig"), "root").join(copies.select("sig", "n", "copies"), "sig"), "jaccard-members")
    per_root = write_through(members.groupBy("root").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_TOKENS)).alias("k")), "jaccard-blocks")
    # Components of one block share tasks.
    m, tokens = members.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    buckets = F.lit(max(1, m // BLOCK, tokens // BLOCK_TOKENS))
    block = F.pmod(F.xxhash64("sig"), F.col("k"))
    dealt = (members.join(per_root, "root").withColumn("block", block).join(sets_for(members.select("sig")), "sig")
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)))
             .select(F.when(F.col("k") == 1, F.pmod(F.xxhash64("root"), buckets)).otherwise(F.col("root")).alias("key"), "k",
                     F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     "root", "block", "sig", "copies", "tokens"))

    def compare(f):
        f = f.sort_values(["root", "sig"], ignore_index=True)
        root, block, sig, copied = (f[c].to_numpy() for c in ("root", "block", "sig", "copies"))
        sets = [np.frombuffer(t, np.uint64) for t in f["tokens"]]
        size = np.array([len(s) for s in sets], np.int64)
        i, j = f["i"].iloc[0], f["j"].iloc[0]
        a, b, links = [], [], np.zeros(len(f), np.int64)
        for x in np.split(np.arange(len(f)), np.flatnonzero(root[1:] != root[:-1]) + 1):
            x, y = (x, x) if i == j else (x[block[x] == i], x[block[x] == j])
            if not len(x) or not len(y):
                continue
            both = shared_tokens([sets[k] for k in x], [sets[k] for k in y])
            keep = 100 * both >= percent * (size[x][:, None] + size[y][None, :] - both)
            if i == j:
                np.fill_diagonal(keep, False)
                links[x] += keep @ copied[x]
                keep = np.triu(keep)
            else:
                links[x] += keep @ copied[y]
                links[y] += keep.T @ copied[x]
            if pairs:
                u, v = np.nonzero(keep)
                a.append(np.maximum(sig[x[u]], sig[y[v]]))
                b.append(np.minimum(sig[x[u]], sig[y[v]]))
        if pairs:
            none = [np.zeros(0, np.int64)]
            return pd.DataFrame({"a": np.concatenate(none + a), "b": np.concatenate(none + b)})
        return pd.DataFrame({"sig": sig, "links": links})

    groups = dealt.groupBy("key", "k", "i", "j")
    return groups.applyInPandas(compare, "a bigint, b bigint" if pairs else "sig bigint, links bigint")


def _named(sized: DataFrame, roots: DataFrame) -> DataFrame:
    """(sig, doc_id, n_shingles, component_id) for every row of sized."""
    named = sized.join(roots.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    names = write_through(named.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("component_id")), "jaccard-names")
    return (named.join(names, "root", "left").select(
        "sig", "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def _joined(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int):
    """(sized, roots, sets_for): (doc_id, n, sig) of every row, (node, root) of the classes that link, and a function
    that gives (sig, tokens) of wanted classes."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    # pandas would turn whole numbers beside nulls into floats, so ids pass Python as text.
    texts = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))

    def sizes(frames):
        counts = np.zeros(SKETCH, np.int64)
        for f in slices(frames):
            sets = shingle_sets(list(f["text"]), n)
            slots = np.concatenate(sets) & np.uint64(SKETCH - 1)
            counts += np.bincount(slots.astype(np.int64), minlength=SKETCH)
            yield pd.DataFrame({"doc_id": f["doc_id"], "n": [len(s) for s in sets],
                                "sig": [signature(s) for s in sets], "slot": -1, "count": 0})
        at = np.nonzero(counts)[0]
        yield pd.DataFrame({"doc_id": pd.Series([None] * len(at), dtype="object"), "n": 0, "sig": 0, "slot": at, "count": counts[at]})

    first = write_through(texts.mapInPandas(
        sizes, "doc_id string, n bigint, sig bigint, slot int, count bigint"), "jaccard-sizes")
    sized = first.where("slot < 0").select(F.col("doc_id").cast(kind).alias("doc_id"), "n", "sig")
    counts = np.zeros(SKETCH)
    for r in first.where("slot >= 0").groupBy("slot").agg(F.sum("count").alias("c")).toLocalIterator():
        counts[r["slot"]] = r["c"]  # at most SKETCH rows
    shared = spark.sparkContext.broadcast(counts)

    def emit(frames):
        prefixes = Prefixes(percent, shared.value)
        for f in slices(frames):
            parts = []
            for s in shingle_sets(list(f["text"]), n):
                if len(s):
                    tokens, ell = prefixes.of(s)
                    meta = (len(s) << 29) + (ell << 26) + np.arange(len(tokens), dtype=np.int64)
                    parts.append((tokens, np.full(len(tokens), signature(s)), meta))
            if parts:
                tok, sig, meta = (np.concatenate(x) for x in zip(*parts))
                yield pd.DataFrame({"token": tok.view(np.int64), "sig": sig, "meta": meta})

    entries = texts.where(F.col("text").isNotNull()).mapInPandas(emit, "token bigint, sig bigint, meta bigint")
    # Aggregates are written before they are joined back: then both sides of the join are plain shuffles and a
    # token or class that many documents have is split.
    common = write_through(entries.groupBy("token").agg(F.min("sig").alias("lo"), F.max("sig").alias("hi"))
                           .where("lo != hi"), "jaccard-common")
    lists = write_through(entries.join(common, "token").select(
        "token", "sig", "lo", F.expr("meta >> 29").alias("n"), F.expr("cast((meta >> 26) & 7 as int)").alias("ell"),
        F.expr("cast(meta & 67108863 as int)").alias("pos")).distinct(), "jaccard-lists")

    classes = write_through(sized.where("n > 0").groupBy("sig").agg(F.min("doc_id").cast("string").alias("doc_id")), "jaccard-classes")
    slot = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit("null"))), F.lit(SLOTS))

    def sets_for(wanted):
        """(sig, tokens) of the classes in wanted, from the text of one document each. A bitmap of fixed size keeps
        other texts out of the pass (false hits fall to the join)."""
        chunks = (wanted.join(classes, "sig").select(slot.alias("s"))
                  .groupBy(F.bitmap_bucket_number(F.col("s") + 1).alias("k"))  # buckets of 32,768 bits, from 1
                  .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("s") + 1)).alias("bits"))
                  .collect())  # at most SLOTS bits
        bits = np.zeros(SLOTS // 8, np.uint8)
        for r in chunks:
            bits[(r["k"] - 1) * 4096:r["k"] * 4096] = np.frombuffer(r["bits"], np.uint8)
        held = spark.sparkContext.broadcast(bits)

        def sets_of(frames):
            for f in slices(frames):
                s = f["slot"].to_numpy()
                hit = (held.value[s >> 3] >> (s & 7)) & 1 == 1
                if hit.any():
                    sets = shingle_sets(list(f["text"].to_numpy()[hit]), n)
                    yield pd.DataFrame({"sig": [signature(x) for x in sets], "tokens": [x.tobytes() for x in sets]})

        found = (texts.where(F.col("text").isNotNull()).select("text", slot.alias("slot"))
                 .mapInPandas(sets_of, "sig bigint, tokens binary"))
        return write_through(found.join(wanted, "sig", "left_semi").dropDuplicates(["sig"]), "jaccard-sets")

    def verify(frames):
        for f in frames:
            keep = []
            for a, b in zip(f["tokens_a"], f["tokens_b"]):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield f.loc[keep, ["a", "b"]]

    def links(pairs):
        sets = sets_for(pairs.select(F.col("a").alias("sig")).union(pairs.select("b")).distinct())
        left = sets.select(F.col("sig").alias("a"), F.col("tokens").alias("tokens_a"))
        right = sets.select(F.col("sig").alias("b"), F.col("tokens").alias("tokens_b"))
        return pairs.join(left, "a").join(right, "b").mapInPandas(verify, "a bigint, b bigint")

    # Anchors of a token's list: its most central class (that with the fewest prefix tokens of its own) and its
    # first. Per class, those are tried that most of its tokens lead to.
    shared_with = lists.groupBy("sig").agg(F.count("*").alias("c"))
    least = f"(n * {percent} + 99) div 100"
    central = write_through(lists.join(shared_with, "sig").groupBy("token").agg(
        F.min(F.struct(F.expr(f"n - {least} + least({least}, {MOST_MATCHES}) - c").alias("own"), "sig")).alias("best"))
        .select("token", F.col("best.sig").alias("central")), "jaccard-central")
    led = lists.join(central, "token")
    near = []
    for anchor in ("lo", "central"):
        met = led.where(f"sig != {anchor}").groupBy("sig", anchor).agg(
            F.count("*").alias("count"), F.first("ell").alias("ell")).where("count >= ell")
        near.append(met.groupBy("sig").agg(F.max_by(anchor, F.struct("count", anchor)).alias("b")).select(F.col("sig").alias("a"), "b"))
    first_pairs = write_through(near[0].union(near[1]).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "jaccard-pairs")
    found = write_through(links(first_pairs), "jaccard-links")
    roots = write_through(components(found), "jaccard-roots")

    # What could still join two components.
    placed = lists.join(roots.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig")).drop("lo")
    mixed = write_through(placed.groupBy("token", "root").count().groupBy("token").agg(
        F.max_by("root", F.struct("count", "root")).alias("main"), F.count("*").alias("roots")).where("roots > 1"), "jaccard-mixed")
    open_lists = write_through(placed.join(mixed.select("token", "main"), "token"), "jaccard-open")
    cols = ("sig", "n", "ell", "pos", "root")
    x = open_lists.where("root != main").select("token", *[F.col(c).alias(f"x_{c}") for c in cols])
    y = open_lists.select("token", "main", *[F.col(c).alias(f"y_{c}") for c in cols])
    need = f"((x_n + y_n) * {percent} + {99 + percent}) div {100 + percent}"
    met = x.join(y, "token").where(
        "x_root != y_root and (y_root = main or x_sig < y_sig) and "
        f"100 * least(x_n, y_n) >= {percent} * greatest(x_n, y_n) and "
        f"x_pos < x_n - {need} + least(x_ell, y_ell) and y_pos < y_n - {need} + least(x_ell, y_ell)").select(
        F.least("x_sig", "y_sig").alias("a"), F.greatest("x_sig", "y_sig").alias("b"), F.least("x_ell", "y_ell").alias("ell"))
    pairs = write_through(met.groupBy("a", "b").agg(F.count("*").alias("matches"), F.first("ell").alias("ell"))
                          .where("matches >= ell").select("a", "b"), "jaccard-pairs")
    if not pairs.isEmpty():
        more = write_through(links(pairs), "jaccard-links")
        if not more.isEmpty():
            roots = write_through(components(found.union(more)), "jaccard-roots")

    return sized, roots, sets_for
