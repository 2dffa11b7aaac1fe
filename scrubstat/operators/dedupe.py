"""Implicit duplicates (C8, C9, C24) without comparing all pairs.

Candidate pairs come from blocked self-joins on shared grams:

* Tokens (C8 b): values sharing a token are matches by definition; the token join is salted so a
  token shared by many values is split over many tasks.
* Containment (C8 a): if s is inside t, t holds every bigram occurrence of s, in particular the
  rarest one; s is indexed by that bigram only, t by all of its bigrams.
* Similarity (C8 c, C9): an edit-distance bound turns "score >= threshold" into "the two strings
  share at least tau bigram occurrences" (occurrences are numbered, so multiset overlap becomes
  set overlap). With elements ordered from rarest to most common, two strings that share tau
  elements share one among their first n - tau + 1 (prefix filtering), so only prefixes are
  joined. Strings too short for a positive bound are paired through shared characters.

* One edit (C9): strings that differ in one character meet on what is left without it, grouped by place; such a
  group holds one string per character, all similar to each other, so it stands for all of its pairs.

Scoring is exact: Spark's `levenshtein` (default), or an Arrow UDF for difflib's ratio and the
weighted ratio. Greedy canonical grouping runs in parallel rounds over groups of similar names.
"""

from __future__ import annotations

import difflib
import math
import re
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import dtype, is_string, scope
from ..functions.text import normalize_key, squash, tokens
from ..session import write_through
from .bags import bag_candidates, edit_admits, ratio_admits

HOT_KEY_ROWS = 2000  # rows per task when a join key is shared by many values
ONE_EDIT = 399  # longest string that is grouped by its text without one character
BLOCK_BITS = 16  # greedy grouping scans blocks of neighbouring names, of two to this power at most
LIVE, WON, LOST = 0, 1, 2  # a name in the greedy scan


# --- candidate generation ------------------------------------------------------------------

def salted_self_pairs(items: DataFrame, key: str = "gram", ident: str = "id",
                      hot: int = HOT_KEY_ROWS) -> DataFrame:
    """Unordered pairs (a < b) of ids that share a key, deduplicated.

    A key held by m > hot ids is split into ceil(m / hot) salt buckets on one side and its rows
    are replicated once per bucket on the other, so its m^2 / 2 comparisons spread over tasks.
    """
    freq = write_through(items.groupBy(key).agg(F.count(F.lit(1)).alias("_m")), "gram-counts")
    it = items.join(freq, key)
    buckets = F.when(F.col("_m") > hot, F.ceil(F.col("_m") / hot)).otherwise(F.lit(1))
    left = it.select(key, F.col(ident).alias("a"),
                     F.pmod(F.xxhash64(F.col(ident)), buckets.cast("long")).alias("_salt"))
    right = it.select(key, F.col(ident).alias("b"),
                      F.explode(F.sequence(F.lit(0).cast("long"),
                                           (buckets - 1).cast("long"))).alias("_salt"))
    return (left.join(right, [key, "_salt"]).where(F.col("a") < F.col("b"))
            .select("a", "b").distinct())


def salted_pairs(left: DataFrame, right: DataFrame, key: str = "gram", hot: int = HOT_KEY_ROWS) -> DataFrame:
    """left(key, x) joined to right(key, y): distinct (x, y), x != y. A key that many right rows hold is split
    into buckets of about `hot` of them; the left rows of the key are repeated once per bucket."""
    # written first, so that the joins back to it are between plain shuffles and split when skewed
    freq = write_through(right.groupBy(key).agg(F.count(F.lit(1)).alias("_m")), "gram-counts")
    buckets = F.ceil(F.col("_m") / hot).cast("long")
    r = right.join(freq, key).select(key, "y", F.pmod(F.xxhash64("y"), buckets).alias("_salt"))
    l = left.join(freq, key).select(key, "x", F.explode(F.sequence(F.lit(0).cast("long"), buckets - 1)).alias("_salt"))  # noqa: E741
    return l.join(r, [key, "_salt"]).where("x != y").select("x", "y").distinct()


def _blocked(gram: Column, block: str | None) -> Column:
    """Prefix a join key with the block (e.g. the column name) so joins stay in a block."""
    return F.concat(F.col(block), F.lit("\u0000"), gram) if block else gram


def _bigram_occurrences(keys: DataFrame, col: str = "key", ident: str = "id",
                        block: str | None = None) -> DataFrame:
    """(id, el) where el = bigram + '#' + its occurrence number within the string."""
    n = F.length(F.col(col))
    grams = F.when(n >= 2, F.transform(F.sequence(F.lit(1), n - 1),
                                       lambda i: F.substring(F.col(col), i, 2)))
    extra = [block] if block else []
    pos = keys.select(ident, *extra, F.posexplode(grams).alias("_p", "_g"))
    w = Window.partitionBy(ident, "_g").orderBy("_p")
    el = F.concat(F.col("_g"), F.lit("#"), F.row_number().over(w).cast("string"))
    return pos.select(ident, _blocked(el, block).alias("el"))


def prefix_candidates(keys: DataFrame, coef: float, col: str = "key", ident: str = "id",
                      block: str | None = None) -> DataFrame:
    """Pairs (a < b) that may share at least ceil(L * coef - 1) bigram occurrences, where L is
    the longer length: each string keeps only its n - tau + 1 rarest elements (tau from its own
    length, a lower bound of the pair's), and strings meet on a shared kept element.
    Strings with tau <= 0 pair up through shared characters instead."""
    occ = _bigram_occurrences(keys, col, ident, block)
    freq = occ.groupBy("el").agg(F.count(F.lit(1)).alias("_f"))
    lens = keys.select(ident, F.length(F.col(col)).alias("_L"))
    ranked = occ.join(freq, "el").join(lens, ident)
    w = Window.partitionBy(ident).orderBy("_f", "el")
    tau = F.ceil(F.col("_L") * coef - 1)
    keep = (F.col("_L") - 1) - tau + 1
    pref = (ranked.withColumn("_r", F.row_number().over(w))
            .where((tau <= 0) | (F.col("_r") <= keep)).select(ident, F.col("el").alias("gram")))
    pairs = salted_self_pairs(pref, "gram", ident)
    short_len = math.floor(1.0 / coef) if coef > 0 else 10 ** 9
    extra = [block] if block else []
    short = keys.where(F.length(F.col(col)) <= short_len).select(
        ident, *extra, F.explode(F.array_distinct(F.split(F.col(col), ""))).alias("gram"))
    short = short.select(ident, _blocked(F.col("gram"), block).alias("gram"))
    return pairs.unionByName(salted_self_pairs(short, "gram", ident)).distinct()


def deletion_candidates(keys: DataFrame, t: float, col: str = "key", ident: str = "id",
                        max_variants: int = 400) -> DataFrame:
    """Exact candidates for levenshtein score >= 100 t (Spark's `levenshtein`).

    If two strings are within edit distance k, deleting at most k characters from each gives
    the same string. A string of length L never needs more than k = floor((1-t) L / t)
    deletions in any qualifying pair, so strings whose deletion neighbourhood (all variants with
    <= k deletions, k <= 2) stays under `max_variants` meet on a shared variant. Longer strings
    fall back to prefix filtering against every string, which is lossless for any pair.
    """
    L = F.length(F.col(col))
    k = F.floor((1 - t) * L / t + 1e-9)
    c = F.col(col)
    empty = F.array().cast("array<string>")
    v1 = F.when(L >= 1, F.transform(F.sequence(F.lit(1), L), lambda i: F.concat(
        F.substring(c, 1, i - 1), F.substring(c, i + 1, 1 << 30)))).otherwise(empty)
    v2 = F.when(L >= 2, F.flatten(F.transform(F.sequence(F.lit(1), L - 1), lambda i: F.transform(
        F.sequence(i + 1, L), lambda j: F.concat(F.substring(c, 1, i - 1),
                                                 F.substring(c, i + 1, j - i - 1),
                                                 F.substring(c, j + 1, 1 << 30)))))).otherwise(empty)
    n_var = 1 + L + L * (L - 1) / 2
    small = (k <= 0) | ((k == 1) & (1 + L <= max_variants)) | ((k == 2) & (n_var <= max_variants))
    variants = F.array_distinct(F.concat(F.array(c), F.when(k >= 1, v1).otherwise(empty),
                                         F.when(k >= 2, v2).otherwise(empty)))
    tagged = keys.select(ident, col, small.alias("_small"))
    items = (tagged.where(F.col("_small"))
             .select(ident, F.explode(variants).alias("gram")))
    pairs = salted_self_pairs(items, "gram", ident)
    big = tagged.where(~F.col("_small"))
    if big.isEmpty():
        return pairs
    coef = 2 * t - 1
    pref_all = _prefix_elements(keys, coef, col, ident)
    big_ids = big.select(F.col(ident).alias("_bid"))
    pref_big = pref_all.join(big_ids, F.col(ident) == F.col("_bid")).drop("_bid")
    unordered = lambda p: p.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    cross = unordered(salted_pairs(pref_big.select("gram", F.col(ident).alias("x")),
                                   pref_all.select("gram", F.col(ident).alias("y"))))
    # pairs whose longer string has length <= 1/coef get no shared-bigram guarantee: pair
    # such strings through a shared character (any match keeps at least one character)
    short_len = math.floor(1.0 / coef) if coef > 0 else 10 ** 9
    chars = keys.where(L <= short_len).select(
        ident, F.explode(F.array_distinct(F.split(F.col(col), ""))).alias("gram"))
    big_short = chars.join(big.select(ident), ident)
    by_char = unordered(salted_pairs(big_short.select("gram", F.col(ident).alias("x")),
                                     chars.select("gram", F.col(ident).alias("y"))))
    return pairs.unionByName(cross).unionByName(by_char).distinct()


def _edits(t: float) -> Column:
    """The most edits between a key and another of levenshtein score >= 100 t."""
    return F.floor((1 - t) * F.length("key") / t + 1e-9)


def one_edit_groups(keys: DataFrame, threshold: float, *carry: str) -> DataFrame:
    """Keys of keys(key, *carry), each there once, of at most `ONE_EDIT` characters, that one edit parts, with
    levenshtein score >= threshold (above 50): rows (rest, p, score, members). A member (p, c, *carry) is the key
    with the character c at place p of `rest` (`_key_of`). With p > 0 the members differ in that place only and all match
    each other; with p = 0 the first member, `rest` itself, matches each of the others. No pair is in two rows."""
    longest = F.length("rest") + 1
    placed = keys.where((_edits(threshold / 100.0) >= 1) & (F.length("key") <= ONE_EDIT)).select(
        "key", *carry, F.explode(F.sequence(F.lit(0), F.length("key"))).alias("p"))
    items = placed.select(
        F.when(F.col("p") == 0, F.col("key")).otherwise(F.expr("concat(left(key, p - 1), substring(key, p + 1))")).alias("rest"),
        F.struct("p", F.expr("CASE WHEN p = 0 THEN '' ELSE substring(key, p, 1) END").alias("c"), *carry).alias("x"))
    # dealt first: the lists do not get shorter by being made before the shuffle
    met = (items.repartition("rest").groupBy("rest").agg(F.collect_list("x").alias("all")).where(F.size("all") > 1)
           .withColumn("score", 100.0 * (1 - F.lit(1) / longest)).where(F.col("score") >= threshold))
    rows = met.select("rest", "score", "all", F.explode(F.array_distinct(F.col("all.p"))).alias("p"))
    # in a run of one character the same text is left wherever it is cut: only its first place counts there
    members = F.expr("sort_array(CASE WHEN p > 0 THEN filter(all, x -> x.p = p) ELSE filter(all, x -> x.p <= 1 OR "
                     "substring(rest, x.p - 1, 1) <> x.c) END)")
    return rows.select("rest", "p", "score", members.alias("members")).where(F.size("members") > 1)


def _key_of(rest: str, x: str) -> Column:
    return F.expr(f"concat(left({rest}, {x}.p - 1), {x}.c, substring({rest}, greatest({x}.p, 1)))")


def _matches(groups: DataFrame) -> DataFrame:
    """Every matching pair (x, y) of members of `one_edit_groups`, once."""
    later = F.expr("CASE WHEN p > 0 THEN filter(members, y -> y.c > x.c) WHEN x.p = 0 THEN filter(members, y -> y.p > 0) END")
    return groups.select("*", F.explode("members").alias("x")).select("rest", "score", "x", F.explode(later).alias("y"))


def _further_pairs(keys: DataFrame, threshold: float) -> DataFrame | None:
    """The pairs (key_a, key_b, score) of levenshtein score >= threshold that `one_edit_groups` leaves out; None if no key
    is long enough to have any."""
    edits, n = _edits(threshold / 100.0), F.length("key")
    keys = keys.where((edits >= 2) | (edits >= 1) & (n >= ONE_EDIT)).select("key", F.col("key").alias("id"))
    if keys.isEmpty():
        return None
    pairs = _scored(deletion_candidates(keys, threshold / 100.0), levenshtein_score(F.col("a"), F.col("b")), threshold)
    return pairs.where((F.greatest(F.length("key_a"), F.length("key_b")) > ONE_EDIT) | (F.levenshtein("key_a", "key_b") > 1))


def _scored(cand: DataFrame, score: Column, threshold: float) -> DataFrame:
    """Candidates (a, b), which are the keys themselves, as pairs (key_a, key_b, score) of score >= threshold."""
    return cand.select(F.least("a", "b").alias("key_a"), F.greatest("a", "b").alias("key_b"),
                       score.alias("score")).where(F.col("score") >= threshold)


def _prefix_elements(keys: DataFrame, coef: float, col: str = "key", ident: str = "id"
                     ) -> DataFrame:
    occ = _bigram_occurrences(keys, col, ident)
    freq = occ.groupBy("el").agg(F.count(F.lit(1)).alias("_f"))
    lens = keys.select(ident, F.length(F.col(col)).alias("_L"))
    ranked = occ.join(freq, "el").join(lens, ident)
    w = Window.partitionBy(ident).orderBy("_f", "el")
    tau = F.ceil(F.col("_L") * coef - 1)
    keep = (F.col("_L") - 1) - tau + 1
    return (ranked.withColumn("_r", F.row_number().over(w))
            .where((tau <= 0) | (F.col("_r") <= keep)).select(ident, F.col("el").alias("gram")))


def containment_candidates(keys: DataFrame, col: str = "key", ident: str = "id",
                           block: str | None = None) -> DataFrame:
    """Ordered pairs (inner, outer) where outer may contain inner: the inner string is indexed
    by its rarest bigram occurrence, the outer by all of its occurrences. Inner strings of one
    character are indexed by that character against every character of the outer."""
    occ = _bigram_occurrences(keys, col, ident, block)
    freq = occ.groupBy("el").agg(F.count(F.lit(1)).alias("_f"))
    rarest = (occ.join(freq, "el").groupBy(ident)
              .agg(F.min_by("el", F.struct("_f", "el")).alias("gram")))
    outer = occ.select(F.col(ident).alias("y"), F.col("el").alias("gram"))
    pairs = salted_pairs(rarest.select(F.col(ident).alias("x"), "gram"), outer)
    extra = [block] if block else []
    one = keys.where(F.length(F.col(col)) == 1).select(
        F.col(ident).alias("x"), _blocked(F.col(col), block).alias("gram"))
    chars = keys.select(F.col(ident).alias("y"), *extra,
                        F.explode(F.array_distinct(F.split(F.col(col), ""))).alias("gram"))
    chars = chars.select("y", _blocked(F.col("gram"), block).alias("gram"))
    return (pairs.unionByName(salted_pairs(one, chars)).distinct()
            .select(F.col("x").alias("inner"), F.col("y").alias("outer")))


# --- scorers -------------------------------------------------------------------------------

def levenshtein_score(a: Column, b: Column) -> Column:
    """100 * (1 - edit distance / longer length), 100 for two empty strings."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(100.0)).otherwise(
        100.0 * (1 - F.levenshtein(a, b) / longest))


@F.pandas_udf(T.DoubleType())
def difflib_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """difflib.SequenceMatcher(None, a, b).ratio(), order-sensitive like the original."""
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)])


def _indel_ratio(a: str, b: str) -> float:
    """2 * LCS / (len a + len b) * 100 (normalised insert/delete similarity)."""
    if not a and not b:
        return 100.0
    if not a or not b:
        return 0.0
    return 200.0 * _lcs(a, b) / (len(a) + len(b))


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, one row of the table as bits of an integer."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _partial(short: str, long: str) -> float:
    if not short:
        return 0.0
    k = len(short)
    best = 0.0
    for i in range(0, len(long) - k + 1):
        best = max(best, _indel_ratio(short, long[i:i + k]))
        if best == 100.0:
            break
    return best


_NON_ALNUM = re.compile(r"[^0-9a-zA-Z]+")


def _process(s: str) -> str:
    return _NON_ALNUM.sub(" ", s).lower().strip()


def weighted_ratio(a: str, b: str) -> float:
    """Weighted ratio (0-100) after the public description: plain ratio; token-sorted and
    token-set ratios scaled by 0.95 when lengths are close; partial ratios scaled by 0.9
    (0.6 beyond a length ratio of 8) otherwise."""
    p1, p2 = _process(a), _process(b)
    if not p1 or not p2:
        return 0.0
    base = _indel_ratio(p1, p2)
    t1, t2 = p1.split(), p2.split()
    sort1, sort2 = " ".join(sorted(t1)), " ".join(sorted(t2))
    s1, s2 = set(t1), set(t2)
    inter = " ".join(sorted(s1 & s2))
    d1 = (inter + " " + " ".join(sorted(s1 - s2))).strip()
    d2 = (inter + " " + " ".join(sorted(s2 - s1))).strip()
    lr = max(len(p1), len(p2)) / min(len(p1), len(p2))
    if lr < 1.5:
        tsort = _indel_ratio(sort1, sort2)
        tset = max(_indel_ratio(inter, d1) if inter else 0.0,
                   _indel_ratio(inter, d2) if inter else 0.0, _indel_ratio(d1, d2))
        return float(round(max(base, tsort * 0.95, tset * 0.95)))
    scale = 0.9 if lr < 8 else 0.6
    sh, lo = (p1, p2) if len(p1) <= len(p2) else (p2, p1)
    ssh, slo = (sort1, sort2) if len(sort1) <= len(sort2) else (sort2, sort1)
    part = _partial(sh, lo) * scale
    psort = _partial(ssh, slo) * 0.95 * scale
    dsh, dlo = (d1, d2) if len(d1) <= len(d2) else (d2, d1)
    pset = max(_partial(dsh, dlo), 100.0 if inter and (not (s1 - s2) or not (s2 - s1)) else 0.0)
    return float(round(max(base, part, psort, pset * 0.95 * scale)))


@F.pandas_udf(T.DoubleType())
def wratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([weighted_ratio(x, y) for x, y in zip(a, b)])


# --- C8 ------------------------------------------------------------------------------------

def _distinct_values(df: DataFrame, column: str) -> DataFrame:
    v = df.select(F.col(column).cast("string").alias("value")).where(F.col("value").isNotNull())
    return v.distinct().select("value", F.col("value").alias("id"))


def implicit_duplicates_token(df: DataFrame, include=None, exclude=None,
                              fuzzy_threshold: float = 0.85, scorer: str = "difflib",
                              token_pairs: bool = True) -> DataFrame:
    """Per string column, ordered pairs (base, other) of distinct values that match by
    containment of squashed forms, a shared token, or similarity of squashed forms >=
    threshold (difflib ratio, order-sensitive; or the symmetric levenshtein ratio).

    Output: (column_name, base, other, by_containment, by_token, by_fuzzy). As in the original,
    a value whose squashed form is empty matches every other value. The pairs of a token grow with the square of
    its values; `token_pairs=False` leaves out pairs that only share a token (`token_groups` lists those values
    once per token).
    """
    if include:
        cols = [c for c in scope(df, include, None, lenient=True)]
    else:
        cols = scope(df, None, exclude)
    cols = [c for c in cols if is_string(dtype(df, c))]
    if not cols:
        raise ValueError("no string column to scan")
    return _token_dups(df, cols, fuzzy_threshold, scorer, token_pairs)


def _token_dups(df: DataFrame, cols: Sequence[str], t: float, scorer: str, token_pairs: bool) -> DataFrame:
    """All columns in one pass: values are tagged with their column, and every join key
    (token, bigram, character) carries the column name, so pairs never cross columns."""
    parts = [df.select(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
             for c in cols]
    tagged = parts[0]
    for p in parts[1:]:
        tagged = tagged.unionByName(p)
    vals = (tagged.where(F.col("value").isNotNull()).distinct()
            .withColumn("id", F.concat(F.col("column_name"), F.lit("\u0000"), F.col("value")))
            .withColumn("key", squash(F.col("value"))))
    vals = write_through(vals, "token-values")
    ids = vals.select("id", "key", "column_name")
    blk = "column_name"
    # (b) tokens (unless pairs that share no more than a token are left out)
    toks = vals.select("id", blk, F.explode(F.array_distinct(tokens(F.col("value"))))
                       .alias("_t")).select("id", _blocked(F.col("_t"), blk).alias("gram"))
    tok_pairs = salted_self_pairs(toks if token_pairs else toks.limit(0), "gram", "id").withColumn("_tok", F.lit(True))
    # (a) containment (ordered) -> unordered pairs
    nonempty = ids.where(F.length("key") > 0)
    cont = containment_candidates(nonempty, block=blk)
    cont_pairs = cont.select(F.least("inner", "outer").alias("a"),
                             F.greatest("inner", "outer").alias("b")).distinct()
    # (c) similarity
    coef = (4 * t - 3) if scorer == "difflib" else (2 * t - 1)
    if coef > 0:
        sim_pairs = prefix_candidates(nonempty, coef, block=blk)
    else:  # too weak for shared bigrams
        sim_pairs = bag_candidates(nonempty, ratio_admits(t) if scorer == "difflib" else edit_admits(t), block=blk)
    cand = (tok_pairs.select("a", "b").unionByName(cont_pairs).unionByName(sim_pairs)
            .distinct().join(tok_pairs, ["a", "b"], "left"))
    # empty squashed forms match everything in their column (both directions): the output is
    # |empties| x d by definition. An equi-join on the column name, so AQE broadcasts the
    # empties only when their measured size is small and splits a skewed column otherwise.
    empties = ids.where(F.length("key") == 0).select(F.col("id").alias("e"),
                                                     F.col(blk).alias("_eb"))
    empty_pairs = ids.select(F.col("id").alias("o"), F.col(blk).alias("_ob")).join(
        empties, (F.col("_eb") == F.col("_ob")) & (F.col("e") != F.col("o")))
    ep = empty_pairs.select(F.least("e", "o").alias("a"), F.greatest("e", "o").alias("b"))
    cand = cand.unionByName(ep.withColumn("_tok", F.lit(None).cast("boolean"))) \
        .groupBy("a", "b").agg(F.max("_tok").alias("_tok"))
    va = vals.select(F.col("id").alias("a"), F.col("column_name"), F.col("value").alias("va"),
                     F.col("key").alias("ka"))
    vb = vals.select(F.col("id").alias("b"), F.col("value").alias("vb"), F.col("key").alias("kb"))
    j = cand.join(va, "a").join(vb, "b")
    both = j.select("column_name", F.col("va").alias("base"), F.col("vb").alias("other"),
                    F.col("ka").alias("kb_"), F.col("kb").alias("ko_"), "_tok").unionByName(
        j.select("column_name", F.col("vb").alias("base"), F.col("va").alias("other"),
                 F.col("kb").alias("kb_"), F.col("ka").alias("ko_"), "_tok"))
    kb, ko = F.col("kb_"), F.col("ko_")
    contains = (F.instr(ko, kb) > 0) | (F.instr(kb, ko) > 0)
    if scorer == "difflib":
        fuzzy = difflib_ratio(kb, ko) >= t
    else:
        fuzzy = levenshtein_score(kb, ko) >= round(100.0 * t, 9)
    scored = both.select("column_name", "base", "other", contains.alias("by_containment"),
                         (F.coalesce(F.col("_tok"), F.lit(False)) if token_pairs else
                          F.arrays_overlap(tokens(F.col("base")), tokens(F.col("other")))).alias("by_token"),
                         F.coalesce(fuzzy, F.lit(False)).alias("by_fuzzy"))
    wanted = F.col("by_containment") | F.col("by_fuzzy")
    return scored.where(wanted | F.col("by_token") if token_pairs else wanted)


def token_groups(df: DataFrame, include=None, exclude=None) -> DataFrame:
    """C8 (b) without pairs: (column_name, token, n_values, value) for every token that two or more distinct
    values of a column share. Linear in the data, where the pairs of a common token grow with its square."""
    cols = [c for c in (scope(df, include, None, lenient=True) if include else scope(df, None, exclude))
            if is_string(dtype(df, c))]
    if not cols:
        raise ValueError("no string column to scan")
    flat = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in cols])))
    toks = flat.where("value is not null").distinct().select(
        "column_name", "value", F.explode(F.array_distinct(tokens(F.col("value")))).alias("token"))
    common = write_through(toks.groupBy("column_name", "token").agg(F.count(F.lit(1)).alias("n_values"))
                           .where("n_values > 1"), "token-counts")
    return toks.join(common, ["column_name", "token"]).select("column_name", "token", "n_values", "value")


# --- C9 ------------------------------------------------------------------------------------

def fuzzy_pairs(df: DataFrame, column: str, threshold: float = 90, scorer: str = "wratio",
                keep_empty: bool = False) -> DataFrame:
    """C9 step 1-3: normalised keys (C11), blocked candidates, exact score >= threshold, which may be
    any: below 87 (weighted ratio) or 50 (levenshtein) candidates come from character bags (`bags`).

    Output: unordered pairs (key_a < key_b, score).
    """
    keys = _fuzzy_keys(df, column, keep_empty)
    t = threshold / 100.0
    if scorer == "levenshtein" and t > 0.5:
        # already exact and each once: neither scored nor made distinct
        near = _matches(one_edit_groups(keys, threshold)).select(
            _key_of("rest", "x").alias("_x"), _key_of("rest", "y").alias("_y"), "score")
        near = near.select(F.least("_x", "_y").alias("key_a"), F.greatest("_x", "_y").alias("key_b"), "score")
        further = _further_pairs(keys, threshold)
        return near if further is None else near.unionByName(further)
    keys = keys.withColumn("id", F.col("key"))
    a, b = F.col("a"), F.col("b")
    if scorer == "levenshtein":
        return _scored(bag_candidates(keys, edit_admits(t)), levenshtein_score(a, b), threshold)
    if scorer == "wratio":
        cand = _wratio_candidates(keys, threshold) if threshold >= WRATIO_LEAST else _wratio_bags(keys, threshold)
        return _scored(cand, wratio_udf(a, b), threshold)
    raise ValueError("scorer must be 'levenshtein' or 'wratio'")


def _fuzzy_keys(df: DataFrame, column: str, keep_empty: bool = False) -> DataFrame:
    if column not in df.columns:
        raise ValueError(f"no column {column!r} to group")
    keys = df.select(normalize_key(F.col(column)).alias("key"))
    if not keep_empty:
        keys = keys.where(F.length("key") > 0)
    # the distinct keys feed several branches: compute the normalisation once
    return write_through(keys.distinct(), "fuzzy-keys")


WRATIO_LEAST = 87  # below it, partial token ratios (at most 85.5) count too, and bigrams are no longer sure


def _wratio_bags(keys: DataFrame, threshold: float) -> DataFrame:
    """Lossless candidates for weighted ratio >= threshold at any threshold: pairs that share a token, and those whose
    common characters reach the bound of one of the ratios. Sorting tokens keeps the characters, and its ratio
    counts 0.95, so the plain forms stand for the sorted ones; sets of tokens have forms of their own."""
    raw = threshold - 0.5  # scores are rounded
    plain = keys.select("id", F.trim(F.regexp_replace("key", "[^0-9a-z]+", " ")).alias("key")).where("key != ''")
    plain = write_through(plain, "wratio-keys")
    toks = F.split("key", " ")
    shared = salted_self_pairs(plain.select("id", F.explode(F.array_distinct(toks)).alias("gram")), "gram", "id")
    sets = plain.select("id", F.array_join(F.array_sort(F.array_distinct(toks)), " ").alias("key"))
    out = (shared.select("a", "b").union(bag_candidates(plain, ratio_admits(raw / 100, raw / 90, 1.5)))
           .union(bag_candidates(sets, ratio_admits(raw / 95, raw / 85.5))).distinct())
    return out  # keys without a word score 0 and pair with nothing


def _wratio_candidates(keys: DataFrame, threshold: float) -> DataFrame:
    """Lossless candidates for weighted ratio >= threshold (>= 87). Scores are rounded, so raw scores from
    `threshold` - 0.5 count. Then one of these holds, each with a blocking of its own:

    * the plain ratio is at least r = raw / 100, or the ratio of the token-sorted (or sorted distinct) forms
      at least raw / 95: a ratio r of lengths a, b leaves at most (1 - r)(a + b) single-character edits, each
      of which breaks at most two bigrams (`prefix_candidates` with 4 r - 3);
    * the forms share a token;
    * the shorter form's ratio to a window of its own length is p >= raw / 90: it then shares k (4 p - 3) - 1 of
      its k - 1 bigrams with the longer form, hence one of its rarest ones (a single character is in it).
    """
    raw = threshold - 0.5
    plain = keys.select("id", F.trim(F.regexp_replace("key", "[^0-9a-z]+", " ")).alias("key")).where("key != ''")
    plain = write_through(plain, "wratio-keys")
    toks = F.split("key", " ")
    out = [salted_self_pairs(plain.select("id", F.explode(F.array_distinct(toks)).alias("gram")), "gram", "id"),
           prefix_candidates(plain, 4 * raw / 100 - 3)]
    for form in (F.array_sort(toks), F.array_sort(F.array_distinct(toks))):
        out.append(prefix_candidates(plain.select("id", F.array_join(form, " ").alias("key")), 4 * raw / 95 - 3))
    if raw <= 90:
        k = F.length("key")
        grams = F.transform(F.sequence(F.lit(1), k - 1), lambda i: F.substring("key", i, 2))
        occ = plain.where(k >= 2).select("id", (k - 1).alias("_n"), F.explode(grams).alias("gram"))
        freq = write_through(occ.groupBy("gram").agg(F.count(F.lit(1)).alias("_f")), "gram-counts")
        shared = F.greatest(F.ceil((F.col("_n") + 1) * (4 * raw / 90 - 3) - 1e-9) - 1, F.lit(1))
        w = Window.partitionBy("id").orderBy("_f", "gram")
        inner = (occ.join(freq, "gram").withColumn("_r", F.row_number().over(w))
                 .where(F.col("_r") <= F.col("_n") - shared + 1).select(F.col("id").alias("x"), "gram").distinct())
        chars = plain.select(F.col("id").alias("y"), F.explode(F.array_distinct(F.split("key", ""))).alias("gram"))
        one = plain.where(k == 1).select(F.col("id").alias("x"), F.col("key").alias("gram"))
        for l, r in ((inner, occ.select(F.col("id").alias("y"), "gram").distinct()), (one, chars)):  # noqa: E741
            out.append(salted_pairs(l, r).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))
    cand = out[0]
    for o in out[1:]:
        cand = cand.unionByName(o)
    return cand.distinct()


def greedy_groups(pairs: DataFrame, order: DataFrame | None = None) -> DataFrame:
    """C9 step 4: the canonical names the sequential greedy scan would pick.

    A name is canonical exactly when no earlier canonical name matches it (lexicographically
    first maximal independent set of the match graph), see `_losers`.

    `order`: optional (key, ord) table giving the scan order; default the key itself.
    Output: (canonical, variant, score) for every match of every canonical name.
    """
    pairs = write_through(pairs.select("key_a", "key_b", "score"), "greedy-pairs")
    names = pairs.select(F.col("key_a").alias("key")).union(pairs.select("key_b")).distinct()
    return _greedy(_ranked(names, order), pairs)


def _ranked(names: DataFrame, order: DataFrame | None) -> DataFrame:
    """names(key) with a long u that rises in the order of the scan."""
    if order is not None:
        names = names.join(order.select("key", "ord"), "key").orderBy("ord", "key")
    else:
        names = names.orderBy("key")
    return write_through(names.select("key", F.monotonically_increasing_id().alias("u")), "greedy-names")


def _greedy(names: DataFrame, pairs: DataFrame | None, near: DataFrame | None = None) -> DataFrame:
    """The groups of names(key, u) by pairs(key_a, key_b, score) and by `near`, the groups of `one_edit_groups` with u."""
    edges, links, out = [], [], []
    if pairs is not None:
        edges.append(pairs.join(names.select(F.col("key").alias("key_a"), F.col("u").alias("ua")), "key_a")
                     .join(names.select(F.col("key").alias("key_b"), F.col("u").alias("ub")), "key_b"))
    if near is not None:
        edges.append(_matches(near.where("p = 0")).select(
            _key_of("rest", "x").alias("key_a"), _key_of("rest", "y").alias("key_b"), "score",
            F.col("x.u").alias("ua"), F.col("y.u").alias("ub")))
        # a group is named by its first member and the place
        near = near.where("p > 0").withColumn("h", F.col("members")[0]["u"])
        links.append(near.select("h", F.col("p").cast("long").alias("t"), F.explode("members.u").alias("u")))
    columns = ["key_a", "key_b", "score", "ua", "ub"]
    edge = edges[0].select(columns) if len(edges) == 1 else edges[0].select(columns).union(edges[1].select(columns))
    edge = write_through(edge, "greedy-edges")
    links.append(edge.select(F.col("ua").alias("h"), (-1 - F.col("ub")).alias("t"), F.explode(F.array("ua", "ub")).alias("u")))
    lost = _losers(links[0] if len(links) == 1 else links[0].union(links[1]))
    canon = write_through(names.select("u").join(lost, "u", "left_anti"), "greedy-canonical")
    for a, b in ("ab", "ba"):
        out.append(edge.join(canon.withColumnRenamed("u", f"u{a}"), f"u{a}").select(
            F.col(f"key_{a}").alias("canonical"), F.col(f"key_{b}").alias("variant"), "score"))
    if near is not None:
        first = near.select("h", "p", F.explode("members.u").alias("u")).join(canon, "u").withColumnRenamed("u", "_u")
        both = near.join(first, ["h", "p"]).select("rest", "score", "members", F.expr("filter(members, x -> x.u = _u)[0]").alias("x"))
        both = both.select("rest", "score", "x", F.explode("members").alias("y")).where("x.u <> y.u")
        out.append(both.select(_key_of("rest", "x").alias("canonical"), _key_of("rest", "y").alias("variant"), "score"))
    found = out[0]
    for o in out[1:]:
        found = found.unionByName(o)
    return found


def _losers(links: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """The names u that an earlier canonical name matches, of links(h, t, u): u is in group (h, t), and the names
    of a group all match each other (a pair is a group of two). Names come first by smaller u.

    In each round blocks of neighbouring names are scanned at once (`_scan_block`). A name waits while an earlier name
    of one of its groups is undecided; within a block that is known at once, between blocks after a round. The first
    block with undecided names decides all of them, so the rounds end. Decided names and groups with nobody left to
    wait for drop out; only the round's losers and the links left are written (to the shared scratch folder)."""
    w, lost = Window.partitionBy("h", "t"), []

    def scan(f: pd.DataFrame) -> pd.DataFrame:
        return _scan_block(f, bits)

    state = links.select("h", "t", "u", F.lit(LIVE).cast("byte").alias("st"))
    while True:
        undecided = F.when(F.col("st") == LIVE, F.col("u"))
        seen = state.select("*", (F.max("st").over(w) == WON).alias("taken"), F.min(undecided).over(w).alias("first"),
                            F.max(undecided).over(w).alias("last"))
        seen = seen.where((F.col("st") == LIVE) & (F.col("taken") | (F.col("first") < F.col("last")))).drop("st")
        done = write_through(seen.groupBy(F.shiftright("u", bits).alias("b")).applyInPandas(
            scan, "h long, t long, u long, st byte"), "greedy-round")
        lost.append(done.where(F.col("st") == LOST).select("u"))
        state = done.where(F.col("st") != LOST)
        if state.where(F.col("st") == LIVE).isEmpty():
            break
    out = lost[0]
    for more in lost[1:]:
        out = out.union(more)
    return out


def _scan_block(f: pd.DataFrame, bits: int) -> pd.DataFrame:
    """The sequential scan over one block: links(h, t, u) of undecided names, with whether the group has a canonical name
    and its first and last undecided ones. Returns the links of names still undecided, those of new canonical
    names whose groups go on in later blocks, and each name that lost once."""
    f = f.sort_values("u", kind="stable", ignore_index=True)
    u = f["u"].to_numpy()
    group = f.groupby(["h", "t"], sort=False).ngroup().to_numpy()
    block = u[0] >> bits
    state = np.zeros(group.max() + 1, np.int8)  # 0 free, 1 an earlier name is undecided, 2 has a canonical name
    state[group[(f["first"].to_numpy() >> bits) < block]] = 1
    state[group[f["taken"].to_numpy(bool)]] = 2
    state, groups = state.tolist(), group.tolist()
    starts = np.flatnonzero(np.r_[True, u[1:] != u[:-1]])
    ends, found = np.r_[starts[1:], len(u)], []
    for i, j in zip(starts.tolist(), ends.tolist()):
        mine = groups[i:j]
        worst = max([state[g] for g in mine])
        found.append((WON, LIVE, LOST)[worst])
        if worst < 2:
            for g in mine:
                state[g] = 2 - worst
    found = np.array(found, np.int8)
    st = np.repeat(found, ends - starts)
    keep = (st == LIVE) | (st == WON) & ((f["last"].to_numpy() >> bits) > block)
    out, lost = f[["h", "t", "u"]].assign(st=st)[keep], u[starts[found == LOST]]
    return pd.concat([out, pd.DataFrame({"h": -1, "t": 0, "u": lost, "st": np.int8(LOST)})], ignore_index=True)


def fuzzy_groups(df: DataFrame, column: str, threshold: float = 90,
                 scorer: str = "wratio", order_by: str | None = None) -> DataFrame:
    """Canonical -> variant pairs. With `order_by`, a key's scan position is the smallest
    `order_by` value among its rows (first appearance); otherwise the key itself."""
    order = None
    if order_by:
        order = (df.select(normalize_key(F.col(column)).alias("key"), F.col(order_by))
                 .groupBy("key").agg(F.min(order_by).alias("ord")))
    if scorer != "levenshtein" or threshold <= 50:
        return greedy_groups(fuzzy_pairs(df, column, threshold, scorer), order)
    # Names one edit apart are grouped, not paired: only matches of canonical names are ever written out.
    names = _ranked(_fuzzy_keys(df, column), order)
    near = write_through(one_edit_groups(names, threshold, "u"), "one-edit")
    return _greedy(names, _further_pairs(names, threshold), near)


def group_values(df: DataFrame, column: str, groups: DataFrame) -> DataFrame:
    """The raw values of every group with their counts: (canonical, key, value, n), the canonical name's own
    spellings included. A key under several canonicals is listed with each."""
    groups = write_through(groups, "groups")
    members = groups.select("canonical", F.col("variant").alias("key")).unionByName(
        groups.select("canonical", F.col("canonical").alias("key"))).distinct()
    raw = (df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
           .withColumn("key", normalize_key(F.col("value"))))
    return members.join(raw, "key").select("canonical", "key", "value", "n")


# --- C24 -----------------------------------------------------------------------------------

def apply_canonical(df: DataFrame, column: str, groups: DataFrame, out: str | None = None
                    ) -> DataFrame:
    """Replace values by their canonical form. Rows are matched on the normalised key;
    a variant under several canonicals takes the best score, then the smallest canonical; spellings of a
    canonical name take that name. Values of no group, and NULL, stay as they are."""
    out = out or f"{column}_canonical"
    groups = write_through(groups, "groups")
    pairs = groups.select(F.col("variant").alias("_key"), "canonical", "score").unionByName(
        groups.select("canonical").distinct().select(F.col("canonical").alias("_key"), "canonical", F.lit(float("inf")).alias("score")))
    best = pairs.groupBy("_key").agg(
        F.min_by("canonical", F.struct((-F.col("score")).alias("s"), F.col("canonical").alias("c")))
        .alias("_canon"))
    keyed = df.withColumn("_key", F.when(F.col(column).isNotNull(), normalize_key(F.col(column))))
    j = keyed.join(best, "_key", "left")
    return j.select(*df.columns, F.coalesce(F.col("_canon"), F.col(column)).alias(out))
