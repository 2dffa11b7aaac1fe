"""Registered queries for implicit duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedupe as dd
from .q_text import _norm_key
from .registry import make_registry
from .tables import table

Q, q = make_registry()

_PART_COLS = ["p_name", "p_brand", "p_type"]


def _token_sql() -> str:
    v = " UNION ALL ".join(f"SELECT DISTINCT '{c}' AS column_name, {c} AS value FROM part "
                           f"WHERE {c} IS NOT NULL" for c in _PART_COLS)
    k = ("SELECT column_name, value, regexp_replace(lower(value), '[^\\p{L}\\p{N}_]+', '', 'g') AS "
         "key, regexp_extract_all(lower(value), '[a-z0-9]+') AS toks FROM v")
    # Each unordered pair once; the edit distance only where the lengths admit it.
    longest = "greatest(length(a.key), length(b.key))"
    lev = (f"CASE WHEN {longest} = 0 THEN true WHEN least(length(a.key), length(b.key)) < 0.85 * {longest} - 1e-9 THEN false "
           f"ELSE 100.0 * (1 - levenshtein(a.key, b.key) / {longest}) >= 85.0 END")
    return (f"WITH v AS ({v}), k AS ({k}), p AS (SELECT a.column_name, a.value AS base, b.value AS "
            f"other, (contains(b.key, a.key) OR contains(a.key, b.key)) AS by_containment, "
            f"len(list_intersect(a.toks, b.toks)) > 0 AS by_token, {lev} AS by_fuzzy "
            f"FROM k a JOIN k b ON a.column_name = b.column_name AND a.value < b.value), "
            f"m AS (SELECT * FROM p WHERE by_containment OR by_token OR by_fuzzy) SELECT * FROM m UNION ALL "
            f"SELECT column_name, other AS base, base AS other, by_containment, by_token, by_fuzzy FROM m")


@q("implicit_dup_token", _token_sql())
def _implicit_dup_token(spark, sf):
    return dd.implicit_duplicates_token(table(spark, sf, "part"), include=_PART_COLS,
                                        fuzzy_threshold=0.85, scorer="levenshtein")


@q("implicit_dup_other", f"SELECT * FROM ({_token_sql()}) t WHERE by_containment OR by_fuzzy")
def _implicit_dup_other(spark, sf):
    """Without the pairs that only share a token."""
    return dd.implicit_duplicates_token(table(spark, sf, "part"), include=_PART_COLS, fuzzy_threshold=0.85,
                                        scorer="levenshtein", token_pairs=False)


@q("implicit_dup_difflib")
def _implicit_dup_difflib(spark, sf):
    return dd.implicit_duplicates_token(table(spark, sf, "part"), include=_PART_COLS,
                                        fuzzy_threshold=0.85, scorer="difflib")


_KEY = _norm_key("c_name")
_SCORE = "100.0 * (1 - levenshtein(a.key, b.key) / greatest(length(a.key), length(b.key)))"


@q("fuzzy_pairs",
   f"WITH k AS (SELECT DISTINCT {_KEY} AS key FROM customer) SELECT a.key AS key_a, b.key AS "
   f"key_b, round({_SCORE}, 6) AS score FROM k a JOIN k b ON a.key < b.key WHERE length(a.key) > 0 "
   f"AND length(b.key) > 0 AND {_SCORE} >= 90")
def _fuzzy_pairs(spark, sf):
    out = dd.fuzzy_pairs(table(spark, sf, "customer"), "c_name", 90, "levenshtein")
    return out.withColumn("score", F.round("score", 6))


@q("fuzzy_pairs_names",
   "WITH k AS (SELECT DISTINCT " + _norm_key("p_name") + " AS key FROM part) SELECT a.key AS "
   f"key_a, b.key AS key_b, round({_SCORE}, 6) AS score FROM k a JOIN k b ON a.key < b.key "
   f"WHERE length(a.key) > 0 AND length(b.key) > 0 AND {_SCORE} >= 75")
def _fuzzy_pairs_names(spark, sf):
    out = dd.fuzzy_pairs(table(spark, sf, "part"), "p_name", 75, "levenshtein")
    return out.withColumn("score", F.round("score", 6))


@q("fuzzy_pairs_weak",
   "WITH k AS (SELECT DISTINCT " + _norm_key("p_name") + " AS key FROM part) SELECT a.key AS "
   f"key_a, b.key AS key_b, round({_SCORE}, 6) AS score FROM k a JOIN k b ON a.key < b.key "
   f"WHERE length(a.key) > 0 AND length(b.key) > 0 AND {_SCORE} >= 40")
def _fuzzy_pairs_weak(spark, sf):
    """A threshold too low for shared pieces of text: candidates by character bags."""
    out = dd.fuzzy_pairs(table(spark, sf, "part"), "p_name", 40, "levenshtein")
    return out.withColumn("score", F.round("score", 6))


@q("implicit_dup_weak", f"SELECT * FROM ({_token_sql().replace('0.85', '0.45').replace('85.0', '45.0')}) t "
   "WHERE by_containment OR by_fuzzy")
def _implicit_dup_weak(spark, sf):
    return dd.implicit_duplicates_token(table(spark, sf, "part"), include=_PART_COLS, fuzzy_threshold=0.45,
                                        scorer="levenshtein", token_pairs=False)


# The sequential scan itself: name by name, canonical unless an earlier canonical name matches it.
_GROUPS = (
    f"k AS (SELECT DISTINCT {_KEY} AS key FROM customer), p AS (SELECT a.key AS u, b.key AS v, {_SCORE} AS score FROM k a "
    f"JOIN k b ON a.key <> b.key WHERE length(a.key) > 0 AND length(b.key) > 0 AND {_SCORE} >= 90), "
    "nb AS (SELECT u, row_number() OVER (ORDER BY u) AS i, list(v) AS vs FROM p GROUP BY u), "
    "scan(i, canon) AS (SELECT 0::BIGINT, []::VARCHAR[] UNION ALL SELECT nb.i, CASE WHEN list_has_any(canon, vs) THEN canon "
    "ELSE list_append(canon, u) END FROM scan JOIN nb ON nb.i = scan.i + 1), "
    "c AS (SELECT unnest(canon) AS u FROM scan WHERE i = (SELECT max(i) FROM nb)), "
    "g AS (SELECT p.u AS canonical, p.v AS variant, score FROM p JOIN c USING (u))")


@q("fuzzy_groups", f"WITH RECURSIVE {_GROUPS} SELECT canonical, variant, round(score, 6) AS score FROM g")
def _fuzzy_groups(spark, sf):
    out = dd.fuzzy_groups(table(spark, sf, "customer"), "c_name", 90, "levenshtein")
    return out.withColumn("score", F.round("score", 6))


@q("fuzzy_groups_wratio")
def _fuzzy_groups_wratio(spark, sf):
    return dd.fuzzy_groups(table(spark, sf, "part"), "p_name", 90, scorer="wratio")


@q("apply_canonical",
   f"WITH RECURSIVE {_GROUPS}, m AS (SELECT variant AS key, canonical, score FROM g UNION ALL SELECT DISTINCT canonical AS key, "
   "canonical, 1e9 AS score FROM g), best AS (SELECT key, canonical FROM m QUALIFY row_number() OVER (PARTITION BY key "
   f"ORDER BY score DESC, canonical) = 1) SELECT c_custkey, c_name, coalesce(best.canonical, c_name) AS c_name_canonical "
   f"FROM customer LEFT JOIN best ON best.key = {_KEY}")
def _apply_canonical(spark, sf):
    cust = table(spark, sf, "customer")
    groups = dd.fuzzy_groups(cust, "c_name", 90, "levenshtein")
    return dd.apply_canonical(cust.select("c_custkey", "c_name"), "c_name", groups)


@q("fuzzy_groups_first_seen")
def _fuzzy_groups_first_seen(spark, sf):
    """The weighted scorer with the scan in the order of first appearance."""
    return dd.fuzzy_groups(table(spark, sf, "part"), "p_name", 90, order_by="p_partkey")


@q("fuzzy_group_values")
def _fuzzy_group_values(spark, sf):
    part = table(spark, sf, "part")
    return dd.group_values(part, "p_name", dd.fuzzy_groups(part, "p_name", 75, "levenshtein"))


_TOKENS = " UNION ALL ".join(f"SELECT DISTINCT '{c}' AS column_name, {c} AS value FROM part WHERE {c} IS NOT NULL" for c in _PART_COLS)


@q("token_groups",
   f"WITH v AS ({_TOKENS}), t AS (SELECT column_name, value, unnest(list_distinct(regexp_extract_all(lower(value), '[a-z0-9]+'))) "
   "AS token FROM v) SELECT column_name, token, count(*) OVER (PARTITION BY column_name, token) AS n_values, value FROM t "
   "QUALIFY n_values > 1")
def _token_groups(spark, sf):
    return dd.token_groups(table(spark, sf, "part"), _PART_COLS)
