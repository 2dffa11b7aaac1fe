"""Span search on long and repetitive texts: no recursion, no quadratic time, the same matches."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from scrubstat.llm.pii import KINDS, add_candidates, find_pii
from scrubstat.llm.secrets import RULES, find_secrets
from scrubstat.llm.spans import SPAN, clear_of, quoted, regex_spans

# Texts whose repeated part goes on for long, per rule.
LONG = {
    "private_key": ("-----BEGIN ", "A ", "PRIVATE KEY-----"), "masked_email": ("mail joe [at] site", " [dot] ab", " x"),
    "email": ("a@b", ".c", " "), "ip": ("1.2.3.", "4", " "), "card": ("4", " 1", " "), "phone": ("+1", "(2", " 3"),
    "local_phone": ("", "555-123-", "4567"), "national_id": ("", "123-45-", "6789"), "iban": ("DE12", " ABCD", " "),
    "name": ("Mr. A", "b", " Cd"), "assign": ("token=", "a=", " "), "access": ("AKIA", "B", " "), "hex": ("", "0a", " "),
    "github": ("ghp_", "a", " "), "slack": ("xoxb-", "a-", " "), "google": ("AIza", "Q", " "), "stripe": ("sk_live_", "a", " "),
    "jwt": ("eyJ", "aaaaaaaaaaa.", " "),
}


@pytest.mark.parametrize("rules", [KINDS, RULES], ids=["pii", "secrets"])
def test_a_million_repetitions(spark, rules):
    rows = [(i, a + b * 1_000_000 + c) for i, (a, b, c) in enumerate(LONG[k] for k, *_ in rules)]
    df = spark.createDataFrame(rows, "id int, text string").repartition(len(rows))
    found = [F.size(regex_spans("text", r, k, i, "true")).alias(k) for i, (k, r, _) in enumerate(rules)]
    out = df.select("id", *found).collect()
    assert len(out) == len(rows)


def test_many_matches_in_one_text(spark):
    text = "".join(f"a{i}@b.com " for i in range(200_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.time()
    (row,) = df.select(regex_spans("text", KINDS[0][1], "email", 0).alias("s")).select(
        F.size("s").alias("n"), F.element_at("s", -1).alias("last")).collect()
    assert row["n"] == 200_000 and text[row["last"]["start"]:row["last"]["end"]] == "a199999@b.com"
    assert time.time() - start < 60
    many = spark.createDataFrame([(1, text[:300_000] + "0123456789abcdef0 " * 20_000)], "doc_id long, text string")
    (row,) = find_secrets(many).select(F.size("spans").alias("n")).collect()
    assert row["n"] == 20_000


def test_possessive_groups_match_as_before(spark):
    old = {"private_key": r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----",
           "masked_email": r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}(?: ?[(\[]dot[)\]] ?[A-Za-z]{2,})+"}
    rng = random.Random(3)
    pieces = {"private_key": ["-----BEGIN ", "PRIVATE ", "PRIVATE KEY-----", "RSA ", "KEY-----", "A", " ", "-----"],
              "masked_email": ["joe", " [at] ", "(at)", "site", " [dot] ", "(dot)", "com", " ", "x", "[dot]"]}
    new = {k: r for k, r, *_ in [*KINDS, *RULES]}
    for k, r in old.items():
        texts = ["".join(rng.choices(pieces[k], k=rng.randint(1, 14))) for _ in range(3000)]
        df = spark.createDataFrame([(t,) for t in texts], "text string")
        got = df.select(regex_spans("text", new[k], k, 0).alias("s")).collect()
        want = [[(m.start(), m.end()) for m in re.finditer(r, t)] for t in texts]
        assert [[(s["start"], s["end"]) for s in row["s"]] for row in got] == want
        assert sum(map(len, want)) > 50


def test_clear_of_equals_brute_force(spark):
    rng = random.Random(5)

    def spans():
        out = []
        for _ in range(rng.randint(0, 12)):
            s = rng.randint(0, 40)
            out.append((s, rng.randint(0, 3), "k", s + rng.randint(1, 8), "x"))
        return sorted(out)

    rows = [(i, spans(), spans()) for i in range(400)]
    df = spark.createDataFrame(rows, f"id int, more array<{SPAN}>, base array<{SPAN}>")
    got = {r["id"]: sorted(map(tuple, r["c"])) for r in df.select("id", clear_of("more", "base").alias("c")).collect()}
    for i, more, base in rows:
        assert got[i] == [m for m in more if not any(b[0] < m[3] and m[0] < b[3] for b in base)]


def test_long_texts_pass_the_operators(spark):
    texts = ["-----BEGIN " + "A " * 3000 + "PRIVATE KEY-----", "mail joe [at] site" + " [dot] ab" * 3000, "a@b.c " * 20_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: len(r["spans"]) for r in find_secrets(df).collect()} == {0: 1, 1: 0, 2: 0}
    found = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in find_pii(df).collect()}
    assert len(found[2]) == 20_000
    (row,) = add_candidates(df.where("doc_id = 1"), "text", "c").collect()
    assert [c["kind"] for c in row["c"]] == ["masked_email"]
    assert quoted("a'b\\") == "'a\\'b\\\\'"
