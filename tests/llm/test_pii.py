import re

from pyspark.sql import functions as F

from scrubstat.llm.pii import BASE_KINDS, em, find_pii, redacted


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 * (int(c) > 4)) for i, c in enumerate(reversed(d))) % 10 == 0


def card(m):
    d = re.sub("[ -]", "", m)
    return 14 <= len(d) <= 19 and luhn(d)


BASE = {
    "email": (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    "ip": (re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (re.compile(r"[0-9]([\x20-]?[0-9])+"), card),
    "phone": (re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def base_spans(text):
    out = [(m.start(), i, k, m.end()) for i, (k, (r, keep)) in enumerate(BASE.items())
           for m in r.finditer(text) if keep(m.group())]
    return [(k, s, e) for s, _, k, e in sorted(out)]


HARD = ["", "a@b.c_x@d.e and x@y.z@w.v %a@b-.c..d @n.m a@b a.b@c.d.e-", "1.2.3.4.5.6.7.8 256.1.1.1 0255.001.0.00000 1.2.3",
        "1.2.3.4" * 50, "é🙂 4111 1111 1111 1111, 4111-1111-1111-1112 4111 1111  1111 1111", "4" * 14 + " " + "0" * 19,
        "+1 (555) 010-9999 +49.30.1234567 +1 +12 +1-------2 +1(2)3(4)5(6)7(8)9(0)1", "+" * 200 + "12345678901",
        "1 " * 20_000, "x" * 50_000 + "@y.z", "0" * 30_000, "1." * 20_000, "+1" + "(" * 20_000, "a@b" + ".c" * 5_000,
        "4111111111111111 " * 400]


def test_base_spans_equal_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows += [(10_000 + i, t) for i, t in enumerate(HARD)] + [(None, None), (None, "q@w.er"), (5, "8.8.8.8")]
    df = spark.createDataFrame([(a, b, "x", "y") for a, b in rows], "doc_id long, text string, spans string, row string")
    kinds = [k for k, *_ in BASE_KINDS]
    out = find_pii(df, keep_rows=True).collect()
    assert len(out) == len(rows)
    for r in out:
        text = r.row.text or ""
        assert [(s.kind, s.start, s.end) for s in r.spans if s.kind in kinds] == base_spans(text)
    assert sum(len(r.spans) for r in out) > 40
    assert find_pii(df.limit(0)).count() == 0


def test_added_spans_and_clean_texts(spark):
    texts = [("call me, phone (415) 555-2671 today", 1), ("my phone number: 212-736-5000.", 1),
             ("order no. 114-22-1133-9 and part 123-45", 0), ("IBAN: DE89 3704 0044 0532 0130 00 bank", 1),
             ("bank account DE00 3704 0044 0532 0130 00 iban", 0), ("mail me: jane.doe (at) example (dot) com", 1),
             ("social security ssn 219-09-9999", 1), ("The version of Mrs and the thing", 0), ("dear Dr. Anna Berg, contact", 1)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts * 3)], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in find_pii(df).collect()}
    for i, (t, want) in enumerate(texts):
        assert len(got[i]) == want, (t, got[i])
        for s in got[i]:
            assert t[s.start:s.end] == s.found


def test_em_learns_reliable_labelers():
    pat = [("k", ("1", "1", "1"), 80), ("k", ("-1", "-1", "-1"), 100), ("k", ("1", "1", "0"), 20), ("k", ("-1", "1", "-1"), 10)]
    soft = em(pat)
    assert soft["k", ("1", "1", "1")] > 0.95 and soft["k", ("-1", "-1", "-1")] < 0.05 and soft["k", ("-1", "1", "-1")] < 0.5


def test_redacted(spark):
    df = spark.createDataFrame([(1, "é mail a@b.cd or +1 212 555 0100!"), (2, "nothing"), (3, "card 4111 1111 1111 1111")], "doc_id long, text string")
    out = {r.doc_id: r.t for r in find_pii(df, keep_rows=True).select("doc_id", redacted(F.col("row.text"), F.col("spans")).alias("t")).collect()}
    assert out == {1: "é mail [EMAIL] or [PHONE]!", 2: "nothing", 3: "card [CARD]"}
