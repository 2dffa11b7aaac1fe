import re

from scrubstat.llm.secrets import ANY, BASE_RULES, RULES, find_secrets, trigram_query

BASE = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
               lambda m: len(m.group(2)) >= 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 18),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m.group()) >= 16),
}


def base_spans(text):
    out = [(m.start(), i, k, m.end()) for i, (k, (r, keep)) in enumerate(BASE.items())
           for m in r.finditer(text) if keep(m)]
    return [(k, s, e) for s, _, k, e in sorted(out)]


def got(df):
    kinds = [k for k, *_ in BASE_RULES]
    return [(r.doc_id, r.text, [(s.kind, s.start, s.end) for s in r.spans if s.kind in kinds], r.spans)
            for r in df.collect()]


HARD = ["", "token=token=abcdefghijklmnop", "secret: token: abcdefghijklmno", "ñ🙂 API_KEY = 'ABCdef123456+/='",
        "passwd:'short' password=\"longenough12\"", "AKIAAKIA" + "X" * 12, "AKIA" + "A" * 13, "AKIA" + "0" * 14,
        "deadbeefdeadbee deadbeefdeadbeef0", "f" * 5000, "apikey" + " " * 5000 + "=" + "z" * 12,
        "token" * 3000 + "=" + "a" * 9000, "ToKeN:" + "é" * 20, ("id=0123456789abcdef0 " * 300)]


def test_base_spans_equal_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows += [(10_000 + i, t) for i, t in enumerate(HARD)] + [(None, None), (None, "secret=abcdefghijkl"), (5, "token=abcdefghijklm")]
    df = spark.createDataFrame([(a, b, "x", "y") for a, b in rows], "doc_id long, text string, spans string, kinds string")
    out = got(find_secrets(df))
    assert len(out) == len(rows)
    assert sum(len(s) for _, _, s, _ in out) > 20
    for _, text, spans, _ in out:
        assert spans == base_spans(text)
    assert find_secrets(df.limit(0)).count() == 0


def test_added_rules_and_offsets(spark):
    t = "é -----BEGIN RSA PRIVATE KEY----- ghp_" + "a1" * 18 + " xoxb-1234567890ab AIza" + "Q" * 35
    (row,) = find_secrets(spark.createDataFrame([(1, t)], "doc_id long, text string")).collect()
    assert {s.kind for s in row.spans} >= {"private_key", "github", "slack", "google"}
    for s in row.spans:
        assert t[s.start:s.end] == s.found


def test_trigram_queries():
    q = {k: trigram_query(r) for k, r, _ in RULES}
    assert q["hex"] == ANY
    assert q["access"] == {frozenset(["aki", "kia"])}
    assert frozenset(["tok", "oke", "ken"]) in q["assign"] and len(q["assign"]) == 6
    assert all(x != ANY for k, x in q.items() if k != "hex")


def test_queries_admit_every_match():
    for text in HARD:
        for kind, (r, keep) in BASE.items():
            for m in r.finditer(text):
                if keep(m):
                    q = trigram_query(dict((k, x) for k, x, _ in RULES)[kind])
                    assert any(all(t in text.lower() for t in a) for a in q)
