import re
from collections import defaultdict

from pyspark.sql import functions as F

import corpus_pipeline as P
from test_jaccard import brute
from test_mixing import water_fill
from test_packing import check_pieces
from test_pii import base_spans

SF = "/root/testdata/sf0.001"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_stages_one_by_one(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("row", F.lit("extra"))
    before, sizes = docs, {}
    for name, stage in P.STAGES:
        out = stage(spark, before, SF)
        out.write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        old = {r.doc_id: r for r in before.collect()}
        rows = out.collect()
        sizes[name] = len(rows)
        if name != "packing":
            assert out.columns == docs.columns
        if name == "quality":
            quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            kept = {r.doc_id for r in rows}
            good = [d for d in old if quality.get(d) == 1]
            bad = [d for d in old if quality.get(d) == 0]
            assert sum(d in kept for d in good) >= 0.95 * len(good) and sum(d in kept for d in bad) <= 0.3 * len(bad)
        elif name == "near_duplicates":
            want = brute(sorted((d, r.text) for d, r in old.items()), 5, 80)
            assert sorted(r.doc_id for r in rows) == sorted(d for d, (n, c) in want.items() if c == d)
            assert all(tuple(r) == tuple(old[r.doc_id]) for r in rows)
        elif name == "pii":
            assert len(rows) == len(old)
            for r in rows:
                had = base_spans(old[r.doc_id].text or "")
                assert base_spans(r.text or "") == [] and r.n_chars == len(r.text)
                assert (r.text == old[r.doc_id].text) if not had and "[" not in r.text else True
        elif name == "mixing":
            got, size = defaultdict(int), defaultdict(int)
            for r in rows:
                got[r.source] += len(words(r.text))
                assert old[r.doc_id].text.startswith(r.text)
            for r in old.values():
                size[r.source] += len(words(r.text))
            for s, t in water_fill(dict(size)).items():
                assert abs(got[s] - t) <= 1
        before = out
    assert sizes["near_duplicates"] < sizes["quality"] < 200


def test_run_and_packing(spark):
    out = P.run(spark, SF)
    rows = out.collect()
    total = sum(r.length for r in rows)
    by = defaultdict(int)
    for r in rows:
        by[r.sequence_id] += r.length
    assert total and max(by.values()) <= 1024
    assert sum(0 if n & (n - 1) == 0 else 1024 - n for n in by.values()) <= 0.02 * total


def test_odd_rows_pass_every_stage(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, spans string, score string"
    rows = [(1, None, None, None, None, None, None), (2, "", "en", "a", 0, "", ""), (None, "some words here", "en", "a", 15, "x", "y"),
            (4, "mail a@b.cd now", "en", "b", 15, "x", "y"), (4, "mail a@b.cd now", "en", "b", 15, "x", "y"), (5, "long " * 20_000, "en", "c", 100_000, "x", "y")]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in P.STAGES[1:]:
            docs = stage(spark, docs, SF)
            if name != "packing":
                assert docs.columns == [x.split()[0] for x in schema.split(", ")]
        got = docs.collect()
        assert (len(got) > 0) == bool(data)
    assert P.quality(spark, spark.createDataFrame(rows, schema), SF).columns == [x.split()[0] for x in schema.split(", ")]
