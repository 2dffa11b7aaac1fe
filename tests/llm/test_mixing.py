import re
from collections import defaultdict

from pyspark.sql import functions as F

from scrubstat.llm.mixing import mix_documents, mix_plan

SCHEMA = "doc_id long, text string, source string, size string, row string"


def water_fill(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, open_, out = sum(sizes.values()), set(names), {}
    while open_:
        level = (total - sum(out.values())) / sum(w[s] for s in open_)
        full = {s for s in open_ if 3 * sizes[s] < level * w[s]}
        if not full:
            out |= {s: level * w[s] for s in open_}
            break
        out |= {s: 3 * sizes[s] for s in full}
        open_ -= full
    return out


def check(rows, docs):
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, t, s in docs:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    targets = water_fill(dict(sizes))
    by_id = {d: (t, s) for d, t, s in docs}
    assert len(rows) == len(docs)
    for r in rows:
        t, s = by_id[r.doc_id]
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) and r.source_size == sizes[s]
        assert abs(r.target - targets[s]) < 1e-6 and 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    for s, t in targets.items():
        assert abs(taken[s] - t) <= 1


def test_mix_meets_targets(spark, sf):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = mix_plan(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    check(rows, docs)
    again = mix_plan(spark.read.parquet(f"{sf}/documents.parquet").repartition(7)).collect()
    assert sorted(rows, key=str) == sorted(again, key=str)


def test_edge_rows(spark):
    docs = [(1, None, "a"), (2, "", "a"), (3, "x " * 4000, "b"), (4, "one", "c"), (5, "two words", None),
            (6, "q " * 500, "d"), (7, "q " * 500, "d"), (8, "zero", "ä"), (9, "   ", "é")]
    df = spark.createDataFrame([(d, t, s, "k", "r") for d, t, s in docs], SCHEMA)
    check(mix_plan(df).collect(), docs)
    assert mix_plan(df.limit(0)).count() == 0
    zero = mix_plan(df.where("doc_id <= 2")).collect()
    assert [r.taken for r in zero] == [0, 0] and [r.target for r in zero] == [0.0, 0.0]
    twice = spark.createDataFrame([(None, "a b c", None, "", "")] * 3 + [(1, "d e", "s", "", "")] * 2, SCHEMA)
    assert sum(r.taken for r in mix_plan(twice).collect()) == 13


def test_mix_documents_rows(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    plan = {r.doc_id: r.taken for r in mix_plan(df).collect()}
    out = mix_documents(df)
    assert out.columns == df.columns
    words = {r.doc_id: r.n for r in out.withColumn("n", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).groupBy("doc_id").agg(F.sum("n").alias("n")).collect()}
    assert words == {d: n for d, n in plan.items() if n}
