import io
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from scrubstat.operators import enrich as en
from scrubstat.sources import archives as ar
from scrubstat.sources import files as fl


def test_missing_csv_raises(spark):
    with pytest.raises(FileNotFoundError):
        fl.read_csv(spark, "/nonexistent/folder", "x.csv")


def test_decimal_comma_and_empties(spark):
    d = tempfile.mkdtemp(prefix="scrubstat-test-")
    p = os.path.join(d, "a.csv")
    with open(p, "w") as fh:
        fh.write('id;amount;note\n1;1,5;\n2;abc;"x"\n3;;""\n')
    rows = fl.read_csv(spark, d, "a.csv", sep=";", decimal=",", keep_empty=True,
                       numeric_columns=["amount"]).orderBy("id").collect()
    assert [r.amount for r in rows] == [1.5, None, None]
    assert [r.note for r in rows] == ["", "x", ""]


def test_zip_archives_with_quoted_newline(spark, tmp_path):
    import zipfile
    for k in range(2):
        with zipfile.ZipFile(tmp_path / f"a{k}.zip", "w") as zf:
            zf.writestr("m.csv", f'name,n\n"two\nlines",{k}\nplain,{k + 10}\n')
    df = ar.read_zip_csv(spark, str(tmp_path), member="m.csv")
    rows = sorted((r.name, r.n) for r in df.collect())
    assert rows == [("plain", "10"), ("plain", "11"), ("two\nlines", "0"), ("two\nlines", "1")]


def test_xlsx_roundtrip(spark, tmp_path):
    with open(tmp_path / "b.xlsx", "wb") as f:
        ar.write_xlsx(f, iter([["a", "b"], ["x", 1.5], ["y & z", None]]))
    rows = ar.read_xlsx(spark, str(tmp_path)).collect()
    assert [(r.a, r.b) for r in rows] == [("x", "1.5"), ("y & z", None)]


def test_release_year_regex(spark):
    df = spark.createDataFrame([("It was Released in 1998 and 2001",), ("release\n 2004",),
                                ("nothing",)], "t string")
    out = [r.y for r in df.select(en.release_year(F.col("t")).alias("y")).collect()]
    assert out == [1998, None, None]


def test_enrich_fallback_and_order(spark):
    base = spark.createDataFrame([("super_game", "pc", 1), ("other", "ps", 2)],
                                 "name string, platform string, k int")
    pages = spark.createDataFrame([(1, "<p>Super Game for PC was released in 1999</p>"),
                                   (2, "<p>unrelated</p>")], "page_id long, html string")
    out = en.enrich_lookup(base, "name", "platform", pages)
    assert out.columns[-2:] == ["release_year", "release_year_int"]
    got = {r.name: r.release_year for r in out.collect()}
    assert got == {"super_game": "1999", "other": "unknown"}


def test_zip_with_xlsx_member_and_missing_path(spark, tmp_path):
    import zipfile
    with zipfile.ZipFile(tmp_path / "c.zip", "w") as zf:
        book = io.BytesIO()
        ar.write_xlsx(book, iter([["a"], ["x"], ["y"]]))
        zf.writestr("book.xlsx", book.getvalue())
    rows = ar.read_zip_csv(spark, str(tmp_path), member="book.xlsx").collect()
    assert sorted(r.a for r in rows) == ["x", "y"]
    with pytest.raises(FileNotFoundError):
        ar.read_zip_csv(spark, str(tmp_path / "nope"))


def test_archives_with_headers_of_their_own(spark, tmp_path):
    import zipfile
    for k, text in enumerate(["id,name\n1,x\n", "name,id\ny,2\n", "id,extra\n3,z\n"]):
        with zipfile.ZipFile(tmp_path / f"a{k}.zip", "w") as zf:
            zf.writestr("m.csv", text)
    df = ar.read_zip_csv(spark, str(tmp_path))
    rows = {tuple(r) for r in df.select("id", "name", "extra").collect()}
    assert rows == {("1", "x", None), ("2", "y", None), ("3", None, "z")}


def test_write_archives_streams_to_uri(spark, tmp_path):
    df = spark.range(25).selectExpr("id", "cast(id as string) as t", "if(id % 5 = 0, null, id * 0.5) as x")
    out = ar.write_archives(df, f"file://{tmp_path}/z", "zip", "m.csv", rows_per_archive=10).collect()
    assert sum(r.rows for r in out) == 25 and len(out) == 3
    assert ar.read_zip_csv(spark, f"{tmp_path}/z").count() == 25


def test_paths_below_any_store():
    from scrubstat.session import join_uri
    assert join_uri("hdfs://name:8020/x/", "tables/a") == "hdfs://name:8020/x/tables/a"
    assert join_uri("s3a://bucket", "/t", "p") == "s3a://bucket/t/p"


def test_cluster_without_shared_folder_raises():
    from types import SimpleNamespace

    from scrubstat.session import checkpoint_dir
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError):
        checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: None)))


@pytest.mark.parametrize("hot", [1, 3, 2000])
def test_best_page_equals_brute_force(spark, hot):
    import random
    rng = random.Random(4)
    vocab = ["the", "of", "game"] * 4 + [f"w{i}" for i in range(25)]
    pages = [(i, " ".join(rng.choices(vocab, k=rng.randint(1, 8)))) for i in range(40)]
    keys = [(f"k{i}" if i else None, " ".join(rng.choices(vocab + ["absent"], k=rng.randint(1, 5)))) for i in range(30)]
    want = {}
    for k, ph in keys:
        best = min(((-len(set(ph.split()) & set(t.split())), p) for p, t in pages), default=None)
        if best and best[0]:
            want[k, ph] = (best[1], -best[0])
    got = en.best_page_match(spark.createDataFrame(keys, "k string, phrase string"), "phrase",
                             spark.createDataFrame(pages, "page_id long, text string"), hot=hot)
    assert {(r.k, r.phrase): (r.page_id, r.score) for r in got.collect()} == want
