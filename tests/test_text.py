import unicodedata

import pytest
from pyspark.sql import functions as F

from scrubstat.functions import text as tx
from scrubstat.operators import clean


def _one(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(fn(F.col("s")).alias("o")).collect()]


def test_normalize_text_literals(spark):
    got = _one(spark, tx.normalize_text, ["¡Hola!", "!hola", "Precio ($)", "A  b__c ", None])
    assert got == ["hola", "_hola", "precio", "a_b_c", None]


def test_normalize_text_idempotent(spark):
    vals = ["  Ñandú AUTO! ", "!Café--X", "x ($)", "a__x  y", "tab\tsep\x1cfs"]
    once = _one(spark, tx.normalize_text, vals)
    twice = _one(spark, tx.normalize_text, once)
    assert once == twice


def test_headers(spark):
    assert tx.normalize_header("Precio ($)") == "precio_"
    assert tx.normalize_header(" Total Spent ") == "total_spent"
    df = spark.createDataFrame([(1, 2)], ["Precio ($)", " Total Spent "])
    assert clean.normalize_headers(df).columns == ["precio_", "total_spent"]


def test_header_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], ["A b", "a_b"])
    with pytest.raises(ValueError):
        clean.normalize_headers(df)


def test_fold_matches_python(spark):
    vals = ["ﬁne ½ Ĳ café", "Ａｂｃ１", "naïve — “quotes”", "ǅemal ⑴ ㎏", "plain"]
    want = [unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode() for v in vals]
    assert _one(spark, tx.fold_ascii, vals) == want


def test_normalize_key(spark):
    got = _one(spark, tx.normalize_key, ["  Coca-Cola® ", None, "Pepsi   Cola"])
    assert got == ["cocacola", "", "pepsi cola"]


def test_squash_and_tokens(spark):
    df = spark.createDataFrame([("Coca-Cola_Zero 2x",)], "s string")
    r = df.select(tx.squash(F.col("s")).alias("q"), tx.tokens(F.col("s")).alias("t")).first()
    assert r.q == "cocacola_zero2x"
    assert r.t == ["coca", "cola", "zero", "2x"]
