from pyspark.sql import functions as F

from scrubstat.operators import clean, convert


def test_sentinel_scan_and_replace(spark):
    df = spark.createDataFrame([("", 1), ("n/a", 2), ("NULL", 3), ("ok", 4), (None, 5)],
                               "a string, b int")
    rows = {r.column_name: r for r in clean.sentinel_scan(df).collect()}
    assert rows["a"].n_matches == 2 and rows["a"].matched_values == ["", "NULL"]
    assert rows["b"].n_matches == 0 and rows["b"].matched_values == []
    out = [r.a for r in clean.replace_placeholders(df).orderBy("b").collect()]
    assert out == [None, "n/a", None, "ok", None]


def test_missing_rate_nan_and_empty(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "x double")
    r = clean.missing_rate(df).first()
    assert (r.total, r.missing, r.pct) == (4, 2, 50.0)
    empty = spark.createDataFrame([], "x double")
    assert clean.missing_rate(empty).first().pct == 0.0


def test_day_names_guard(spark):
    df = spark.createDataFrame([(0, 0), (6, 7), (None, 1)], "a int, b int")
    rows = clean.day_names(df).collect()
    assert [r.a for r in rows] == ["sunday", "saturday", None]
    assert [r.b for r in rows] == [0, 7, 1]


def test_int_to_bool(spark):
    df = spark.createDataFrame([(0,), (1,), (5,), (None,)], "x int")
    assert [r.x for r in clean.int_to_bool(df).collect()] == [False, True, True, None]


def test_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (2, "a"), (2, "a"), (3, "b")],
                               "k int, v string")
    r = clean.duplicate_count(df).first()
    assert (r.n_rows, r.n_distinct, r.n_duplicates) == (6, 3, 3)
    assert clean.drop_duplicates(df).count() == 3


def test_fill_missing(spark):
    df = spark.createDataFrame([(1.0, "a", "g"), (None, None, "g"), (3.0, "a", "h"),
                                (float("nan"), "b", "h"), (10.0, None, "h")],
                               "x double, s string, g string")
    out = clean.fill_missing(df, {"x": "median", "s": "mode"}).collect()
    assert [r.x for r in out] == [1.0, 3.0, 3.0, 3.0, 10.0]
    assert [r.s for r in out] == ["a", "a", "a", "b", "a"]
    by = clean.fill_missing(df, {"x": "mean"}, by=["g"]).orderBy("g", "s").collect()
    assert sorted(r.x for r in by if r.g == "h") == [3.0, 6.5, 10.0]


def test_strict_numbers(spark):
    df = spark.createDataFrame([("1,5",), ("1d",), ("nan",), (" 2 ",), ("1e3",), (None,)],
                               "t string")
    out = [r.t for r in convert.convert_to_numeric(df, "float").collect()]
    assert out == [1.5, None, None, 2.0, 1000.0, None]
    fails = {(r.failure, r.value) for r in convert.numeric_failures(df, "t").collect()}
    assert fails == {("non_numeric", "1d"), ("non_numeric", "nan"), ("non_integer", "1,5")}


def test_integer_mode_keeps_column_on_failure(spark):
    ok = spark.createDataFrame([(" 2 ",), ("1e3",), (None,)], "t string")
    assert [r.t for r in convert.convert_to_numeric(ok, "integer").collect()] == [2, 1000, None]
    bad = spark.createDataFrame([("2",), ("2.5",)], "t string")
    assert convert.convert_to_numeric(bad, "integer").schema["t"].dataType.simpleString() == "string"
    assert [r.t for r in convert.convert_to_numeric(bad, None).collect()] == [2.0, 2.5]


def test_dates(spark):
    df = spark.createDataFrame([("2024-02-30 00:00:00",), ("2024-03-01 10:00:00",), ("x",)],
                               "t string")
    out = [r.t for r in convert.normalize_datetime(df, fmt="%Y-%m-%d %H:%M:%S").collect()]
    assert out[0] is None and out[2] is None and out[1].hour == 10
    loc = convert.normalize_datetime(df, fmt="%Y-%m-%d %H:%M:%S", time_zone="Asia/Kolkata")
    assert loc.collect()[1].t.hour == 4 and loc.collect()[1].t.minute == 30
    tod = convert.time_of_day(spark.createDataFrame([("13:05",)], "t string"), "t", "%H:%M")
    assert tod.first().t == "13:05:00"


def test_category_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("c",)], "s string")
    out = convert.category_codes(df, "s").collect()
    assert sorted((r.s, r.s_code) for r in out if r.s) == [("a", 0), ("b", 1), ("b", 1), ("c", 2)]
    assert [r.s_code for r in out if r.s is None] == [-1]
