"""Registered queries for null handling, duplicates, recodes and headers (C1-C7, C16-C18, C23,
P3, P4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as c
from .registry import make_registry
from .tables import table, view, with_views

Q, q = make_registry()

# Columns of the `dirty` view with their Spark types.
DIRTY_COLS = [("id", "bigint"), ("segment_raw", "string"), ("label_raw", "string"),
              ("amount_raw", "string"), ("whole_raw", "string"), ("gender_raw", "string"),
              ("day_num", "int"), ("day_bad", "int"), ("flag_int", "int"), ("ts_raw", "string"),
              ("balance", "double")]
_PH = ", ".join("'" + p.replace("'", "''") + "'" for p in c.PLACEHOLDERS)


def _union(parts):
    return " UNION ALL ".join(parts)


def _sentinel_sql():
    parts = []
    for name, t in DIRTY_COLS:
        if t == "string":
            parts.append(
                f"SELECT '{name}' AS column_name, CAST(count(*) FILTER (WHERE {name} IN ({_PH})) "
                f"AS BIGINT) AS n_matches, coalesce(list_sort(list_distinct(list({name}) FILTER "
                f"(WHERE {name} IN ({_PH})))), CAST([] AS VARCHAR[])) AS matched_values FROM dirty")
        else:
            parts.append(f"SELECT '{name}' AS column_name, CAST(0 AS BIGINT) AS n_matches, "
                         f"CAST([] AS VARCHAR[]) AS matched_values")
    return with_views(_union(parts), "dirty")


@q("sentinel_scan", _sentinel_sql())
def _sentinel_scan(spark, sf):
    return c.sentinel_scan(view(spark, sf, "dirty"))


def _replaced_cols():
    return ", ".join(f"CASE WHEN {n} IN ({_PH}) THEN NULL ELSE {n} END AS {n}" if t == "string"
                     else n for n, t in DIRTY_COLS)


@q("sentinel_replace", with_views(f"SELECT {_replaced_cols()} FROM dirty", "dirty"))
def _sentinel_replace(spark, sf):
    return c.replace_placeholders(view(spark, sf, "dirty"))


def _missing_rate_sql():
    parts = [f"SELECT '{n}' AS column_name, CAST(count(*) AS BIGINT) AS total, "
             f"CAST(count(*) FILTER (WHERE {n} IS NULL{' OR isnan(' + n + ')' if t == 'double' else ''}) "
             f"AS BIGINT) AS missing, round(coalesce(count(*) FILTER (WHERE {n} IS NULL"
             f"{' OR isnan(' + n + ')' if t == 'double' else ''}) * 100.0 / nullif(count(*), 0), 0), 2) "
             f"AS pct FROM r" for n, t in DIRTY_COLS]
    return with_views(f"WITH r AS (SELECT {_replaced_cols()} FROM dirty) " + _union(parts),
                      "dirty")


@q("missing_rate", _missing_rate_sql())
def _missing_rate(spark, sf):
    return c.missing_rate(c.replace_placeholders(view(spark, sf, "dirty")))


@q("column_info", with_views(_union([
    f"SELECT CAST({i} AS INTEGER) AS position, '{n}' AS column_name, '{t}' AS data_type, "
    f"CAST(count({n}) AS BIGINT) AS non_null FROM dirty" for i, (n, t) in enumerate(DIRTY_COLS)]),
    "dirty"))
def _column_info(spark, sf):
    return c.column_info(view(spark, sf, "dirty"))


@q("null_rows", with_views("SELECT * FROM dirty WHERE label_raw IS NULL", "dirty"))
def _null_rows(spark, sf):
    from ..columns import null_rows
    return null_rows(view(spark, sf, "dirty"), "label_raw")


def _heatmap_sql():
    parts = [f"SELECT bucket, '{n}' AS column_name, CAST(count(*) AS BIGINT) AS n_rows, "
             f"CAST(count(*) FILTER (WHERE {n} IS NULL) AS BIGINT) AS n_null, "
             f"round(count(*) FILTER (WHERE {n} IS NULL) / count(*), 6) AS null_rate "
             f"FROM b GROUP BY bucket" for n, _t in DIRTY_COLS]
    return with_views(
        "SELECT * FROM (WITH b AS (SELECT *, CAST(floor((row_number() OVER (ORDER BY id) - 1) * 20 "
        "/ count(*) OVER ()) AS INTEGER) AS bucket FROM dirty) " + _union(parts) + ") x", "dirty")


@q("null_heatmap", _heatmap_sql())
def _null_heatmap(spark, sf):
    return c.null_heatmap(view(spark, sf, "dirty"), "id", buckets=20)


@q("fill_missing", with_views(
    "SELECT id, coalesce(balance, (SELECT quantile_cont(balance, 0.5) FROM dirty)) AS balance, "
    "coalesce(label_raw, (SELECT label_raw FROM dirty WHERE label_raw IS NOT NULL GROUP BY label_raw "
    "ORDER BY count(*) DESC, label_raw LIMIT 1)) AS label_raw, coalesce(whole_raw, 'missing') AS "
    "whole_raw, coalesce(day_bad, (SELECT avg(day_bad) FROM dirty)) AS day_bad FROM dirty", "dirty"))
def _fill_missing(spark, sf):
    d = view(spark, sf, "dirty").select("id", "balance", "label_raw", "whole_raw",
                                        F.col("day_bad").cast("double").alias("day_bad"))
    return c.fill_missing(d, {"balance": "median", "label_raw": "mode", "whole_raw": "missing",
                              "day_bad": "mean"})


@q("fill_missing_by_group", with_views(
    "SELECT d.id, d.gender_raw, coalesce(d.balance, m.med) AS balance FROM dirty d JOIN "
    "(SELECT gender_raw, quantile_cont(balance, 0.5) AS med FROM dirty GROUP BY gender_raw) m "
    "ON d.gender_raw = m.gender_raw", "dirty"))
def _fill_missing_by_group(spark, sf):
    d = view(spark, sf, "dirty").select("id", "gender_raw", "balance")
    return c.fill_missing(d, {"balance": "median"}, by=["gender_raw"])


@q("duplicate_count", with_views(
    "SELECT CAST(count(*) AS BIGINT) AS n_rows, (SELECT CAST(count(*) AS BIGINT) FROM "
    "(SELECT DISTINCT * FROM dup_rows) x) AS n_distinct, CAST(count(*) - (SELECT count(*) FROM "
    "(SELECT DISTINCT * FROM dup_rows) y) AS BIGINT) AS n_duplicates FROM dup_rows", "dup_rows"))
def _duplicate_count(spark, sf):
    return c.duplicate_count(view(spark, sf, "dup_rows"))


@q("drop_duplicates", with_views("SELECT DISTINCT * FROM dup_rows", "dup_rows"))
def _drop_duplicates(spark, sf):
    return c.drop_duplicates(view(spark, sf, "dup_rows"))


@q("int_to_bool", with_views(
    "SELECT id, flag_int <> 0 AS flag_int, day_num <> 0 AS day_num, gender_raw FROM dirty", "dirty"))
def _int_to_bool(spark, sf):
    d = view(spark, sf, "dirty").select("id", "flag_int", "day_num", "gender_raw")
    return c.int_to_bool(d, include=["flag_int", "day_num", "gender_raw"])


@q("recode_gender", with_views(
    "SELECT id, CASE gender_raw WHEN 'f' THEN 'female' WHEN 'm' THEN 'male' ELSE gender_raw END "
    "AS gender_raw FROM dirty", "dirty"))
def _recode_gender(spark, sf):
    return c.standardize_gender(view(spark, sf, "dirty").select("id", "gender_raw"))


_DAYS = " ".join(f"WHEN {i} THEN '{d}'" for i, d in enumerate(c.DAY_NAMES))


@q("day_names", with_views(
    f"SELECT id, CASE day_num {_DAYS} END AS day_num, day_bad FROM dirty", "dirty"))
def _day_names(spark, sf):
    return c.day_names(view(spark, sf, "dirty").select("id", "day_num", "day_bad"))


@q("normalize_headers",
   "SELECT c_custkey AS customer_id, c_name AS nombre_cliente_, c_acctbal AS precio_, "
   "c_mktsegment AS market_segment FROM customer")
def _normalize_headers(spark, sf):
    d = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("Customer ID"), F.col("c_name").alias(" Nombre (Cliente) "),
        F.col("c_acctbal").alias("Précio ($)"), F.col("c_mktsegment").alias("Market--Segment"))
    return c.normalize_headers(d)
