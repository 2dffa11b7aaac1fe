"""Access to the driver tables and the derived fixture views.

The view texts use only syntax that both Spark SQL and DuckDB accept, so the same text feeds a
query and its oracle.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

# The regions of the order star schema, in name order.
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]

DIRTY_SQL = """
SELECT c_custkey AS id,
  CASE c_custkey % 15 WHEN 0 THEN '' WHEN 1 THEN ' ' WHEN 2 THEN 'N/A' WHEN 3 THEN 'none' WHEN 4 THEN 'None'
    WHEN 5 THEN 'NULL' WHEN 6 THEN 'nan' WHEN 7 THEN 'NaT' WHEN 8 THEN 'n/a' WHEN 9 THEN NULL ELSE c_mktsegment END AS segment_raw,
  CASE c_custkey % 6 WHEN 0 THEN concat('  Ñandú ', c_mktsegment, '! ') WHEN 1 THEN concat('!Café--', c_mktsegment)
    WHEN 2 THEN concat(c_mktsegment, ' ($)') WHEN 3 THEN concat(c_mktsegment, '__x  y') WHEN 4 THEN NULL ELSE c_mktsegment END AS label_raw,
  CASE WHEN c_custkey % 11 = 0 THEN 'abc' WHEN c_custkey % 7 = 0 THEN NULL
    WHEN c_custkey % 5 = 0 THEN replace(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING), '.', ',')
    WHEN c_custkey % 13 = 0 THEN '1d' WHEN c_custkey % 17 = 0 THEN 'nan'
    ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING) END AS amount_raw,
  CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE concat(' ', CAST(c_custkey AS STRING), ' ') END AS whole_raw,
  CASE c_custkey % 4 WHEN 0 THEN 'm' WHEN 1 THEN 'f' WHEN 2 THEN 'male' ELSE 'F' END AS gender_raw,
  CAST(c_custkey % 7 AS INT) AS day_num, CAST(c_custkey % 9 AS INT) AS day_bad, CAST(c_custkey % 3 AS INT) AS flag_int,
  CASE WHEN c_custkey % 8 = 0 THEN '2024-02-30 00:00:00' WHEN c_custkey % 9 = 0 THEN 'not a date'
    ELSE concat('2024-', lpad(CAST(1 + c_custkey % 12 AS STRING), 2, '0'), '-', lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0'),
      ' ', lpad(CAST(c_custkey % 24 AS STRING), 2, '0'), ':05:09') END AS ts_raw,
  CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_acctbal END AS balance
FROM customer
"""

TREND_SQL = """
SELECT row_number() OVER (ORDER BY r_name, o_orderdate, c_mktsegment) AS record_id, r_name AS region,
  o_orderdate AS trending_date, c_mktsegment AS category_title, count(*) AS videos_count
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name, o_orderdate, c_mktsegment
"""

DUP_ROWS_SQL = ("SELECT l_returnflag, l_linestatus, l_linenumber, CAST(l_quantity AS INT) AS qty "
                "FROM lineitem")
SPANS_SQL = ("SELECT c_mktsegment AS grp, c_acctbal AS val FROM customer "
             "WHERE c_mktsegment IN ('BUILDING','MACHINERY')")
CONSTANTS_SQL = ("SELECT c_custkey AS id, CAST(2 AS DOUBLE) AS same, CAST(c_custkey AS DOUBLE) AS "
                 "varying, CAST(NULL AS DOUBLE) AS empty FROM customer")

# Odd inputs: NaN among the values, a constant, a column without values, whole numbers with gaps, text of a number
# beyond the range of a long, dates and booleans.
EDGE_SQL = ("SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 0 THEN CAST('NaN' AS DOUBLE) WHEN c_custkey % 50 = 1 THEN "
            "c_acctbal * 100 ELSE c_acctbal END AS noisy, CAST(5 AS DOUBLE) AS same, CAST(NULL AS DOUBLE) AS nothing, "
            "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey % 11 AS INT) END AS whole, "
            "CASE WHEN c_custkey % 9 = 0 THEN '100000000000000000000' ELSE CAST(c_custkey AS STRING) END AS large_raw, "
            "CAST(concat('2024-01-', lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0')) AS DATE) AS day, "
            "c_custkey % 4 = 0 AS flag FROM customer")

VIEWS = {"edge": EDGE_SQL, "dirty": DIRTY_SQL, "dup_rows": DUP_ROWS_SQL, "spans": SPANS_SQL,
         "constants": CONSTANTS_SQL}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def register(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Register the driver tables as temp views (the SQL below refers to them by name)."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived fixture view computed by Spark from the driver tables."""
    register(spark, sf_dir)
    return spark.sql(VIEWS[name])


def trend(spark: SparkSession, sf_dir: str, with_record_id: bool = False) -> DataFrame:
    """The `trend` fixture, built by the D1 operator (distributed numbering on request)."""
    from ..operators.dashboard import trend_table
    t = lambda n: table(spark, sf_dir, n)
    return trend_table(t("orders"), t("customer"), t("nation"), t("region"), with_record_id)


def with_views(sql: str, *names: str) -> str:
    """Prefix an oracle query with the fixture views it reads, as common table expressions."""
    texts = {"trend": TREND_SQL, **VIEWS}
    ctes = ", ".join(f"{n} AS ({texts[n].strip()})" for n in names)
    if not names:
        return sql
    if sql.lstrip().upper().startswith("WITH "):
        return f"WITH {ctes}, {sql.lstrip()[5:]}"
    return f"WITH {ctes} {sql}"
