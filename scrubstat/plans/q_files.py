"""Registered file queries (S1-S6): tables are written to a fresh scratch folder in the shared
checkpoint area by a Spark job, then read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import archives as ar
from ..sources import files as fl
from .q_clean import DIRTY_COLS
from .registry import make_registry
from .tables import table, view, with_views

Q, q = make_registry()


def _scratch(spark, name):
    return scratch_path(spark, f"files/{name}-{uuid.uuid4().hex}")


@q("read_csv_roundtrip", "SELECT * FROM customer")
def _read_csv_roundtrip(spark, sf):
    cust = table(spark, sf, "customer")
    p = fl.write_csv(cust, _scratch(spark, "customer_csv"))
    return fl.read_csv(spark, p, schema=cust.schema)


def _dialect_sql():
    cols = []
    for n, t in DIRTY_COLS:
        if n == "balance":
            cols.append("balance")
        elif t == "string":
            cols.append(f"coalesce({n}, '') AS {n}")
        else:
            cols.append(f"coalesce(CAST({n} AS VARCHAR), '') AS {n}")
    return with_views(f"SELECT {', '.join(cols)} FROM dirty", "dirty")


@q("read_csv_dialect", _dialect_sql())
def _read_csv_dialect(spark, sf):
    d = view(spark, sf, "dirty")
    out = d.select(*[F.replace(F.col(n).cast("string"), F.lit("."), F.lit(",")).alias(n)
                     if n == "balance" else F.col(n) for n, _t in DIRTY_COLS])
    p = fl.write_csv(out, _scratch(spark, "dirty_csv"), sep=";")
    return fl.read_csv(spark, p, sep=";", decimal=",", keep_empty=True,
                       numeric_columns=["balance"])


@q("read_csv_dates", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def _read_csv_dates(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    p = _scratch(spark, "orders_csv")
    (o.write.mode("overwrite").option("header", True)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(p))
    df = fl.read_csv(spark, p, parse_dates=["o_orderdate"], date_format="%Y-%m-%d %H:%M:%S")
    return df.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_orderdate",
                     F.col("o_totalprice").cast("double").alias("o_totalprice"))


@q("write_read_roundtrip", "SELECT * FROM customer")
def _write_read_roundtrip(spark, sf):
    p = fl.write_parquet(table(spark, sf, "customer"), _scratch(spark, "customer_parquet"))
    return spark.read.parquet(p)


def _typed(df, schema):
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


@q("read_zip_members", "SELECT * FROM customer")
def _read_zip_members(spark, sf):
    cust = table(spark, sf, "customer")
    folder = _scratch(spark, "customer_zip")
    ar.write_archives(cust, folder, "zip", "customer.csv").collect()
    return _typed(ar.read_zip_csv(spark, folder, member="customer.csv"), cust.schema)


@q("read_xlsx_members", "SELECT * FROM customer")
def _read_xlsx_members(spark, sf):
    cust = table(spark, sf, "customer")
    folder = _scratch(spark, "customer_xlsx")
    ar.write_archives(cust, folder, "xlsx").collect()
    return _typed(ar.read_xlsx(spark, folder), cust.schema)
