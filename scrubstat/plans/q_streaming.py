"""Registered streaming queries: cleaners and trend counts over a parquet stream."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..functions.text import normalize_text
from ..streaming.runner import hourly_counts, read_latest, read_parquet_stream, read_table, run_to_table
from .q_text import _norm_text
from .registry import make_registry
from .tables import table

Q, q = make_registry()


def _events_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return read_parquet_stream(spark, os.path.join(sf, "events*.parquet"), schema)


@q("stream_hourly_counts",
   "SELECT date_trunc('hour', ts) AS window_start, event_type, CAST(count(*) AS BIGINT) AS n, "
   "round(sum(value), 6) AS total FROM events GROUP BY ALL")
def _stream_hourly_counts(spark, sf):
    s = hourly_counts(_events_stream(spark, sf), "ts", "event_type", "value", watermark="2 hours")
    out = run_to_table(s, "hourly_counts", mode="update")  # state older than the watermark is dropped
    r = read_latest(spark, out, ["window_start", "event_type"])
    return r.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                    "event_type", "n", F.round("total", 6).alias("total"))


@q("stream_clean_events",
   f"SELECT event_id, {_norm_text('event_type')} AS event_type, value FROM events")
def _stream_clean_events(spark, sf):
    s = _events_stream(spark, sf).select(
        "event_id", normalize_text(F.col("event_type")).alias("event_type"), "value")
    out = run_to_table(s, "clean_events", mode="append")
    return read_table(spark, out)
