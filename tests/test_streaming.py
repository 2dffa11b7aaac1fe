import os

from pyspark.sql import functions as F

from scrubstat.functions.text import normalize_text
from scrubstat.plans.tables import table
from scrubstat.streaming.runner import (batch_writer, hourly_counts, read_parquet_stream, read_table,
                                        run_to_table)


def test_stream_matches_batch(spark, sf):
    schema = table(spark, sf, "events").schema
    stream = read_parquet_stream(spark, os.path.join(sf, "events*.parquet"), schema)
    cleaned = stream.select("event_id", normalize_text(F.col("event_type")).alias("t"))
    out = read_table(spark, run_to_table(cleaned, "test_clean"))
    batch = table(spark, sf, "events").select(
        "event_id", normalize_text(F.col("event_type")).alias("t"))
    assert sorted(out.collect()) == sorted(batch.collect())


def test_stream_hourly_counts_complete(spark, sf):
    schema = table(spark, sf, "events").schema
    stream = read_parquet_stream(spark, os.path.join(sf, "events*.parquet"), schema)
    agg = hourly_counts(stream, "ts", "event_type")
    out = spark.read.parquet(run_to_table(agg, "test_hourly", mode="complete"))
    ev = table(spark, sf, "events")
    want = ev.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("w"),
                      "event_type").count()
    got = {(r.window_start.replace(tzinfo=None) if hasattr(r.window_start, "replace") else
            r.window_start, r.event_type, r.n) for r in
           out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      "event_type", "n").collect()}
    assert got == {(r.w, r.event_type, r["count"]) for r in want.collect()}


def test_replayed_batch_replaces_itself(spark, tmp_path):
    write = batch_writer(f"{tmp_path}/t")
    for batch_id, rows in ((0, 3), (1, 2), (1, 2)):
        write(spark.range(rows), batch_id)
    assert read_table(spark, f"{tmp_path}/t").count() == 5
