"""Structured Streaming entry points.

The reference has no stream; its table is "refreshed daily". The column-expression cleaners
(C2, C10-C13, C16, C17, C20) accept a streaming DataFrame unchanged, and the trend counts run as
a streaming aggregate. Results go to durable parquet tables through `foreachBatch` (executor-side
writes, a checkpoint location in the shared folder), never to a driver-memory sink.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import join_uri, scratch_path


def read_parquet_stream(spark: SparkSession, path_glob: str, schema, max_files: int = 100
                        ) -> DataFrame:
    """A streaming DataFrame over parquet files matching a folder or glob."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
            .parquet(path_glob))


def hourly_counts(stream: DataFrame, ts: str, key: str, value: str | None = None,
                  window: str = "1 hour", watermark: str | None = None) -> DataFrame:
    """Trend counts per (time window, key); optional watermark bounds the state."""
    s = stream
    if watermark:  # which Spark takes on instants only
        s = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        aggs.append(F.sum(value).alias("total"))
    g = s.groupBy(F.window(ts, window).alias("w"), key).agg(*aggs)
    return g.select(F.col("w.start").alias("window_start"), key, *[a for a in
                                                                   (["n", "total"] if value else ["n"])])


def run_to_table(stream: DataFrame, name: str, mode: str = "append",
                 out: str | None = None) -> str:
    """Run a streaming query over everything available now and persist it as parquet.

    append: each micro-batch is a folder `batch=<id>` of its own, written in overwrite mode, so a batch that
    is replayed after a failure replaces itself. complete: each micro-batch holds the full result and
    replaces the table. update: each batch folder holds the rows that changed; `read_latest` keeps the last of
    each key. Returns the table folder (in the shared checkpoint area); read it with `read_table`.
    """
    spark = stream.sparkSession
    run_id = uuid.uuid4().hex
    out = out or scratch_path(spark, f"streams/{name}-{run_id}/table")
    ckpt = scratch_path(spark, f"streams/{name}-{run_id}/checkpoint")
    q = (stream.writeStream.outputMode(mode).option("checkpointLocation", ckpt)
         .foreachBatch(batch_writer(out, mode)).trigger(availableNow=True).start())
    q.awaitTermination()
    return out


def batch_writer(out: str, mode: str = "append"):
    """The foreachBatch function: idempotent for a batch id."""
    def write(batch: DataFrame, batch_id: int) -> None:
        target = out if mode == "complete" else join_uri(out, f"batch={batch_id}")
        batch.write.mode("overwrite").parquet(target)
    return write


def read_table(spark: SparkSession, out: str) -> DataFrame:
    """What `run_to_table` wrote, without the batch column."""
    return spark.read.parquet(out).drop("batch")


def read_latest(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """What an `update` run wrote: per key the row of the last batch that has it."""
    t = spark.read.parquet(out)
    rest = [c for c in t.columns if c not in (*keys, "batch")]
    last = t.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_last"))
    return last.select(*keys, "_last.*")
