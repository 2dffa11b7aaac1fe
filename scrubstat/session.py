"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import io
import os
import re
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings the operators assume. AQE re-plans joins at run time (a side that turns out small is
# broadcast, skewed partitions are split), and the session clock is pinned to UTC so timestamps
# compare equal to the SQL oracle.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "scrubstat",
              shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage, as a URI string.

    On a cluster this is whatever `spark.checkpoint.dir` names (a shared file system); without
    that setting a cluster job raises. Only a single-JVM session (tests, a laptop) gets a scratch
    folder below `spark.local.dir`.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return _swept(spark, current)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = join_uri(spark.conf.get("spark.local.dir", "/tmp"), "scrubstat-scratch")
    sc.setCheckpointDir(configured)  # Spark adds a folder with a fresh name
    return _swept(spark, sc.getCheckpointDir())


_SWEPT: set[str] = set()


def _swept(spark: SparkSession, base: str) -> str:
    """Have Spark's file layer remove the application's own folder when the job ends."""
    if base not in _SWEPT:
        _SWEPT.add(base)
        fs, p = _hadoop(spark, base)
        fs.deleteOnExit(p)
    return base


def join_uri(base: str, *parts: str) -> str:
    """Path below a base folder, which may be a plain path or a URI of any store."""
    return "/".join([base.rstrip("/"), *(p.strip("/") for p in parts)])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder next to the checkpoint data, for intermediate tables written by operators."""
    return join_uri(checkpoint_dir(spark), name)


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Remove scratch tables that nothing reads any more (loops call it after each round)."""
    for path in paths:
        fs, p = _hadoop(spark, path)
        fs.delete(p, True)


_TABLES: list[str] = []  # scratch tables of this process


def release_scratch(spark: SparkSession, keep: DataFrame) -> None:
    """Remove the scratch tables written so far, but for those that `keep` reads. For jobs in steps, each of
    which starts from a table that the last one wrote elsewhere."""
    read = "\n".join(keep.inputFiles())
    for path in [t for t in _TABLES if t.rpartition("/")[2] not in read]:
        drop_scratch(spark, path)
        _TABLES.remove(path)


def write_through(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing a parquet table into the shared checkpoint folder and reading it
    back. Unlike `checkpoint()`, the re-read table carries its real size, so iterative jobs do
    not compound estimated join sizes from round to round."""
    path = scratch_path(df.sparkSession, f"tables/{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    _TABLES.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches go to Python workers by bytes, not only by rows: ten thousand long texts at once would take
    most of a worker's memory. A setting of the user's own is left as it is."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, DEFAULT_CONF[key])


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in Python workers (Arrow UDFs, mapInPandas).

    The package is zipped once per application, written through Spark's file layer into the
    shared folder (any store) and added with `addPyFile`, like `spark-submit --py-files`, so
    executors can import it whatever their working directory or environment.
    """
    sc = spark.sparkContext
    bound_batches(spark)
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, root))
    target = join_uri(scratch_path(spark, f"pkg-{uuid.uuid4().hex}"), "scrubstat.zip")
    fs, p = _hadoop(spark, target)
    out = fs.create(p, True)
    try:
        out.write(buf.getvalue())
    finally:
        out.close()
    sc.addPyFile(target)
    _SHIPPED.add(app)
