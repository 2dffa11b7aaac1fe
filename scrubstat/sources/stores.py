"""Files of a glob, listed by Spark and opened by tasks for reading at any place."""

from __future__ import annotations

import io

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def reached(path: str):
    """(file system, path) by pyarrow for a path or URI; None for a store that pyarrow does not know."""
    import pyarrow as pa
    from pyarrow.fs import FileSystem, LocalFileSystem
    if "://" not in path:
        return LocalFileSystem(), path.removeprefix("file:")
    try:
        return FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return None


def listed(spark: SparkSession, glob: str, pattern: str) -> DataFrame:
    """(path, content) of the matching files; a path that does not exist raises FileNotFoundError. Content is null, and
    no file is read, where tasks can open the files themselves; in other stores it is the whole file, which
    Spark limits to 2 GB."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(glob)
        first = files.select("path").first()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            raise FileNotFoundError(glob) from e
        raise
    if first is None or reached(first["path"]) is not None:
        return files.select("path", F.lit(None).cast("binary").alias("content"))
    return files.select("path", "content")


def opened(path: str, content: bytes | None):
    """A readable, seekable file."""
    if content is not None:
        return io.BytesIO(content)
    fs, p = reached(path)
    return fs.open_input_file(p)
