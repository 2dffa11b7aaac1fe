"""Dictionary-compressed WARC archives: writer and reader.

A Zstandard dictionary is built from records of a bounded sample of the pages (`sample_pages` pages in the order of a
hash, `sample_bytes` of each), embedded in a leading skippable frame of every archive, and each record is compressed
as a frame of its own. Any reader that knows the `.warc.zst` convention can read an archive by itself. If the
sample is too small to train on, its tail serves as a raw dictionary.

Of pages with equal payloads the one with the smallest id is a `response`; the others are `revisit` records that
name it and carry no payload. The equal payloads are found by SHA-1 with partial minima; a hot payload is joined
back like any skewed key. Tasks stream their pages into archives of about `archive_bytes`, in the folder given (any
store that pyarrow's file systems reach); each attempt writes files of its own and only those of successful attempts
are in the manifest.

Defined results: null html is the empty payload; a page without id is a response unless a page with an id has its
payload; rows that repeat the smallest id of a payload are all responses; payloads of fewer than `min_bytes` bytes
are all responses; null urls give records without a target; an empty table gives no archive; other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import join_uri, write_through

MAGIC = 0x184D2A5D  # fixed value: the skippable frame that holds a .warc.zst dictionary
DATE = "2024-01-01T00:00:00Z"  # the pages have no date of their own
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def make_record(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One WARC 1.1 record: a response, or a revisit of page `refers_to`."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(f"%{ord(c):02X}" if ord(c) < 33 else c for c in url))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes], size: int) -> bytes:
    try:
        return zstandard.train_dictionary(size, records, level=3).as_bytes()
    except zstandard.ZstdError:  # too few or too small
        return (b"".join(records) or make_record(None, None, b"", None))[-size:]


class ArchiveWriter:
    """One archive on an open stream."""

    def __init__(self, stream, dictionary: bytes, level: int = 3):
        self.stream, self.records = stream, 0
        self.compressor = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary))
        stream.write(struct.pack("<II", MAGIC, len(dictionary)) + dictionary)
        self.size = 8 + len(dictionary)

    def add(self, record: bytes) -> None:
        frame = self.compressor.compress(record)
        self.stream.write(frame)
        self.size += len(frame)
        self.records += 1


def read_archive(stream):
    """Yield (headers, block) of each record of an archive."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != MAGIC:
        raise ValueError("the archive has no dictionary frame")
    own = zstandard.ZstdCompressionDict(stream.read(size))
    source = zstandard.ZstdDecompressor(dict_data=own).stream_reader(stream, read_across_frames=True)
    buffer = b""

    def fill(n: int) -> None:
        nonlocal buffer
        parts, have = [buffer], len(buffer)
        while have < n:
            more = source.read(max(1 << 16, n - have))
            if not more:
                break
            parts.append(more)
            have += len(more)
        buffer = b"".join(parts)

    while True:
        end, want = buffer.find(b"\r\n\r\n"), len(buffer) + 1
        while end < 0:
            fill(want)
            if len(buffer) < want:
                if buffer:
                    raise ValueError("the archive ends within a record")
                return
            end, want = buffer.find(b"\r\n\r\n"), len(buffer) + 1
        lines = buffer[:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = {k: v for k, _, v in (x.partition(": ") for x in lines[1:])}
        n = int(headers["Content-Length"])
        fill(end + 4 + n + 4)
        block, tail = buffer[end + 4:end + 4 + n], buffer[end + 4 + n:end + 8 + n]
        if tail != b"\r\n\r\n":
            raise ValueError("a record is cut off")
        buffer = buffer[end + 8 + n:]
        yield headers, block


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_bytes: int = 0, archive_bytes: int = 32 << 20, dictionary_bytes: int = 32 << 10,
                   sample_pages: int = 500, sample_bytes: int = 8 << 10) -> DataFrame:
    """Write the pages as archives below `folder`; returns the manifest (path, records, bytes)."""
    # pandas would turn whole numbers beside nulls into floats, so ids pass Python as text.
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(html_col, F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.encode("html", "UTF-8")))
    firsts = write_through(rows.where(F.octet_length("html") >= min_bytes).groupBy(F.col("sha").alias("key"))
                           .agg(F.min("id").alias("first")), "warc-firsts")
    # Each partition sends its first pages to the driver, so a hash keeps all but about twice the sample out.
    share = max(1, min(1 << 30, (sample_pages << 31) // max(1, rows.count())))
    sample = (rows.where(F.pmod(F.xxhash64("id", "url"), F.lit(1 << 30)) < share)
              .select("id", "url", F.substring("html", 1, sample_bytes).alias("html"))
              .orderBy(F.xxhash64("id", "url"), "html").limit(sample_pages).collect())
    dictionary = build_dictionary([make_record(None if r["id"] is None else str(r["id"]), r["url"], r["html"].encode(), None)
                                   for r in sample], dictionary_bytes)
    planned = rows.join(firsts, F.col("sha") == F.col("key"), "left").select(
        F.col("id").cast("string").alias("id"), "url", "html",
        F.when(F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")), F.col("first")).cast("string").alias("refers_to"))

    def write(frames):
        from pyarrow.fs import FileSystem
        fs, base = FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        task = TaskContext.get()
        name, parts, stream, archive = f"part-{task.partitionId():05d}-{task.taskAttemptId()}", 0, None, None
        for f in frames:
            for r in f.itertuples(index=False):
                if archive is None:
                    path = f"{name}-{parts:04d}.warc.zst"
                    stream = fs.open_output_stream(f"{base}/{path}", compression=None)
                    archive = ArchiveWriter(stream, dictionary)
                    parts += 1
                archive.add(make_record(r.id, r.url, r.html.encode(), r.refers_to))
                if archive.size >= archive_bytes:
                    stream.close()
                    yield pd.DataFrame({"path": [path], "records": [archive.records], "bytes": [archive.size]})
                    archive = None
        if archive is not None:
            stream.close()
            yield pd.DataFrame({"path": [path], "records": [archive.records], "bytes": [archive.size]})

    return planned.mapInPandas(write, "path string, records bigint, bytes bigint").withColumn(
        "path", F.concat(F.lit(folder.rstrip("/") + "/"), F.col("path")))


def read_archives(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """The records of the archives listed in a manifest (path, records): page_id (text), url,
    record_type, refers_to (text), payload_digest, payload_bytes and payload (null for revisits). Payload and block
    digests and the number of records are verified."""
    def read(frames):
        from pyarrow.fs import FileSystem
        for f in frames:
            for uri, count in zip(f["path"], f["records"]):
                fs, path = FileSystem.from_uri(uri)
                out, held = [], 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for h, block in read_archive(stream):
                        count -= 1
                        if h["WARC-Block-Digest"] != "sha1:" + base32_sha1(block):
                            raise ValueError(f"a block of {uri} is damaged")
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest, size = h["WARC-Payload-Digest"].removeprefix("sha1:"), int(http.rpartition(b": ")[2])
                        whole = h["WARC-Type"] == "response"
                        if whole and (digest, size) != (base32_sha1(payload), len(payload)):
                            raise ValueError(f"a payload of {uri} is damaged")
                        out.append((h.get("X-Page-ID"), h.get("WARC-Target-URI"), h["WARC-Type"], h.get("X-Refers-To-Page-ID"),
                                    digest, size, payload if whole else None))
                        held += len(block)
                        if held >= 16 << 20:
                            yield pd.DataFrame(out, columns=names)
                            out, held = [], 0
                if count:
                    raise ValueError(f"{uri} lacks {count} records")
                if out:
                    yield pd.DataFrame(out, columns=names)

    names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
    n = manifest.count()
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("path", "records").repartition(max(1, min(n, max(width, n // 8)))).mapInPandas(
        read, "page_id string, url string, record_type string, refers_to string, payload_digest string,"
              " payload_bytes bigint, payload binary")


def archive_round_trip(pages: DataFrame, folder: str, id_col: str = "page_id", **options) -> DataFrame:
    """Write the pages, then read the archives back."""
    kind = pages.schema[id_col].dataType.simpleString()
    manifest = write_through(write_archives(pages, join_uri(folder), id_col, **options), "warc-manifest")
    back = read_archives(pages.sparkSession, manifest)
    return back.withColumn("page_id", F.col("page_id").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind))
