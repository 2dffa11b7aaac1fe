"""Archive sources (S4, S5): many ZIP archives or XLSX workbooks read in parallel.

Spark lists the archives without reading them. A first job reads each archive's central directory, at its end, and gives
one row per member with its place in the file. Members are then dealt over tasks, and each task reads the bytes of its
members alone and inflates them as a stream, so an archive may be of any size, memory stays bounded, and the
members of one archive are read in parallel (a member, one deflate stream, is what cannot be split). In a store that only
Spark reads, archives come as whole files (`stores.listed`).

The columns of CSV members are known after their first lines; rows are then made with the wanted columns only. All
values are text, typed afterwards in Spark (see `convert.cast_datatypes`).
"""

from __future__ import annotations

import csv
import io
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import write_through
from .stores import listed, opened
from .workbook import Workbook, spooled, write_xlsx

ROW_SCHEMA = "archive string, member string, row_no long, header array<string>, fields array<string>"
MEMBER_SCHEMA = "archive string, content binary, member string, offset long, packed long, size long, method int, crc long"
CHUNK = 10_000  # rows held at a time,
CHUNK_CHARS = 1 << 22  # and characters
SHEETS = (".xlsx",)


class MemberStream(io.RawIOBase):
    """The content of one member, read and inflated piece by piece; its checksum is verified at the end."""

    def __init__(self, file, member: str, offset: int, packed: int, method: int, crc: int):
        if method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
            raise ValueError(f"{member}: unsupported compression method {method}")
        file.seek(offset)
        head = file.read(30)
        if head[:4] != b"PK\x03\x04" or head[6] & 1:
            raise ValueError(f"{member}: {'encrypted' if head[:4] == b'PK' + bytes([3, 4]) else 'no member header'}")
        name, extra = struct.unpack("<HH", head[26:30])
        file.seek(offset + 30 + name + extra)
        self.file, self.member, self.left, self.crc, self.sum = file, member, packed, crc, 0
        self.inflate = zlib.decompressobj(-15) if method else None
        self.rest = b""

    def readable(self) -> bool:
        return True

    def readinto(self, out) -> int:
        got = b""
        while not got:
            if self.inflate is None:
                got = self.file.read(min(self.left, len(out)))
                self.left -= len(got)
                ended = not got
            else:
                if not self.rest and self.left:
                    self.rest = self.file.read(min(self.left, 1 << 16))
                    self.left -= len(self.rest)
                    if not self.rest:
                        break
                ended = not self.rest
                got = self.inflate.decompress(self.rest, len(out))
                self.rest = self.inflate.unconsumed_tail
            if ended and not got:
                break
        if not got and self.sum != self.crc:
            raise zipfile.BadZipFile(f"{self.member}: checksum differs")
        self.sum = zlib.crc32(got, self.sum)
        out[:len(got)] = got
        return len(got)


def _open_member(r) -> io.BufferedReader:
    return io.BufferedReader(MemberStream(opened(r.archive, r.content), r.member, r.offset, r.packed, r.method, r.crc), 1 << 16)


def zip_members(spark: SparkSession, glob: str, member: str | None = None) -> DataFrame:
    """One row per member of every archive matching `glob`, in `MEMBER_SCHEMA`: those of one name (an archive
    without it raises KeyError), else all CSV members."""

    def directory(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path, content in zip(f["path"], f["content"]):
                with opened(path, content) as file, zipfile.ZipFile(file) as zf:
                    found = [i for i in zf.infolist() if not i.is_dir()
                             and (i.filename == member if member else i.filename.lower().endswith(".csv"))]
                if member and not found:
                    raise KeyError(f"{member} not found in {path}")
                yield pd.DataFrame([(path, content, i.filename, i.header_offset, i.compress_size, i.file_size, i.compress_type, i.CRC)
                                    for i in found], columns=[c.split()[0] for c in MEMBER_SCHEMA.split(", ")])

    if member and not member.lower().endswith((".csv", *SHEETS)):
        raise ValueError(f"unsupported member type: {member}")
    return listed(spark, glob, "*.zip").mapInPandas(directory, MEMBER_SCHEMA)


def _dealt(rows: DataFrame, name: str) -> DataFrame:
    """The members or files, listed once, dealt over tasks: one each, or a few each where there are very many."""
    kept = write_through(rows, name)
    return kept.repartition(max(1, min(kept.count(), 32 * rows.sparkSession.sparkContext.defaultParallelism)))


def _member_rows(r, sep: str, encoding: str) -> Iterator[tuple[int, list]]:
    with _open_member(r) as raw:
        if r.member.lower().endswith(SHEETS):
            with spooled(raw) as book:
                yield from Workbook(book).rows()
        else:
            text = io.TextIOWrapper(raw, encoding=encoding, newline="")
            yield from enumerate(csv.reader(text, delimiter=sep))


def _chunks(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += sum(len(x) if isinstance(x, str) else sum(map(len, filter(None, x))) for x in row if isinstance(x, (str, list)))
        if len(out) >= CHUNK or size >= CHUNK_CHARS:
            yield out
            out, size = [], 0
    if out:
        yield out


def _framed(archive: str, member: str, rows) -> Iterator[pd.DataFrame]:
    """Frames of `ROW_SCHEMA`; every row carries its member's header (row 0)."""
    header = None

    def whole():
        nonlocal header
        for n, fields in rows:
            header = fields if header is None else header
            yield archive, member, n, header, fields

    for part in _chunks(whole()):
        yield pd.DataFrame(part, columns=["archive", "member", "row_no", "header", "fields"])


def read_zip_rows(spark: SparkSession, glob: str, member: str | None = None, sep: str = ",",
                  encoding: str = "utf-8") -> DataFrame:
    """Raw rows of the members of every archive matching `glob`: CSV members (quoted
    newlines kept) or `.xlsx` members (first sheet); other member types raise ValueError and
    a missing member raises KeyError."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples(index=False):
                yield from _framed(r.archive, r.member, _member_rows(r, sep, encoding))

    return _dealt(zip_members(spark, glob, member), "zip-members").mapInPandas(run, ROW_SCHEMA)


def _named_columns(headers: DataFrame) -> list[str]:
    """The distinct names of (fields array), a schema, in order of place, then name."""
    names = [r["name"] for r in headers.select(F.posexplode("fields").alias("at", "name"))
             .where("name is not null").groupBy("name").agg(F.min("at").alias("at")).orderBy("at", "name").collect()]
    if not names:
        raise ValueError("no header row found")
    return names


def with_header(rows: DataFrame) -> DataFrame:
    """Name the fields by each member's own header (row 0) and drop the header rows. Members may order their
    columns differently or lack some (NULL); the result has every name that occurs, in order of place,
    then name. The distinct names, a schema, are taken to the driver."""
    names = _named_columns(rows.where(F.col("row_no") == 0))
    data = rows.where(F.col("row_no") > 0)
    # short rows (trailing empty cells) and absent columns give NULL instead of an index error
    return data.select(*[F.get("fields", F.array_position("header", F.lit(n)).cast("int") - 1).alias(n) for n in names])


def _wanted(names: list[str], columns: list[str] | None) -> list[str]:
    missing = [c for c in columns or [] if c not in names]
    if missing:
        raise KeyError(f"no column {', '.join(missing)}")
    return names if columns is None else list(columns)


def _table(source: DataFrame, rows_of, columns: list[str] | None) -> DataFrame:
    """One table of text columns from the rows (row number, fields) that `rows_of` gives for a row of `source`, named by
    their own headers (row 0). The headers are read first; then only the wanted columns leave the tasks."""

    def first(frames):
        for f in frames:
            for r in f.itertuples(index=False):
                for n, fields in rows_of(r):
                    if n == 0:
                        yield pd.DataFrame({"fields": [fields]})
                    break

    names = _wanted(_named_columns(source.mapInPandas(first, "fields array<string>")), columns)

    def run(frames):
        for f in frames:
            for r in f.itertuples(index=False):
                yield from picked(rows_of(r))

    def picked(rows):
        header = next(rows, (0, []))[1]
        at = [header.index(n) if n in header else -1 for n in names]
        cells = (tuple(x[i] if 0 <= i < len(x) else None for i in at) for _, x in rows)
        for part in _chunks(cells):
            yield pd.DataFrame(part, columns=names, dtype=object)

    return source.mapInPandas(run, ", ".join(f"`{n.replace('`', '``')}` string" for n in names))


def read_zip_csv(spark: SparkSession, glob: str, member: str | None = None, sep: str = ",",
                 encoding: str = "utf-8", columns: list[str] | None = None) -> DataFrame:
    """Members of many archives as one table of text columns named by the headers; with `columns`
    only those are made (a name that no member has raises KeyError)."""
    return _table(_dealt(zip_members(spark, glob, member), "zip-members"), lambda r: _member_rows(r, sep, encoding), columns)


def _books(spark: SparkSession, glob: str) -> DataFrame:
    return _dealt(listed(spark, glob, "*.xlsx"), "workbooks")


def read_xlsx(spark: SparkSession, glob: str, sheet: int | str = 1, columns: list[str] | None = None) -> DataFrame:
    """One worksheet, by name or by position from 1 in the order of the workbook, of every workbook matching `glob`, as
    text columns named by the header row (see `workbook` for dates, booleans and errors). A workbook without that
    sheet raises KeyError."""

    def rows_of(r):
        with opened(r.path, r.content) as file:
            yield from Workbook(file).rows(sheet)

    return _table(_books(spark, glob), rows_of, columns)


def xlsx_sheets(spark: SparkSession, glob: str) -> DataFrame:
    """(archive, position, sheet): the sheets of every workbook, in order."""

    def run(frames):
        for f in frames:
            for path, content in zip(f["path"], f["content"]):
                with opened(path, content) as file:
                    names = list(Workbook(file).sheets)
                yield pd.DataFrame({"archive": path, "position": range(1, len(names) + 1), "sheet": names})

    return _books(spark, glob).mapInPandas(run, "archive string, position int, sheet string")


# --- writers used to produce archives from Spark data (one archive per partition) ----------

def write_zip_csv(stream, rows: Iterator[list], member: str, sep: str) -> None:
    """A ZIP with one CSV member, row by row."""
    with zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED) as zf:
        with zf.open(member, "w") as raw, io.TextIOWrapper(raw, "utf-8", newline="") as text:
            w = csv.writer(text, delimiter=sep, lineterminator="\n")
            for r in rows:
                w.writerow(["" if v is None else (repr(v) if isinstance(v, float) else v) for v in r])


def write_archives(df: DataFrame, folder: str, kind: str = "zip", member: str = "data.csv",
                   sep: str = ",", rows_per_archive: int = 50_000) -> DataFrame:
    """Write `df` as archives of about `rows_per_archive` rows (ZIP holding a CSV member, or XLSX) into a shared
    folder of any store that pyarrow's file systems reach; returns (archive, rows) per archive written. Tasks
    stream their rows; each attempt writes a file of its own name. Runs as a Spark job."""
    cols = df.columns
    parts = max(1, -(-df.count() // rows_per_archive))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        from pyarrow.fs import FileSystem
        count = 0

        def rows():
            nonlocal count
            yield cols
            for b in batches:
                for row in b[cols].itertuples(index=False, name=None):
                    count += 1
                    yield [None if v is None or (isinstance(v, float) and v != v) else
                           (v.item() if hasattr(v, "item") else v) for v in row]

        fs, base = FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        name = f"part-{uuid.uuid4().hex}.{kind}"
        with fs.open_output_stream(f"{base}/{name}", compression=None) as f:
            if kind == "zip":
                write_zip_csv(f, rows(), member, sep)
            else:
                write_xlsx(f, rows())
        if count:
            yield pd.DataFrame({"archive": [f"{folder.rstrip('/')}/{name}"], "rows": [count]})
        else:
            fs.delete_file(f"{base}/{name}")

    return df.repartition(parts).mapInPandas(run, "archive string, rows long")
