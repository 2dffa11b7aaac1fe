import base64
import hashlib
import io
import os
import struct

import pytest
import zstandard
from pyspark.errors import PythonException

from scrubstat.llm import warc as W


def want(pages):
    first = {}
    for i, _, h in pages:
        k = (h or "").encode()
        if i is not None:
            first[k] = min(first.get(k, i), i)
    out = []
    for i, _, h in pages:
        p = (h or "").encode()
        f = first.get(p)
        again = f is not None and i != f
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if again else "response", f if again else None,
                    None if again else p))
    return sorted(out, key=str)


def run(df, folder, **options):
    out = W.archive_round_trip(df, folder, **options)
    return sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload))
                   for r in out.collect()], key=str)


def test_round_trip_of_the_table(spark, sf, tmp_path):
    df = spark.read.parquet(f"{sf}/pages.parquet")
    pages = [(r.page_id, r.url, r.html) for r in df.collect()]
    assert run(df, f"file://{tmp_path}/a", archive_bytes=20_000) == want(pages)
    files = sorted(os.listdir(tmp_path / "a"))
    assert len(files) > 1
    data = (tmp_path / "a" / files[0]).read_bytes()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D
    # each record is a frame of its own
    d, rest, n = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size])), data[8 + size:], 0
    while rest:
        o = d.decompressobj()
        assert o.decompress(rest).startswith(b"WARC/1.1\r\n")
        rest, n = o.unused_data, n + 1
    assert n == sum(1 for _ in W.read_archive(io.BytesIO(data)))


def test_edges(spark, tmp_path):
    schema = "page_id long, url string, html string, sha string, key int"
    assert run(spark.createDataFrame([], schema), f"{tmp_path}/e") == []
    pages = [(3, None, None), (1, "http://a b\r\nX: y", ""), (2, "u", "é🙂" * 10), (9, "u", "é🙂" * 10), (2, "u", "é🙂" * 10),
             (None, "n", "only here"), (None, "n", "é🙂" * 10), (5, "big", "x\r\n\r\n" * 400_000), (6, "z", "\x00WARC/1.1\r\n\r\n"), (2**60 + 1, "u", "q")]
    df = spark.createDataFrame([(*p, "s", 1) for p in pages], schema)
    assert run(df, f"{tmp_path}/f") == want(pages)
    small = run(df.where("page_id in (1, 3, 2, 9)"), f"{tmp_path}/g", min_bytes=10)
    assert [r[3] for r in small if r[1] == 0] == ["response", "response"] and sum(r[3] == "revisit" for r in small) == 1


def test_damage_is_noticed(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "payload " * 50)], "page_id long, url string, html string")
    m = W.write_archives(df, f"{tmp_path}/d").collect()
    data = open(m[0].path, "rb").read()
    listed = spark.createDataFrame(m)
    assert W.read_archives(spark, listed).count() == 1
    for bad in (data[:-9], data[:-60] + b"x" + data[-59:]):
        with open(m[0].path, "wb") as f:
            f.write(bad)
        with pytest.raises(PythonException):
            W.read_archives(spark, listed).collect()
    with pytest.raises(ValueError):
        list(W.read_archive(io.BytesIO(b"\x28\xb5\x2f\xfd" + bytes(20))))


def test_dictionary_helps():
    recs = [W.make_record(str(i), f"http://x/{i}", f"<html><body>page {i} common words here</body></html>".encode(), None) for i in range(400)]
    d = W.build_dictionary(recs, 16 << 10)
    out = io.BytesIO()
    a = W.ArchiveWriter(out, d)
    for r in recs:
        a.add(r)
    assert a.size - len(d) < 0.5 * sum(len(zstandard.compress(r)) for r in recs)
