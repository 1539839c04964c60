from __future__ import annotations

import base64
import glob
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from recordtrust.llm import warc
from recordtrust.sources.workspace import Workspace

SCHEMA = "page_id long, url string, html string, digest string, bytes int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA)


def brute(rows, least=0):
    """Rows by payload, the largest (page_id, url) first; the first of them is the response."""
    rank = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")
    groups, out = {}, []
    for r in rows:
        groups.setdefault((r[2] or "").encode(), []).append(r)
    for payload, found in groups.items():
        found.sort(key=rank, reverse=True)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        for at, r in enumerate(found):
            revisit = at > 0 and len(payload) >= least
            out.append((r[0], len(payload), digest, "revisit" if revisit else "response", found[0][0] if revisit else None))
    return sorted(out, key=str)


def some_rows():
    rng = random.Random(4)
    rows = [(i, f"http://a/{i}", f"<p>{'é€😀 x' * rng.randrange(50)}</p>") for i in range(150)]
    rows += [(1000 + i, f"http://b/{i}", "<html>copy</html>") for i in range(120)]
    rows += [(7, "http://c\r\nX: y", None), (8, None, ""), (None, "http://d", "n"), (None, None, "n"), (None, None, "n"), (9, None, "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n")]
    rows += [(1119, "http://b/119", "<html>copy</html>")] * 5 + [(1119, "http://z", "<html>copy</html>")] * 3 + [(2, "u", "rep")] * 2
    return rows


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("least", [0, 10])
def test_against_brute_force(spark, settings, small, least):
    rows = some_rows()
    if small:
        settings(taskRows="20", broadcastBytes="0")
    with Workspace(spark) as space:
        found = warc.page_records(pages(spark, rows).repartition(3), space, least)
        assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        assert sorted(map(tuple, found.collect()), key=str) == brute(rows, least)


def test_empty_table(spark):
    with Workspace(spark) as space:
        assert warc.page_records(pages(spark, some_rows()).limit(0), space).count() == 0


def test_files(spark, tmp_path):
    """Archives are single streams first; then every record is a member at its offset, and the file plain gzip."""
    rows = some_rows()
    with Workspace(spark) as space:
        warc.write_archives(pages(spark, rows).repartition(2), f"{tmp_path}/one", space)
        warc.normalise(spark, f"{tmp_path}/one", f"{tmp_path}/many")
        warc.normalise(spark, f"{tmp_path}/many/kind=records", f"{tmp_path}/again")
    streams = [open(f, "rb").read() for f in glob.glob(f"{tmp_path}/one/part*")]
    assert all(len([*warc.members(memoryview(x))]) == 1 for x in streams)
    raw = sorted(b for x in streams for b in [gzip.decompress(x)])
    names = {f.rsplit("/", 1)[1]: f for f in glob.glob(f"{tmp_path}/many/kind=records/part*")}
    assert sorted(b for f in names.values() for b in [gzip.decompress(open(f, "rb").read())]) == raw
    assert sorted(gzip.decompress(open(f, "rb").read()) for f in glob.glob(f"{tmp_path}/again/kind=records/part*")) == raw
    index = warc.read_index(spark, f"{tmp_path}/many").collect()
    assert len(index) == len(rows)
    for e in index:
        with open(names[e.file], "rb") as f:
            f.seek(e.offset)
            record = gzip.decompress(f.read(e.length))
        assert record.startswith(b"WARC/1.1\r\nWARC-Type: " + e.type.encode()) and f"WARC-Record-ID: {e.id}\r\n".encode() in record
    wanted = warc.read_index(spark, f"{tmp_path}/many").where(F.col("id").isin("<urn:page:9>", "<urn:page:1004>"))
    found = {r.id: bytes(r.record) for r in warc.read_entries(spark, f"{tmp_path}/many", wanted).collect()}
    assert set(found) == {"<urn:page:9>", "<urn:page:1004>"}
    assert found["<urn:page:9>"].endswith(b"\r\n\r\nWARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n\r\n\r\n") and b"WARC-Refers-To: <urn:page:1119>" in found["<urn:page:1004>"]


def test_large_record(spark):
    """From 16 MiB on a member does not end with 0."""
    rows = [(1, "u", "ab" * (9 << 20)), (2, "v", "c"), (3, "w", "ab" * (9 << 20))]
    with Workspace(spark) as space:
        assert sorted(map(tuple, warc.page_records(pages(spark, rows).coalesce(1), space).collect()), key=str) == brute(rows)


def test_broken_stream(spark, tmp_path):
    whole = gzip.compress(b"WARC/1.0\r\nContent-Length: 900\r\n\r\nabc\r\n\r\n")
    for name, data in (("short", whole), ("cut", whole[:-9]), ("other", gzip.compress(b"HTTP/1.1 200 OK\r\n"))):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part.gz").write_bytes(data)
        with pytest.raises(Exception, match="part.gz"):
            warc.normalise(spark, f"{tmp_path}/{name}", f"{tmp_path}/out-{name}")


def test_foreign_records(spark, tmp_path):
    """Line feeds alone, folded fields, several members and types of records are taken as they are."""
    one = b"WARC/1.0\r\nwarc-type: warcinfo\r\nWARC-Record-ID: <urn:x:1>\r\nContent-Length: 4\r\n\r\na: b\r\n\r\n"
    two = b"WARC/1.0\nWARC-Type: conversion\nWARC-Record-ID: <urn:x:2>\nX-Note: a\n b\nContent-Length: 3\n\nxyz\n\n"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.warc.gz").write_bytes(gzip.compress(one + two) + gzip.compress(one))
    warc.normalise(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    found = warc.read_index(spark, f"{tmp_path}/out").orderBy("offset").collect()
    assert [(r.id, r.type) for r in found] == [("<urn:x:1>", "warcinfo"), ("<urn:x:2>", "conversion"), ("<urn:x:1>", "warcinfo")]
