"""WARC archives of pages: written as monolithic gzip streams, normalised to a gzip member per record.

1. ``write_archives`` writes a WARC/1.1 record per page as text, so Spark's writer puts each task's records
   into one gzip stream. Of records with equal payloads, the one with the largest page_id is the response and the
   others revisit it: a revisit holds the HTTP head alone. Payloads are told apart by SHA-1. Digests are counted per
   page first, and only those met more than once are joined back, as a broadcast of measured size or with hot
   digests dealt over tasks.
2. ``normalise`` takes any folder of WARC files. Each stream is inflated once, front to back; every record becomes
   a gzip member of its own, and a line of the sidecar index tells its offset and length. A task writes one archive
   and the index of the same file name, in one commit.
3. ``read_archives`` reads members back, each by itself; ``read_entries`` reads those an index selects.

Spark's text writer puts a separator behind every row. Archives use a NUL for it: a member ends with the high byte
of its size, which is 0 below 16 MiB, so that byte is left to the writer. A larger member is followed by an empty
one, which ends with 0 too. Index lines are JSON and end with a NUL.

Defined cases: a null html is an empty payload; a null page_id is written ``null``, counts as the least and is
read as null again; rows of one page_id are records of their own, and of equal payloads that with the
largest url is the response (null is least), of rows equal in all three one; payloads below ``least_bytes`` are
all responses; line ends in a url become spaces; an empty table gives archives without records; further
columns are ignored. A stream that breaks off or holds something else than records fails with its path.
An archive is a row while it is rewritten, so its compressed bytes have to fit a task.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordtrust.operators.joins import attach
from recordtrust.sources.workspace import Workspace

END = "\r\n"
CLOSE = END + END
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
NUL = "\x00"
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
BATCH_BYTES = 1 << 20

REWRITTEN = "kind string, at long, value binary"
INDEX = "id string, type string, offset long, length long"
MEMBERS = "file string, offset long, length long, id string, type string, refers_to string, payload_bytes long, payload_digest string"


def base32(digest: Column) -> Column:
    """Base32 of a SHA-1 digest given in hex: five hex digits are four characters."""
    numbers = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.conv(F.substr(digest, i * 5 + 1, F.lit(5)), 16, 10).cast("int"))
    letters = F.transform(numbers, lambda v: F.concat(*[F.substr(F.lit(BASE32), F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]))
    return F.array_join(letters, "")


def repeated_payloads(sized: DataFrame, workspace: Workspace) -> DataFrame:
    """Digests of more than one row: page and url of the response, how many rows share these, and all rows."""
    counted = sized.groupBy("digest", "page_id", "url").agg(F.count(F.lit(1)).alias("n"))
    top = counted.groupBy("digest").agg(F.max(F.struct("page_id", "url", "n")).alias("top"), F.sum("n").alias("rows")).where("rows > 1")
    found = top.select("digest", F.col("top.page_id").alias("to_page"), F.col("top.url").alias("to_url"), F.col("top.n").alias("copies"), "rows")
    return workspace.stage(found, "payloads")


def records(pages: DataFrame, workspace: Workspace, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html, digest (hex), bytes and, for a revisit, the page it refers to."""
    html = F.coalesce("html", F.lit(""))
    sized = pages.select(F.col("page_id"), F.col("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).cast("long").alias("bytes"))
    repeated = repeated_payloads(sized.where(F.col("bytes") >= least_bytes), workspace)
    met = attach(sized, repeated, ["digest"], "left", "rows", null_safe=True)
    met = met.withColumn("copies", F.when(F.col("bytes") >= least_bytes, F.col("copies")))
    top = F.col("page_id").eqNullSafe(F.col("to_page")) & F.col("url").eqNullSafe(F.col("to_url"))
    plain = ["page_id", "url", "html", "digest", "bytes", "to_page"]
    revisit = F.col("copies").isNotNull() & ~top
    out = met.where(F.coalesce(F.col("copies"), F.lit(1)) == 1).select(*plain, revisit.alias("revisit"))
    if repeated.where("copies > 1").isEmpty():
        return out
    # Rows that are equal in all columns stand for the response together: count them, make all but one a revisit.
    more = met.where("copies > 1")
    same = more.where(top).groupBy("page_id", "url", "digest", "bytes", "to_page").agg(F.first("html").alias("html"), F.count(F.lit(1)).alias("n"))
    same = same.withColumn("number", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).withColumn("revisit", F.col("number") > 1)
    return out.unionByName(more.where(~top).select(*plain, F.lit(True).alias("revisit"))).unionByName(same.select(*plain, "revisit"))


def record_text(rows: DataFrame) -> Column:
    """The record, without the two line ends that close it."""

    def urn(page: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(page).cast("string"), F.lit("null")), F.lit(">"))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(END))

    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}"), line("Content-Length", F.col("bytes").cast("string")), F.lit(END))
    block = F.concat(http, F.when(F.col("revisit"), F.lit("")).otherwise(F.col("html")))
    kind = F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))
    return F.concat(
        F.lit(f"WARC/1.1{END}"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", urn("page_id")),
        line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", " ")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("digest")))),
        F.when(F.col("revisit"), F.concat(line("WARC-Refers-To", urn("to_page")), line("WARC-Profile", F.lit(PROFILE)))).otherwise(F.lit("")),
        F.lit(f"Content-Type: application/http;msgtype=response{END}"),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(END),
        block,
    )


def write_archives(pages: DataFrame, folder: str, workspace: Workspace, least_bytes: int = 0) -> None:
    """Write every page as a record; each file is one gzip stream."""
    rows = records(pages, workspace, least_bytes)
    rows.select(record_text(rows).alias("value")).write.option("compression", "gzip").option("lineSep", CLOSE).option("maxRecordsPerFile", 0).text(folder)


class Record(NamedTuple):
    fields: dict[str, str]
    raw: bytes
    block: int

    def field(self, name: str) -> str | None:
        return self.fields.get(name)


def parse_record(stream: BinaryIO) -> Record | None:
    """The next record of a stream, with lower-case field names; None at its end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no record begins with {line[:40]!r}")
    head, fields, last = [line], {}, ""
    while (line := stream.readline()) not in (b"\r\n", b"\n"):
        if not line:
            raise EOFError("a record's head breaks off")
        head.append(line)
        if line[:1] in b" \t" and last:
            fields[last] += " " + line.decode("utf-8", "replace").strip()
        else:
            name, _, value = line.decode("utf-8", "replace").partition(":")
            last = name.strip().lower()
            fields[last] = value.strip()
    head.append(line)
    size = int(fields["content-length"])
    block = stream.read(size)
    if len(block) < size:
        raise EOFError("a record's block breaks off")
    begin = b"".join(head)
    return Record(fields, begin + block + CLOSE.encode(), len(begin))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("kind", pa.string()), ("at", pa.int64()), ("value", pa.binary())])
    offset, rows, index, held = 0, [], [], 0
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            with gzip.GzipFile(fileobj=pa.BufferReader(content.as_buffer()) if content.is_valid else io.BytesIO()) as stream:
                while True:
                    try:
                        record = parse_record(stream)
                    except (EOFError, OSError, ValueError, KeyError, zlib.error) as error:
                        raise ValueError(f"{path.as_py()}: {error}") from error
                    if record is None:
                        break
                    member = gzip.compress(record.raw, 6, mtime=0)
                    entry = {"id": record.field("warc-record-id"), "type": record.field("warc-type"), "offset": offset, "length": len(member)}
                    index.append(("index", len(index), json.dumps(entry).encode()))
                    if member[-1]:
                        member += EMPTY_MEMBER
                    rows.append(("records", offset, member[:-1]))
                    offset += len(member)
                    held += len(member)
                    if held >= BATCH_BYTES:
                        yield _batch(rows, schema)
                        rows, held = [], 0
    for at in range(0, len(rows), 10_000):
        yield _batch(rows[at : at + 10_000], schema)
    for at in range(0, len(index), 10_000):
        yield _batch(index[at : at + 10_000], schema)


def normalise(spark: SparkSession, archives: str, folder: str) -> None:
    """Rewrite all archives of a folder: ``folder/kind=records`` and, by the same file names, ``folder/kind=index``."""
    rewritten = spark.read.format("binaryFile").load(archives).select("path", "content").mapInArrow(_rewrite, REWRITTEN)
    ordered = rewritten.sortWithinPartitions("kind", "at").select("kind", F.col("value").cast("string").alias("value"))
    ordered.write.partitionBy("kind").option("compression", "none").option("lineSep", NUL).option("maxRecordsPerFile", 0).text(folder)


def _of_kind(kind: str) -> Column:
    """Files of one kind; without records there are none, and no folder of that kind."""
    return F.col("_metadata.file_path").rlike(f"/kind={kind}/[^/]*$")


def _archives(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).where(_of_kind("records"))
    return files.select(F.col("_metadata.file_name").alias("file"), "content")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """file, id, type, offset and length of every record."""
    lines = spark.read.schema(INDEX).option("lineSep", NUL).option("recursiveFileLookup", True).json(folder).where(_of_kind("index"))
    return lines.select(F.col("_metadata.file_name").alias("file"), "id", "type", "offset", "length")


def members(content: memoryview) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and inflated bytes of every gzip member."""
    at, step = 0, 1 << 16
    while at < len(content):
        inflate, parts, begin = zlib.decompressobj(31), [], at
        while not inflate.eof:
            piece = content[at : at + step]
            if not len(piece):
                raise EOFError("a member breaks off")
            parts.append(inflate.decompress(piece))
            at += len(piece) - len(inflate.unused_data)
        yield begin, at - begin, b"".join(parts)


def describe(file: str, offset: int, length: int, raw: bytes) -> tuple:
    """A row of MEMBERS: size and digest come from a response's payload, from a revisit's heads otherwise."""
    record = parse_record(io.BytesIO(raw))
    head, _, payload = record.raw[record.block : -len(CLOSE)].partition(CLOSE.encode())
    if record.field("warc-type") == "response":
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    else:
        lengths = [x.split(b":", 1)[1] for x in head.split(END.encode()) if x.lower().startswith(b"content-length:")]
        size, digest = int(lengths[0]) if lengths else None, (record.field("warc-payload-digest") or "").removeprefix("sha1:") or None
    return file, offset, length, record.field("warc-record-id"), record.field("warc-type"), record.field("warc-refers-to"), size, digest


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of normalised archives, each from its own member."""
    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("id", pa.string()), ("type", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for offset, length, raw in members(memoryview(content.as_buffer())):
                    if raw:  # an empty member closes a large one
                        rows.append(describe(file, offset, length, raw))
                    if len(rows) >= 10_000:
                        yield _batch(rows, schema)
                        rows = []
        if rows:
            yield _batch(rows, schema)

    return _archives(spark, folder).mapInArrow(run, MEMBERS)


def read_entries(spark: SparkSession, folder: str, entries: DataFrame) -> DataFrame:
    """id and raw record of some index rows: their members are cut out of the archives and nothing else is inflated."""
    cut = _archives(spark, folder).join(entries.select("file", "id", "offset", "length"), "file")
    member = F.substring(F.col("content"), (F.col("offset") + 1).cast("int"), F.col("length").cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = pa.array([gzip.decompress(x.as_py()) for x in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), raw], names=["id", "record"])

    return cut.select("id", member.alias("member")).mapInArrow(run, "id string, record binary")


def page_records(pages: DataFrame, workspace: Workspace, least_bytes: int = 0) -> DataFrame:
    """Write pages, normalise the archives and read them back: a row per page, found through the index."""
    spark, written, folder = pages.sparkSession, workspace.path("archives"), workspace.path("records")
    write_archives(pages, written, workspace, least_bytes)
    normalise(spark, written, folder)
    found = read_archives(spark, folder).join(read_index(spark, folder), ["file", "offset", "length", "id", "type"])

    def page(urn: str) -> Column:
        return F.expr(f"try_cast(regexp_extract({urn}, '^<urn:page:(.*)>$', 1) AS long)")

    return found.select(page("id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), page("refers_to").alias("refers_to"))
