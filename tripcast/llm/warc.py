"""WARC archives: writing, normalising of monolithic gzip, reading by index.

* ``write_archives``: a task writes its pages as records into gzip files that
  are each one stream (one member), as crawlers that compress a whole file
  leave them.
* ``normalise``: a task inflates one such file once, from front to back,
  holding one record at a time, rewrites every record as a gzip member of its
  own and writes a sidecar index (offset, length, type, id, digest) beside the
  new file; the same rows come back as a table.
* ``read_records``: tasks go to the offsets, inflate single members and parse
  them.

Of records with equal payloads of at least ``least_bytes`` bytes, the one with
the largest id is a ``response``, the others are ``revisit`` records without
the payload.

A task names its files anew in every attempt and returns the names as rows;
only the rows of attempts that Spark kept are ever read, so a lost executor
leaves at most files that nothing refers to.  Files lie in the shared folder
and are opened with ``pyarrow.fs``.

Cases: a null html is the empty payload; a null url becomes ``urn:page:<id>``;
rows with a null id are never chosen while their group has an id, and are
responses themselves if it has none; rows that share the largest id are all
responses; an empty table writes no archive and gives no rows; line breaks in
urls are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcast.llm.common import table, written
from tripcast.session import scratch_path

LEAST_BYTES = 0
ARCHIVE_BYTES = 64 << 20     # payload bytes after which a task begins its next archive
READ_BYTES = 1 << 20
LEVEL = 6
DATE = "2000-01-01T00:00:00Z"
#: fixed values: names of the format
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and path[5:7] != "//" else path)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def clean(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in url)


def headers(fields: list[tuple[str, str]]) -> bytes:
    return b"".join(f"{k}: {v}\r\n".encode() for k, v in fields) + b"\r\n"


def page_record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    http = b"HTTP/1.1 200 OK\r\n" + headers([("Content-Type", "text/html; charset=utf-8"),
                                            ("Content-Length", str(len(payload)))])
    block = http if revisit else http + payload
    name = "none" if page is None else str(page)
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{name}>"),
              ("WARC-Date", DATE), ("WARC-Target-URI", clean(url) if url else f"urn:page:{name}"),
              ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}")]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + b"\r\n" + headers(fields) + block + b"\r\n\r\n"


def info_record(name: str) -> bytes:
    block = headers([("format", "WARC File Format 1.1")])
    return VERSION + b"\r\n" + headers([
        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"),
        ("WARC-Date", DATE), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(block)))]
    ) + block + b"\r\n\r\n"


class Record(NamedTuple):
    fields: dict[str, str]
    block: bytes
    raw: bytes


def parse_fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(b":") for line in head.split(b"\r\n")[1:] if line)
    return {k.decode().lower(): v.strip().decode() for k, _, v in pairs}


def parse(stream: Iterator[bytes]) -> Iterator[Record]:
    """Records of an inflated stream that comes in pieces; holds one at a time."""
    held = bytearray()
    for piece in stream:
        held += piece
        at = 0
        while (end := held.find(b"\r\n\r\n", at)) >= 0:
            fields = parse_fields(bytes(held[at:end]))
            begin, stop = end + 4, end + 4 + int(fields["content-length"])
            if len(held) < stop + 4:
                break
            yield Record(fields, bytes(held[begin:stop]), bytes(held[at:stop + 4]))
            at = stop + 4
        del held[:at]
    if held:
        raise ValueError("the archive ends within a record")


def inflated(source) -> Iterator[bytes]:
    """A gzip stream of one member or more, in pieces; one that ends within a
    member has been cut and is an error."""
    machine, begun = zlib.decompressobj(31), False
    while data := source.read(READ_BYTES):
        while data:
            begun = True
            yield machine.decompress(data)
            data = machine.unused_data if machine.eof else b""
            if machine.eof:
                machine, begun = zlib.decompressobj(31), False
    if begun:
        raise ValueError("the archive ends within a gzip member")


class Deflater:
    """Counts what it writes to a sink, compressed as one stream."""

    def __init__(self, sink):
        self.sink, self.machine = sink, zlib.compressobj(LEVEL, zlib.DEFLATED, 31)

    def write(self, data: bytes) -> None:
        self.sink.write(self.machine.compress(data))

    def close(self) -> None:
        self.sink.write(self.machine.flush())
        self.sink.close()


def choose(pages: DataFrame, key: str, payload: str, least_bytes: int) -> DataFrame:
    """``pages`` (key, url, payload, sha) with ``top``, the largest id among
    equal payloads where there are several and they are long enough."""
    top = pages.filter(F.octet_length(payload) >= least_bytes).groupBy("sha").agg(
        F.max(key).alias("top"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("sha", "top")
    # both sides read from tables and sorted, so Spark can split a payload that many pages share
    return pages.join(written(top, "repeated-payloads").hint("merge"), "sha", "left")


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
                   least_bytes: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes monolithic archives; one row (path, records) for each."""
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("payload"))
    chosen = choose(rows.withColumn("sha", F.sha1("payload")), "key", "payload", least_bytes).select(
        "key", "url", "payload", "top")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, place = file_system(folder)
        fs.create_dir(place, recursive=True)
        out, path, records, held = None, "", 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path = f"{place}/{uuid.uuid4().hex}.warc.gz"
                    out, records, held = Deflater(fs.open_output_stream(path, compression=None)), 0, 0
                    out.write(info_record(path))
                revisit = row["top"] is not None and row["top"] != row["key"]
                out.write(page_record(row["key"], row["url"], row["payload"], row["top"], revisit))
                records, held = records + 1, held + len(row["payload"])
                if held >= archive_bytes:
                    out.close()
                    yield pa.RecordBatch.from_pydict({"path": [path], "records": [records]})
                    out = None
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [records]})

    return written(chosen.mapInArrow(write, "path string, records long"), "archives")


INDEX = "path string, offset long, length long, type string, id string, digest string"


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrites each archive with one member per record; the index rows.  The
    sidecar beside each new file has the same rows as tab-separated lines."""

    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, place = file_system(folder)
        fs.create_dir(place, recursive=True)
        for path in (p for pdf in batches for p in pdf["path"]):
            target = f"{place}/{uuid.uuid4().hex}.warc.gz"
            offset, lines = 0, []
            with (fs.open_input_stream(path, compression=None) as source,
                  fs.open_output_stream(target, compression=None) as out,
                  fs.open_output_stream(f"{target}.idx", compression=None) as index):
                for record in parse(inflated(source)):
                    machine = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    member = machine.compress(record.raw) + machine.flush()
                    out.write(member)
                    line = (target, offset, len(member), record.fields["warc-type"], record.fields["warc-record-id"],
                            record.fields.get("warc-payload-digest"))
                    index.write(("\t".join(str(x or "") for x in line[1:]) + "\n").encode())
                    offset += len(member)
                    lines.append(line)
                    if len(lines) == 10_000:
                        yield pd.DataFrame(lines, columns=[c.split()[0] for c in INDEX.split(", ")])
                        lines = []
            yield pd.DataFrame(lines, columns=[c.split()[0] for c in INDEX.split(", ")])

    # archives are dealt out one by one: each is a task's worth of work
    spread = archives.select("path").repartition(max(1, archives.count()))
    return written(spread.mapInPandas(rewrite, INDEX), "warc-index")


RECORD = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")


def page_of(name: str | None) -> int | None:
    last = (name or "").strip("<>").rpartition(":")[2]
    return None if last in ("", "none") else int(last)


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The page records at the offsets of ``index``; the digest of a payload
    that is there is computed anew and must be the one recorded."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = file_system(folder)
        path, source = None, None
        for pdf in batches:
            rows = []
            for at in pdf.sort_values(["path", "offset"]).itertuples():
                if at.path != path:
                    path, source = at.path, fs.open_input_file(at.path)
                source.seek(at.offset)
                record = next(parse(inflated(io.BytesIO(source.read(at.length)))))
                f = record.fields
                head, _, payload = record.block.partition(b"\r\n\r\n")
                digest = f["warc-payload-digest"].removeprefix("sha1:")
                n = int(parse_fields(head)["content-length"])
                if f["warc-type"] == "response" and (len(payload) != n or digest_of(payload) != digest):
                    raise ValueError(f"damaged record {f['warc-record-id']} in {at.path}")
                rows.append((page_of(f["warc-record-id"]), n, digest, f["warc-type"], page_of(f.get("warc-refers-to")),
                             f["warc-target-uri"]))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in RECORD.split(", ")])
            yield out.astype({"page_id": "Int64", "refers_to": "Int64"})

    # whole runs of an archive's records to a task, so its reads go forward
    return index.filter("type in ('response', 'revisit')").mapInPandas(read, RECORD)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    archives = write_archives(table(spark, sf_dir, "pages", "page_id", "url", "html"), f"{folder}/monolithic")
    index = normalise(archives, f"{folder}/members")
    return read_records(index, f"{folder}/members").drop("url")


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
h AS (SELECT page_id, CAST(octet_length(encode(t)) AS BIGINT) AS payload_bytes, sha1(t) AS hex FROM p),
d AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS INTEGER)
          >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) AS INTEGER), 1)), '') AS payload_digest,
        max(page_id) OVER (PARTITION BY hex) AS top FROM h)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = top OR payload_bytes < {LEAST_BYTES} THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top OR payload_bytes < {LEAST_BYTES} THEN NULL ELSE top END AS refers_to
FROM d
"""
