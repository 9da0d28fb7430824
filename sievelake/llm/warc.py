"""WARC archives: a writer with one gzip member per record, and a sequential reader.

An archive is one row (archive, data) of a table, so any file system that Spark can write holds it; files named
``*.warc.gz`` are read with Spark's binaryFile source and written to a mounted folder by ``save_files``. The reader
inflates member by member in small pieces, frames each record by its Content-Length, and checks its digests.
"""

from __future__ import annotations

import base64
import hashlib
import os
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize

PIECE = 64 << 10
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:x-page:"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))]) + "\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(head.encode() + block + b"\r\n\r\n") + pack.flush()


def _line(value: str | None) -> str:
    """A header value: line breaks would end the header, so they are escaped."""
    return (value or "").replace("\r", "%0D").replace("\n", "%0A").strip()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One gzip member: a response, or a revisit of the response of page ``refers_to``."""
    name, full = ("none" if page_id is None else str(page_id)), digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<{URN}{name}>"), ("WARC-Date", DATE), ("WARC-Target-URI", _line(url))]
    headers += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{full}"), ("WARC-Block-Digest", f"sha1:{digest(block)}")]
    if refers_to is not None:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{URN}{refers_to}>")]
    return _member(headers, block)


def write_archives(pages: DataFrame, least_revisit_bytes: int = 0, archive_bytes: int = 8 << 20, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """A table (archive, data) of WARC archives with a record per row of ``pages``.

    Of rows with equal payloads of at least ``least_revisit_bytes`` bytes, the one with the largest id is a response and
    those with smaller ids are revisits of it; shorter payloads are all responses.

    Null html is an empty payload; a null id is always a response; rows that repeat the largest id are all responses;
    a null URL is written empty; an empty table gives no archive; other columns are not read.
    """
    rows = pages.select(F.col(key).cast("long").alias("id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.unhex(F.sha1("payload")))
    slim = rows.where(F.octet_length("payload") >= least_revisit_bytes).select("id", "sha")
    first = slim.groupBy("sha").agg(F.max("id").alias("refers_to"), F.min("id").alias("low")).where("low < refers_to").drop("low")
    first = materialize(first, "warc-first")  # read back as a plain table, so that Spark can split a large group's join
    again = slim.join(first, "sha").where(F.col("id") < F.col("refers_to")).select("id", "sha", "refers_to").distinct()
    placed = rows.join(again, ["id", "sha"], "left").select("id", "url", "payload", "refers_to")

    def run(batches):
        part, n, out = TaskContext.get().partitionId(), 0, bytearray()
        made = lambda: pa.RecordBatch.from_pydict({"archive": [f"part-{part:06d}-{n:06d}.warc.gz"], "data": [bytes(out)]})
        for batch in batches:
            for one in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "payload", "refers_to")), strict=True):
                if not out:
                    out += _member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:x-archive:{part}-{n}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                out += record(*one)
                if len(out) >= archive_bytes:
                    yield made()
                    n, out = n + 1, bytearray()
        if out:
            yield made()

    return placed.mapInArrow(run, "archive string, data binary")


def members(data: bytes):
    """Each gzip member's content, inflated in pieces."""
    at = 0
    while at < len(data):
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            if at >= len(data):
                raise ValueError("the last gzip member is cut short")
            piece = data[at : at + PIECE]
            parts.append(inflate.decompress(piece))
            at += len(piece) - len(inflate.unused_data)
        yield b"".join(parts)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record; ValueError if the framing is wrong."""
    end = member.index(b"\r\n\r\n")
    version, *lines = member[:end].decode().split("\r\n")
    if not version.startswith("WARC/1."):
        raise ValueError(f"not a WARC record: {version[:20]}")
    head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    size = int(head["content-length"])
    block, rest = member[end + 4 : end + 4 + size], member[end + 4 + size :]
    if len(block) != size or rest != b"\r\n\r\n":
        raise ValueError("the record's length differs from its Content-Length")
    return head, block


_FIELDS = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("digest_ok", pa.bool_()), ("payload", pa.binary()), ("error", pa.string())]
_DDL = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, digest_ok boolean, payload binary, error string"


def _page(urn: str | None) -> int | None:
    name = (urn or "").strip("<>").removeprefix(URN)
    return int(name) if name.lstrip("-").isdigit() else None


def _safely(found):
    """What an iterator gives, and at its end the error that it breaks off with."""
    try:
        yield from found
    except (ValueError, zlib.error) as broken:
        yield broken


def _row(member: bytes | Exception, with_payload: bool) -> tuple | None:
    """The fields of a response or revisit record, or of an error; None for other records."""
    try:
        if isinstance(member, Exception):
            raise ValueError(str(member))
        head, block = parse(member)
        kind = head["warc-type"]
        if kind not in ("response", "revisit"):
            return None
        http, _, payload = block.partition(b"\r\n\r\n")
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in http.decode().split("\r\n")[1:])}
        said = head["warc-payload-digest"].removeprefix("sha1:")
        good = head["warc-block-digest"] == f"sha1:{digest(block)}" and (kind == "revisit" or digest(payload) == said)
        length = len(payload) if kind == "response" else int(fields["content-length"])
        return _page(head["warc-record-id"]), head["warc-target-uri"] or None, kind, length, said, _page(head.get("warc-refers-to")), good, payload if with_payload and kind == "response" else None, None
    except (ValueError, KeyError) as broken:
        return (None,) * (len(_FIELDS) - 1) + (f"{type(broken).__name__}: {broken}",)


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """A row per response or revisit record of the archives in column ``data``, in file order within an archive.

    ``digest_ok``: the block's digest, and a response's payload digest, are those of its header. A revisit's
    payload_bytes and payload_digest are the full payload's, from its headers; its payload is null. A record that is
    framed wrongly, or lacks a header, is a row with ``error`` and nulls, and so is the place where the compression breaks
    off, beyond which an archive can't be read; ``error`` is null elsewhere. Null or empty data holds no records.
    """

    def run(batches):
        for batch in batches:
            for data in batch.column("data").to_pylist():
                rows, size = [], 0
                for member in _safely(members(data or b"")):
                    row = _row(member, with_payload)
                    if row is None:
                        continue
                    rows.append(row)
                    size += len(row[-2] or b"")
                    if len(rows) >= 5000 or size > 16 << 20:
                        yield _rows(rows)
                        rows, size = [], 0
                if rows:
                    yield _rows(rows)

    return archives.select("data").mapInArrow(run, _DDL)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), _FIELDS, strict=True)], names=[k for k, _ in _FIELDS])


def read_files(spark: SparkSession, path: str, **options) -> DataFrame:
    """Records of the ``*.warc.gz`` files below ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").option("recursiveFileLookup", True).load(path)
    return read_archives(files.select(F.col("content").alias("data")), **options)


def save_files(archives: DataFrame, folder: str) -> None:
    """Write each archive as a file of its name to ``folder``, which every executor has mounted at the same place."""

    def put(rows):
        os.makedirs(folder, exist_ok=True)
        for row in rows:
            path = os.path.join(folder, row["archive"])
            with open(f"{path}.tmp-{TaskContext.get().taskAttemptId()}", "wb") as out:
                out.write(row["data"])
            os.replace(out.name, path)

    archives.foreachPartition(put)
