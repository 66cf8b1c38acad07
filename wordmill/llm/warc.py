"""WARC archives, and a chunked table of their records.

Archives are written as one gzip member a record. The reader streams them: a payload becomes rows of a record
identifier, a chunk number and at most ``CHUNK`` bytes, each with the digest of the payload up to its end, so no record
is held whole however large it is, and the last chunk's digest is the payload's.

Of records with equal payloads of at least ``least`` bytes that with the smallest page_id is a response and the others
are revisits of it. Defined results: a null html is an empty payload, a null url an empty target. A page without a
page_id is never referred to: it revisits an equal page that has one, else it is a response. Rows that repeat the
smallest page_id are all responses. Very large payloads are written and read in chunks. Other columns are ignored. An empty
table gives archives without records.

The reader takes archives of other makers too, compressed or not: record identifiers of any form, records of any type, and
revisits without a length, whose payload_end is null. An archive that is cut or broken gives the rows before the fault and a last row
of record_type ``error`` that says what it met; other archives are read on. Errors of the store are none of these: they fail the task, which
Spark tries again. Header lines, urls among them, are read whole; a header beyond ``MOST_HEADER`` bytes is a fault. Line ends in a url
become a blank.
"""

from __future__ import annotations

import base64
import hashlib
import io
import os
import re
import urllib.parse
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Workspace, filesystem

CHUNK = 1 << 18
_DATE = "2024-01-01T00:00:00Z"  # records carry no time of their own here; the same input gives the same archive
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _header(kind: str, page: str, url: str, length: int, digest: str, size: int, refers: str | None) -> bytes:
    clean = re.sub(r"[\r\n]+", " ", url)
    page = urllib.parse.quote(page, safe="")  # an identifier may hold any character
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Date: {_DATE}", f"WARC-Target-URI: {clean}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}", "Content-Type: application/http;msgtype=response", f"Content-Length: {length}"]
    if refers is not None:
        lines += [f"WARC-Refers-To: <urn:page:{urllib.parse.quote(refers, safe='')}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass")


def _write(folder: str, level: int):
    def run(batches):
        fs, at = filesystem(f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz")
        part = f"{at}.{uuid.uuid4().hex}"
        fs.create_dir(os.path.dirname(at), recursive=True)
        n = 0
        with fs.open_output_stream(part, compression=None) as out:
            for batch in batches:
                ids, urls, firsts, digests = (batch.column(c).to_pylist() for c in ("page_id", "url", "first_id", "digest"))
                for k, (page, url, first, digest) in enumerate(zip(ids, urls, firsts, digests)):
                    html = batch.column("html")[k].as_buffer()
                    size = html.size if html is not None else 0
                    revisit = first is not None and page != first
                    member = zlib.compressobj(level, zlib.DEFLATED, 31)
                    length = len(_HTTP) + (0 if revisit else size)
                    out.write(member.compress(_header("revisit" if revisit else "response", "" if page is None else str(page), url or "", length, base32_sha1(bytes.fromhex(digest)), size, str(first) if revisit else None)))
                    out.write(member.compress(_HTTP))
                    if not revisit and size:
                        view = memoryview(html)
                        for i in range(0, size, CHUNK):
                            out.write(member.compress(view[i : i + CHUNK]))
                    out.write(member.compress(b"\r\n\r\n") + member.flush())
                    n += 1
        fs.move(part, at)
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz"]), pa.array([n], pa.int64())], ["path", "records"])

    return run


def write_archives(pages: DataFrame, work: Workspace, least: int = 0, level: int = 6) -> DataFrame:
    """Write an archive for each partition of ``pages`` (page_id, url, html); returns (path, records)."""
    html = F.coalesce("html", F.lit(""))
    digested = pages.select("page_id", F.sha1(html).alias("digest"), F.octet_length(html).alias("size"))
    several = digested.where(F.col("size") >= least).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # a table of its own, so its size is known when the join with the pages is planned
    several = work.keep(several, "several")
    full = pages.select("page_id", "url", F.col("html"), F.sha1(html).alias("digest"), (F.octet_length(html) >= least).alias("joins"))
    # a digest that very many pages have is split over salts
    salts = 16
    salted = several.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).withColumnRenamed("digest", "of_digest")
    full = full.withColumn("row_salt", F.when(F.col("joins"), F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int")))
    joined = full.join(salted, (F.col("digest") == F.col("of_digest")) & (F.col("row_salt") == F.col("salt")), "left")
    files = joined.select("page_id", "url", "html", "first_id", "digest").mapInArrow(_write(f"{work.path}/archives", level), "path string, records long")
    return work.keep(files, "files")


#: Bytes that are read of a line at once, and bytes of a record's header beyond which an archive counts as broken.
_LINE = 1 << 16
MOST_HEADER = 1 << 28


def _header_line(stream, room: int) -> bytes:
    """A whole line, however long; one beyond ``room`` is an error, never cut."""
    pieces, held = [], 0
    while piece := stream.readline(_LINE):
        pieces.append(piece)
        held += len(piece)
        if held > room:
            raise ValueError(f"header of more than {MOST_HEADER} bytes")
        if piece.endswith(b"\n"):
            break
    return b"".join(pieces)


def records(stream, chunk: int = CHUNK):
    """Rows of an archive: headers, chunk number, offset of the chunk's end, digest so far, last, bytes."""
    while line := _header_line(stream, MOST_HEADER):
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:40]!r}")
        headers, room = {}, MOST_HEADER
        while (line := _header_line(stream, room)) and line not in (b"\r\n", b"\n"):
            room -= len(line)
            name, _, value = line.decode("utf-8", "surrogateescape").partition(":")
            headers[name.strip().lower()] = value.strip()
        if "content-length" not in headers:
            raise ValueError("record without a length, or archive ends inside a header")
        left = int(headers["content-length"])
        if headers.get("content-type", "").startswith("application/http"):
            whole = True
            while left and (line := stream.readline(min(left, _LINE))):  # the payload begins after the HTTP header
                left -= len(line)
                if whole and line in (b"\r\n", b"\n"):
                    break
                whole = line.endswith(b"\n")
        digest, number, end = hashlib.sha1(), 0, 0
        while True:
            data = stream.read(min(chunk, left)) if left else b""
            if left and not data:
                raise ValueError("archive ends inside a record")
            left -= len(data)
            digest.update(data)
            end += len(data)
            yield headers, number, end, digest.copy(), not left, data
            number += 1
            if not left:
                break


_ID = re.compile(r"<urn:page:(.*)>")


def _identifier(value: str | None) -> str | None:
    """The page of an identifier that :func:`write_archives` made (null where that is empty), others without their brackets."""
    if not value:
        return None
    own = _ID.fullmatch(value)
    return urllib.parse.unquote(own[1]) or None if own else value.strip("<>")


def _clean(value: str | None) -> str | None:
    """Bytes of a header that are no UTF-8 become marks."""
    return None if value is None else value.encode("utf-8", "surrogateescape").decode("utf-8", "replace")


class _Members(io.RawIOBase):
    """The bytes of gzip members, one after the other; what is before a fault is read before the fault is raised."""

    def __init__(self, raw):
        self.raw, self.member, self.rest = raw, None, b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while True:
            if self.member is None:
                self.rest = self.rest.lstrip(b"\0")
            if not self.rest:
                self.rest = self.raw.read(1 << 16)
                if not self.rest:
                    if self.member is not None:
                        raise EOFError("archive ends inside a member")
                    return 0
                continue
            if self.member is None:
                self.member = zlib.decompressobj(31)
            out = self.member.decompress(self.rest, len(buffer))
            if self.member.eof:
                self.member, self.rest = None, self.member.unused_data
            else:
                self.rest = self.member.unconsumed_tail
            if out:
                buffer[: len(out)] = out
                return len(out)


def _read(with_data: bool, chunk: int, own: bool):
    def run(batches):
        for batch in batches:
            for path, expected in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist() if own else [None] * len(batch)):
                fs, at = filesystem(path)
                rows, held, n = [], 0, 0
                try:
                    with fs.open_input_stream(at, compression=None) as raw:
                        plain = io.BufferedReader(raw, 1 << 16)
                        zipped = plain.peek(2)[:2] == b"\x1f\x8b"
                        stream = io.BufferedReader(_Members(plain), 1 << 16) if zipped else plain
                        for headers, number, end, digest, last, data in records(stream, chunk):
                            kind = headers.get("warc-type")
                            value = base32_sha1(digest.digest())
                            if kind == "revisit":  # digest and length of the payload that isn't repeated
                                told, length = headers.get("warc-payload-digest"), headers.get("x-payload-length")
                                value, end = told and told.removeprefix("sha1:"), int(length) if length else None
                            refers = _identifier(headers.get("warc-refers-to"))
                            rows.append((*map(_clean, (_identifier(headers.get("warc-record-id")), kind, refers, headers.get("warc-target-uri"))), number, end, value, last, data if with_data else None, None))
                            held += len(data) if with_data else 200
                            n += last
                            if held > 1 << 22:
                                yield _rows(rows)
                                rows, held = [], 0
                # what a broken archive raises; errors of the store go up, so that Spark tries the task again
                except (ValueError, EOFError, zlib.error) as e:
                    if own:
                        raise ValueError(f"{path}: record {n}: {e}") from e
                    rows.append((None, "error", None, None, None, None, None, False, None, _clean(str(e)) or type(e).__name__))
                if own and n != expected:
                    raise ValueError(f"{path}: {n} records, not {expected}")
                if rows:
                    yield _rows(rows)

    return run


_CHUNK_COLUMNS = (("record_id", "string"), ("record_type", "string"), ("refers_to", "string"), ("url", "string"), ("chunk", "int"), ("payload_end", "long"), ("digest", "string"), ("is_last", "boolean"), ("data", "binary"), ("error", "string"))
_CHUNK_TYPES = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.bool_(), pa.binary(), pa.string())


def _rows(rows):
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_CHUNK_TYPES)], [c for c, _ in _CHUNK_COLUMNS])


def read_chunks(files: DataFrame, with_data: bool = True, chunk: int = CHUNK, own: bool = False) -> DataFrame:
    """The chunk table of archives (path): record_id, record_type, refers_to, url, chunk, payload_end, digest, is_last, data, error.

    ``own``: ``files`` are what :func:`write_archives` gave (path, records); an archive that is broken or doesn't have that many records then
    fails the task in place of an error row."""
    n = max(1, files.count())
    return files.select("path", *["records"] * own).repartition(n, "path").mapInArrow(_read(with_data, chunk, own), ", ".join(" ".join(c) for c in _CHUNK_COLUMNS))


#: What :func:`write_archives` and :func:`read_chunks` give for the payloads, in DuckDB.
SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
b AS (
  SELECT *, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || rpad(substr(hex, (i * 5 // 4)::INT + 1, 3), 3, '0'))::INT >> (7 - (i * 5) % 4)::INT) & 31) + 1, 1)), '') AS payload_digest,
    min(page_id) OVER (PARTITION BY hex) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id IS NULL OR page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM b
"""
