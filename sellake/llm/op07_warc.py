"""Operator 7, WARC: a writer with one gzip member per record and a sequential reader.

The reader takes the compressed bytes in portions, decompresses them incrementally, finds a record's end by its Content-Length
and the end of its member, and verifies block and payload digests. It holds one record at a time, so a very long payload costs its
own length. Only page_id, url and html are read, so other columns may have any names.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, key_of, open_fs, publish, read, scratch

FILE_BYTES, PORTION = 1 << 30, 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, path string, offset long"


class WarcError(ValueError):
    """A file that is not a row of whole, unchanged WARC records."""


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _field(value: str) -> str:
    """A header value: one line."""
    return " ".join(str(value).split())


def record(kind: str, record_id: str, uri: str, block: bytes, date: str, **more: str) -> bytes:
    """One record, compressed as a gzip member of its own."""
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": date, "WARC-Target-URI": uri, "WARC-Block-Digest": _sha1(block), "Content-Length": len(block)}
    head |= {k.replace("_", "-"): v for k, v in more.items()}
    lines = "".join(f"{k}: {_field(v)}\r\n" for k, v in head.items() if v != "")
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n") + pack.flush()


def http_head(length: int) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length


def page_record(page_id, uri, payload: bytes | None, length: int, digest_hex: str, refers_to, date: str) -> bytes:
    digest = "sha1:" + base64.b32encode(bytes.fromhex(digest_hex)).decode()
    more = {"WARC_Payload_Digest": digest, "Content_Type": "application/http; msgtype=response"}
    uri = uri or f"urn:page:{page_id}"
    if refers_to is None:
        return record("response", f"urn:page:{page_id}", uri, http_head(length) + payload, date, **more)
    return record("revisit", f"urn:page:{page_id}", uri, http_head(length), date, WARC_Profile=PROFILE, WARC_Refers_To=f"<urn:page:{refers_to}>", **more)


def _headers(raw: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = raw.decode("utf-8", "replace").split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def read_records(stream, portion: int = PORTION) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers in lower case, block) of each record of a file object, in order, each verified.

    A truncated member, a length or digest that does not fit, and bytes that are no member raise WarcError with the offset.
    """
    at, rest = 0, b""
    while True:
        rest = rest or stream.read(portion)
        if not rest:
            return
        member, parts, size = zlib.decompressobj(31), [], 0
        while not member.eof:
            if not rest and not (rest := stream.read(portion)):
                raise WarcError(f"record at {at} is cut off")
            try:
                parts.append(member.decompress(rest))
            except zlib.error as e:
                raise WarcError(f"record at {at}: {e}") from e
            size, rest = size + len(rest) - len(member.unused_data), member.unused_data
        data = b"".join(parts)
        head, mark, body = data.partition(b"\r\n\r\n")
        version, headers = _headers(head)
        if not mark or not version.startswith("WARC/") or not headers.get("content-length", "").isdigit():
            raise WarcError(f"record at {at} has no WARC header")
        n = int(headers["content-length"])
        block = body[:n]
        if len(block) != n or body[n:] != b"\r\n\r\n":
            raise WarcError(f"record at {at}: its length is not {n}")
        if headers.get("warc-block-digest") not in (None, _sha1(block)):
            raise WarcError(f"record at {at}: block digest")
        if headers.get("warc-type") == "response" and "warc-payload-digest" in headers and headers["warc-payload-digest"] != _sha1(block.partition(b"\r\n\r\n")[2]):
            raise WarcError(f"record at {at}: payload digest")
        yield at, headers, block
        at += size


def write_warc(pages: DataFrame, out_dir: str, min_bytes: int = 1000, date: str = "1970-01-01T00:00:00Z", page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write ``pages`` to WARC files in ``out_dir`` (shared by all executors); the manifest has ``path`` and ``n_records``.

    Of pages with equal payloads of at least ``min_bytes`` bytes, that of the largest id is a response and the others are
    revisits of it, without payload. A NULL or empty html is an empty response; a NULL url becomes a urn; NULL ids count as the
    least. Rows that repeat an id and its payload get equal records. No page: no file. Only digests are shuffled to find equal
    payloads; each payload moves once, by its page. Files are closed near FILE_BYTES, and only files in the manifest count.
    """
    rows = pages.select(key_of(F.col(page_id).cast("long")).alias("id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1("html")).withColumn("n", F.octet_length("html").cast("long"))
    large = cut(rows.where(F.col("n") >= min_bytes).select("id", "digest"), "page-digests")
    top = cut(large.groupBy("digest").agg(F.max("id").alias("top"), F.count("*").alias("n")).where("n > 1").drop("n"), "page-copies")
    again = large.join(top, "digest").where("id <> top").select("id", "digest", "top").distinct()
    planned = rows.join(again, ["id", "digest"], "left").select("id", "url", F.when(F.col("top").isNull(), F.col("html")).alias("html"), "digest", "n", "top")
    name = lambda k: None if k is None or k == -(2**63) else k

    def write(batches):
        part, number, batches = TaskContext.get().partitionId(), 0, iter(batches)
        waiting: list = []

        def more():
            while not waiting:
                b = next(batches, None)
                if b is None:
                    return False
                waiting.extend(zip(*(b.column(c).to_pylist() for c in ("id", "url", "html", "n", "digest", "top"))))
                waiting.reverse()
            return True

        while more():
            path, n = f"{out_dir}/{part:06d}-{number:04d}-{uuid.uuid4().hex}.warc.gz", [0]

            def fill(out, n=n):
                size = out.write(record("warcinfo", f"urn:file:{part}:{number}", "", b"format: WARC File Format 1.1\r\n", date, Content_Type="application/warc-fields"))
                while size < FILE_BYTES and more():
                    pid, uri, text, length, digest, ref = waiting.pop()
                    size += out.write(page_record(name(pid), uri, None if text is None else text.encode(), length, digest, ref, date))
                    n[0] += 1

            publish(path, fill)
            number += 1
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array(n, pa.int64())], names=["path", "n_records"])

    return cut(planned.mapInArrow(write, "path string, n_records long"), "warc-manifest")


def read_warc(manifest: DataFrame) -> DataFrame:
    """The page records of the files of ``manifest``: page_id, payload_bytes and payload_digest (hex) of the full payload,
    record_type, refers_to, path and offset. A task reads whole files in order; of a revisit the length is that in its HTTP head."""

    def page(urn: str | None):
        tail = (urn or "").strip("<>").rpartition(":")[2]
        return int(tail) if tail.lstrip("-").isdigit() else None

    def scan(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                fs, inner = open_fs(path)
                out = []
                with fs.open_input_stream(inner, compression=None) as stream:
                    for at, h, block in read_records(stream):
                        if h.get("warc-type") in ("response", "revisit"):
                            head, _, payload = block.partition(b"\r\n\r\n")
                            length = int(_headers(head)[1]["content-length"])
                            if h["warc-type"] == "response" and length != len(payload):
                                raise WarcError(f"{path} at {at}: {len(payload)} bytes of payload, not {length}")
                            digest = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
                            out.append((page(h["warc-record-id"]), length, digest, h["warc-type"], page(h.get("warc-refers-to")), path, at))
                        if len(out) >= 4096:
                            yield _rows(out)
                            out = []
                if out:
                    yield _rows(out)

    def _rows(out):
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[x.split()[0] for x in _READ.split(", ")])

    return manifest.repartitionByRange(max(1, manifest.count()), "path").mapInArrow(scan, _READ)


def op7_warc(spark, sf_dir: str) -> DataFrame:
    """All ``pages`` written and read back."""
    manifest = write_warc(read(spark, sf_dir, "pages", "page_id", "url", "html"), scratch(spark, "warc"))
    return read_warc(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS payload_digest FROM p),
t AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS top FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN top = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN top <> page_id THEN top END AS refers_to FROM t"""
