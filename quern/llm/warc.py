"""Content-addressed archive of WARC records.

A record is its exact header block (the WARC header and, in a response, the HTTP header), a
payload and what follows it. The payload is stored once under its SHA-256; the other bytes of
each record are stored apart, with the digest. A join on the digest gives back every
record, byte by byte.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_END = b"\r\n\r\n"


def headers(block: bytes) -> dict[bytes, bytes]:
    """Fields of a header block by lower-case name; of a repeated one, the first."""
    out: dict[bytes, bytes] = {}
    for line in block.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            out.setdefault(name.strip().lower(), value.strip())
    return out


def divide(raw: bytes) -> tuple[bytes, bytes, bytes, bytes]:
    """Header block, payload and tail of a record, and the digest that it declares (or nothing). Together the first three are raw."""
    at = raw.find(_END)
    if not raw.startswith(b"WARC/") or at < 0:
        return b"", raw, b"", b""
    at += len(_END)
    fields = headers(raw[:at])
    size = fields.get(b"content-length", b"")
    end = min(len(raw), at + int(size)) if size.isdigit() else len(raw)
    if fields.get(b"content-type", b"").startswith(b"application/http"):
        inner = raw.find(_END, at, end)
        if inner >= 0:
            at = inner + len(_END)
    return raw[:at], raw[at:end], raw[end:], fields.get(b"warc-payload-digest", b"")


def agrees(declared: bytes, payload: bytes) -> bool | None:
    """Whether a declared digest is the payload's; None if none is declared or its kind is unknown."""
    name, _, value = declared.partition(b":")
    kind = name.decode("ascii", "replace").lower().replace("-", "")
    if kind not in ("sha1", "sha256", "sha512", "md5") or not value:
        return None
    digest = hashlib.new(kind, payload)
    return value.lower() == digest.hexdigest().encode() or value == base64.b32encode(digest.digest())


def parsed(records: DataFrame, id_col: str, record_col: str, payload: bool) -> DataFrame:
    """id_col, head, tail, digest, verified and, if wanted, payload and its size, of each record."""
    kind = records.schema[id_col].dataType.simpleString()
    source = records.where(F.col(record_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(record_col).cast("binary").alias("raw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, bodies, tails, digests, verified = [], [], [], [], []
            for raw in batch.column(1).to_pylist():
                head, body, tail, declared = divide(raw)
                heads.append(head)
                bodies.append(body)
                tails.append(tail)
                digests.append(hashlib.sha256(body).hexdigest())
                verified.append(agrees(declared, body))
            columns = [batch.column(0), pa.array(heads, pa.binary()), pa.array(tails, pa.binary()), pa.array(digests, pa.string()), pa.array(verified, pa.bool_())]
            if payload:
                columns = [columns[3], pa.array(bodies, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["digest", "payload"] if payload else ["id", "head", "tail", "digest", "verified"])

    if payload:
        return source.mapInArrow(run, "digest string, payload binary")
    return source.mapInArrow(run, f"id {kind}, head binary, tail binary, digest string, verified boolean").withColumnRenamed("id", id_col)


def archive(records: DataFrame, path: str, id_col: str = "record_id", record_col: str = "record") -> None:
    """Write records to path: payloads (digest, payload), each once, and records (id_col, head, tail, digest, verified).

    The digest is always computed from the payload; verified tells whether a declared
    WARC-Payload-Digest agrees with it (null without one that can be checked). A record that
    doesn't parse is a payload without head. Null records are left out; an empty record has an
    empty payload; repeated records are kept, ids may repeat or be null. An empty table gives two
    empty ones. Other columns are ignored. The payload is shuffled once, after equal ones of a partition were merged.
    """
    parsed(records, id_col, record_col, payload=False).write.option("compression", "zstd").parquet(f"{path}/records")
    parsed(records, id_col, record_col, payload=True).dropDuplicates(["digest"]).write.option("compression", "zstd").parquet(f"{path}/payloads")


def restore(spark: SparkSession, path: str, id_col: str = "record_id", record_col: str = "record") -> DataFrame:
    """Every archived record: id_col, digest, verified and record_col, its exact bytes.

    A payload whose bytes don't give its digest any more is an error. Ids may be null or repeat: a row comes back for each that was archived.
    """
    records, payloads = spark.read.parquet(f"{path}/records"), spark.read.parquet(f"{path}/payloads")
    return records.join(payloads, "digest").select(id_col, "digest", "verified", F.when(F.sha2("payload", 256) == F.col("digest"), F.concat("head", "payload", "tail")).otherwise(F.raise_error(F.concat(F.lit("payload damaged: "), "digest"))).alias(record_col))


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A WARC response record for every page that has a body: id_col and record (binary). A null url is written as an empty one."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(html_col).cast("string"), F.lit("\r\n\r\n"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(">\r\nWARC-Target-URI: "), url,
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.sha2(F.col(html_col).cast("binary"), 256), F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.octet_length(html_col)).cast("string"), F.lit("\r\n\r\n"),
    )
    return pages.where(F.col(html_col).isNotNull()).select(id_col, F.concat(head, http, F.col(html_col), F.lit("\r\n\r\n")).cast("binary").alias("record"))
