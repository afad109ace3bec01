import base64
import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm import store, warc


def record(payload, kind=b"application/http; msgtype=response", digest=None, http=b"HTTP/1.1 200 OK\r\nX: 1\r\n\r\n", version=b"WARC/1.0"):
    body = http + payload
    lines = [version, b"WARC-Type: response", b"Content-Type: " + kind]
    if digest:
        lines.append(b"WARC-Payload-Digest: " + digest)
    return b"\r\n".join([*lines, b"Content-Length: %d" % len(body), b"", b""]) + body + b"\r\n\r\n"


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.binary(max_size=60), st.lists(st.sampled_from([b"WARC/1.0", b"\r\n", b"\r\n\r\n", b"Content-Length: 5", b"content-type: application/http", b"x", b"HTTP/1.1 200"]), max_size=14).map(b"".join)))
def test_parts_are_the_whole(raw):
    head, body, tail, _ = warc.divide(raw)
    assert head + body + tail == raw


def test_digests():
    p = b"payload"
    assert warc.agrees(b"sha256:" + hashlib.sha256(p).hexdigest().encode(), p)
    assert warc.agrees(b"sha1:" + base64.b32encode(hashlib.sha1(p).digest()), p)
    assert warc.agrees(b"sha1:AAAA", p) is False
    assert warc.agrees(b"crc:1", p) is None and warc.agrees(b"", p) is None


def test_archive_and_restore(spark):
    same = b"<html>same</html>" * 1000
    rows = [
        (1, record(same), "x"), (2, record(same, http=b"HTTP/1.1 200 OK\r\nY: 2\r\n\r\n"), "x"), (2, record(same), "x"), (3, b"", "x"), (4, None, "x"), (None, record(b"other", digest=b"sha1:" + base64.b32encode(hashlib.sha1(b"other").digest())), "x"),
        (5, b"not a record \xff\x00", "x"), (6, record(b"\xff" * 2_000_000, digest=b"sha256:00"), "x"), (7, record(b"plain", kind=b"text/plain", http=b""), "x"),
    ]
    df = spark.createDataFrame(rows, "record_id BIGINT, record BINARY, payload STRING")
    warc.archive(df, path := store.new_path(spark, "w"))
    got = warc.restore(spark, path).collect()
    assert sorted(((r["record_id"], bytes(r["record"])) for r in got), key=str) == sorted(((i, x) for i, x, _ in rows if x is not None), key=str)
    assert all(r["digest"] == hashlib.sha256(warc.divide(bytes(r["record"]))[1]).hexdigest() for r in got)
    verified = {r["record_id"]: r["verified"] for r in got}
    assert verified[None] is True and verified[6] is False and verified[1] is None and verified[5] is None
    payloads = [bytes(r["payload"]) for r in spark.read.parquet(f"{path}/payloads").collect()]
    assert payloads.count(same) == 1 and len(payloads) == len(set(payloads)) == 6
    assert not any(same in bytes(r["head"]) + bytes(r["tail"]) for r in spark.read.parquet(f"{path}/records").collect())
    warc.archive(df.limit(0), path := store.new_path(spark, "w"))
    assert warc.restore(spark, path).count() == 0
