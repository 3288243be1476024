"""WARC archives: round trips against plain Python, archives of others, pushed predicates, damage."""

import base64
import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from stratalake.llm import common, warc

PAGES = [
    (5, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (9, None, "<p>same</p>"), (2, "http://a/0", "<p>same</p>"),
    (7, "http://b\r\nX-Bad: 1", ""), (8, "", None), (1, "http://c", "WARC/1.1\r\n\r\n" * 3), (3, "http://d", "é日本😀" * 50_000),
    (None, "http://e", "lost"), (None, None, "lost"), (4, "http://f", "twice"), (4, "http://f", "twice"), (4, "http://f", "twice"),
    (6, "http://g", "twice"), (10, "http://h", "\r\n\r\nHTTP/1.1 200 OK"), (-3, "http://i", "x"),
]


def frame(spark, rows):
    rows = [(*r, "a", "b", "c", "d") for r in rows]
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string, digest string, first string, many string").repartition(3)


def plain(rows, least=0):
    order = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    first, out = {}, []
    for i, url, html in sorted(rows, key=order):
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        again = len(raw) >= least and raw in first
        out.append((i, len(raw), digest, "revisit" if again else "response", first[raw] if again else None))
        first.setdefault(raw, i)
    return sorted(out, key=str)


@pytest.mark.parametrize("least,heavy", [(0, 1000), (6, 3), (10_000_000, 1000)])
def test_pages_round_trip(spark, monkeypatch, least, heavy):
    monkeypatch.setattr(common, "HEAVY", heavy)
    got = warc.archived(frame(spark, PAGES), least=least).collect()
    assert sorted(map(tuple, got), key=str) == plain(PAGES, least)


def test_empty_table(spark):
    assert warc.archived(frame(spark, [])).collect() == []


def test_records_as_written(spark, tmp_dir):
    path = f"{tmp_dir}/a"
    warc.write_warc(warc.with_revisits(frame(spark, PAGES), "page_id", "url", "html"), path, file_bytes=300, level=1)
    with open(f"{path}/{'0' * 32}.warc.gz", "wb") as f:
        f.write(b"left by a lost attempt")  # in no manifest
    rows = warc.read_warc(spark, path).collect()
    assert len(rows) == len(PAGES) and len({r["file"] for r in rows}) > 3
    whole = {r["record_id"]: r for r in rows if r["record_type"] == "response"}
    assert len(whole) == len({(h or "") for _, _, h in PAGES}) and len({r["record_id"] for r in rows}) == len(rows)
    texts = {(h or "").encode() for _, _, h in PAGES}
    assert {bytes(r["payload"]) for r in whole.values()} == texts
    for r in rows:
        if r["record_type"] == "revisit":
            assert r["payload"] is None and whole[r["refers_to"]]["payload_digest"] == r["payload_digest"]
            assert r["fields"]["warc-profile"] == warc.IDENTICAL
        else:
            assert r["payload_digest"] == "sha1:" + r["payload_sha1"] and len(r["payload"]) == r["payload_bytes"]
    uris = {r["fields"]["x-page-id"]: r["target_uri"] for r in rows if "x-page-id" in r["fields"]}
    assert uris["7"] == "http://b%0D%0AX-Bad: 1" and uris["9"] is None and uris["8"] == ""
    # files are packed into partitions, in as many tasks as their bytes ask for
    assert warc.read_warc(spark, path, ["offset"]).rdd.getNumPartitions() == 1
    assert warc.read_warc(spark, path, ["offset"], partition_bytes=1).rdd.getNumPartitions() > 3
    # more is added, nothing replaced
    warc.write_warc(warc.with_revisits(frame(spark, PAGES[:1]), "page_id", "url", "html"), path)
    assert warc.read_warc(spark, path, ["offset"]).count() == len(PAGES) + 1
    with pytest.raises(Exception, match="append"):
        spark.createDataFrame([("a",)], "record_id string").write.format("warc").mode("overwrite").save(path)


def others(kind: str, n: int = 30) -> bytes:
    """Records as other tools write them: folded and repeated fields, other types, no lengths in gzip headers."""
    out = b""
    for i in range(n):
        http = b"HTTP/1.1 200 OK\r\nServer: x\r\nset-cookie: a\r\nSet-Cookie: b\r\n\r\n"
        block = (http if i % 3 else b"") + b"body %d " % i * (i * 400)
        head = f"WARC/1.0\r\nWARC-Type: {['warcinfo', 'response', 'request'][i % 3]}\r\nWARC-Record-ID: <{i}>\r\nX-Long: one\r\n  two\r\n"
        head += f"content-type: {'application/http; msgtype=response' if i % 3 else 'application/warc-fields'}\r\nContent-Length: {len(block)}\r\n"
        raw = head.encode() + b"\r\n" + block + b"\r\n\r\n"
        out += gzip.compress(raw) if kind == ".gz" else warc.compress_record(raw) if kind == "sl.gz" else raw
    return out


@pytest.mark.parametrize("kind", [".gz", "sl.gz", ""])
def test_archives_of_others(spark, tmp_dir, kind):
    with open(f"{tmp_dir}/x.warc{kind[-3:]}", "wb") as f:
        f.write(others(kind))
    rows = warc.read_warc(spark, tmp_dir).orderBy(F.expr("int(substring(record_id, 2, length(record_id) - 2))")).collect()
    assert [r["record_id"] for r in rows] == [f"<{i}>" for i in range(30)]
    assert all(bytes(r["payload"]) == b"body %d " % i * (i * 400) and r["fields"]["x-long"] == "one two" for i, r in enumerate(rows))
    assert rows[1]["http_fields"] == {"server": "x", "set-cookie": "a, b"} and rows[0]["http_fields"] == {}
    some = warc.read_warc(spark, tmp_dir, ["record_id", "payload_bytes"], ["warcinfo"], {"X-Long": ["one two"], "Content-Type": None})
    assert sorted(r["payload_bytes"] for r in some.collect()) == [len(b"body %d " % i * (i * 400)) for i in range(0, 30, 3)]
    assert warc.read_warc(spark, tmp_dir, ["record_id"], fields={"x-none": None}).collect() == []


def test_filters_are_pushed_and_unwanted_payloads_not_decoded(spark, tmp_dir):
    """The middles of all requests are overwritten: only reading them fails."""
    raw = bytearray()
    for i in range(40):
        payload = os.urandom(200_000) if i % 2 else b"good %d" % i
        r = warc.encode_record({"record_type": "request" if i % 2 else "response", "record_id": f"<{i}>", "date": "d", "payload": payload})
        member = bytearray(warc.compress_record(r))
        if i % 2:
            member[100_000:100_500] = bytes(500)
        raw += member
    with open(f"{tmp_dir}/x.warc.gz", "wb") as f:
        f.write(raw)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = warc.read_warc(spark, tmp_dir)
        for where in (F.col("record_type") == "response", F.col("record_type").isin("response", "metadata"), F.col("record_id").isin("<0>", "<2>")):
            got = df.where(where & F.col("payload_bytes").isNotNull()).collect()
            assert got and all(r["payload"].startswith(b"good") for r in got)
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    assert warc.read_warc(spark, tmp_dir, ["payload"], ["response"]).count() == 20
    assert warc.read_warc(spark, tmp_dir, ["record_id"]).count() == 40  # headers alone
    with pytest.raises(Exception, match="damaged|shorter|cut off"):
        warc.read_warc(spark, tmp_dir, ["payload"]).collect()


@pytest.mark.parametrize("kind", [".gz", "sl.gz", ""])
def test_a_cut_or_foreign_file_fails(spark, tmp_dir, kind):
    whole = others(kind, 8)
    with open(f"{tmp_dir}/x.warc{kind[-3:]}", "wb") as f:
        f.write(whole[: len(whole) - 40])
    for columns in (["payload"], ["record_id"]):
        with pytest.raises(Exception, match="cut off|shorter"):
            warc.read_warc(spark, tmp_dir, columns).collect()
    with open(f"{tmp_dir}/x.warc{kind[-3:]}", "wb") as f:
        f.write(b"<html>" * 10)
    with pytest.raises(Exception, match="no record"):
        warc.read_warc(spark, tmp_dir).collect()


def test_base32(spark):
    raw = [bytes([i]) * 3 for i in range(20)]
    df = spark.createDataFrame([(r,) for r in raw], "x binary").select(warc.base32(F.unhex(F.sha1("x"))).alias("b"))
    assert [r["b"] for r in df.collect()] == [base64.b32encode(hashlib.sha1(r).digest()).decode() for r in raw]
