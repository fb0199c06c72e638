"""WARC files: round trips, what other readers see, push-down, skipping, and damaged files."""

import gzip
import hashlib
import io
import os
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from transferlens.llm import warc

SCHEMA = "page_id bigint, url string, html string, record_id int, payload int"
PAGES = [
    (4, "http://a.org/1", "x" * 100), (2, "http://a.org/2", "x" * 100), (9, "http://a.org/3", "x" * 100), (None, "http://a.org/4", "x" * 100),
    (5, None, "x" * 99), (6, "http://a.org/\r\nWARC-Type: evil", "x" * 99), (7, "", ""), (8, "http://a.org/é", None), (10, "u", "é🦆" * 500),
    (11, "u", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" * 20), (1, "u", "é🦆" * 500), (12, "u", "long " * 400_000),
    (13, "u", "y" * 150), (13, "u", "y" * 150), (14, "u", "y" * 150), (None, "u", "z" * 150), (None, "u", "z" * 150)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, 1, 2) for p in PAGES], SCHEMA).repartition(3)


def expected():
    firsts = {}
    for key, _, html in PAGES:
        if len((html or "").encode()) >= 100 and key is not None:
            firsts[html] = min(key, firsts.get(html, key))
    out = []
    for key, _, html in PAGES:
        data, first = (html or "").encode(), firsts.get(html)
        again = first is not None and (key is None or key > first)
        out.append((key, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(map(repr, out))


def files(path):
    return sorted(f"{path}/{f}" for f in os.listdir(path) if not f.startswith("."))


@pytest.mark.parametrize("most", [warc.BROADCAST, 0])
@pytest.mark.parametrize("options", [{}, {"compression": "none", "file_bytes": "3000"}, {"file_bytes": "1"}])
def test_pages_come_back(spark, pages, tmp_path, monkeypatch, most, options):
    monkeypatch.setattr(warc, "BROADCAST", most)
    path = str(tmp_path / "archive")
    warc.archive(pages, path, **options)
    assert sorted(repr(tuple(r)) for r in warc.read_pages(spark, path).collect()) == expected()
    assert all(re.search(r"\.warc(\.gz)?$", f) for f in files(path)) and len(files(path)) > (3 if "file_bytes" in options else 0)
    again = warc.read_warc(spark, path, "record_id", partition_bytes=1)
    assert again.rdd.getNumPartitions() == len(files(path))
    kinds = warc.read_warc(spark, path).groupBy("record_type").count().collect()
    assert {r.record_type: r["count"] for r in kinds} == {"warcinfo": len(files(path)), "response": 12, "revisit": 5}


def test_empty_tables_and_folders(spark, pages, tmp_path):
    assert warc.archived(pages.limit(0)).count() == 0
    assert warc.read_warc(spark, str(tmp_path), "record_id").count() == 0


def test_records_are_plain_warc(spark, pages, tmp_path):
    """Without this library: gzip members and lengths by the book."""
    path = str(tmp_path / "archive")
    warc.archive(pages, path)
    seen = 0
    for file in files(path):
        data = io.BytesIO(gzip.open(file).read())
        while line := data.readline():
            assert line == b"WARC/1.1\r\n"
            fields = {}
            while (line := data.readline()) != b"\r\n":
                name, _, value = line.decode().rstrip("\r\n").partition(": ")
                assert name not in fields
                fields[name] = value
            block = data.read(int(fields["Content-Length"]))
            assert data.read(4) == b"\r\n\r\n" and fields["WARC-Date"].endswith("Z") and fields["WARC-Record-ID"].startswith("<urn:")
            if fields["WARC-Type"] == "warcinfo":
                continue
            seen += 1
            head, _, payload = block.partition(b"\r\n\r\n")
            told = int(re.search(rb"Content-Length: (\d+)", head)[1])
            if fields["WARC-Type"] == "response":
                assert told == len(payload) and fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(payload).hexdigest()
            else:
                assert not payload and fields["WARC-Refers-To"].startswith("<urn:page:") and "identical-payload-digest" in fields["WARC-Profile"]
    assert seen == len(PAGES)


def foreign(gz, split):
    """Records as others write them: no lengths in members, one member for several records, headers in other case and folded."""
    one = b"WARC/1.0\r\nwarc-type: response\r\nWARC-RECORD-ID: <urn:a>\r\nwarc-target-uri: http://x\r\n /y\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: 48\r\n\r\nHTTP/1.0 404 Not Found\r\nServer: s\r\nX: y\r\n\r\nhello\r\n\r\n"
    two = b"WARC/1.0\r\nWARC-Type: request\r\nWARC-Record-ID: <urn:b>\r\nContent-Type: application/http\r\nContent-Length: 18\r\n\r\nGET / HTTP/1.1\r\n\r\n\r\n\r\n"
    three = b"WARC/1.0\r\nWARC-Type: metadata\r\nWARC-Record-ID: <urn:c>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    parts = [one, two, three] if split else [one + two + three]
    return b"".join(gzip.compress(p) if gz else p for p in parts)


@pytest.mark.parametrize("gz,split", [(False, True), (True, True), (True, False)])
def test_foreign_files(spark, tmp_path, gz, split):
    file = tmp_path / f"a.warc{'.gz' if gz else ''}"
    file.write_bytes(foreign(gz, split))
    rows = {r.record_id: r for r in warc.read_warc(spark, str(file)).collect()}
    one, two, three = (rows[f"urn:{x}"] for x in "abc")
    assert (one.http_status, bytes(one.payload), one.payload_bytes, one.target_uri, one.http_content_type) == (404, b"hello", 5, "http://x /y", None)
    assert (two.record_type, bytes(two.payload), two.http_status) == ("request", b"", None)
    assert (three.content_type, bytes(three.payload), three.payload_bytes) == (None, b"abc", 3)
    for kind, n in (("request", 1), ("none", 0)):
        assert warc.read_warc(spark, str(file), "record_type").filter(F.col("record_type") == kind).count() == n


def pushed(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return "Filter" not in plan


def test_predicates_are_pushed_and_agree_with_spark(spark, pages, tmp_path):
    path = str(tmp_path / "archive")
    warc.archive(pages, path)
    columns = ["record_id", "record_type", "target_uri", "refers_to", "payload_bytes", "http_status", "content_length"]
    whole = warc.read_warc(spark, path, *columns).collect()
    held = spark.createDataFrame(whole, warc.read_warc(spark, path, *columns).schema)
    conditions = [
        "record_type = 'revisit'", "record_type IN ('revisit', 'warcinfo')", "refers_to IS NULL", "refers_to IS NOT NULL", "payload_bytes > 100", "payload_bytes <= 100",
        "target_uri LIKE 'http://a%'", "target_uri LIKE '%/1'", "target_uri LIKE '%org%'", "refers_to <> 'urn:page:2'", "refers_to <=> NULL", "http_status = 200 AND content_length >= 250",
        "NOT (record_type = 'response')", "record_type <> 'response' AND payload_bytes < 1000", "record_type = 'revisit' OR payload_bytes = 0", "length(record_id) = 10", "refers_to IN ('urn:page:2', NULL)"]
    for condition in conditions:
        found = warc.read_warc(spark, path, *columns).filter(condition)
        assert sorted(map(repr, found.collect())) == sorted(map(repr, held.filter(condition).collect())), condition
    assert pushed(warc.read_warc(spark, path, *columns).filter("record_type = 'revisit'"))
    assert not pushed(warc.read_warc(spark, path, *columns).filter("length(record_id) = 10"))


def test_unwanted_payloads_are_not_decoded(spark, tmp_path):
    """With compressed payloads overwritten by noise, everything that does not need them still works."""
    pages = spark.createDataFrame([(1, "u", os.urandom(60_000).hex()), (2, "v", "short" * 30)], "page_id bigint, url string, html string").coalesce(1)
    path = str(tmp_path / "archive")
    warc.archive(pages, path)
    (file,) = files(path)
    data = bytearray(open(file, "rb").read())
    data[20_000:40_000] = bytes(20_000)
    open(file, "wb").write(data)
    os.unlink(f"{path}/.{os.path.basename(file)}.crc") if os.path.exists(f"{path}/.{os.path.basename(file)}.crc") else None
    heads = warc.read_warc(spark, path, "record_id", "record_type", "payload_bytes", "http_status")
    assert {r.record_id: r.payload_bytes for r in heads.filter("record_type = 'response'").collect()} == {"urn:page:1": 120_000, "urn:page:2": 150}
    short = warc.read_warc(spark, path, "record_id", "payload", "target_uri").filter("target_uri = 'v'")
    assert [len(r.payload) for r in short.collect()] == [150]
    with pytest.raises(PySparkException):
        warc.read_pages(spark, path).collect()


def test_damaged_files_raise(spark, tmp_path):
    for name, data, said in (("cut.warc", foreign(False, True)[:-10], "cut off"), ("cut.warc.gz", foreign(True, True)[:-30], "cut off"), ("odd.warc", b"hello\r\n\r\nworld", "no WARC record"),
                             ("odd.warc.gz", foreign(True, True) + b"rubbish", "gzip member"), ("none.warc", b"WARC/1.0\r\nWARC-Type: x\r\n\r\n", "content-length")):
        (tmp_path / name).write_bytes(data)
        with pytest.raises(PySparkException, match=said):
            warc.read_warc(spark, str(tmp_path / name), "record_id").collect()
    with pytest.raises(PySparkException, match="no such columns"):
        spark.read.format("warc").schema("nothing string").load(str(tmp_path)).collect()


def test_failed_writes_leave_nothing(spark, pages, tmp_path):
    path = str(tmp_path / "archive")
    warc.archive(pages, path)
    before = files(path)
    bad = pages.withColumn("html", F.when(F.col("page_id") == 11, F.raise_error(F.lit("lost"))).otherwise(F.col("html")))
    with pytest.raises(PySparkException):
        warc.archive(bad, path)
    assert files(path) == before
    rows = spark.createDataFrame([("urn:x", "resource", bytearray(b"\x00\xff"))], "record_id string, record_type string, payload binary")
    rows.write.format("warc").mode("overwrite").option("compression", "none").save(path)
    assert len(files(path)) == 1 and [bytes(r.payload) for r in warc.read_warc(spark, path, "record_type", "payload").filter("record_type = 'resource'").collect()] == [b"\x00\xff"]
