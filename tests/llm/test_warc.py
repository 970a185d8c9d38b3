"""Archives written, read back and read from elsewhere."""

import base64
import gzip
import hashlib
import os

import pytest
from pyspark.sql import datasource as ds, functions as F

from landfall.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, first long"
PAGES = [
    (1, "http://a.example/1", "<p>one</p>", "x", 1), (2, "http://a.example/2", "<p>one</p>", "x", 1), (3, None, None, "x", 1), (4, "http://a.example/ä b\r\nX: y", "", "x", 1),
    (5, "http://a.example/5", "é" * 300_000, "x", 1), (6, "http://a.example/6", "é" * 300_000, "x", 1), (7, "u", "tie", "x", 1), (7, "v", "tie", "x", 1), (8, "w", "tie", "x", 1),
    (None, "n", "<p>one</p>", "x", 1), (None, "n", "alone", "x", 1), (None, "n", "alone", "x", 1), (9, "u", "body with\r\n\r\nblank lines and WARC/1.1", "x", 1),
]


def plain(rows, least=0):
    out = []
    for page, _, html, *_ in rows:
        raw = (html or "").encode()
        same = [p for p, _, h, *_ in rows if (h or "") == (html or "") and p is not None]
        first = min(same) if same and len(raw) >= least else None
        again = first is not None and page != first
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", first if again else None))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


@pytest.mark.parametrize("least", [0, 5])
def test_pages(spark, tmp_path, least):
    path = str(tmp_path / "w")
    warc.write_pages(spark.createDataFrame(PAGES, SCHEMA).repartition(4), path, least, file_bytes=500)
    found = warc.read_pages(spark, path)
    assert order(map(tuple, found.select(*COLUMNS).collect())) == order(plain(PAGES, least))
    texts = {(r.page_id, bytes(r.payload)) for r in found.filter("record_type = 'response'").collect()}
    assert texts >= {(p, (h or "").encode()) for p, _, h, *_ in PAGES if p in (1, 3, 5, 9)}
    assert not found.filter("record_type = 'revisit' and payload is not null").count()
    urls = {r.page_id: r.url for r in found.collect()}
    assert urls[4] == "http://a.example/ä%20b%0D%0AX:%20y" and urls[3] is None


def test_no_pages(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_pages(spark.createDataFrame([], SCHEMA), path)
    assert warc.read_pages(spark, path).collect() == []


def test_only_listed_files_are_read(spark, tmp_path):
    """A task that was broken off leaves a file that no list names; a second write adds, an overwrite replaces."""
    path = str(tmp_path / "w")
    pages = spark.createDataFrame(PAGES[:2], SCHEMA)
    warc.write_pages(pages, path)
    (tmp_path / "w" / "stray.warc.gz").write_bytes(b"\x1f\x8b\x08 broken")
    assert warc.read_warc(spark, path).count() == 2
    warc.write_pages(pages, path)
    assert warc.read_warc(spark, path).count() == 4
    warc.page_records(pages).write.format("warc").mode("overwrite").save(path)
    assert warc.read_warc(spark, path).count() == 2


def record(kind, block, *fields, content="application/http;msgtype=response"):
    head = [f"WARC-Type: {kind}", *fields, f"Content-Type: {content}", f"Content-Length: {len(block)}"]
    return b"WARC/1.0\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


BODY = b"HTTP/1.1 200 OK\r\nX-One: 1\r\n\r\n" + os.urandom(9000)
RECORDS = [
    record("warcinfo", b"software: none\r\n", content="application/warc-fields"),
    record("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", "WARC-Target-URI: http://a/", content="application/http;msgtype=request"),
    record("response", BODY, "warc-target-uri: http://a/", "X-Long: first", "  second"),
    record("response", BODY, "WARC-Target-URI: http://b/"),
    record("metadata", b"", "WARC-Target-URI: http://b/", content="text/plain"),
]


@pytest.mark.parametrize("name, data", [
    ("plain.warc", b"".join(RECORDS)),
    ("members.warc.gz", b"".join(map(gzip.compress, RECORDS))),
    ("lengths.warc.gz", b"".join(map(warc.gzip_member, RECORDS))),
])
def test_archives_from_elsewhere(spark, tmp_path, name, data):
    (tmp_path / name).write_bytes(data)
    (tmp_path / "notes.txt").write_text("no archive")
    found = warc.read_warc(spark, str(tmp_path)).orderBy("at").collect()
    assert [r.record_type for r in found] == ["warcinfo", "request", "response", "response", "metadata"]
    assert [bytes(r.payload) for r in found] == [b"software: none\r\n", b"", BODY.split(b"\r\n\r\n", 1)[1], BODY.split(b"\r\n\r\n", 1)[1], b""]
    assert found[2].headers["x-long"] == "first second" and found[2].http_headers == {"x-one": "1"}
    one = warc.read_warc(spark, str(tmp_path / name)).filter("record_type = 'response' and target_uri like 'http://b%'")
    assert [r.at for r in one.collect()] == [found[3].at]
    assert gzip.decompress(data) == b"".join(RECORDS) if name.endswith("gz") else True
    (tmp_path / name).write_bytes(data[:-60] if name == "plain.warc" else data[:-400])
    with pytest.raises(Exception, match="the file ends within a record|no end of headers"):
        warc.read_warc(spark, str(tmp_path)).collect()


def test_unwanted_blocks_are_not_read(tmp_path):
    """Of a long record that does not qualify, little more than its headers is read."""

    class Counting:
        def __init__(self, file):
            self.file, self.n = file, 0

        def read(self, n):
            self.n += n
            return self.file.read(n)

        def seek(self, at):
            self.file.seek(at)

    raw = record("response", b"HTTP/1.1 200 OK\r\n\r\n" + os.urandom(1 << 20), "WARC-Target-URI: http://a/")
    for made, source in [(raw, warc._Plain), (warc.gzip_member(raw), warc._Member)]:
        (tmp_path / "f").write_bytes(made)
        with open(tmp_path / "f", "rb") as file:
            counting = Counting(file)
            assert warc._record(source(counting, 0), [warc.Predicate("record_type", "EqualTo", "revisit")], True)[0] is None
            assert warc._record(source(counting, 0), [], False)[0]["payload"] is None
            assert counting.n < 10_000


def test_pushed_filters(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(b"".join(RECORDS))
    df = warc.read_warc(spark, str(tmp_path))
    conditions = {
        "record_type in ('request', 'metadata')": 2, "target_uri is null": 1, "not record_type = 'response'": 3, "payload_bytes > 100": 2,
        "target_uri = 'http://a/'": 2, "not target_uri = 'http://a/'": 2, "record_type like 're%'": 3, "length(payload) > 100": 2, "target_uri <=> null": 1,
        "not target_uri in ('http://a/')": 2, "record_type like '%info'": 1, "record_type like '%qu%'": 1,
    }
    for condition, n in conditions.items():
        assert df.filter(condition).count() == n, condition
    plan = df.filter("record_type = 'response' and length(payload) > 1")._jdf.queryExecution().executedPlan().toString()
    above = plan.split("BatchScan")[0]
    assert "length(payload" in above and "= response" not in above


def test_predicates():
    row = dict.fromkeys(warc._NAMES) | {"record_type": "response", "payload_bytes": 5}
    at = lambda c: (c,)
    assert warc.predicate(ds.In(at("record_type"), ("revisit", None))).of(row) is None
    assert warc.predicate(ds.Not(ds.IsNull(at("record_type")))).of(row)
    assert warc.predicate(ds.EqualTo(at("target_uri"), "x")).of(row) is None
    assert warc.predicate(ds.LessThanOrEqual(at("payload_bytes"), 5)).of(row)
    assert warc.predicate(ds.EqualTo(("headers", "x"), "y")) is None and warc.predicate(ds.EqualTo(at("payload"), b"")) is None


def test_digest_expression(spark):
    rows = [(b"",), (b"abc",), (os.urandom(100),), (None,)]
    got = spark.createDataFrame(rows, "b binary").select("b", warc.base32_sha1(F.col("b")).alias("d")).collect()
    for r in got:
        assert r.d == (None if r.b is None else base64.b32encode(hashlib.sha1(r.b).digest()).decode())


def test_partitions_are_planned_by_size(tmp_path):
    for i in range(6):
        (tmp_path / f"{i}.warc").write_bytes(RECORDS[0] * 10)
    size = len(RECORDS[0]) * 10
    reader = warc.WarcReader({"path": str(tmp_path), "partition_bytes": str(2 * size)})
    assert [len(p.stretches) for p in reader.partitions()] == [2, 2, 2]


def test_written_files_are_cut_for_reading(spark, tmp_path):
    path = str(tmp_path / "w")
    pages = spark.createDataFrame([(i, "u", os.urandom(500).hex(), "x", 1) for i in range(60)], SCHEMA).coalesce(1)
    warc.page_records(pages).coalesce(1).write.format("warc").mode("append").option("mark_bytes", "4000").save(path)
    assert len(warc.archives(*warc.file_system(path))) == 1
    found = warc.read_warc(spark, path, partition_bytes=5000)
    assert found.rdd.getNumPartitions() > 5
    assert sorted(int(r.headers["page-id"]) for r in found.collect()) == list(range(60))
