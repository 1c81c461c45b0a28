"""Archives, tables, writers, plug-ins and streams."""

import gzip
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wrackline.operators import documents
from wrackline.registry import Registry
from wrackline.sinks import writers
from wrackline.sources import tables, warc
from wrackline.streaming import streams


def archive(packed=False):
    page = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nServer: s\r\n\r\n<html><title>T</title><body><p>Extremely simple webpage</p><a href='/x'>x</a></body></html>"
    return b"".join(
        [
            warc.write_record("warcinfo", None, "2019-08-15T01:02:03Z", b"software: x", packed=packed),
            warc.write_record("response", "<http://example.org/>", "2019-08-15T01:02", page, packed=packed),
            warc.write_record("request", "http://example.org/", "2019-08-15T01:02:03Z", b"GET / HTTP/1.1\r\n\r\n", packed=packed),
        ]
    )


def test_read_archives(spark, tmp_path):
    warc.register(spark)
    (tmp_path / "a.warc").write_bytes(archive())
    (tmp_path / "b.warc.gz").write_bytes(archive(True))
    (tmp_path / "empty.warc").write_bytes(b"")
    (tmp_path / "cut.warc").write_bytes(archive()[:400])
    (tmp_path / "c.arc").write_bytes(b"http://e.org/ 1.2.3.4 20080430204825 text/plain 19\nHTTP/1.0 200 OK\n\nhi\n")
    df = spark.read.format("warc").load(str(tmp_path))
    counts = {(r["source_file"], r["record_type"]): r["n"] for r in df.groupBy("source_file", "record_type").agg(F.count("*").alias("n")).collect()}
    for name in ("a.warc", "b.warc.gz"):
        assert [counts[(name, t)] for t in ("warcinfo", "response", "request")] == [1, 1, 1]
    assert counts[("c.arc", "arc")] == 1 and counts[("cut.warc", None)] == 1
    rows = {r["source_file"]: r for r in df.where("record_type = 'response'").collect()}
    assert bytes(rows["a.warc"]["payload"]) == bytes(rows["b.warc.gz"]["payload"]) and rows["a.warc"]["http_status"] == "HTTP/1.1 200 OK"
    light = spark.read.format("warc").option("includePayload", "false").option("recordTypes", "response").load(str(tmp_path / "a.warc"))
    got = light.collect()
    assert len(got) == 1 and got[0]["payload"] is None and got[0]["http_headers"][0]["name"] == "Content-Type"
    offsets = [r["source_file_offset"] for r in df.where("source_file = 'a.warc'").orderBy("source_file_offset").collect()]
    cut = spark.read.format("warc").option("splitBytes", "200").load(str(tmp_path / "a.warc"))
    assert sorted(r["source_file_offset"] for r in cut.collect()) == offsets


def test_documents_from_archive(spark, tmp_path):
    warc.register(spark)
    (tmp_path / "a.warc").write_bytes(archive())
    docs = documents.build_documents(spark.read.format("warc").load(str(tmp_path)), documents.Config(record_types=("response",), statuses=("2",)))
    (doc,) = docs.select("url", "id", "crawl_date", "wayback_date", "title", "content", "links", "content_type_norm", "host_surt", "hash").collect()
    assert doc["url"] == "http://example.org/" and doc["id"].startswith("201908150102/")
    assert doc["crawl_date"] == datetime(2019, 8, 15, 1, 2) and doc["wayback_date"] == 20190815010200
    assert doc["title"] == "T" and "Extremely simple webpage" in doc["content"] and doc["links"] == ["http://example.org/x"]
    assert doc["content_type_norm"] == "html" and doc["host_surt"] == ["(org,", "(org,example,"] and doc["hash"].startswith("sha1:")


def test_nested_archives(spark):
    outer = spark.createDataFrame([(1, bytearray(archive())), (2, None)], "id int, payload binary")
    assert warc.nested_archives(outer, "id", "payload").count() == 3


def test_tables(spark, tmp_path):
    (tmp_path / "s.txt").write_text("(uk,co,bbc,\n# no\nhttp://www.a.org/\n\n")
    assert sorted(r[0] for r in tables.surt_prefixes(spark, str(tmp_path / "s.txt")).collect()) == ["(org,a,", "(uk,co,bbc,"]
    (tmp_path / "m.json").write_text('{"digest": "d", "n": 1}\nnot json\n')
    assert tables.record_maps(spark, str(tmp_path / "m.json")).where("mdx_map['n'] = '1'").count() == 1
    (tmp_path / "x.cdx").write_text(" CDX N b a m s k r M S V g\na.org/ 20080430204825 http://a.org/ text/plain 200 SUCG - - 523 776 f\nbad line\n")
    assert tables.cdx(spark, str(tmp_path / "x.cdx")).first()["source_file_offset"] == 776
    (tmp_path / "a.json").write_text(json.dumps({"collections": {"root": {"http://a": {"collection": "C", "collections": ["C"], "subject": []}}}, "collectionDateRanges": {"C": {"start": 0, "end": None}}}))
    rules, ranges = tables.annotations(spark, str(tmp_path / "a.json"))
    assert rules.first()["collection"] == "C" and ranges.first()["range_end"] is None
    assert json.loads(tables.annotations_json(rules, ranges))["collections"]["root"]["http://a"]["collection"] == "C"
    assert tables.config({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}
    (tmp_path / "l.csv").write_text("AB1,1.5,2.5\n")
    assert tuple(tables.lookup_csv(spark, str(tmp_path / "l.csv")).first()) == ("AB1", "1.5,2.5")


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("1", "f", "a<b", ["x"])], "id string, source_file string, title string, links array<string>")
    for form in ("jsonl", "parquet", "xml"):
        writers.write_documents(df, str(tmp_path / form), form, per_source=form == "jsonl")
    assert spark.read.json(str(tmp_path / "jsonl")).first()["archive"] == "f"
    body = writers.bulk_body(['{"id": "1", "n": 2}'], "i", "now").decode().splitlines()
    assert json.loads(body[0])["index"]["_id"] == "1" and json.loads(body[1])["n"] == [2] and json.loads(body[1])["index_time"] == ["now"]
    assert b'<field name="t">a&lt;b</field>' in writers.update_body(['{"t": "a<b"}'])
    assert [len(b) for b in writers.batches(["x" * 10] * 5, 2, 1000)] == [2, 2, 1] and [len(b) for b in writers.batches(["x" * 10] * 3, 9, 15)] == [1, 1, 1]
    assert writers.send_documents(df, lambda data: 200) == {"sent": 1, "dropped": 0, "retries": 0}
    assert writers.send_documents(df, lambda data: 500, retries=1, pause=0.0) == {"sent": 0, "dropped": 1, "retries": 2}
    assert writers.send_lines(df.select(F.col("title").alias("value")), lambda data: 204) == {"sent": 1}
    writers.write_text(df, str(tmp_path / "t"), "title", compressed=True)
    assert b"".join(gzip.open(p).read() for p in (tmp_path / "t").glob("*.gz")) == b"a<b\n"


def test_plugins(spark):
    r = Registry()

    @r.payload_analyser("size", "^text")
    def size(data, url):
        return {"size": len(data)}

    @r.payload_analyser("bad")
    def bad(data, url):
        raise ValueError("no")

    @r.text_analyser("shout")
    def shout(text):
        return {"up": text.upper()}

    df = spark.createDataFrame([(bytearray(b"abc"), "text/html", "u", " hi "), (bytearray(b"x"), "image/png", "u", None)], "d binary, m string, u string, t string")
    got = df.select(r.analyse_payload(F.col("d"), F.col("m"), F.col("u")).alias("p"), r.analyse_text(F.col("t")).alias("t")).collect()
    assert got[0]["p"]["fields"] == {"size": "3"} and got[0]["p"]["errors"] == ["ValueError bad: no"] and got[0]["t"]["fields"] == {"up": "HI"}
    assert got[1]["p"]["fields"] == {} and got[1]["t"]["fields"] == {}


def test_streams(spark, tmp_path):
    rows = [(1, datetime(2024, 1, 1, 0, 5), "a"), (1, datetime(2024, 1, 1, 0, 6), "a"), (2, datetime(2024, 1, 1, 1, 5), "b")]
    df = spark.createDataFrame(rows, "id int, ts timestamp, k string")
    df.write.parquet(str(tmp_path / "in"))
    stream = lambda: streams.landing(spark, str(tmp_path / "in"), df.schema)
    windows = streams.run_to_memory(streams.captures_per_window(stream(), "ts", ["k"], "1 hour"), "w", "complete")
    assert sorted((r["k"], r["n"]) for r in windows.collect()) == [("a", 2), ("b", 1)]
    assert streams.run_to_memory(streams.without_duplicates(stream(), ["id"], "ts"), "dd").count() == 2
    at = datetime(2024, 1, 1)
    events = spark.createDataFrame([("d", "u1", "revisit", at), ("d", "u0", "response", at), ("e", "u2", "revisit", at), ("f", "u3", "response", datetime(2024, 3, 1))], "digest string, url string, record_type string, ts timestamp")
    events.write.parquet(str(tmp_path / "ev"))
    out = streams.run_to_memory(streams.first_response_state(streams.landing(spark, str(tmp_path / "ev"), events.schema), "ts", salts=2), "rv")
    # u2 waits for a response until the watermark has passed it
    got = sorted((r["url"], r["record_type"], r["response_url"]) for r in out.collect())
    assert got == [("u0", "response", None), ("u1", "reduplicated", "u0"), ("u2", "revisit", None), ("u3", "response", None)]


def _record(url, body, kind="response", name=lambda n: n):
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + body
    head = {"WARC-Type": kind, "WARC-Date": "2020-01-01T00:00:00Z", "WARC-Record-ID": "<urn:x>", "WARC-Target-URI": url, "Content-Length": str(len(block))}
    return b"WARC/1.0\r\n" + b"".join(f"{name(k)}: {v}\r\n".encode() for k, v in head.items()) + b"\r\n" + block + b"\r\n\r\n"


def test_archive_split_points_and_header_case(spark, tmp_path):
    """Records inside payloads are no split points; header names may have any case; payloads are cut without loss of later records."""
    inner = _record("http://inner.test/", b"x")
    raw = b"".join(_record(f"http://h.test/{i}", (b"\r\n\r\n" + inner) * 40, name=str.lower if i % 2 else str) for i in range(3))
    (tmp_path / "a.warc").write_bytes(raw)
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(_record(f"http://g.test/{i}", b"z" * 100_000)) for i in range(3)))
    warc.register(spark)
    df = spark.read.format("warc").option("splitBytes", "3000").load(str(tmp_path))
    got = sorted((r["record_type"], r["warc_headers"]["WARC-Target-URI"], r["error"]) for r in df.collect())
    want = sorted(("response", f"http://{h}.test/{i}", None) for h in "gh" for i in range(3))
    assert got == want and df.rdd.getNumPartitions() == 4
    cut = spark.read.format("warc").option("maxPayloadBytes", "10").load(str(tmp_path))
    assert sorted((r["warc_headers"]["WARC-Target-URI"], len(r["payload"])) for r in cut.collect()) == sorted((u, 10) for _, u, _ in want)
    none = spark.read.format("warc").option("includePayload", "false").load(str(tmp_path))
    assert sorted(r["warc_headers"]["WARC-Target-URI"] for r in none.collect()) == sorted(u for _, u, _ in want)
    lengths = {r["source_file_offset"]: r["record_length"] for r in none.where("source_file = 'b.warc.gz'").collect()}
    assert sum(lengths.values()) == (tmp_path / "b.warc.gz").stat().st_size
    other = warc.load_archives(spark, str(tmp_path))
    assert sorted((r["record_type"], r["warc_headers"]["WARC-Target-URI"], r["error"]) for r in other.collect()) == want
    assert sorted(map(str, other.select("http_headers", "record_length", "payload").collect())) == sorted(map(str, df.select("http_headers", "record_length", "payload").collect()))


def test_archive_stream_takes_late_files(spark, tmp_path):
    """A file that arrives later is read, whatever its name; a file is read once."""
    warc.register(spark)
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "m.warc").write_bytes(_record("http://m.test/", b"m"))
    out = str(tmp_path / "run")
    urls_of = lambda: sorted(r[0] for r in streams.run_to_folder(streams.landing_archives(spark, str(folder)).selectExpr("warc_headers['WARC-Target-URI'] AS url"), out).collect())
    assert urls_of() == ["http://m.test/"]
    (folder / "a.warc").write_bytes(_record("http://a.test/", b"a"))
    assert urls_of() == ["http://a.test/", "http://m.test/"]


def test_decoding_keeps_what_it_can():
    from wrackline.functions import payload

    two = gzip.compress(b"one") + gzip.compress(b"two")
    assert payload.decompress(two, "gzip") == (b"onetwo", None)
    got, error = payload.decompress(two[:-6], "gzip")
    assert got.startswith(b"onetwo"[:3]) and error
    assert payload.dechunk(b"3\r\nabc\r\nzz\r\nrest") == b"abczz\r\nrest"
    assert payload.dechunk(b"3\r\nabc\r\n0\r\n\r\n") == b"abc"
