"""Scalar functions against literal values."""

import datetime

import pytest
from pyspark.sql import functions as F

from wrackline.functions import content_types, dates, html, payload, text, urls


def one(spark, column, **values):
    rows = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return rows.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("given", "ambiguous", "plain"),
    [
        ("http://example.com", "http://example.com/", "http://example.com/"),
        ("https://www.example.com", "http://www.example.com/", "http://example.com/"),
        ("/foo/", "/foo", "/foo"),
        ("/%2A", "/%2a", "/*"),
        ("/æblegrød og øl", "/æblegrød%20og%20øl", "/æblegrød%20og%20øl"),
        ("Red, Rosé 14%", "red,%20rosé%2014%25", "red,%20rosé%2014%25"),
        ("/backslash\\", "/backslash%5c", "/backslash%5c"),
    ],
)
def test_canonical_url(given, ambiguous, plain):
    assert urls.canonicalise(given, True, False) == ambiguous
    assert urls.canonicalise(given, True, True) == plain


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("http://example.com/%C3%86blegr%C3", "http://example.com/Æblegr%c3"),
        ("http://example.com/path?foo=%20 +", "http://example.com/path?foo=+++"),
        ("http://example.com/+%20 path?foo=+%20 ", "http://example.com/+%20%20path?foo=+++"),
        ("http://example.com/hash#%23", "http://example.com/hash#%23"),
        ("http://example.com/%a%2A", "http://example.com/%25a*"),
        ("", ""),
        (None, None),
    ],
)
def test_default_canonical_url(given, expected):
    assert urls.canonicalise(given) == expected


def test_canonical_form_is_stable():
    for u in ("http://www.example.com/a b?q= c#%23", "https://example.com//", "x%zz", "http://example.com/%C6blegr%F8d"):
        once = urls.canonicalise(u)
        assert urls.canonicalise(once) == once


def test_resolve():
    assert urls.resolve("http://example.com/bar/", "zoo/baz.html") == "http://example.com/bar/zoo/baz.html"
    assert urls.resolve("http://example.com/foo | bar/", "sub/") == "http://example.com/foo%20|%20bar/sub"
    assert urls.resolve("nothing", "x") is None


def test_hosts(spark):
    rows = spark.createDataFrame([("http://news.bbc.co.uk/x",), ("http://-a",), ("http://" + "a" * 64 + ".com/",), ("http://foo.example.com&foo=bar",), ("http://fourth.whatever.googleapis.com/",), (None,)], "u string")
    out = rows.select(urls.host(F.col("u")).alias("h")).select("h", urls.private_suffix(F.col("h")).alias("d"), urls.public_suffix(F.col("h")).alias("s"), urls.host_levels(F.col("h")).alias("l"), urls.host_surts(F.col("h")).alias("t")).collect()
    assert [r["h"] for r in out] == ["news.bbc.co.uk", "malformed.host", "malformed.host", "malformed.host", "fourth.whatever.googleapis.com", None]
    assert out[0]["d"] == "bbc.co.uk" and out[0]["s"] == "co.uk" and out[4]["d"] == "whatever.googleapis.com"
    assert out[0]["l"] == ["uk", "co.uk", "bbc.co.uk", "news.bbc.co.uk"] and out[0]["t"][1] == "(uk,co," and out[1]["l"] == []


def test_digests():
    assert payload.base32_digest("sha1:5a3311bde611032119d6080eebf83a4a3b3475ed") == "sha1:LIZRDPPGCEBSCGOWBAHOX6B2JI5TI5PN"
    assert payload.base32_digest("md5:1") == "md5:1" and payload.base32_digest(None) is None


def test_dates(spark):
    stamps = spark.createDataFrame([("200009200005",), ("20000920000545",), ("2000092000054512",), ("20000920000545123",), ("2000",), (None,)], "s string")
    out = [r[0] for r in stamps.select(dates.crawl_date(F.col("s"))).collect()]
    assert out[0] == datetime.datetime(2000, 9, 20, 0, 5) and out[1] == out[2] == out[3] == datetime.datetime(2000, 9, 20, 0, 5, 45) and out[4:] == [None, None]
    assert dates.date_in("on 3 March 2011, 10:20 it") == datetime.datetime(2011, 3, 3, 10, 20)
    assert dates.date_in("12/25/2010") == datetime.datetime(2010, 12, 25) and dates.date_in("2010-02-30") is None


def test_text(spark):
    assert one(spark, text.adjust(F.lit('" leading   middle\u0007  and   trailing spaces  "'))) == '" leading middle and trailing spaces "'
    assert one(spark, text.adjust(F.lit("a\nb"))) == "ab" and one(spark, text.adjust(F.lit("  "))) is None
    assert one(spark, text.trim_spaces(F.lit("  a \n  b  c "))) == "a\nb c"
    assert one(spark, text.char_ngrams(F.lit("abc"), 2, 3)) == ["ab", "bc", "abc"]
    assert one(spark, text.shingles(text.tokens(F.lit("A b, c")), 2, 2)) == ["a b", "b c"]
    assert one(spark, text.postcodes(F.lit("to LS23 7BQ and LS23 7BQ, W1A 1AA"))) == ["LS23 7BQ", "W1A 1AA"]
    assert one(spark, text.letter_trigrams(F.lit("Ab1c"))) == ["_ab", "ab_", "b_c", "_c_"]
    assert one(spark, text.sentiment(F.lit(0.0))) == "Neutral"
    assert one(spark, text.path_levels(F.lit("/a/b"))) == ["/a", "/a/b"] and one(spark, text.path_levels(F.lit("/a/b"), True)) == ["a/b", "b"]


def test_payload_decoding():
    import gzip

    assert payload.dechunk(b"5\r\nhello\r\n1;x=y\r\n!\r\n0\r\n\r\n") == b"hello!"
    assert payload.dechunk(b"plain") == b"plain" and payload.dechunk(b"5\r\nhello", hinted=False) == b"5\r\nhello"
    assert payload.decompress(gzip.compress(b"x"), None) == (b"x", None)
    assert payload.decompress(b"x", "br")[1] == "unsupported content encoding: br"
    assert payload.decompress(b"\x1f\x8bbroken", "gzip")[0] == b"\x1f\x8bbroken"


def test_fuzzy_hash_is_local():
    base = b"The quick brown fox jumps over the lazy dog. " * 200
    size, a, _ = payload.ctph(base[:4000] + b"CHANGED" + base[4000:])
    same, b, _ = payload.ctph(base)
    assert payload.ctph(b"") == (3, "", "") and size == same
    assert payload.ctph(base) == payload.ctph(base)


def test_images_and_xml():
    import struct

    png = b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", 640, 480)
    assert payload.image_size(png) == (640, 480) and payload.image_size(b"GIF89a" + struct.pack("<HH", 3, 4)) == (3, 4)
    assert payload.image_size(b"\xff\xd8\xff\xc0\x00\x11\x08\x00\x10\x00\x20") == (32, 16) and payload.image_size(None) == (None, None)
    assert payload.xml_root(b'<a:Root xmlns:a="http://X/y"/>') == "http://x/y#root" and payload.xml_root(b"nope") is None


def test_content_types(spark):
    assert one(spark, content_types.full_type(F.lit("application/octet-stream"), F.lit(None).cast("string"), F.lit("video/mp4"), F.lit(None).cast("string"), F.lit(None).cast("string"))) == "video/mp4"
    assert one(spark, content_types.norm(F.lit("video/mp4"))) == "video" and one(spark, content_types.kind(F.lit("text/html"))) == "Web Page"
    assert one(spark, content_types.content_type(F.lit("text/html; charset=x"), F.lit(0), F.lit("response"))) == "application/x-empty"
    assert one(spark, payload.sniffed_type(F.lit(b"%PDF-1.4"))) == "application/pdf" and one(spark, payload.first_bytes(F.lit(b"\x01\x02"))) == "01020000"


def test_html():
    page = '<html><base href="/b/"><a href="x">a</a><a href="mailto:a@b">m</a><img src="i.png" srcset="j.png 1x, k.png 2x"><a rel="license" href="/l">l</a><p>First <b>one</b></p></html>'
    f = dict(zip(html.FEATURES.names, html.features(page, "http://e.org/")))
    assert f["links"] == ["http://e.org/b/x", "mailto:a@b", "http://e.org/l"] and f["links_images"] == ["http://e.org/b/i.png", "http://e.org/b/j.png", "http://e.org/b/k.png"]
    assert f["licenses"] == ["http://e.org/l"] and f["first_paragraph"] == "First one"
    assert len(html.features("<b>test<p></b><script> if (3<a) console.log('something');</script>", "")[4]) == 3
    assert html.features(None, "x") is None
