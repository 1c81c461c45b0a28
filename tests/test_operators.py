"""Operators on small fixtures: nulls, ties, repeats, empty tables, clashing names."""

from datetime import datetime

from pyspark.sql import functions as F

from wrackline.operators import annotate, captures, filters, jobs, names, nearest, search, skew


def rows(df, *by):
    return sorted(tuple(r) for r in df.collect())


def test_dominant_keys(spark):
    df = spark.createDataFrame([("a", "x")] * 30 + [(f"h{i}", "x") for i in range(60)] + [(None, None)] * 10, "host string, domain string").withColumn("n", F.lit(1))
    assert rows(skew.dominant_keys(df, ["host", "domain"]).select("key_field", "key_value", "n")) == [("domain", "x", 90), ("host", "a", 30)]
    assert skew.dominant_keys(df.limit(0), ["host"]).count() == 0


def test_key_profile(spark):
    df = spark.createDataFrame([("a", "u"), ("a", "u"), ("a", None), ("b", None), (None, "v")], "k string, u string")
    out = skew.key_profile(df, "k", {"n": F.count(F.lit(1))}, {"n_u": "u"})
    assert rows(out) == [("a", 3, 1), ("b", 1, 0)]


def test_semi_join_heavy_equals_plain_join(spark):
    df = spark.range(5000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 700)).alias("k"), "id")
    keyed = df.where("k % 2 = 0").groupBy("k").agg(F.count("*").alias("w"))
    got = skew.semi_join_heavy(df, keyed, ["k"], "w", heavy_share=0.05)
    assert rows(got) == rows(df.where("k % 2 = 0").select("k", "id"))
    assert skew.semi_join_heavy(df, keyed.limit(0), ["k"], "w").count() == 0


def test_filters(spark):
    df = spark.createDataFrame(
        [("response", "http://a/x", 200), ("response", "http://a/x", 404), ("request", "http://a/x", 200), ("arc", "http://a/x", 200), ("response", None, 200), ("response", "dns:a", None), ("response", "http://a/x", None)],
        "record_type string, url string, status_code int",
    )
    kept = filters.keep_captures(df, {"record_types": ["response"], "protocols": ["http", "dns:"], "statuses": ["2"]})
    assert sorted((r[0], r[1]) for r in kept.collect()) == [("arc", "http://a/x"), ("response", "dns:a"), ("response", "http://a/x")]
    assert filters.keep_captures(df, {"protocols": []}).count() == 0
    assert filters.keep_captures(df, {"protocols": [""], "url_exclude": [" ", ""]}).count() == 6
    listed = spark.createDataFrame([("http://a",), ("",), (None,)], "prefix string")
    assert filters.excluded_by_prefix(df, "url", listed).count() == 2
    assert filters.excluded_by_prefix(df, "url", listed.limit(0)).count() == 7


def test_annotations(spark):
    docs = spark.createDataFrame([(1, "http://www.a.org/p", "sub.a.org", "F-1.warc", datetime(2015, 1, 1)), (2, None, None, None, None), (3, "http://b.org/", "b.org", "G-1.warc", datetime(2010, 1, 1))], "id int, url string, host string, source_file string, crawl_date timestamp")
    rules = spark.createDataFrame(
        [("resource", "http://www.a.org/p", "C", ["C", "C|D"], ["S"]), ("resource", "http://www.a.org/p", "C", ["C", "C|D"], ["S"]), ("subdomains", "http://www.a.org/", None, ["D"], ["T", None]), ("source_file_matches", "^G", "D", [], None), ("root", None, "C", [], [])],
        "scope string, rule_key string, collection string, collections array<string>, subject array<string>",
    )
    ranges = spark.createDataFrame([("C", datetime(2014, 1, 1), None), ("D", None, datetime(2015, 1, 1)), ("C|D", None, None)], "collection string, range_start timestamp, range_end timestamp")
    out = rows(annotate.annotate(docs, "id", "url", "host", "source_file", "crawl_date", rules, ranges))
    assert out == [(1, ["C"], ["C", "C|D"], ["S", "T"]), (3, ["D"], [], [])]
    filled = annotate.back_fill(docs.withColumn("collection", F.array(F.lit("old"))), annotate.annotate(docs, "id", "url", "host", "source_file", "crawl_date", rules, ranges), "id")
    assert {r["id"]: r["collection"] for r in filled.collect()} == {1: ["old", "C"], 2: ["old"], 3: ["old", "D"]}


def test_access_and_lookup(spark):
    df = spark.createDataFrame([(1, "(uk,co,bbc,)/x"), (2, "(org,a,)/"), (3, None)], "id int, surt string")
    listed = spark.createDataFrame([("(uk,co,bbc,",), ("(uk,co,bbc,",)], "prefix string")
    assert [r["access_terms"] for r in annotate.access_terms(df, "surt", listed).orderBy("id").collect()] == ["OA", "RRO", "RRO"]
    arks = spark.createDataFrame([("f", "ark:1"), ("f", "ark:0"), (None, "x")], "file string, ark string")
    files = spark.createDataFrame([("f",), ("g",)], "name string")
    assert rows(annotate.with_ark(files, "name", arks).select("archive")) == [("ark:0#f",), ("g",)]


def test_reduplicate(spark):
    maps = [
        {"digest": "d", "record-type": "revisit", "url": "u1", "timestamp": "3"},
        {"digest": "d", "record-type": "response", "url": "u0", "timestamp": "1", "length": "9"},
        {"digest": "d", "record-type": "response", "url": "uX", "timestamp": "2"},
        {"digest": "e", "record-type": "revisit", "url": "u2"},
        {"digest": "", "record-type": "revisit", "url": "u3"},
        {"record-type": "metadata", "url": "u4"},
    ]
    df = spark.createDataFrame([(m,) for m in maps], "mdx_map map<string,string>")
    out = {r[0]["url"]: r[0] for r in captures.reduplicate(df).collect()}
    assert len(out) == 6 and out["u1"] == {"digest": "d", "record-type": "reduplicated", "url": "u1", "timestamp": "3", "length": "9"}
    assert out["u2"]["record-type"] == "revisit" and out["u3"]["record-type"] == "revisit" and out["uX"]["timestamp"] == "2"
    assert captures.reduplicate(df.limit(0)).count() == 0


def test_reduplicate_copies_no_exemplars(spark):
    """Exemplars are not multiplied into a broadcast; hot and other digests give the same records."""
    maps = [{"digest": f"d{i}", "record-type": "response", "url": f"u{i}", "timestamp": "1", "length": str(i)} for i in range(50)]
    maps += [{"digest": f"d{i % 7 if i < 60 else 3}", "record-type": "revisit", "url": f"v{i}"} for i in range(90)] + [{"digest": "x", "record-type": "revisit", "url": "w"}]
    df = spark.createDataFrame([(m,) for m in maps], "mdx_map map<string,string>")
    done = {share: captures.reduplicate(df, share=share) for share in (0.0, 0.2, 2.0)}
    assert all("explode" not in d._jdf.queryExecution().toString() for d in done.values())
    got = [sorted(sorted(r[0].items()) for r in d.collect()) for d in done.values()]
    assert got[0] == got[1] == got[2] and len(got[0]) == len(maps)
    assert sum(dict(m)["record-type"] == "reduplicated" and dict(m)["length"] == "3" for m in got[0]) == 30 + sum(i % 7 == 3 for i in range(60))


def test_reduplicated_maps_query(spark, data):
    """Every record of mdx as plain Python overlays it, without copies of exemplars in the plan."""
    import json

    from wrackline.plans.capture_queries import QUERIES

    df = QUERIES["reduplicated_maps"](spark, data)
    assert "explode" not in df._jdf.queryExecution().toString()
    maps, first = [r[0] for r in spark.read.parquet(f"{data}/mdx.parquet").collect()], {}
    for m in sorted((m for m in maps if m.get("record-type") == "response" and m.get("digest")), key=lambda m: (m.get("timestamp", "~"), json.dumps(sorted(m.items())))):
        first.setdefault(m["digest"], m)
    want = [first[m["digest"]] | m | {"record-type": "reduplicated"} if m.get("record-type") == "revisit" and m.get("digest") in first else m for m in maps]
    got = [json.loads(r[0]) for r in df.collect()]
    order = lambda x: sorted(json.dumps(m, sort_keys=True) for m in x)
    assert order(got) == order(want) and sum(m["record-type"] == "reduplicated" for m in got if "record-type" in m) > 0


def test_reduplicate_shuffles_no_lone_responses(spark, monkeypatch):
    """Responses without revisits stay out of the shuffle of exemplars; with few bits more come along, for the same records."""
    seen, staged = [], captures.staged
    monkeypatch.setattr(captures, "staged", lambda df, label: seen.append(df) or staged(df, label))
    maps = [{"digest": f"d{i}", "record-type": "response", "url": f"u{i}", "timestamp": str(i % 3)} for i in range(3000)] + [{"digest": f"d{i * 97}", "record-type": "response", "url": f"w{i}", "timestamp": "1"} for i in range(30)]
    maps += [{"digest": f"d{i * 97}", "record-type": "revisit", "filename": f"f{i}"} for i in range(40)]
    df = spark.createDataFrame([(m,) for m in maps], "mdx_map map<string,string>")

    def written(plan):
        metric = plan.metrics().get("shuffleRecordsWritten") if plan.nodeName() == "Exchange" and "_digest#" in plan.outputPartitioning().toString() else None
        under = [plan.plan()] if "QueryStage" in plan.nodeName() else [plan.executedPlan()] if "Adaptive" in plan.nodeName() else [plan.children().apply(i) for i in range(plan.children().size())]
        return (metric.get().value() if metric else 0) + sum(map(written, under))

    got = [sorted(sorted(r[0].items()) for r in captures.reduplicate(df).collect())]
    seen[0].collect()
    assert 0 < written(seen[0]._jdf.queryExecution().executedPlan()) < 1000
    for bits in (8, 1):
        monkeypatch.setattr(captures, "MARKS", bits)
        got.append(sorted(sorted(r[0].items()) for r in captures.reduplicate(df).collect()))
    assert got[0] == got[1] == got[2] and len(got[0]) == len(maps)
    assert {dict(m)["filename"]: dict(m)["url"] for m in got[0] if dict(m)["record-type"] == "reduplicated"} == {f"f{i}": f"w{i}" if i < 30 and i * 97 % 3 == 2 else f"u{i * 97}" for i in range(31)}


def test_record_order(spark):
    df = spark.createDataFrame([("f", 0, 100, "response", "u", "h1"), ("f", 40, 100, "metadata", "u", None), ("f", 50, 100, "metadata", "u", None), ("f", 60, 100, "response", "v", "h2"), ("f", 70, 100, "metadata", "w", None)], "file string, offset long, size long, record_type string, url string, hash string")
    assert [r["compressed_length"] for r in captures.compressed_length(df, "file", "offset", "size").orderBy("offset").collect()] == [40, 10, 10, 10, 30]
    found = captures.metadata_with_response(df, "file", "offset", "record_type", "url", ["hash"]).collect()
    assert [(r["offset"], r["response_hash"]) for r in found] == [(40, "h1")]


def test_hosts_report(spark):
    line = "t {s} {b} {u} L - text/html #1 20+5 sha1:x - {a}"
    lines = [line.format(s="200", b="10", u="http://h/x", a="-"), line.format(s="200", b="5", u="http://h/y", a="3t,warcRevists:digest"), line.format(s="-9998", b="-", u="https://h:80/y", a="-"), line.format(s="-1", b="1", u="http://h/y", a="-"), line.format(s="1", b="7", u="dns:h", a="warcRevisit:digest"), "too few"]
    out = rows(jobs.hosts_report(spark.createDataFrame([(x,) for x in lines] + [(None,)], "log_line string")))
    assert out == [("h", 3, 22, 0, 2, 12), ("h:80", 1, 0, 1, 0, 0)]


def test_sample_is_bounded_and_repeatable(spark):
    df = spark.range(20000).select(F.when(F.col("id") < 15000, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("k"), F.col("id").cast("string").alias("v"))
    a = jobs.sample_per_key(df, "k", "v", 50)
    assert {r["k"]: r["n"] for r in a.groupBy("k").agg(F.count("*").alias("n")).collect()} == {"hot": 50, **{f"k{i}": 50 for i in range(7)}}
    assert rows(a) == rows(jobs.sample_per_key(df.repartition(7), "k", "v", 50))


def test_names(spark):
    rules = [(r"A-(\d+)", {"n": "$1"}), (r"A-.*", {"m": "all"})]
    df = spark.createDataFrame([("A-12",), ("A-x",), ("B",), (None,)], "f string")
    assert [(r["n"], r["m"]) for r in names.with_name_fields(df, "f", rules).collect()] == [("12", None), (None, "all"), (None, None), (None, None)]
    assert rows(names.rule_counts(df.where("f IS NOT NULL"), "f", rules)) == [(-1, 1, "B"), (0, 1, "A-12"), (1, 1, "A-x")]


def test_nearest(spark):
    assert len(nearest.palette()) == 147
    df = spark.createDataFrame([(126, 254, 211), (None, 1, 1)], "r int, g int, b int")
    assert [r[0] for r in df.select(nearest.nearest_colour(F.col("r"), F.col("g"), F.col("b"))).collect()] == ["aquamarine", None]
    known = nearest.profiles(spark.createDataFrame([("en", "the cat and the dog"), ("de", "der hund und die katze")], "lang string, text string"))
    docs = spark.createDataFrame([(1, "the dog"), (2, "die katze"), (3, "12 34"), (4, None)], "id int, t string")
    assert {r["id"]: r["lang"] for r in nearest.nearest_profile(docs, "id", "t", known).collect()} == {1: "en", 2: "de"}


def test_search(spark):
    df = spark.createDataFrame([(1, "a harbour board met"), (2, "board of the harbour, harbour"), (3, "harbourboard"), (4, None)], "id int, t string")
    out = search.search(df, "harbour board", "t", "id").collect()
    assert [(r["id"], r["score"]) for r in out] == [(1, 4.0), (2, 3.0)]
    hashes = spark.createDataFrame([(1, "abcdefghijkl"), (2, "abcdefghijkX"), (3, "zzzzzzzzz"), (4, None)], "id int, h string")
    near = search.similar_hashes(hashes, "id", "h", hashes.where("id = 1"), 3, 0.5)
    assert sorted(r["id"] for r in near.collect()) == [1, 2]
    places = spark.createDataFrame([(1, 51.5, -0.1), (2, 48.9, 2.3)], "id int, lat double, lon double")
    assert [r["id"] for r in search.within(places, "lat", "lon", 51.4, 0.0, 50).collect()] == [1]


def test_prefixes_of_any_number_of_lengths(spark):
    """More distinct prefix lengths than any list limit; rows that repeat; clashing column names."""
    listed = spark.range(1, 6000).select(F.expr("concat('p', repeat('x', cast(id as int)))").alias("prefix"))
    df = spark.createDataFrame([("p" + "x" * 5999, 1), ("p" + "x" * 5999, 1), ("px", 2), ("q", 3), (None, 4)], "url string, id int").withColumn("_x", F.lit(0))
    assert rows(filters.excluded_by_prefix(df, "url", listed).select("id")) == [(3,), (4,)]
    assert rows(annotate.access_terms(df, "url", listed).select("id", "access_terms")) == [(1, "OA"), (1, "OA"), (2, "OA"), (3, "RRO"), (4, "RRO")]


def test_file_patterns_in_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([(1, None, None, "F-1.warc", None), (2, None, None, "G-1.warc", None)], "id int, url string, host string, source_file string, crawl_date timestamp")
    rules = spark.createDataFrame([("source_file_matches", f"^{c}", "D", [], None) for c in "FGHIJ"], "scope string, rule_key string, collection string, collections array<string>, subject array<string>")
    monkeypatch.setattr(annotate, "MAX_RULES", 2)
    assert rows(annotate.matched_rules(docs, "id", "url", "host", "source_file", rules).select("id", "collection")) == [(1, "D"), (2, "D")]


def test_strict_postcodes_types_and_hosts(spark):
    from wrackline.functions import content_types, text, urls

    codes = {"SW1A 1AA": True, "w1a1aa": True, "M1 1AE": True, "GIR 0AA": True, "QZ9 9ZZ": False, "SW1A 1CA": False, "EC1A1BB": True, "": False}
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    assert {r[0]: r[1] for r in df.select("c", text.is_postcode(F.col("c"))).collect()} == codes
    types = {"application/msword": "word", "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "other", "image/png": "image", "imagery": "other", "application/vnd.ms-excel": "excel", "application/vnd.ms-excel.sheet": "other", "x/vnd.rn-realaudio": "other", "application/vnd.rn-realaudio": "audio", None: "other"}
    df = spark.createDataFrame([(c,) for c in types], "c string")
    assert {r[0]: r[1] for r in df.select("c", content_types.norm(F.col("c"))).collect()} == types
    hosts = {"http://a_b.test/": "malformed.host", "http://ab.test/": "ab.test", "http://ab.test./": "malformed.host", "http://-a/": "malformed.host"}
    df = spark.createDataFrame([(c,) for c in hosts], "c string")
    assert {r[0]: r[1] for r in df.select("c", urls.host(F.col("c"))).collect()} == hosts


def test_outlinks_of_responses_only(spark):
    df = spark.createDataFrame([(2000, "a", ["x"], "response", "http://a/"), (2000, "a", ["x"], "revisit", "http://a/"), (2000, "a", ["y"], None, "http://a:80/p"), (2000, "a", ["y"], "response", "dns:a"), (2000, "a", None, "response", "http://a/"), (None, None, ["x"], "response", None)], "y int, h string, l array<string>, t string, u string")
    assert rows(jobs.outlinks(df, "y", "h", "l", "t", "u")) == [(2000, "a", "x", 1), (2000, "a", "y", 1)]


def test_long_urls_keep_their_own_id(spark):
    from wrackline.operators import documents

    schema = "warc_headers map<string,string>, http_status string, http_headers array<struct<name:string,value:string>>, payload binary"
    heads = [{"WARC-Target-URI": f"http://a.test/{'x' * 2500}{c}", "WARC-Date": "2020-01-01T00:00:00Z", "WARC-Type": "response"} for c in "pq"]
    heads.append({"WARC-Target-URI": "<http://a.test/foo.png%201080w>", "WARC-Date": "2020-01-01T00:00:00Z", "WARC-Type": "response"})
    out = documents.build_documents(spark.createDataFrame([(h, "HTTP/1.1 200 OK", [], b"") for h in heads], schema)).select("id", "url", "url_norm").collect()
    assert len({r["id"] for r in out}) == 3 and {len(r["url"]) for r in out[:2]} == {2000}
    assert out[2]["url"] == "http://a.test/foo.png%201080w" and out[2]["url_norm"] == "http://a.test/foo.png"


def test_link_sets_equal_the_column_functions(spark):
    from wrackline.functions import urls

    links = ["http://a.co.uk/x", "http://B.co.uk:80/", "http://uk/", "http://1.2.3.4/", "http://a_b/", "nothing", "http://u@x.blogspot.co.uk/", "http://deep.sub.example.com/p", "http://deep.sub.example.com/q", "https://a.github.io"]
    df = spark.createDataFrame([(links,), ([],), (None,)], "links array<string>")
    hosts = F.array_distinct(F.transform("links", lambda u: urls.host(u)))
    want = df.select(hosts, F.array_distinct(F.transform(hosts, lambda h: urls.private_suffix(h))), F.array_distinct(F.array_compact(F.transform(hosts, lambda h: urls.public_suffix(h)))), F.array_distinct(F.flatten(F.transform(hosts, urls.host_surts))))
    got = df.select(urls.link_sets(F.col("links")).alias("s")).select("s.*")
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
