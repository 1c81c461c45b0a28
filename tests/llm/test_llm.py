"""Training-data operators against brute force, exact round trips, held-out accuracy and small fixtures."""

import os
import random

import pytest
from pyspark.sql import functions as F

from wrackline.llm import boilerplate, bpe, garbled, langid, lines, pack, reading, segments, spam, truncated

RANKS = bpe.tokenizer_file("byte_bpe_50k")
pytestmark = pytest.mark.skipif(not os.path.exists(RANKS), reason="no public tokenizers here")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- encoding ---------------------------------------------------------------------


def test_encoding_equals_reference_library(spark, data):
    import tiktoken

    ranks = bpe.load_ranks(RANKS)
    other = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    rng = random.Random(1)
    texts += ["", None, " ", "\n\n", "a  b\n c", "<|endoftext|> x", "It's 12½x² naïve　日本語​", "\x1c a \x85b\xa0 c", "x" * 70000, "é" * 5000 + " " * 3000]
    texts += ["".join(rng.choice(" \n\t\xa0ab'sé日1! ") for _ in range(60)) for _ in range(300)]
    enc = bpe.encoder(RANKS)
    offsets, ids = enc.encode_batch(texts)
    for k, t in enumerate(texts):
        got = ids[offsets[k] : offsets[k + 1]].tolist()
        assert got == (other.encode_ordinary(t) if t else [])
        assert other.decode(got) == (t or "")


def test_encode_column(spark):
    df = spark.createDataFrame([(1, "hello world", "x"), (2, "", "x"), (3, None, "x"), (None, "a", "x"), (1, "hello world", "x")], "doc_id bigint, text string, ids string")
    out = rows(bpe.encode_column(df.where("doc_id IS NOT NULL"), "doc_id", "text", RANKS))
    assert out == [(1, [31373, 995]), (1, [31373, 995]), (2, []), (3, [])]
    assert bpe.encode_column(df.limit(0), "doc_id", "text", RANKS).count() == 0


def test_perfect_hash_has_one_slot_an_entry():
    table = bpe.PerfectHash([f"w{i}" for i in range(5000)], list(range(5000)))
    assert table.find([f"w{i}" for i in range(5000)]) == list(range(5000)) and table.find(["none", ""]) == [-1, -1]
    assert len(table.words) == 5000 and None not in table.words


# --- packing -----------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(6))
def test_match_sizes_places_every_item(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 64, 512])
    sizes = [min(capacity, int(rng.expovariate(3 / capacity)) + 1) for _ in range(rng.choice([1, 50, 3000]))]
    histogram = {s: sizes.count(s) for s in set(sizes)}
    plan = pack.match_sizes(histogram, capacity)
    fill: dict[int, int] = {}
    placed: dict[int, int] = {}
    for size, lo, hi, base, per in plan.runs:
        placed[size] = placed.get(size, 0) + hi - lo
        for r in range(lo, hi):
            c = base + (r - lo) // per
            fill[c] = fill.get(c, 0) + size
    assert placed == histogram and max(fill.values()) <= capacity and set(fill) == set(range(plan.containers))
    assert plan.containers <= 1.25 * -(-sum(sizes) // capacity) + 1


def test_pack(spark):
    sizes = spark.createDataFrame([(i, n) for i, n in enumerate([0, None, 3, 5, 5, 10, 23, 1, 1, 5] + [4] * 40)], "doc_id bigint, n bigint").withColumn("rank", F.lit("clash"))
    out = pack.pack(sizes, "doc_id", "n", [(1, 10), (2, 7)])
    for p, capacity in ((1, 10), (2, 7)):
        own = out.where(f"pack_id = {p}")
        assert own.groupBy("container").agg(F.sum("n_tokens").alias("s")).agg(F.max("s")).first()[0] <= capacity
        total = {r["doc_id"]: (r["s"], r["k"]) for r in own.groupBy("doc_id").agg(F.sum("n_tokens").alias("s"), F.count("*").alias("k")).collect()}
        assert len(total) == 50 and total[6] == (23, -(-23 // capacity)) and total[0] == (0, 1) == total[1]
        assert all(k == 1 for d, (s, k) in total.items() if s <= capacity)
    assert pack.pack(sizes.limit(0), "doc_id", "n", [(1, 10)]).count() == 0


# --- repeated lines -------------------------------------------------------------------


def test_repeated_lines_and_deltas(spark):
    pages = [(i, "d", f"u{i % 6}", f"Home {i}!\nText {chr(97 + i)}\n\n123") for i in range(8)] + [(8, None, "u9", "Home"), (9, "d", None, "Home"), (10, "d", "u1", None), (11, "e", "u1", "HOME"), (12, "d", "u0", "home")]
    df = spark.createDataFrame(pages, "id bigint, domain string, url string, content string").withColumn("k1", F.lit(1))
    want = [(i, 1) for i in range(8)] + [(12, 1)]
    assert rows(lines.repeated_lines(df, "id", "domain", "url", "content", 5)) == want
    keyed = lines.line_keys(df, "id", "domain", "url", "content")
    state, new = lines.merge_delta(lines.LineCounts(), keyed.where("id < 4"), 5)
    assert new.count() == 0
    state, new = lines.merge_delta(state, keyed.where("id >= 4"), 5)
    assert new.count() == 1
    state, again = lines.merge_delta(state, keyed, 5)
    assert again.count() == 0
    built = {r["id"]: r["content_clean"] for r in lines.rebuild(df, "id", "content", keyed, new).collect()}
    assert set(built) == {i for i, _ in want} and built[0] == "Text a\n\n123"
    assert lines.repeated_lines(df.limit(0), "id", "domain", "url", "content").count() == 0


# --- languages and levels ----------------------------------------------------------------


def samples(spark, data):
    return [(r["lang"], r["text"]) for r in spark.read.parquet(f"{data}/lang_samples.parquet").orderBy("sample_id").collect()]


def test_language_held_out(spark, data):
    known = samples(spark, data)
    model = langid.LanguageModel(known[::2])
    got, sure = model.classify([t for _, t in known[1::2]])
    assert sum(a == b for a, (b, _) in zip(got, known[1::2])) >= 0.99 * len(got) and sure.min() > 0.5
    assert model.classify([None, "", "12 !"])[0] == [None, None, None]


def test_reading_held_out(spark, data):
    graded = [(r["lang"], r["reading_level"], r["text"]) for r in spark.read.parquet(f"{data}/graded_texts.parquet").orderBy("item_id").collect()]
    known = samples(spark, data)
    model = reading.ReadingModel([g for i, g in enumerate(graded) if i % 5], langid.LanguageModel(known), known)
    hard = 0
    held = graded[::5]
    for lang, level, text in held:
        words = langid.words_of(text.lower())
        at = [model.vocabulary[lang][w] for w in words if w in model.vocabulary[lang]]
        placed = model.words[lang].place(model.words[lang].b[at].sum(keepdims=True), reading.np.array([len(at)]))
        hard += (model.scaled(lang, placed, reading.np.array([model.shape(lang, words, text)[0]]))[0] >= 3.5) == (level >= 4)
    assert hard >= 0.9 * len(held)


def test_rate_edges(spark, data):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "12 34", "x"), (4, "The cat made a hat. The dog ate the bed. " * 8, "x"), (4, "A stochastic approximation corroborates the institutional heterogeneity. " * 8, "x"), (5, "Кот купил дом. " * 9, "x")], "doc_id bigint, text string, lang string")
    out = reading.rate(df, "doc_id", "text", spark.read.parquet(f"{data}/graded_texts.parquet"), spark.read.parquet(f"{data}/lang_samples.parquet"), rounds=1).collect()
    assert len(out) == 6 and {r["reading_level"] for r in out if r["doc_id"] <= 3} == {None}
    levels = sorted(r["reading_level"] for r in out if r["doc_id"] == 4)
    assert levels[0] <= 2 and levels[1] >= 4
    other = next(r for r in out if r["doc_id"] == 5)
    assert other["lang"] == "ru" and not other["anchored"] and other["reading_level"] is not None


def test_label_language(spark):
    df = spark.createDataFrame([("EN",), ("en-GB",), ("deu",), ("ger",), ("und",), ("",), (None,), ("unknown",), ("xx",)], "l string")
    assert [r[0] for r in df.select(segments.label_language(F.col("l"))).collect()] == ["en", "en", "de", "de", None, None, None, None, "xx"]


def test_segments_of_mixed_text(spark, data):
    model = langid.LanguageModel(segments.with_copies(samples(spark, data)))
    text = "The festival supported the summer programme in the old town hall. The garden club opened the reading room.\nLe conseil municipal a décrit la fête d’été avant les vacances. Le club a préparé le pain."
    df = spark.createDataFrame([(1, "d.test", "http://d.test/", text, None), (2, None, None, None, None), (3, "d.test", "http://d.test/2", "Home | News", None)], "id bigint, domain string, url string, content string, title string").withColumn("label", F.lit("en"))
    found = segments.page_segments(df, "id", boilerplate.Wrapper({}), model)
    assert [(r["id"], r["segment_no"], r["first_line"], r["lang"]) for r in found.orderBy("id", "segment_no").collect()] == [(1, 1, 1, "en"), (1, 2, 2, "fr"), (3, 0, 1, "en")]
    assert {(r["id"], r["lang"]) for r in segments.page_languages(found, "id").collect()} == {(1, "en"), (1, "fr"), (3, "en")}
    assert rows(segments.mislabelled(df, "id", "label", found)) == [(1, "en"), (1, "fr")]


# --- boilerplate and spam --------------------------------------------------------------


def site(n, host):
    return [(f"http://{host}/{i}", host, host, f"Home | News | Contact\nHome > News > Title number {chr(97 + i)} of {host}\nTitle number {chr(97 + i)} of {host}\nPublished 1/{i + 1}/2010\nA long sentence about the matter {chr(97 + i)} of {host}, with many words in it.\nMost read\n- Other page {chr(98 + i)} there\n- Third page {chr(99 + i)} here\n© 2010 {host.split('.')[0]}. All rights reserved.", f"Title number {chr(97 + i)} of {host}") for i in range(n)]


def test_wrapper_induction(spark):
    pages = [p for h in ("alpha.test", "betas.test", "gamma.test", "delta.test") for p in site(6, h)]
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(pages)] + [(99, None, None, None, None, None)], "id bigint, url string, host string, domain string, content string, title string").withColumn("h", F.lit(1))
    items, own = boilerplate.induce(df, "url", "host", "domain", "content", "title")
    assert {"home", "news", "contact", "most read", "all rights reserved"} <= set(items)
    wrapper = boilerplate.Wrapper(items)
    got = {}
    for r in boilerplate.boilerplate_lines(df, "id", wrapper).collect():
        got.setdefault(r["id"], []).append(r["line_no"])
    assert set(got) == set(range(24)) and all(sorted(v) == [1, 2, 6, 7, 8, 9] for v in got.values())
    assert boilerplate.induce(df.limit(0), "url", "host", "domain", "content", "title")[0] == {}
    assert rows(boilerplate.bodies(df.where("id = 0"), "id", wrapper)) == [(0, "\n".join(pages[0][3].split("\n")[2:5]))]


def test_menu_of_one_host(spark, monkeypatch):
    """A menu and footer that stand on one host alone are its own template; the byline of its only author is not."""
    texts = [f"Zork | Blip | Quux\nStory {chr(97 + i)}{chr(97 + i % 7)}\nBy Jane Roe\nThe council met number {chr(97 + i % 26)}{chr(97 + i // 26)} in the hall.\nImprint of the zork office" for i in range(40)]
    df = spark.createDataFrame([(i, f"http://one.test/{i}", "one.test", "one.test", t, None) for i, t in enumerate(texts)], "id bigint, url string, host string, domain string, content string, title string")
    want = sorted((i, k) for i in range(40) for k in (1, 5))
    assert rows(boilerplate.boilerplate_lines(df, "id", boilerplate.wrapper_for(df))) == want
    more = df.unionByName(spark.createDataFrame([(100 + k, *p) for k, p in enumerate(p for h in ("alpha.test", "betas.test", "gamma.test") for p in site(6, h))], df.schema))
    whole = rows(boilerplate.boilerplate_lines(more, "id", boilerplate.wrapper_for(more)))
    monkeypatch.setattr(boilerplate, "MAX_WRAPPER", 0)
    assert rows(boilerplate.boilerplate_lines(more, "id", boilerplate.wrapper_for(more))) == whole and set(want) < set(whole)


def share(lines, labels=None, model=None):
    return spam.rate(*spam.observe(lines, labels or [0] * len(lines)), model)[3]


def test_spam_labels():
    prose = ["The council met in the town hall and talked about the new bridge for a long time."] * 3
    assert share(prose) == 0
    assert share(["cheap shoes " * 20, "cheap shoes, loans, " * 12]) == 1
    assert share(["http://a.example/1", "http://b.example/2", "http://c.example/3", "www.d.test"]) == 1
    assert share(["#CheapShoes #Loans #Deals #Flights"]) == 1
    catalogue = ["The museum shows four old bowls that a farmer found near the river.", "Lunholt, 14 cm, 46 g, no. 2193", "Vordra, 114 cm, 440 g, no. 3469", "All of them came from one small workshop in the next valley, as the marks tell."]
    assert share(catalogue) < 0.5
    assert spam.rate(*spam.observe([""], [4])) == (0, 0, 0, 0.0)
    # one long line of keywords between prose lines
    assert share([prose[0], "loan offers here, " * 40, prose[0]]) > 0.5


def test_spam_model_is_estimated(spark):
    """Baum-Welch: likelier with every round, the same from blocks of any size, and states keep their meaning."""
    pages = [("TPPPPM", "122311"), ("MMTPPM", "111211"), ("MKKKKM", "199991"), ("MSSSSS", "111111"), ("P", "9"), ("UUUU", "1111")] * 5
    model, last = spam.Model(), None
    for _ in range(4):
        counts = model.expected(pages, [1] * len(pages))
        assert abs(counts[:4].sum() - len(pages)) < 1e-6
        assert abs(counts[20:].sum() - sum(int(c) for _, w in pages for c in w)) < 1e-6
        model = model.refitted(counts)
    df = spark.createDataFrame([(s, w, 5) for s, w in dict.fromkeys(pages)], "symbols string, steps string, n bigint").repartition(3)
    fitted = spam.estimate(df)
    assert fitted.viterbi("TPPMKK", [1, 2, 2, 1, 3, 3]) == [0, 0, 0, 3, 2, 2]
    assert fitted.emit[2][spam.SYMBOLS.index("K")] > spam.EMIT[2][spam.SYMBOLS.index("K")]


# --- encodings and cuts -----------------------------------------------------------------


def test_garbled_round_trip(spark):
    clean = ["La panadería preparó la exposición con otros vecinos", "El niño añadió un jardín pequeño también", "Der Bürgermeister prüfte die alte Brücke früh", "Le théâtre a préparé la fête d’été"]
    rows_ = [(i, clean[i % 4] + f" {i}", None) for i in range(400)]
    bad = lambda t, wrong, right="utf-8": t.encode(right).decode(wrong)
    rows_ += [(1000 + i, bad(clean[i % 4], "latin-1"), None) for i in range(12)] + [(2000 + i, bad(clean[i % 4], "mac_roman"), bad(clean[1], "mac_roman")) for i in range(12)]
    rows_ += [(3000, "El niño explicó por qué “é” puede ser “Ã©” aquí", None), (3001, "", None), (3002, None, None), (3003, "El ni�o a�adi� un jard�n", None)]
    df = spark.createDataFrame(rows_, "id bigint, content string, title string")
    fixed = {(r["id"], r["field_name"]): r["restored"] for r in garbled.restore(df, "id", ["content", "title"]).collect()}
    assert {k for k in fixed if k[0] < 1000 or 3000 <= k[0] <= 3002} == set()
    assert all(fixed[(1000 + i, "content")] == clean[i % 4] for i in range(12))
    assert all(fixed[(2000 + i, "content")] == clean[i % 4] and fixed[(2000 + i, "title")] == clean[1] for i in range(12))
    assert fixed[(3003, "content")] == "El niño añadió un jardín"
    assert garbled.restore(df.limit(0), "id", ["content", "title"]).count() == 0


def test_truncated(spark, monkeypatch):
    full = [(i, f"http://h/{i}", f"The long council of town number {chr(97 + i % 26)} met in the old hall and opened a new bridge today.\nAnother line that ends in the old hall.\nBack to top" + "\nThe end." * (i % 2)) for i in range(60)]
    cut = [(100, "http://h/100", "The long council of town number a met in the old hall and opened a new"), (101, "http://h/101", "Another text.\nThe long council of town number b met in the ol")]
    df = spark.createDataFrame(full + cut + [(102, None, None), (103, "u", ""), (104, "u", "One line.\n")], "id bigint, url string, content string").withColumn("source", F.lit("s"))
    got = {r["id"] for r in truncated.judge(df, "id", "content", "url").where("cut").collect()}
    assert got == {100, 101}
    monkeypatch.setattr(truncated, "MAX_BROADCAST", 0)
    again = truncated.judge(df, "id", "content", "url")
    assert {r["id"] for r in again.where("cut").collect()} == {100, 101} and {r["id"] for r in again.where("by_trigram").collect()} == {100, 101}
    assert truncated.judge(df.limit(0), "id", "content", "url").count() == 0
    long_ = spark.createDataFrame([(0, "http://h/x", "x" * 400 + " " + "y" * 400)], "id bigint, url string, content string").unionByName(df.drop("source"))
    assert {r["id"] for r in truncated.judge(long_, "id", "content", "url").where("cut").collect()} >= {100, 101}
    rate = truncated.source_rates(df, "id", "source", "content", spark.createDataFrame([(100,), (101,)], "id bigint")).first()
    assert (rate["n_texts"], rate["n_cut"]) == (64, 2)


# --- queries -------------------------------------------------------------------------------


def test_llm_queries_with_sql(spark, data):
    import duckdb

    from wrackline.llm import queries

    con = duckdb.connect()
    for name in ("mementos", "pack_sizes"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    for name in ("p4_found", "p4_clean", "p9_checks"):
        df = queries.QUERIES[name](spark, data)
        names = sorted(df.columns)
        assert sorted((tuple(r) for r in df.select(names).collect()), key=repr) == sorted(con.execute(f"SELECT {', '.join(names)} FROM ({queries.SQL[name]})").fetchall(), key=repr), name


def test_llm_queries_run(spark, data):
    """Every query gives rows; those of all rows give one each."""
    from wrackline.llm import queries

    documents = spark.read.parquet(f"{data}/documents.parquet").count()
    for name in ("p1_found", "p2_found", "p3_found", "p5_found", "p7_found", "p10_found"):
        found = queries.QUERIES[name](spark, data)
        assert found.count() == found.distinct().count() > 0
    for name in ("p8_ids", "p10_levels"):
        assert queries.QUERIES[name](spark, data).count() == documents
    assert queries.QUERIES["p2_dom_body"](spark, data).count() == spark.read.parquet(f"{data}/warc_records.parquet").count()


# --- trees ------------------------------------------------------------------------------


def _html(i, extra=""):
    menu = "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in ("Home", "News", "About"))
    return f"<html><head><title>t</title><script>x</script></head><body><div><ul>{menu}</ul></div><div><h1>Story {i}</h1><p>Text <b>{i}</b> of the day.</p>{extra}<p>More in {i * 7}.</p></div><div>Imprint<br>All rights</div></body></html>"


def test_dom_template_of_one_host(spark):
    """Constant nodes of one host's trees are boilerplate, varying slots are the body; nulls, repeats and small hosts."""
    rows_ = [(i, "h.test", f"u{i}", _html(i, "<p>Note</p>" if i == 3 else "")) for i in range(12)] + [(11, "h.test", "u11", _html(11)), (20, "s.test", "u", _html(20)), (21, "h.test", "x", None), (22, None, None, _html(22)), (23, "h.test", "y", "")]
    df = spark.createDataFrame(rows_, "id bigint, host string, url string, page string").withColumn("h", F.lit("clash"))
    from wrackline.llm import dom

    got = [(r["id"], r["aligned"], r["body"]) for r in dom.page_bodies(df, "id", "host", "url", "page").collect()]
    assert len(got) == len(rows_)
    for k, aligned, text in got:
        if k < 12:
            assert aligned and text == f"Story {k}\nText {k} of the day.\n" + ("Note\n" if k == 3 else "") + f"More in {k * 7}."
    rest = {k: (aligned, text) for k, aligned, text in got if k >= 20}
    assert rest[21][1] is None and rest[23][1] is None and not rest[20][0] and rest[20][1].startswith("Home\nNews\nAbout\nStory 20")
    assert dom.page_bodies(df.limit(0), "id", "host", "url", "page").count() == 0


def test_tree_matching_equals_brute_force():
    """The alignment has the greatest number of equal texts of all order-preserving ones."""
    from wrackline.llm import dom

    def best(a, b):
        if a.tag != b.tag or a.text != b.text:
            return -1
        if a.text is not None:
            return 1

        def go(i, j):
            if i == len(a.children) or j == len(b.children):
                return 0
            w = best(a.children[i], b.children[j])
            return max(go(i + 1, j), go(i, j + 1), w + go(i + 1, j + 1) if w >= 0 else 0)

        return go(0, 0)

    rng = random.Random(4)

    def tree(depth=0):
        return "".join(rng.choice(["x", "y", "z"]) + "<br>" if depth == 2 or rng.random() < 0.5 else f"<{(t := rng.choice(['p', 'ul']))}>{tree(depth + 1)}</{t}>" for _ in range(rng.randint(1, 3)))

    for _ in range(60):
        a, b = dom.parse(tree()), dom.parse(tree())
        assert len(dom.matched(a, b)[1]) == best(a, b)
