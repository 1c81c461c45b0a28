"""Cases that cut-down methods lose: garbled boilerplate, deltas, rare lost words, long lines."""

import pytest
from pyspark.sql import functions as F

from wrackline.llm import boilerplate, garbled, lines, queries

FOOTER = "Utilizamos información básica según nuestra política de protección y los términos."
PAGES = "id_long bigint, url string, host string, domain string, content string, title string, content_language string"


def bad(text):
    return text.encode("utf-8").decode("latin-1")


def pages(footer=FOOTER, hosts=("alpha.test", "betas.test", "gamma.test", "delta.test")):
    """24 pages of four hosts with one footer; on the first page of each host it is wrongly decoded."""
    out = []
    for h in hosts:
        for i in range(6):
            text = f"The council of {h} met number {chr(97 + i)} in the old town hall and talked about a new bridge.\n"
            out.append((len(out), f"http://{h}/{i}", h, h, text + (bad(footer) if i == 0 else footer), None, "en"))
    return out


@pytest.fixture(scope="module")
def folder(spark, data, tmp_path_factory):
    at = tmp_path_factory.mktemp("whole")
    spark.createDataFrame(pages(), PAGES).coalesce(1).write.parquet(f"{at}/mementos.parquet")
    spark.read.parquet(f"{data}/lang_samples.parquet").write.parquet(f"{at}/lang_samples.parquet")
    return str(at)


def test_garbled_footer_is_no_main_text(spark, folder):
    """p7 and p1: a wrongly decoded footer is a template line, as in p2."""
    rated = {r["id_long"]: r["prose"] for r in queries.p7_pages(spark, folder).collect()}
    assert len(rated) == 24 and all(rated[k] == rated[k + 1] for k in range(0, 24, 6))
    assert {r["last_line"] for r in queries.p1_segments(spark, folder).collect()} == {1}


def test_label_returns_restored_lines():
    """p1 scores what a garbled line says, not its wrong characters."""
    fix = garbled.Restorer([garbled.FAMILIES.index(("latin-1", "utf-8"))], {"ía": 50, "lí": 50, "ó ": 50, "ió": 50, "ón": 50}, {"Política": 50, "Información": 50}, {})
    assert boilerplate.Wrapper({}, fix).label(bad("Política Información"), "", None)[0] == ["Política Información"]


def test_deltas_equal_one_load(spark):
    """p4: documents of a later delta lose lines that crossed before, and rebuilt ones do not get them back."""
    rows = [(i, "d", f"u{i}", f"Home {i}\nText {chr(97 + i)}\nFooter", 2001) for i in range(5)]
    rows += [(5 + i, "d", f"v{i}", f"Home\nOther {chr(97 + i)}\nText a", 2002) for i in range(4)]
    rows += [(9, "d", "w", "Home", None), (10, None, "x", "Home", 2002), (11, "d", "y", None, 2003), (12, "d", "z", "Footer\nnew", 2003)]
    df = spark.createDataFrame(rows, "id bigint, domain string, url string, content string, year int")
    args = (df, "id", "domain", "url", "content")
    whole = lines.repeated_lines(*args)
    want = sorted(tuple(r) for r in whole.collect())
    assert sorted(tuple(r) for r in lines.incremental_lines(*args, "year").collect()) == want and (12, 1) in want and (0, 2) in want
    clean = {r["id"]: r["content_clean"] for r in lines.without_lines(df, "id", "content", whole).collect()}
    built = lines.incremental_clean(*args, "year").collect()
    assert len(built) == len(rows) and {r["id"]: r["content_clean"] for r in built} == clean
    assert clean[0] == "" and clean[5] == "Other a" and clean[12] == "new"
    keyed = lines.line_keys(*args)
    state, _ = lines.merge_delta(lines.LineCounts(), keyed.where("id < 5"))
    state, newly = lines.merge_delta(state, keyed.where("id >= 5"))
    second = lines.rebuild(df, "id", "content", keyed, newly, state.crossed, df.where("id >= 5").select("id"))
    assert {r["id"]: r["content_clean"] for r in second.collect()} == {k: v for k, v in clean.items() if k == 0 or k >= 5}
    assert lines.incremental_lines(df.limit(0), *args[1:], "year").count() == 0


def test_rare_lost_words(spark, monkeypatch):
    """p3: a lost word below the share that is broadcast is restored too."""
    monkeypatch.setattr(garbled, "LEAST_SHARE", 0.01)
    rows = [(i, f"El niño añadió un jardín {i}", None) for i in range(200)] + [(900, "El Ni�o a�adi� un jard�n\n\nplain", None), (901, "Qx�zt alone", "(�)"), (902, None, None)]
    df = spark.createDataFrame(rows, "id bigint, content string, title string")
    fixed = {(r["id"], r["field_name"]): (r["restored"], r["n_lines"]) for r in garbled.restore(df, "id", ["content", "title"]).collect()}
    assert fixed == {(900, "content"): ("El Niño añadió un jardín\n\nplain", 1), (901, "content"): ("Qx�zt alone", 1)}


def test_long_garbled_footer(spark, tmp_path):
    """p2: a garbled template line is found at any length."""
    footer = "Utilizamos información básica según nuestra política. La protección también será más rápida aquí. Los términos están allí con atención pública. El teléfono del público está en la última página. Jamás pedirá códigos según nuestra declaración."
    footer = footer + " " + footer.replace("Utilizamos", "También utilizamos")
    assert len(bad(footer)) > 500
    spark.createDataFrame(pages(footer), PAGES).coalesce(1).write.parquet(f"{tmp_path}/mementos.parquet")
    assert sorted(tuple(r) for r in queries.p2_found(spark, str(tmp_path)).collect()) == [(k, 2) for k in range(24)]


def test_units_with_twins_are_decoded_too(spark):
    """p3: a unit is turned back by every family, also where its ASCII letters could have given it a twin."""
    word = "преприятие"
    wrong = "abcd" + word.encode("cp1251").decode("cp1252")
    found = {(garbled.FAMILIES[f], text) for _, f, text in garbled.Decoder(garbled.np.array(sorted({ord(c) for c in word}))).readings(["plain", wrong, ""])}
    assert found >= {(("cp1252", "cp1251"), "abcd" + word)} and all("plain" not in t for _, t in found)


def test_decoder_equals_one_by_one():
    """The vectorised decoding gives what turn_back gives, for known characters."""
    units = ["été", "Ã©tÃ©", "ñandú", "дом", "äîì", "日本", "æ—¥æœ¬", "“x”", "a\x81b", "ÉCOLE", "naïve…", "", "😀é"]
    known = sorted({ord(c) for u in units for c in u} | set(range(0xA0, 0x180)) | set(range(0x400, 0x460)))
    got = set(garbled.Decoder(garbled.np.array(known)).readings(units))
    want = set()
    for k, u in enumerate(units):
        for f, family in enumerate(garbled.FAMILIES):
            back = garbled.turn_back(u, family)
            if back is not None and back != u and not back.isascii() and all(ord(c) < 128 or ord(c) in known for c in back):
                want.add((k, f, back))
    assert got == want


def test_cover(spark):
    """Families are chosen by all sets of explaining families, however many there are."""
    sets = [([1, 2], 5), ([2, 3], 4), ([1], 2), ([4], 2), ([5, 6], 3)]
    assert garbled.cover(spark.createDataFrame(sets, "families array<int>, n bigint")) == [2, 5]
    assert garbled.cover(spark.createDataFrame([], "families array<int>, n bigint")) == []


def test_similarity_over_texts(spark, tmp_path):
    """Fuzzy hashes, near-duplicates, shingles and n-grams are taken over whole texts of documents."""
    from wrackline.plans.capture_queries import QUERIES

    base = " ".join(f"word{k * k % 997} stands in line {k}." for k in range(150))
    texts = [(50, base), (51, base + " One more sentence."), (52, " ".join(f"other {k * 7 % 89} thing" for k in range(150))), (53, None), (54, "ab cd")]
    spark.createDataFrame(texts, "doc_id bigint, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = {name: QUERIES[name](spark, str(tmp_path)).collect() for name in ("text_fuzzy_hashes", "similar_texts", "text_shingles", "text_ngrams")}
    assert {r["doc_id"] for r in got["text_fuzzy_hashes"]} == {50, 51, 52, 54}
    assert [(r["query"], r["doc_id"]) for r in got["similar_texts"]] == [(50, 51)]
    assert {r["doc_id"]: r["shingles"] for r in got["text_shingles"]}[54] == ["ab cd"]
    assert {r["doc_id"]: r["grams"] for r in got["text_ngrams"]}[54] == sorted({"ab cd"[i : i + n] for n in range(2, 6) for i in range(6 - n)})


def test_ngrams_equal_sql_functions(spark, monkeypatch):
    """The Arrow pass gives what Spark's functions give: wide and invalid characters, empty texts, alphabets that fit no integer."""
    from wrackline.functions import text
    from wrackline.operators import grams

    texts = ["ab cd", "", "a", "été ñandú дом 日本語日本 😀é😀é", None, "aaaa\n\0\0b", "xy" * 40, "".join(chr(0x4E00 + 7 * k % 6000) for k in range(9000)), "plain words " * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    df = df.unionByName(spark.sql("SELECT 20L AS doc_id, CAST(X'61C3A9FF80E6976281' AS STRING) AS text")).coalesce(1)
    want = {r[0]: list(r[1]) for r in df.where("text IS NOT NULL").select("doc_id", F.transform(F.sort_array(F.array_distinct(text.char_ngrams(F.col("text")))), lambda g: F.hex(g))).collect()}
    for chunk in (1, 60, 1 << 18):
        monkeypatch.setattr(grams, "CHUNK", chunk)
        got = {r[0]: list(r[1]) for r in grams.distinct_ngrams(df, "doc_id", "text").select("doc_id", F.transform("grams", lambda g: F.hex(g))).collect()}
        assert got == want


def test_dom_template_counts_all_pages(spark):
    """p2: a block on 33 of 60 urls is the host's template, one on 27 is not, whatever a few pages say."""
    from wrackline.llm import dom

    def page(i):
        blocks = ("<div><p>Often here</p></div>" if i * 7 % 60 < 33 else "") + ("<div><p>Rarely here</p></div>" if i * 11 % 60 < 27 else "")
        return f"<html><body><ul><li>Home</li></ul><div><h1>Story {i}</h1></div>{blocks}<div>Imprint</div></body></html>"

    rows = [(60 * h + i, f"h{h}.test", f"u{i}", page(i)) for h in range(12) for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, host string, url string, page string")
    got = {r["id"]: (r["aligned"], r["body"]) for r in dom.page_bodies(df, "id", "host", "url", "page").collect()}
    assert got == {k: (True, f"Story {k % 60}" + ("\nRarely here" if k % 60 * 11 % 60 < 27 else "")) for k in range(720)}
