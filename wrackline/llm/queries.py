"""Queries of the training-data problems, named pN_..., and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wrackline.functions import html
from wrackline.llm import boilerplate, bpe, dom, garbled, langid, lines, pack, reading, segments, spam, truncated
from wrackline.session import staged, table


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document by byte_bpe_50k."""
    return bpe.encode_column(table(spark, sf_dir, "documents"), "doc_id", "text", bpe.tokenizer_file("byte_bpe_50k"))


def p9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in containers of each capacity of pack_sizes."""
    return pack.pack_texts(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "pack_sizes"))


def p9_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per capacity: containers used, the least possible number, and the share of room used."""
    fill = p9_pack(spark, sf_dir).groupBy("pack_id", "container").agg(F.sum("n_tokens").alias("used"), F.count(F.lit(1)).alias("pieces"))
    per = fill.groupBy("pack_id").agg(F.count(F.lit(1)).alias("containers"), F.sum("used").alias("tokens"), F.max("used").alias("fullest"), F.sum("pieces").alias("pieces"))
    sizes = table(spark, sf_dir, "pack_sizes").select("pack_id", "capacity")
    return per.join(F.broadcast(sizes), "pack_id").withColumn("least_containers", F.ceil(F.col("tokens") / F.col("capacity"))).withColumn("fill", F.col("tokens") / (F.col("containers") * F.col("capacity")))


def _by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mementos with the five-year period of their capture, by which they are loaded."""
    return table(spark, sf_dir, "mementos").withColumn("_period", (F.col("crawl_year") - F.pmod("crawl_year", F.lit(5))).cast("int"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines on at least 5 urls of their domain, loaded period by period."""
    return lines.incremental_lines(_by_period(spark, sf_dir), "id_long", "domain", "url", "content", "_period")


def p4_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every memento's content without such lines."""
    return lines.incremental_clean(_by_period(spark, sf_dir), "id_long", "domain", "url", "content", "_period")


def p1_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of the segments of every page's running text, with confidence."""
    pages = table(spark, sf_dir, "mementos")
    samples = [(r["lang"], r["text"]) for r in table(spark, sf_dir, "lang_samples").where("lang IS NOT NULL AND text IS NOT NULL").limit(langid.MAX_SAMPLES).collect()]
    return segments.page_segments(pages, "id_long", boilerplate.wrapper_for(pages, garbled.learn(pages, ["content", "title"])), langid.LanguageModel(segments.with_copies(samples)))


def p1_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of every page with letters."""
    return segments.page_languages(p1_segments(spark, sf_dir), "id_long")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of pages whose label is missing or wrong, or whose running text is mixed."""
    return segments.mislabelled(table(spark, sf_dir, "mementos"), "id_long", "content_language", p1_segments(spark, sf_dir))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of content that are not part of the page's main body."""
    pages = table(spark, sf_dir, "mementos")
    return boilerplate.boilerplate_lines(pages, "id_long", boilerplate.wrapper_for(pages, garbled.learn(pages, ["content", "title"])))


def p2_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main body of every memento with content."""
    pages = table(spark, sf_dir, "mementos")
    return boilerplate.bodies(pages, "id_long", boilerplate.wrapper_for(pages, garbled.learn(pages, ["content", "title"])))


def p2_dom_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The body of every raw HTML response by alignment of its DOM tree with its host's template."""
    rows = table(spark, sf_dir, "warc_records").join(table(spark, sf_dir, "mementos").select("id_long", "host", "url"), "id_long", "left")
    pages = rows.withColumn("page", html.decode_page(F.col("payload"), html.charset_of(F.col("payload"), F.lit(None).cast("string"))))
    return dom.page_bodies(pages, "id_long", "host", "url", "page")


def p9_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of the packing per capacity, all to be 0: containers over capacity, documents missing, texts split without need."""
    packed = staged(p9_pack(spark, sf_dir), "packed")
    sizes = table(spark, sf_dir, "pack_sizes").select("pack_id", "capacity")
    over = packed.groupBy("pack_id", "container").agg(F.sum("n_tokens").alias("used")).join(F.broadcast(sizes), "pack_id").groupBy("pack_id").agg(F.count_if(F.col("used") > F.col("capacity")).alias("over"))
    texts = packed.groupBy("pack_id", "doc_id").agg(F.count(F.lit(1)).alias("pieces"), F.sum("n_tokens").alias("tokens")).join(F.broadcast(sizes), "pack_id")
    needless = texts.groupBy("pack_id").agg(F.count_if(F.col("pieces") != F.greatest(F.ceil(F.col("tokens") / F.col("capacity")), F.lit(1))).alias("needless"), F.count(F.lit(1)).alias("n_docs"))
    total = table(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("n")).scalar()
    return over.join(needless, "pack_id").select("pack_id", "over", "needless", (total - F.col("n_docs")).alias("missing"))


def p3_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Garbled values of content and title with their restored text."""
    return garbled.restore(table(spark, sf_dir, "mementos"), "id_long", ["content", "title"])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Garbled values of content and title."""
    pages = table(spark, sf_dir, "mementos")
    return garbled.garbled_values(pages, "id_long", ["content", "title"], garbled.learn(pages, ["content", "title"])).select("id_long", "field_name")


def p5_judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence on every memento whose content ends open."""
    return truncated.judge(table(spark, sf_dir, "mementos"), "id_long", "content", "url", "domain", "content_text_length")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mementos whose content was cut inside a line."""
    return p5_judged(spark, sf_dir).where("cut").select("id_long")


def p5_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of cut contents per host."""
    return truncated.source_rates(table(spark, sf_dir, "mementos"), "id_long", "host", "content", p5_found(spark, sf_dir))


def p7_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prose and list letters of every memento with content, and whether lists prevail."""
    pages = table(spark, sf_dir, "mementos")
    return spam.rate_pages(pages, "id_long", boilerplate.wrapper_for(pages, garbled.learn(pages, ["content", "title"])))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose main text is mostly keywords, links or tags."""
    return p7_pages(spark, sf_dir).where("flagged").select("id_long")


def p10_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and reading level of every document."""
    return reading.rate(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "graded_texts"), table(spark, sf_dir, "lang_samples"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in a graded language, of at least 40 words, whose level is 4 or 5."""
    return p10_levels(spark, sf_dir).where("anchored AND n_words >= 40 AND reading_level >= 4").select("doc_id")


def p10_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the corpus by language and reading level."""
    return p10_levels(spark, sf_dir).groupBy("lang", "anchored", "reading_level").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_words").alias("n_words"))


_P4_LINES = """
    WITH l AS (
        SELECT id_long, domain, url, unnest(string_split(content, chr(10))) AS line,
               unnest(range(1, len(string_split(content, chr(10))) + 1)) AS line_no
        FROM mementos WHERE domain IS NOT NULL AND url IS NOT NULL AND content IS NOT NULL),
    f AS (SELECT id_long, domain, url, CAST(line_no AS INT) AS line_no, trim(regexp_replace(lower(line), '[^\\p{L}\\p{M}]+', ' ', 'g')) AS form FROM l),
    k AS (SELECT domain, form FROM f WHERE form <> '' GROUP BY domain, form HAVING count(DISTINCT url) >= 5)"""

QUERIES = {"p8_ids": p8_ids, "p9_pack": p9_pack, "p9_summary": p9_summary, "p9_checks": p9_checks, "p4_found": p4_found, "p4_clean": p4_clean, "p1_found": p1_found, "p1_segments": p1_segments, "p1_pages": p1_pages, "p2_found": p2_found, "p2_body": p2_body, "p2_dom_body": p2_dom_body, "p3_found": p3_found, "p3_restored": p3_restored, "p5_found": p5_found, "p5_judged": p5_judged, "p5_rates": p5_rates, "p7_found": p7_found, "p7_pages": p7_pages, "p10_found": p10_found, "p10_levels": p10_levels, "p10_profile": p10_profile}

SQL: dict[str, str] = {
    "p4_found": _P4_LINES + " SELECT id_long, line_no FROM f JOIN k USING (domain, form)",
    "p4_clean": _P4_LINES
    + """, cut AS (SELECT DISTINCT id_long, line_no FROM f JOIN k USING (domain, form)),
        kept AS (SELECT id_long, string_agg(line, chr(10) ORDER BY l.line_no) AS content_clean FROM l LEFT JOIN cut USING (id_long, line_no) WHERE cut.line_no IS NULL GROUP BY id_long)
        SELECT m.id_long, CASE WHEN m.id_long IN (SELECT id_long FROM cut) THEN coalesce(content_clean, '') ELSE content END AS content_clean FROM mementos m LEFT JOIN kept USING (id_long)""",
    "p9_checks": "SELECT pack_id, CAST(0 AS BIGINT) AS over, CAST(0 AS BIGINT) AS needless, CAST(0 AS BIGINT) AS missing FROM pack_sizes WHERE pack_id IS NOT NULL",
}
