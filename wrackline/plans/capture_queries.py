"""Queries of the capture operators over the test tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wrackline.functions import content_types, dates, payload, text, urls
from wrackline.operators import annotate, captures, documents, filters, grams, jobs, names, nearest, search
from wrackline.session import new_folder, staged, table
from wrackline.sinks import writers
from wrackline.streaming import streams

QUERIES = {}
SQL: dict[str, str] = {}


#: Suffixes of two labels of the invented hosts of the test tables.
TEST_SUFFIXES = ("co.example", "org.test")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- URL and host functions (F7-F15, C7-C9) ----------------------------------------------

_HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1))"
_VALID = "regexp_matches(h, '^(?:[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?\\.)*[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?$') AND length(h) <= 255"


@query(
    f"""WITH a AS (SELECT id_long, url, {_HOST} AS h,
                      regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS p,
                      split_part(split_part(list_last(string_split(url, '/')), '?', 1), '&', 1) AS r FROM mementos)
        SELECT id_long, CASE WHEN url IS NULL THEN NULL WHEN {_VALID} THEN h ELSE 'malformed.host' END AS host,
               CASE WHEN p = '' THEN '/' ELSE p END AS path,
               CASE WHEN p IN ('', '/') OR regexp_matches(p, '^/index\\.[a-z]+$') THEN 'slashpage' WHEN p = '/robots.txt' THEN 'robots.txt' ELSE 'normal' END AS url_type,
               r AS resourcename, regexp_replace(lower(regexp_extract(r, '\\.([^.]*)$', 1)), '[^0-9a-z]', '', 'g') AS extension
        FROM a"""
)
def url_parts(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return table(spark, d, "mementos").select("id_long", urls.host(u).alias("host"), urls.path(u).alias("path"), urls.url_type(u).alias("url_type"), urls.resource_name(u).alias("resourcename"), urls.extension(u).alias("extension"))


_LEVELS = "list_transform(range(1, len(string_split({h}, '.')) + 1), lambda i: array_to_string(list_slice(string_split({h}, '.'), len(string_split({h}, '.')) - i + 1, len(string_split({h}, '.'))), '.'))"


@query(
    f"""WITH h AS (SELECT host FROM mementos WHERE host IS NOT NULL AND host <> 'malformed.host' AND NOT regexp_matches(host, '^[0-9.]+$')),
             l AS (SELECT unnest({_LEVELS.format(h="host")}) AS level FROM h)
        SELECT '(' || array_to_string(list_reverse(string_split(level, '.')), ',') || ',' AS surt, count(*) AS n FROM l GROUP BY 1"""
)
def surt_level_counts(spark: SparkSession, d: str) -> DataFrame:
    levels = table(spark, d, "mementos").where("host IS NOT NULL").select(F.explode(urls.host_surts(F.col("host"))).alias("surt"))
    return levels.groupBy("surt").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT host, CASE WHEN host = 'malformed.host' THEN NULL WHEN list_slice(string_split(host, '.'), -2, -1) IN (['co', 'example'], ['org', 'test']) THEN array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') ELSE list_last(string_split(host, '.')) END AS public_suffix, count(*) AS n FROM mementos WHERE host IS NOT NULL GROUP BY 1, 2")
def host_suffixes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "mementos").where("host IS NOT NULL").groupBy("host").agg(F.count(F.lit(1)).alias("n")).select("host", urls.public_suffix(F.col("host"), TEST_SUFFIXES).alias("public_suffix"), "n")


@query("SELECT id_long, regexp_replace(strftime(crawl_date, '%Y%m%d%H%M%S'), '[^0-9]', '', 'g') || '/' || base64(unhex(md5(url))) AS id FROM mementos WHERE url IS NOT NULL")
def capture_id(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "mementos").where("url IS NOT NULL").select("id_long", payload.capture_id(F.date_format("crawl_date", "yyyyMMddHHmmss"), F.col("url")).alias("id"))


@query("SELECT id_long, CAST(strftime(crawl_date, '%Y%m%d%H%M%S') AS BIGINT) AS stamp, CAST(year(crawl_date) AS INT) AS crawl_year, wayback_date // 10000000000 AS stamp_year FROM mementos WHERE crawl_date IS NOT NULL AND wayback_date IS NOT NULL")
def capture_dates(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "mementos").where("crawl_date IS NOT NULL AND wayback_date IS NOT NULL")
    stamp = F.date_format("crawl_date", "yyyy-MM-dd HH:mm:ss")
    return rows.select("id_long", dates.wayback_date(stamp).alias("stamp"), F.year("crawl_date").alias("crawl_year"), dates.year(F.col("wayback_date").cast("string")).cast("bigint").alias("stamp_year"))


@query()
def canonical_urls(spark: SparkSession, d: str) -> DataFrame:
    """Canonical and error-fixed form of every URL (byte-level, no SQL twin)."""
    return table(spark, d, "mementos").select("id_long", urls.canonical_url(F.col("url")).alias("url_canonical"), urls.fix_url_errors(F.col("url")).alias("url_fixed"))


@query("SELECT id_long, url_surt AS urlkey FROM (SELECT id_long, url, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1) AS h, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(.*)$', 1) AS r, CASE WHEN h = '' THEN url ELSE '(' || array_to_string(list_reverse(string_split(regexp_replace(lower(h), '^www[0-9]*\\.', ''), '.')), ',') || ',)' || r END AS url_surt FROM mementos)")
def url_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "mementos").select("id_long", urls.url_surt(F.col("url")).alias("urlkey"))


# --- text functions (F20, F24, F25, T1-T5) -------------------------------------------------


@query("SELECT doc_id, nullif(substr(trim(regexp_replace(regexp_replace(coalesce(text, ''), '[\\x00-\\x1f\\x7f]', '', 'g'), '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g'), ' '), 1, 200), '') AS adjusted FROM documents")
def text_adjust(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.adjust(F.col("text"), 200).alias("adjusted"))


@query("SELECT term, count(*) AS n FROM (SELECT unnest(string_split_regex(lower(text), '[^\\pL\\pN]+')) AS term FROM documents WHERE text IS NOT NULL) WHERE term <> '' GROUP BY term ORDER BY n DESC, term LIMIT 1000")
def top_terms(spark: SparkSession, d: str) -> DataFrame:
    return search.top_terms(table(spark, d, "documents"), "text", 1000)


@query("SELECT id_long, list_sort(list_distinct(flatten([list_transform(range(1, length(title) - n + 2), lambda i: substr(title, i, n)) for n in [2, 3, 4, 5] if length(title) >= n]))) AS grams FROM mementos WHERE title IS NOT NULL")
def title_ngrams(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "mementos").where("title IS NOT NULL").select("id_long", F.sort_array(F.array_distinct(text.char_ngrams(F.col("title")))).alias("grams"))


@query("WITH w AS (SELECT id_long, list_filter(string_split_regex(lower(title), '[^\\pL\\pN]+'), lambda x: x <> '') AS t FROM mementos WHERE title IS NOT NULL) SELECT id_long, flatten([list_transform(range(1, len(t) - n + 2), lambda i: array_to_string(list_slice(t, i, i + n - 1), ' ')) for n in [2, 3] if len(t) >= n]) AS shingles FROM w")
def title_shingles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "mementos").where("title IS NOT NULL").select("id_long", text.shingles(text.tokens(F.col("title")), 2, 3).alias("shingles"))


@query(
    """WITH t AS (SELECT concat('Send it to ', substr('ABDEGHLNS', CAST(c_custkey % 9 + 1 AS INT), 1), c_custkey % 10, ' ', c_nationkey % 10, 'AB', ', ', substr('KLMNO', CAST(c_custkey % 5 + 1 AS INT), 1), 'T', c_custkey % 7 + 1, ' 1QX or KT1 1QV.') AS text FROM customer)
        SELECT p AS postcode, split_part(p, ' ', 1) AS district, CAST(count(*) AS BIGINT) AS n
        FROM (SELECT unnest(list_distinct(regexp_extract_all(text, '[A-Z]{1,2}[0-9R][0-9A-Z]? [0-9][ABD-HJLNP-UW-Z]{2}'))) AS p FROM t) GROUP BY ALL"""
)
def postcode_counts(spark: SparkSession, d: str) -> DataFrame:
    """Postcodes in texts made of customers' numbers; the test tables hold none."""
    letter = lambda letters, n: F.substring(F.lit(letters), (F.col("c_custkey") % n + 1).cast("int"), F.lit(1))
    made = F.concat(F.lit("Send it to "), letter("ABDEGHLNS", 9), F.col("c_custkey") % 10, F.lit(" "), F.col("c_nationkey") % 10, F.lit("AB, "), letter("KLMNO", 5), F.lit("T"), F.col("c_custkey") % 7 + 1, F.lit(" 1QX or KT1 1QV."))
    found = table(spark, d, "customer").select(F.explode(text.postcodes(made)).alias("postcode"))
    return found.select("postcode", F.get(text.postcode_districts(F.col("postcode")), F.lit(0)).alias("district")).groupBy("postcode", "district").agg(F.count(F.lit(1)).alias("n"))


# --- content types (C13, C21) ---------------------------------------------------------------

_LADDER = """CASE WHEN regexp_matches(m, '^image/') THEN 'image' WHEN regexp_matches(m, '^audio/|^application/vnd\\.rn-realaudio$') THEN 'audio'
    WHEN regexp_matches(m, '^video/|^application/(mp4|vnd\\.rn-realmedia)$') THEN 'video' WHEN regexp_matches(m, '^(text/htm|application/xhtml)') THEN 'html'
    WHEN regexp_matches(m, '^application/pdf') THEN 'pdf' WHEN regexp_matches(m, 'word$') THEN 'word' WHEN regexp_matches(m, 'excel$') THEN 'excel'
    WHEN regexp_matches(m, 'powerpoint$') THEN 'powerpoint' WHEN regexp_matches(m, '^text/plain') THEN 'text' ELSE 'other' END"""


@query(f"SELECT mime, {_LADDER} AS norm, count(*) AS n FROM (SELECT mime, coalesce(mime, '') AS m FROM cdx) GROUP BY ALL")
def content_type_ladder(spark: SparkSession, d: str) -> DataFrame:
    counted = table(spark, d, "cdx").groupBy("mime").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("mime", content_types.norm(F.col("mime")).alias("norm"), "n")


@query("SELECT coalesce(content_type_served, '') || chr(9) || coalesce(content_type, '') || chr(9) AS triple, count(*) AS n FROM mementos GROUP BY 1")
def format_triples(spark: SparkSession, d: str) -> DataFrame:
    triple = content_types.format_triple(F.col("content_type_served"), F.col("content_type"), F.lit(None).cast("string"))
    return table(spark, d, "mementos").groupBy(triple.alias("triple")).agg(F.count(F.lit(1)).alias("n"))


# --- filters (P1-P20, J9) ---------------------------------------------------------------------


@query("SELECT id_long FROM mementos WHERE (record_type IN ('response') OR record_type = 'arc') AND url IS NOT NULL AND starts_with(url, 'http') AND NOT regexp_matches(url, 'robots\\.txt|/tags/') AND (NOT starts_with(url, 'http') OR coalesce(starts_with(CAST(status_code AS VARCHAR), '2'), false))")
def record_filter(spark: SparkSession, d: str) -> DataFrame:
    config = {"record_types": ["response"], "protocols": ["http"], "url_exclude": ["robots\\.txt", "/tags/", " "], "statuses": ["2"]}
    return filters.keep_captures(table(spark, d, "mementos"), config).select("id_long")


@query("SELECT id_long FROM mementos m WHERE NOT EXISTS (SELECT 1 FROM annotation_rules r WHERE r.scope = 'root' AND r.rule_key <> '' AND starts_with(m.url, r.rule_key))")
def url_exclusion(spark: SparkSession, d: str) -> DataFrame:
    prefixes = table(spark, d, "annotation_rules").where("scope = 'root'").select(F.col("rule_key").alias("prefix"))
    return filters.excluded_by_prefix(table(spark, d, "mementos"), "url", prefixes).select("id_long")


@query("SELECT value FROM (SELECT concat_ws(' ', coalesce(urlkey, '-'), coalesce(CAST(wayback_date AS VARCHAR), '-'), coalesce(original, '-'), coalesce(mime, '-'), coalesce(CAST(status AS VARCHAR), '-'), coalesce(digest, '-'), coalesce(redirect, '-'), coalesce(meta, '-'), coalesce(CAST(compressed_length AS VARCHAR), '-'), coalesce(CAST(source_file_offset AS VARCHAR), '-'), coalesce(filename, '-')) AS value FROM cdx) WHERE instr(value, ' application/http 200 ') <= 1 AND instr(value, ' warc/request ') <= 1 AND instr(value, ' warc/metadata ') <= 1")
def cdx_lines_kept(spark: SparkSession, d: str) -> DataFrame:
    return jobs.cdx_lines(table(spark, d, "cdx")).where(filters.cdx_kept(F.col("value")))


# --- joins (J1-J8, J10-J15) ----------------------------------------------------------------------

_ANNOTATED = f"""
    WITH rules AS (SELECT DISTINCT * FROM annotation_rules WHERE rule_key IS NOT NULL AND scope IS NOT NULL),
    m AS (SELECT id_long, url, regexp_replace(lower(host), '^www\\.', '') AS h, source_file, crawl_date FROM mementos),
    levels AS (SELECT id_long, unnest({_LEVELS.format(h="h")}) AS level FROM m WHERE h IS NOT NULL AND h <> 'malformed.host' AND NOT regexp_matches(h, '^[0-9.]+$')),
    hits AS (
        SELECT m.id_long, r.collection, r.collections, r.subject FROM m JOIN rules r ON r.scope IN ('resource', 'root') AND m.url = r.rule_key
        UNION ALL
        SELECT l.id_long, r.collection, r.collections, r.subject FROM levels l JOIN rules r ON r.scope = 'subdomains'
            AND l.level = regexp_replace(lower(regexp_extract(r.rule_key, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)), '^www\\.', '')
        UNION ALL
        SELECT m.id_long, r.collection, r.collections, r.subject FROM m JOIN rules r ON r.scope = 'source_file_matches' AND regexp_matches(m.source_file, r.rule_key)),
    v AS (
        SELECT id_long, 'collection' AS kind, collection AS value FROM hits WHERE collection <> ''
        UNION ALL SELECT id_long, 'collections', unnest(collections) FROM hits),
    dated AS (
        SELECT v.id_long, kind, value FROM v JOIN mementos USING (id_long) JOIN annotation_ranges g ON v.value = g.collection
        WHERE (g.range_start IS NULL OR crawl_date > g.range_start) AND (g.range_end IS NULL OR crawl_date < g.range_end)
        UNION ALL SELECT id_long, 'subject', s FROM (SELECT id_long, unnest(subject) AS s FROM hits) WHERE s IS NOT NULL)
    SELECT id_long, coalesce(list_sort(list_distinct(list(value) FILTER (kind = 'collection'))), []) AS collection,
           coalesce(list_sort(list_distinct(list(value) FILTER (kind = 'collections'))), []) AS collections,
           coalesce(list_sort(list_distinct(list(value) FILTER (kind = 'subject'))), []) AS subject
    FROM dated GROUP BY id_long"""


@query(_ANNOTATED)
def collection_annotation(spark: SparkSession, d: str) -> DataFrame:
    return annotate.annotate(table(spark, d, "mementos"), "id_long", "url", "host", "source_file", "crawl_date", table(spark, d, "annotation_rules"), table(spark, d, "annotation_ranges"))


@query("WITH p AS (SELECT DISTINCT regexp_replace(host_surt[len(host_surt)], ',$', '') AS prefix FROM mementos WHERE domain IN ('halnykeshwiki.org.test', 'mopesmivenfen.test') AND host_surt IS NOT NULL AND len(host_surt) > 0) SELECT id_long, CASE WHEN EXISTS (SELECT 1 FROM p WHERE starts_with(m.host_surt[len(m.host_surt)], p.prefix)) THEN 'OA' ELSE 'RRO' END AS access_terms FROM mementos m")
def open_access(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "mementos").select("id_long", "domain", F.get("host_surt", F.size("host_surt") - 1).alias("surt"))
    prefixes = pages.where("domain IN ('halnykeshwiki.org.test', 'mopesmivenfen.test') AND surt IS NOT NULL").select(F.regexp_replace("surt", ",$", "").alias("prefix"))
    return annotate.access_terms(pages, "surt", prefixes).select("id_long", "access_terms")


@query("SELECT c_custkey, n_name AS place FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey < 3")
def lookup_join(spark: SparkSession, d: str) -> DataFrame:
    nations = table(spark, d, "nation").where("n_regionkey < 3")
    return annotate.lookup(table(spark, d, "customer"), "c_nationkey", nations, "n_nationkey", "n_name", "place").select("c_custkey", "place")


_REDUP = """
    WITH m AS (SELECT mdx_map AS r, r['digest'] AS digest, coalesce(r['record-type'], '') AS t, coalesce(r['timestamp'], '~') AS ts FROM mdx),
    x AS (SELECT digest, min(ts) AS ts FROM m WHERE digest IS NOT NULL AND digest <> '' AND t = 'response' GROUP BY digest)
    SELECT CASE WHEN m.t = 'revisit' AND x.digest IS NOT NULL THEN 'reduplicated' ELSE m.r['record-type'] END AS record_type, m.r['url'] AS url, m.r['timestamp'] AS stamp, m.digest AS digest
    FROM m LEFT JOIN x ON m.digest = x.digest"""


@query(_REDUP)
def reduplicate(spark: SparkSession, d: str) -> DataFrame:
    """Revisits overlaid on the first response of their digest: the columns SQL can rebuild."""
    m = F.col("mdx_map")
    return captures.reduplicate(table(spark, d, "mdx")).select(m["record-type"].alias("record_type"), m["url"].alias("url"), m["timestamp"].alias("stamp"), m["digest"].alias("digest"))


@query()
def reduplicated_maps(spark: SparkSession, d: str) -> DataFrame:
    """The whole record maps after reduplication, as JSON."""
    return captures.reduplicate(table(spark, d, "mdx")).select(F.to_json("mdx_map").alias("record"))


NAME_RULES = (
    (r"BRM-(weekly|daily)-(\d+)-crawl(\d+)\.warc\.gz", {"harvest_kind": "$1", "harvest_crawl": "$3"}),
    (r"BRM-([a-z]+)-(\d+)-.*", {"harvest_kind": "$1"}),
)


@query("SELECT source_file, CASE WHEN regexp_full_match(source_file, 'BRM-(weekly|daily)-(\\d+)-crawl(\\d+)\\.warc\\.gz') THEN regexp_extract(source_file, '^BRM-(weekly|daily)-', 1) WHEN regexp_full_match(source_file, 'BRM-([a-z]+)-(\\d+)-.*') THEN regexp_extract(source_file, '^BRM-([a-z]+)-', 1) END AS harvest_kind, CASE WHEN regexp_full_match(source_file, 'BRM-(weekly|daily)-(\\d+)-crawl(\\d+)\\.warc\\.gz') THEN regexp_extract(source_file, 'crawl(\\d+)\\.warc\\.gz$', 1) END AS harvest_crawl, count(*) AS n FROM mementos GROUP BY ALL")
def archive_name_fields(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "mementos").groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))
    return names.with_name_fields(files, "source_file", NAME_RULES)


@query("SELECT CASE WHEN regexp_full_match(source_file, 'BRM-(weekly|daily)-(\\d+)-crawl(\\d+)\\.warc\\.gz') THEN 0 WHEN regexp_full_match(source_file, 'BRM-([a-z]+)-(\\d+)-.*') THEN 1 ELSE -1 END AS rule, count(*) AS n, max(source_file) AS last_example FROM mementos GROUP BY 1")
def archive_name_rules(spark: SparkSession, d: str) -> DataFrame:
    return names.rule_counts(table(spark, d, "mementos"), "source_file", NAME_RULES)


_PALETTE = ", ".join(f"({i}, '{n}', {r}, {g}, {b})" for i, (n, r, g, b) in enumerate(nearest.palette()))


@query(f"WITH c AS (SELECT * FROM (VALUES {_PALETTE}) t(i, name, r, g, b)), p AS (SELECT p_partkey, p_partkey * 37 % 256 AS r, p_partkey * 91 % 256 AS g, p_size * 5 % 256 AS b FROM part) SELECT p_partkey, arg_min(name, abs(p.r - c.r) + abs(p.g - c.g) + abs(p.b - c.b) + i / 1000.0) AS colour FROM p, c GROUP BY p_partkey")
def nearest_colour(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, d, "part").select("p_partkey", nearest.nearest_colour((k * 37) % 256, (k * 91) % 256, (F.col("p_size") * 5) % 256).alias("colour"))


@query()
def language_profile(spark: SparkSession, d: str) -> DataFrame:
    """Nearest trigram profile of every document (profiles of the clean samples)."""
    return nearest.nearest_profile(table(spark, d, "documents"), "doc_id", "text", nearest.profiles(table(spark, d, "lang_samples")))


# --- order-dependent (W1, W2, J14) ----------------------------------------------------------------


@query("SELECT id_long, coalesce(lead(source_file_offset) OVER (PARTITION BY source_file ORDER BY source_file_offset), 1000000000000) - source_file_offset AS compressed_length FROM (SELECT min(id_long) AS id_long, source_file, source_file_offset FROM mementos WHERE source_file IS NOT NULL AND source_file_offset IS NOT NULL GROUP BY source_file, source_file_offset)")
def record_lengths(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "mementos").where("source_file IS NOT NULL AND source_file_offset IS NOT NULL").groupBy("source_file", "source_file_offset").agg(F.min("id_long").alias("id_long")).withColumn("size", F.lit(1_000_000_000_000))
    return captures.compressed_length(rows, "source_file", "source_file_offset", "size").select("id_long", "compressed_length")


@query("SELECT event_id, last_value(CASE WHEN event_type = 'click' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS carried FROM events")
def carry_forward(spark: SparkSession, d: str) -> DataFrame:
    return captures.carry_forward(table(spark, d, "events"), "user_id", "event_id", F.col("event_type") == "click", F.col("value"), "carried").select("event_id", "carried")


# --- aggregates (A1-A22) ---------------------------------------------------------------------------


@query(
    """WITH t AS (SELECT string_split_regex(log_line, '\\s+') AS t FROM crawl_log),
        v AS (SELECT CASE WHEN starts_with(t[4], 'dns:') THEN replace(t[4], 'dns:', '') ELSE nullif(regexp_extract(t[4], '^https?://([^/]+)/.*$', 1), '') END AS host,
                     coalesce(CASE WHEN t[3] = '-' THEN 0 ELSE TRY_CAST(t[3] AS BIGINT) END, 0) AS size, t[2] = '-9998' AS robots,
                     contains(t[12], 'warcRevists:digest') OR contains(t[12], 'warcRevisit:digest') AS dup
              FROM t WHERE len(t) = 12 AND (NOT starts_with(t[2], '-') OR t[2] = '-9998'))
        SELECT host, count(*) AS urls, CAST(sum(size) AS BIGINT) AS bytes, CAST(count_if(robots) AS BIGINT) AS robots, CAST(count_if(dup) AS BIGINT) AS dup_urls,
               CAST(coalesce(sum(size) FILTER (dup), 0) AS BIGINT) AS dup_bytes FROM v WHERE host IS NOT NULL GROUP BY host"""
)
def hosts_report(spark: SparkSession, d: str) -> DataFrame:
    return jobs.hosts_report(table(spark, d, "crawl_log"))


@query(
    """WITH r AS (SELECT record_type AS t, content_type AS c, strftime(crawl_date, '%Y-%m-%dT%H:%M:%SZ') AS d, url,
                         regexp_extract(url, '^https?://(?:[^/?#@]*@)?([^/?#]+)', 1) AS h FROM mementos),
        s AS (SELECT 'RECORD-TOTAL' AS stat, NULL AS value FROM r UNION ALL SELECT 'WARC-RECORD-TYPE', t FROM r UNION ALL SELECT 'CONTENT-TYPE', c FROM r
              UNION ALL SELECT CASE WHEN length(d) > 4 THEN 'YEAR' ELSE 'MALFORMED-DATE' END, CASE WHEN length(d) > 4 THEN substr(d, 1, 4) END FROM r
              UNION ALL SELECT CASE WHEN url IS NULL THEN 'NULL-URI-TOTAL' ELSE 'HOSTS' END, CASE WHEN url IS NOT NULL THEN h END FROM r WHERE url IS NULL OR h <> '')
        SELECT stat, value, count(*) AS n FROM s GROUP BY ALL"""
)
def warc_stats(spark: SparkSession, d: str) -> DataFrame:
    return jobs.record_stats(table(spark, d, "mementos"), F.col("record_type"), F.col("content_type"), F.date_format("crawl_date", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.col("url"))


@query(
    """SELECT dataset, year, value, count(*) AS n FROM (
            SELECT 'hosts' AS dataset, crawl_year AS year, host AS value FROM mementos WHERE host IS NOT NULL
            UNION ALL SELECT 'formats', crawl_year, coalesce(content_type_served, '') || chr(9) || coalesce(content_type, '') || chr(9) FROM mementos
            UNION ALL SELECT 'hostLinks', crawl_year, concat_ws(chr(9), host, l) FROM (SELECT crawl_year, host, unnest(links_hosts) AS l FROM mementos)) GROUP BY ALL"""
)
def yearly_datasets(spark: SparkSession, d: str) -> DataFrame:
    formats = content_types.format_triple(F.col("content_type_served"), F.col("content_type"), F.lit(None).cast("string"))
    return jobs.datasets(table(spark, d, "mementos"), "crawl_year", "host", formats, "links_hosts")


@query("SELECT crawl_year, host, linked_host, count(*) AS n FROM (SELECT crawl_year, host, unnest(links_hosts) AS linked_host FROM mementos WHERE host IS NOT NULL AND coalesce(record_type, 'arc') IN ('response', 'arc') AND regexp_matches(url, '^https?://[^/:]+(:[0-9]+)?/')) GROUP BY ALL")
def outlink_counts(spark: SparkSession, d: str) -> DataFrame:
    return jobs.outlinks(table(spark, d, "mementos"), "crawl_year", "host", "links_hosts", "record_type", "url")


_SUFFIX = "CASE WHEN {h} = 'malformed.host' THEN NULL WHEN list_slice(string_split({h}, '.'), -2, -1) IN (['co', 'example'], ['org', 'test']) THEN array_to_string(list_slice(string_split({h}, '.'), -2, -1), '.') ELSE list_last(string_split({h}, '.')) END"


@query(f"SELECT crawl_year, target_suffix, source_suffix, count(*) AS n FROM (SELECT DISTINCT id_long, crawl_year, {_SUFFIX.format(h='host')} AS source_suffix, {_SUFFIX.format(h='l')} AS target_suffix FROM (SELECT id_long, crawl_year, host, unnest(links_hosts) AS l FROM mementos WHERE host IS NOT NULL)) GROUP BY ALL")
def inlink_suffix_counts(spark: SparkSession, d: str) -> DataFrame:
    return jobs.inlink_suffixes(table(spark, d, "mementos"), "crawl_year", "host", "links_hosts", TEST_SUFFIXES)


@query("SELECT DISTINCT CAST(wayback_date AS VARCHAR) || '/' || url AS capture, unnest(regexp_extract_all(substr(content, 1, 1048576), '\\b(?:19|20)\\d\\d\\b')) AS match FROM mementos WHERE content IS NOT NULL AND url IS NOT NULL AND wayback_date IS NOT NULL")
def pattern_matches(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "mementos").where("content IS NOT NULL AND url IS NOT NULL AND wayback_date IS NOT NULL")
    return jobs.pattern_matches(rows, F.col("wayback_date").cast("string"), "url", "content", r"\b(?:19|20)\d\d\b")


@query("SELECT DISTINCT domain, generator AS value FROM (SELECT domain, unnest(generator) AS generator FROM mementos WHERE domain IS NOT NULL)")
def distinct_generators(spark: SparkSession, d: str) -> DataFrame:
    return jobs.distinct_values(table(spark, d, "mementos").where("domain IS NOT NULL").select("domain", F.explode("generator").alias("value")), "domain", "value")


@query()
def sample_per_domain(spark: SparkSession, d: str) -> DataFrame:
    """A repeatable sample of up to 20 captures per domain."""
    return jobs.sample_per_key(table(spark, d, "mementos").where("domain IS NOT NULL").select("domain", "id"), "domain", "id", 20)


@query("SELECT value, count(*) AS n FROM (SELECT unnest(server) AS value FROM mementos) WHERE value IS NOT NULL GROUP BY value ORDER BY n DESC, value LIMIT 20")
def facet_servers(spark: SparkSession, d: str) -> DataFrame:
    return jobs.facet(table(spark, d, "mementos"), F.explode("server"), 20)


@query("SELECT DISTINCT content_language AS value FROM mementos WHERE content_language IS NOT NULL")
def facet_exists_language(spark: SparkSession, d: str) -> DataFrame:
    return jobs.facet_exists(table(spark, d, "mementos"), F.col("content_language"))


@query("SELECT url, id_long, wayback_date FROM (SELECT url, id_long, wayback_date, row_number() OVER (PARTITION BY url ORDER BY wayback_date DESC, id_long) AS r FROM mementos WHERE url IS NOT NULL) WHERE r = 1")
def latest_per_url(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "mementos").select("url", "id_long", "wayback_date")
    return jobs.best_per_group(rows, "url", [-F.col("wayback_date"), F.col("id_long")])


@query("SELECT crawl_year, content_type_norm, CAST(sum(content_length) AS BIGINT) AS total, avg(content_length) AS mean, count(content_length) AS n FROM mementos GROUP BY ROLLUP (crawl_year, content_type_norm)")
def size_rollup(spark: SparkSession, d: str) -> DataFrame:
    return jobs.rollup_sizes(table(spark, d, "mementos"), ["crawl_year", "content_type_norm"], "content_length")


@query("SELECT n_tags, count(*) AS n FROM (SELECT id_long, len(list_distinct(links_hosts)) AS n_tags FROM mementos WHERE links_hosts IS NOT NULL) GROUP BY 1")
def distinct_links_histogram(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "mementos").where("links_hosts IS NOT NULL").groupBy(F.size(F.array_distinct("links_hosts")).cast("bigint").alias("n_tags")).agg(F.count(F.lit(1)).alias("n"))


# --- order, partitions, sets -------------------------------------------------------------------------


@query("SELECT urlkey, wayback_date, digest, part FROM (SELECT *, CASE WHEN urlkey >= 'q' THEN 2 WHEN urlkey >= 'h' THEN 1 ELSE 0 END AS part FROM cdx)")
def index_partitions(spark: SparkSession, d: str) -> DataFrame:
    return jobs.sorted_index(jobs.split_partitions(table(spark, d, "cdx"), "urlkey", ["q", "h"])).select("urlkey", "wayback_date", "digest", "part")


@query("SELECT digest FROM (SELECT DISTINCT digest FROM cdx INTERSECT SELECT DISTINCT replace(hash, 'sha1:', '') FROM mementos)")
def digests_in_both(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "cdx").select("digest").intersect(table(spark, d, "mementos").select(F.replace("hash", F.lit("sha1:"), F.lit("")).alias("digest")))


@query("SELECT digest FROM (SELECT DISTINCT digest FROM cdx EXCEPT SELECT DISTINCT replace(hash, 'sha1:', '') FROM mementos)")
def digests_only_in_index(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "cdx").select("digest").subtract(table(spark, d, "mementos").select(F.replace("hash", F.lit("sha1:"), F.lit("")).alias("digest")))


# --- search (T8-T10, O5) -------------------------------------------------------------------------------

_TOK = "list_filter(string_split_regex(lower(content), '[^\\pL\\pN]+'), lambda x: x <> '')"


@query(
    f"""WITH t AS (SELECT id_long, content, {_TOK} AS t FROM mementos WHERE content IS NOT NULL AND content_type_norm = 'html' AND contains(lower(content), 'harbour') AND contains(lower(content), 'board')),
        s AS (SELECT id_long, content, len(list_filter(t, lambda x: x = 'harbour')) AS a, len(list_filter(t, lambda x: x = 'board')) AS b FROM t)
        SELECT id_long, CAST(a + b AS DOUBLE) * CASE WHEN contains(lower(content), 'harbour board') THEN 2.0 ELSE 1.0 END AS score FROM s WHERE a > 0 AND b > 0
        ORDER BY score DESC, id_long LIMIT 50 OFFSET 10"""
)
def keyword_search(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "mementos").where("content IS NOT NULL")
    return search.search(pages, "harbour board", "content", "id_long", 50, 10, F.col("content_type_norm") == "html").select("id_long", "score")


@query()
def fuzzy_hashes(spark: SparkSession, d: str) -> DataFrame:
    """Fuzzy hash of every title."""
    h = payload.fuzzy_hash(F.col("title"))
    return table(spark, d, "mementos").where("title IS NOT NULL").select("id_long", h.alias("h")).select("id_long", "h.block_size", "h.hash", "h.hash_double")


@query()
def text_fuzzy_hashes(spark: SparkSession, d: str) -> DataFrame:
    """Fuzzy hash of the whole text of every document."""
    h = payload.fuzzy_hash(F.col("text"))
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", h.alias("h")).select("doc_id", "h.block_size", "h.hash", "h.hash_double")


@query()
def similar_texts(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose fuzzy hash is similar to that of another one with an id divisible by 50."""
    hashes = staged(text_fuzzy_hashes(spark, d).select("doc_id", "hash"), "fuzzy-hashes")
    return search.similar_hashes(hashes, "doc_id", "hash", hashes.where(F.col("doc_id") % 50 == 0)).where(F.col("query") != F.col("doc_id"))


@query()
def text_shingles(spark: SparkSession, d: str) -> DataFrame:
    """Runs of two and three words of the text of every document."""
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", text.shingles(text.tokens(F.col("text")), 2, 3).alias("shingles"))


@query()
def text_ngrams(spark: SparkSession, d: str) -> DataFrame:
    """Distinct substrings of two to five characters of the text of every document."""
    return grams.distinct_ngrams(table(spark, d, "documents"), "doc_id", "text")


# --- payloads (C1-C21, X2-X8) ----------------------------------------------------------------------------


@query("SELECT id_long, lower(hex(payload[1:4])) AS first_bytes, octet_length(payload) AS length FROM warc_records")
def payload_first_bytes(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("payload")
    return table(spark, d, "warc_records").select("id_long", F.lower(payload.first_bytes(p)).alias("first_bytes"), F.length(p).cast("bigint").alias("length"))


@query()
def payload_types(spark: SparkSession, d: str) -> DataFrame:
    """Digest and sniffed type of every payload."""
    p = F.col("payload")
    return table(spark, d, "warc_records").select("id_long", payload.payload_digest(p).alias("digest"), payload.sniffed_type(p).alias("sniffed"))


@query()
def shuffled_index(spark: SparkSession, d: str) -> DataFrame:
    """Index lines spread evenly without regard to their keys."""
    return jobs.shuffled(table(spark, d, "cdx"), 8)


@query()
def built_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents of all raw responses: envelope, types, text, links."""
    docs = documents.build_documents(table(spark, d, "warc_records"), documents.Config(statuses=("2",)))
    return docs.select("id_long", "id", "url", "url_norm", "host", "domain", "crawl_date", "crawl_year", "status_code", "content_type", "content_type_norm", "hash", "title", "content", "links", "links_hosts", "elements_used", "parse_error")


@query("SELECT id_long, regexp_replace(warc_headers['WARC-Target-URI'], '^<(.*)>$', '\\1') AS url, TRY_CAST(nullif(regexp_extract(http_status, '^\\S+\\s+(\\d{3})', 1), '') AS INT) AS status_code FROM warc_records")
def record_envelopes(spark: SparkSession, d: str) -> DataFrame:
    return documents.envelope(table(spark, d, "warc_records")).select("id_long", "url", "status_code")


@query(
    """WITH c AS (SELECT regexp_extract(original, '^[A-Za-z]+://([^/?#:]+)', 1) AS h, original AS url, CAST(wayback_date AS VARCHAR) AS w FROM cdx
                  WHERE regexp_matches(regexp_extract(original, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '^/?$|^/index\\.[a-z]+$') AND original LIKE 'http%://%'),
             p AS (SELECT *, string_split(lower(h), '.') AS l, concat_ws('-', substr(w, 1, 4), substr(w, 5, 2), substr(w, 7, 2)) || 'T' || concat_ws(':', substr(w, 9, 2), substr(w, 11, 2), substr(w, 13, 2)) || 'Z' AS d FROM c),
             q AS (SELECT *, array_to_string(list_slice(l, CASE WHEN list_slice(l, -2, -1) IN (['co', 'example'], ['org', 'test']) THEN -3 ELSE -2 END, -1), '.') AS domain, w || '/' || base64(unhex(md5(url))) AS id, replace(replace(replace(url, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS u FROM p)
        SELECT '<record><header><identifier>' || id || '</identifier><datestamp>' || d || '</datestamp></header><metadata><oai_dc:dc><dc:title>' || domain || '</dc:title><dc:identifier>' || u || '</dc:identifier><dc:date>' || d
               || '</dc:date><dc:source>' || domain || '</dc:source></oai_dc:dc></metadata></record>' AS value FROM q"""
)
def oai_slash_pages(spark: SparkSession, d: str) -> DataFrame:
    """Dublin Core records of the slash pages of http URLs in the index."""
    url, stamp = F.col("original"), F.col("wayback_date").cast("string")
    rows = table(spark, d, "cdx").where(filters.protocol_in(url, ["http"])).select(payload.capture_id(stamp, url).alias("id"), url.alias("url"), urls.url_type(url).alias("url_type"), urls.private_suffix(urls.host(url), TEST_SUFFIXES).alias("domain"), F.to_timestamp(stamp, "yyyyMMddHHmmss").alias("crawl_date"), F.lit(None).cast("string").alias("title"))
    return writers.oai_records(rows)


@query()
def header_json(spark: SparkSession, d: str) -> DataFrame:
    """All headers of a record as one JSON map."""
    return jobs.header_records(table(spark, d, "warc_records"))


# --- windows over events (batch twins of the streams) ---------------------------------------------------


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY 1, 2")
def hourly_events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


@query(
    """WITH o AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= ts - INTERVAL '30 minutes' THEN 0 ELSE 1 END AS new FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL),
        s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM o)
        SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k"""
)
def event_sessions(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").where("ts IS NOT NULL AND user_id IS NOT NULL")
    return rows.groupBy(F.session_window("ts", "30 minutes 1 microsecond").alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("start"), "n")


# --- the same as streams over what is there (2.14) --------------------------------------------------------


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS start, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS \"end\", event_type, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY ALL")
def streamed_windows(spark: SparkSession, d: str) -> DataFrame:
    """Captures per hour and type from a stream that runs over all files there are, in complete mode."""
    counted = streams.run_to_folder(streams.captures_per_window(_event_stream(spark, d), "ts", ["event_type"], "1 hour"), new_folder(spark, "streamed-windows"), "complete")
    return counted.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


@query("SELECT DISTINCT event_id, user_id, event_type FROM events WHERE ts IS NOT NULL")
def streamed_first_rows(spark: SparkSession, d: str) -> DataFrame:
    """The first row of each event from a stream that drops repeats within the watermark."""
    first = streams.without_duplicates(_event_stream(spark, d), ["event_id"], "ts")
    return streams.run_to_folder(first.select("event_id", "user_id", "event_type"), new_folder(spark, "streamed-first"))


@query("SELECT event_id, value FROM events e WHERE NOT EXISTS (SELECT 1 FROM annotation_rules r WHERE r.rule_key <> '' AND starts_with(e.event_type, substr(r.rule_key, 1, 1)))")
def streamed_exclusions(spark: SparkSession, d: str) -> DataFrame:
    """Events whose type begins with none of some prefixes that are read anew for each micro-batch."""
    out = new_folder(spark, "streamed-exclusions")
    load = lambda: table(spark, d, "annotation_rules").where("rule_key <> ''").select(F.substring("rule_key", 1, 1).alias("prefix"))
    kept = lambda rows, listed: filters.excluded_by_prefix(rows, "event_type", listed)
    write = lambda rows, number: rows.select("event_id", "value").write.mode("append").parquet(f"{out}/out")
    streams.with_reloaded_exclusions(_event_stream(spark, d), load, kept, write, f"{out}/progress").awaitTermination()
    return spark.read.schema("event_id bigint, value double").parquet(f"{out}/out")


def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    return streams.landing(spark, f"{d}/events.parque[t]", table(spark, d, "events").schema).where("ts IS NOT NULL").withColumn("ts", F.col("ts").cast("timestamp"))


# --- plain relational coverage on the star schema ----------------------------------------------------------


@query("SELECT n_name, CAST(year(o_orderdate) AS INT) AS y, count(DISTINCT o_orderkey) AS orders, sum(l_extendedprice * (1 - l_discount)) AS amount FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY CUBE (n_name, y)")
def order_cube(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount"))
    joined = li.join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.withColumn("y", F.year("o_orderdate")).cube("n_name", "y").agg(F.count(F.lit(1)).alias("orders"), F.sum("amount").alias("amount"))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def customers_without_urgent_orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").join(table(spark, d, "orders").where("o_orderpriority = '1-URGENT'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT l_orderkey, l_linenumber, rank() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS r FROM lineitem QUALIFY r <= 3")
def top_lines_per_supplier(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    r = F.rank().over(Window.partitionBy("l_suppkey").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"))
    return table(spark, d, "lineitem").withColumn("r", r).where("r <= 3").select("l_orderkey", "l_linenumber", F.col("r").cast("bigint").alias("r"))
