"""Aggregations over captures: host reports, statistics, yearly datasets, links, samples, facets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wrackline.functions import urls
from wrackline.operators import filters


def frequencies(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, n): count of each value per key; partial counts before the shuffle."""
    return df.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))


def distinct_values(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.select(key, value).distinct()


def hosts_report(log: DataFrame, line: str = "log_line") -> DataFrame:
    """Per host: urls, bytes, robots, and urls and bytes found to be duplicates (both spellings of the mark)."""
    rows = log.select(F.split(F.col(line), r"\s+").alias("t")).where(filters.log_line_valid(F.col("t")))
    t = lambda i: F.get(F.col("t"), F.lit(i))
    size = F.when(t(2) == "-", F.lit(0)).otherwise(t(2).try_cast("bigint"))
    dup = t(11).contains("warcRevists:digest") | t(11).contains("warcRevisit:digest")
    picked = rows.select(urls.crawl_log_host(t(3)).alias("host"), F.coalesce(size, F.lit(0)).alias("size"), (t(1) == "-9998").alias("robots"), dup.alias("dup"))
    return picked.groupBy("host").agg(
        F.count(F.lit(1)).alias("urls"),
        F.sum("size").alias("bytes"),
        F.count_if("robots").alias("robots"),
        F.count_if("dup").alias("dup_urls"),
        F.coalesce(F.sum(F.when(F.col("dup"), F.col("size"))), F.lit(0)).alias("dup_bytes"),
    )


def record_stats(df: DataFrame, record_type: Column, media: Column, date: Column, url: Column) -> DataFrame:
    """(stat, value, n): totals, types, content types, years, malformed dates, hosts, missing URLs; one pass."""
    web = F.regexp_extract(url, r"^https?://(?:[^/?#@]*@)?([^/?#]+)", 1)
    pair = lambda stat, value: F.struct(F.lit(stat).alias("stat"), value.cast("string").alias("value"))
    none = F.lit(None).cast("string")
    good = F.length(date) > 4
    stats = F.array(
        pair("RECORD-TOTAL", none),
        pair("WARC-RECORD-TYPE", record_type),
        pair("CONTENT-TYPE", media),
        F.when(good, pair("YEAR", F.substring(date, 1, 4))).otherwise(pair("MALFORMED-DATE", none)),
        F.when(url.isNull(), pair("NULL-URI-TOTAL", none)).when(web != "", pair("HOSTS", web)),
    )
    return df.select(F.explode(stats).alias("s")).where("s IS NOT NULL").select("s.stat", "s.value").groupBy("stat", "value").agg(F.count(F.lit(1)).alias("n"))


def datasets(df: DataFrame, year: str, host: str, formats: Column, linked: str) -> DataFrame:
    """(dataset, year, value, n): hosts, formats and host links per year; one scan, one shuffle."""
    empty = F.array().cast("array<string>")
    tag = lambda name, values: F.transform(values, lambda v: F.struct(F.lit(name).alias("dataset"), v.alias("value")))
    one = lambda c: F.array_compact(F.array(c))
    pairs = F.transform(F.coalesce(F.col(linked), empty), lambda h: F.concat_ws("\t", F.col(host), h))
    all_ = F.concat(tag("hosts", one(F.col(host))), tag("formats", one(formats)), tag("hostLinks", pairs))
    return df.select(F.col(year).alias("year"), F.explode(all_).alias("d")).select("d.dataset", "year", "d.value").groupBy("dataset", "year", "value").agg(F.count(F.lit(1)).alias("n"))


def outlinks(df: DataFrame, year: str, host: str, linked: str, record_type: str, url: str) -> DataFrame:
    """(year, host, linked_host, n) of responses of http URLs."""
    rows = df.where(F.col(host).isNotNull() & filters.has_outlinks(F.col(record_type), F.col(url))).select(year, host, F.explode(linked).alias("linked_host"))
    return rows.groupBy(year, host, "linked_host").agg(F.count(F.lit(1)).alias("n"))


def inlink_suffixes(df: DataFrame, year: str, host: str, linked: str, suffixes: tuple[str, ...] = urls.SUFFIXES) -> DataFrame:
    """(year, target_suffix, source_suffix, n): each page counts once per target suffix."""
    target = F.array_distinct(F.transform(F.col(linked), lambda h: urls.public_suffix(h, suffixes)))
    rows = df.where(F.col(host).isNotNull()).select(F.col(year), urls.public_suffix(F.col(host), suffixes).alias("source_suffix"), F.explode(target).alias("target_suffix"))
    return rows.groupBy(year, "target_suffix", "source_suffix").agg(F.count(F.lit(1)).alias("n"))


def pattern_matches(df: DataFrame, date: Column, url: str, text: str, pattern: str, max_chars: int = 1 << 20) -> DataFrame:
    """(capture, match): distinct matches of a pattern per capture in the first ``max_chars`` of its text."""
    found = F.regexp_extract_all(F.substring(F.col(text), 1, max_chars), F.lit(f"({pattern})"), F.lit(1))
    return df.select(F.concat_ws("/", date, F.col(url)).alias("capture"), F.explode(F.array_distinct(found)).alias("match")).distinct()


def file_digests(files: DataFrame, algorithm: str = "sha512") -> DataFrame:
    """(digest, length, path) of whole files read by the binary source."""
    digest = F.md5("content") if algorithm == "md5" else F.sha2("content", int(algorithm.removeprefix("sha")))
    return files.select(digest.alias("digest"), F.length("content").alias("length"), "path")


def sample_per_key(df: DataFrame, key: str, value: str, n: int = 1000, seed: int = 1231241245) -> DataFrame:
    """At most ``n`` rows per key with the least hash of (seed, value): the same rows for any layout of the data.

    Each hash bucket of a key is cut to ``n`` rows first, so that a hot key is
    never sorted by one task; only ``n`` rows per bucket meet in the last step.
    """
    order = F.xxhash64(F.lit(seed), F.col(value))
    rows = df.withColumn("_o", order).withColumn("_b", F.pmod(F.shiftright(F.xxhash64(F.col(value), F.lit(seed)), 3), F.lit(64)))
    first = rows.withColumn("_r", F.row_number().over(Window.partitionBy(key, "_b").orderBy("_o", value))).where(F.col("_r") <= n)
    last = first.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy("_o", value))).where(F.col("_r") <= n)
    return last.drop("_o", "_b", "_r")


def header_records(records: DataFrame) -> DataFrame:
    """(key, record): all headers of a record as one JSON map, keyed by type and digest."""
    warc = F.transform_keys("warc_headers", lambda k, _: F.concat(F.lit("HEADER-"), k))
    http = F.map_from_entries(F.transform(F.array_distinct(F.transform("http_headers", lambda h: F.lower(h["name"]))), lambda n: F.struct(F.concat(F.lit("HTTP-"), n).alias("key"), F.element_at(F.filter("http_headers", lambda h: F.lower(h["name"]) == n), 1)["value"].alias("value"))))
    headers = F.map_concat(warc, F.coalesce(http, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))))
    key = F.concat_ws(":", F.col("warc_headers")["WARC-Type"], F.col("warc_headers")["WARC-Payload-Digest"])
    return records.select(key.alias("key"), F.to_json(headers).alias("record"))


def facet(df: DataFrame, field: Column, limit: int = 100, name: str = "value") -> DataFrame:
    """The most frequent values of a field (an array counts each value), most frequent first, ties by value."""
    counted = df.select(field.alias(name)).where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), name).limit(limit)


def facet_exists(df: DataFrame, field: Column, name: str = "value") -> DataFrame:
    """The distinct values of a field, without counts."""
    return df.select(field.alias(name)).where(F.col(name).isNotNull()).distinct()


def best_per_group(df: DataFrame, group: str, order: Sequence[Column]) -> DataFrame:
    """One row per group, the first by ``order``, as an algebraic minimum: hot groups reduce map-side."""
    picked = F.min_by(F.struct(*df.columns), F.struct(*order))
    return df.where(F.col(group).isNotNull()).groupBy(F.col(group).alias("_g")).agg(picked.alias("_row")).select("_row.*")


def rollup_sizes(df: DataFrame, keys: Sequence[str], size: str) -> DataFrame:
    """Sum, mean and count of sizes for each level of the keys."""
    return df.rollup(*keys).agg(F.sum(size).alias("total"), F.avg(size).alias("mean"), F.count(size).alias("n"))


def timings(df: DataFrame, step: str, parent: str, ms: str, top: int = 20) -> DataFrame:
    """Count, sum and mean of step times, the ``top`` longest of each parent."""
    per = df.groupBy(parent, step).agg(F.count(F.lit(1)).alias("n"), F.sum(ms).alias("total_ms"), F.avg(ms).alias("mean_ms"))
    return per.withColumn("_r", F.row_number().over(Window.partitionBy(parent).orderBy(F.desc("total_ms"), step))).where(F.col("_r") <= top).drop("_r")


def cdx_lines(df: DataFrame, columns: Sequence[str] = ("urlkey", "wayback_date", "original", "mime", "status", "digest", "redirect", "meta", "compressed_length", "source_file_offset", "filename")) -> DataFrame:
    """(value): lines of a capture index, columns joined by a space, missing ones ``-``."""
    return df.select(F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]).alias("value"))


def sorted_index(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Index lines in total order (sampled range partitioning)."""
    ranged = df.repartitionByRange(partitions, "urlkey", "wayback_date") if partitions else df.repartitionByRange("urlkey", "wayback_date")
    return ranged.sortWithinPartitions("urlkey", "wayback_date")


def split_partitions(df: DataFrame, key: str, points: Sequence[str]) -> DataFrame:
    """``df`` with ``part``: the number of split points at or below the key (below the first: 0)."""
    return df.withColumn("part", F.size(F.filter(F.array(*[F.lit(p) for p in sorted(points)]).cast("array<string>"), lambda p: p <= F.col(key))))


def shuffled(df: DataFrame, partitions: int, seed: int = 1231241245) -> DataFrame:
    """Rows spread evenly over ``partitions`` in an order without regard to their content, the same at every run."""
    order = F.xxhash64(F.lit(seed), F.to_json(F.struct(*df.columns)))
    return df.withColumn("_o", order).repartition(partitions, "_o").sortWithinPartitions("_o").drop("_o")
