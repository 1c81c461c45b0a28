"""Collections, subjects and access terms from curators' rules; lookups on small tables.

Rules and ranges are curated by hand. They are broadcast only after a check of
their number (``MAX_RULES``); beyond it the equality scopes are ordinary joins
and file patterns, which have no equality key, are compared in blocks.

Defined results: null rule keys match nothing; a duplicate rule adds nothing;
a collection without a range is never given; range ends are exclusive and null
ends open; rows without a rule have empty arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wrackline.functions import urls
from wrackline.operators.prefixes import values_with_prefix

MAX_RULES = 50_000


def _small(df: DataFrame, limit: int = MAX_RULES) -> DataFrame:
    return F.broadcast(df) if df.count() <= limit else df


def in_range(date: Column, start: Column, end: Column) -> Column:
    """Strictly between; null ends are open."""
    return (start.isNull() | (date > start)) & (end.isNull() | (date < end))


def _key_host(rule_key: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(rule_key, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1)), r"^www\.", "")


def matched_rules(df: DataFrame, key: str, url: str, host: str, source_file: str, rules: DataFrame, host_suffix: bool = True) -> DataFrame:
    """(key, scope, collection, collections, subject) of each rule that fits a row.

    Scopes: ``resource`` and ``root`` by equal URL; ``subdomains`` by the row's
    host or one of its parent hosts (``host_suffix``), ``source_file_matches`` by
    pattern.
    """
    rules = rules.where("rule_key IS NOT NULL AND scope IS NOT NULL").distinct()
    picked = ["scope", "collection", "collections", "subject"]
    rows = df.select(F.col(key), F.col(url).alias("_url"), F.regexp_replace(F.lower(F.col(host)), r"^www\.", "").alias("_host"), F.col(source_file).alias("_file"))
    exact = _small(rules.where("scope IN ('resource', 'root')"))
    out = rows.join(exact, rows["_url"] == exact["rule_key"]).select(key, *picked)
    below = _small(rules.where("scope = 'subdomains'").withColumn("_key_host", _key_host(F.col("rule_key"))).where("_key_host <> ''"))
    parents = rows.where("_host IS NOT NULL").select(key, F.explode(urls.host_levels(F.col("_host")) if host_suffix else F.array("_host")).alias("_level"))
    out = out.unionByName(parents.join(below, F.col("_level") == below["_key_host"]).select(key, *picked))
    patterns = rules.where("scope = 'source_file_matches'")
    # file names repeat over captures: patterns meet each name once, in as many broadcast blocks as their number asks for
    names = rows.where("_file IS NOT NULL").select("_file").distinct()
    blocks = -(-patterns.count() // MAX_RULES)
    hits = None
    for k in range(max(1, blocks)):
        block = patterns if blocks <= 1 else patterns.where(F.pmod(F.xxhash64("rule_key"), F.lit(blocks)) == k)
        found = names.join(F.broadcast(block), F.expr("_file RLIKE rule_key")).select(F.col("_file").alias("_hit"), *picked)
        hits = found if hits is None else hits.unionByName(found)
    out = out.unionByName(rows.join(hits, F.col("_file") == F.col("_hit")).select(key, *picked))
    return out


def annotate(df: DataFrame, key: str, url: str, host: str, source_file: str, date: str, rules: DataFrame, ranges: DataFrame) -> DataFrame:
    """(key, collection, collections, subject): distinct, sorted values of all rules that fit, within their date ranges."""
    fits = matched_rules(df, key, url, host, source_file, rules).join(df.select(F.col(key).alias("_key"), F.col(date).alias("_date")), F.col(key) == F.col("_key")).drop("_key")
    span = _small(ranges.where("collection IS NOT NULL").select(F.col("collection").alias("_name"), "range_start", "range_end"))
    kinds = [
        fits.select(key, "_date", F.lit("collection").alias("_kind"), F.col("collection").alias("_value")).where("_value <> ''"),
        fits.select(key, "_date", F.lit("collections").alias("_kind"), F.explode("collections").alias("_value")),
    ]
    dated = kinds[0].unionByName(kinds[1]).join(span, (F.col("_value") == F.col("_name")) & in_range(F.col("_date"), F.col("range_start"), F.col("range_end"))).select(key, "_kind", "_value")
    subjects = fits.select(key, F.lit("subject").alias("_kind"), F.explode("subject").alias("_value")).where("_value IS NOT NULL")
    of = lambda kind: F.sort_array(F.collect_set(F.when(F.col("_kind") == kind, F.col("_value")))).alias(kind)
    return dated.unionByName(subjects).groupBy(key).agg(of("collection"), of("collections"), of("subject"))


def access_terms(df: DataFrame, surt_key: str, prefixes: DataFrame, prefix: str = "prefix") -> DataFrame:
    """``df`` with ``access_terms``: OA where a listed SURT prefix begins the row's SURT, else RRO."""
    hit = values_with_prefix(df, surt_key, prefixes, prefix).withColumn("_oa", F.lit(True))
    joined = df.join(hit, df[surt_key] == hit["_v"], "left")
    return joined.withColumn("access_terms", F.when(F.col("_oa"), "OA").otherwise("RRO")).drop("_v", "_oa")


def lookup(df: DataFrame, on: str, table: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Left join of one value of a lookup table (postcode -> location, archive -> identifier); the first in order counts on duplicates."""
    one = table.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.min(value).alias(out))
    return df.join(_small(one, 1_000_000), df[on] == F.col("_k"), "left").drop("_k")


def with_ark(df: DataFrame, file: str, arks: DataFrame) -> DataFrame:
    """``identifier#file`` where the file has one, else the file name."""
    joined = lookup(df, file, arks, "file", "ark", "_ark")
    return joined.withColumn("archive", F.when(F.col("_ark").isNotNull(), F.concat_ws("#", "_ark", file)).otherwise(F.col(file))).drop("_ark")


def back_fill(documents: DataFrame, annotated: DataFrame, key: str) -> DataFrame:
    """Documents with new annotations merged into the old ones (arrays united, none lost)."""
    new = annotated.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in ("collection", "collections", "subject")])
    out = documents.join(new, documents[key] == F.col("_k"), "left")
    empty = F.array().cast("array<string>")
    for c in ("collection", "collections", "subject"):
        old = F.coalesce(F.col(c), empty) if c in documents.columns else empty
        out = out.withColumn(c, F.array_union(old, F.coalesce(F.col(f"_{c}"), empty))).drop(f"_{c}")
    return out.drop("_k")
