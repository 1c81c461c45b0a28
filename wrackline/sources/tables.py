"""Text and table sources: logs, record maps, rules, prefixes, lookups, configuration."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wrackline.functions import urls


def input_paths(spark: SparkSession, listing: str) -> list[str]:
    """Paths named by a text file, one a line (a list made by an operator, read by the driver)."""
    return [r[0].strip() for r in spark.read.text(listing).collect() if r[0].strip()]


def crawl_log(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(log_file, log_line)."""
    return spark.read.text(paths).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("log_file"), F.col("value").alias("log_line"))


def record_maps(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(mdx_map) from JSON lines of any keys; lines that are no objects are dropped."""
    return spark.read.text(paths).select(F.from_json("value", "map<string,string>").alias("mdx_map")).where("mdx_map IS NOT NULL")


def cdx(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Typed rows of an 11-column capture index; header lines are dropped."""
    names = ("urlkey", "wayback_date", "original", "mime", "status", "digest", "redirect", "meta", "compressed_length", "source_file_offset", "filename")
    kinds = {"wayback_date": "bigint", "status": "int", "compressed_length": "bigint", "source_file_offset": "bigint"}
    lines = spark.read.text(paths).where(~F.col("value").startswith(" CDX")).select(F.split("value", " ").alias("c")).where(F.size("c") == len(names))
    return lines.select(*[(F.col("c")[i].try_cast(kinds[n]) if n in kinds else F.col("c")[i]).alias(n) for i, n in enumerate(names)])


def whole_files(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(paths)


def annotations(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rules, ranges) from a JSON export: scope -> key -> rule, and collection -> date range (milliseconds)."""
    with open(path.removeprefix("file://"), encoding="utf-8") as file:
        data = json.load(file)
    rules = [(scope, key, r.get("collection"), r.get("collections") or [], r.get("subject") or []) for scope, keys in (data.get("collections") or {}).items() for key, r in keys.items()]
    ranges = [(name, r.get("start"), r.get("end")) for name, r in (data.get("collectionDateRanges") or {}).items()]
    return (
        spark.createDataFrame(rules, "scope string, rule_key string, collection string, collections array<string>, subject array<string>"),
        spark.createDataFrame(ranges, "collection string, s bigint, e bigint").select("collection", F.timestamp_millis("s").alias("range_start"), F.timestamp_millis("e").alias("range_end")),
    )


def annotations_json(rules: DataFrame, ranges: DataFrame) -> str:
    """The JSON export of rules and ranges (tables of curators, small by nature)."""
    scopes: dict[str, dict] = {}
    for r in rules.collect():
        scopes.setdefault(r["scope"], {})[r["rule_key"]] = {"collection": r["collection"], "collections": r["collections"], "subject": r["subject"]}
    spans = {r["collection"]: {"start": r["s"], "end": r["e"]} for r in ranges.select("collection", F.unix_millis("range_start").alias("s"), F.unix_millis("range_end").alias("e")).collect()}
    return json.dumps({"collections": scopes, "collectionDateRanges": spans}, sort_keys=True)


def curated_targets(spark: SparkSession, path: str) -> DataFrame:
    """Rules from an export of a curation tool (JSON lines with title, urls, scope, collection, subjects)."""
    rows = spark.read.schema("title string, urls array<string>, scope string, collection string, subjects array<string>").json(path)
    return rows.select("scope", F.explode("urls").alias("rule_key"), "collection", F.when(F.col("collection").isNotNull(), F.array("collection")).otherwise(F.array().cast("array<string>")).alias("collections"), F.col("subjects").alias("subject"))


def surt_prefixes(spark: SparkSession, path: str) -> DataFrame:
    """(prefix): lines of a prefix list; URLs among them become SURTs; comments and blanks are dropped."""
    lines = spark.read.text(path).select(F.trim("value").alias("v")).where("v <> '' AND NOT v LIKE '#%'")
    return lines.select(F.when(F.col("v").rlike("^[a-z]+://[^(]"), F.regexp_replace(urls.url_surt(F.col("v")), r"\)/?$", "")).otherwise(F.regexp_replace("v", "^https?://", "")).alias("prefix")).distinct()


def lookup_csv(spark: SparkSession, path: str) -> DataFrame:
    """(key, value): first column, and the second and third joined by a comma."""
    rows = spark.read.schema("key string, a string, b string").csv(path)
    return rows.select(F.trim("key").alias("key"), F.concat_ws(",", F.trim("a"), F.trim("b")).alias("value"))


def config(*layers: str | dict) -> dict:
    """Layers of JSON files or dicts merged deeply, later ones over earlier ones."""

    def merge(a: dict, b: dict) -> dict:
        return {**a, **{k: merge(a[k], v) if isinstance(v, dict) and isinstance(a.get(k), dict) else v for k, v in b.items()}}

    out: dict = {}
    for layer in layers:
        if isinstance(layer, str):
            with open(layer, encoding="utf-8") as file:
                layer = json.load(file)
        out = merge(out, layer)
    return out
