"""Predicates that choose captures; each is a Column, so that Catalyst pushes and orders them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wrackline.functions import urls
from wrackline.operators.prefixes import values_with_prefix


def record_type_in(record_type: Column, types: Sequence[str]) -> Column:
    """Type in the list; ``arc`` always; an empty list keeps all."""
    return F.lit(True) if not types else record_type.isin(*types) | (record_type == "arc")


def has_url(url: Column) -> Column:
    return url.isNotNull()


def protocol_in(url: Column, prefixes: Sequence[str]) -> Column:
    """URL begins with one of the prefixes; an empty list keeps nothing, an empty prefix all."""
    return reduce(lambda a, b: a | b, [url.startswith(p) for p in prefixes], F.lit(False))


def url_matches_none(url: Column, patterns: Sequence[str]) -> Column:
    """No pattern is found in the URL; blank patterns are ignored."""
    wanted = [p for p in patterns if p.strip()]
    return ~reduce(lambda a, b: a | b, [url.rlike(p) for p in wanted], F.lit(False))


def status_begins(status: Column, url: Column, prefixes: Sequence[str]) -> Column:
    """Status of http URLs begins with one of the prefixes; null status drops; an empty list keeps all."""
    if not prefixes:
        return F.lit(True)
    fits = reduce(lambda a, b: a | b, [status.cast("string").startswith(p) for p in prefixes])
    return ~url.startswith("http") | F.coalesce(fits, F.lit(False))


def slash_pages(url: Column) -> Column:
    return urls.url_type(url) == "slashpage"


def mime_matches_none(media: Column, patterns: Sequence[str]) -> Column:
    return url_matches_none(F.coalesce(media, F.lit("")), patterns)


def is_html(media: Column) -> Column:
    return media.startswith("text") | media.startswith("application/xhtml+xml")


def is_xml(media: Column) -> Column:
    return media.startswith("application/xml") | media.startswith("text/xml") | media.rlike(r"\+xml")


def is_pdf(media: Column) -> Column:
    return media.startswith("application/pdf")


def is_image(media: Column) -> Column:
    return media.startswith("image")


def sampled_images(media: Column, length: Column, key: Column, max_length: int, rate: int) -> Column:
    """Images up to a size, one in ``rate`` of them, chosen by a hash of the key (repeatable)."""
    return is_image(media) & (length <= max_length) & (F.pmod(F.xxhash64(key), F.lit(rate)) == 0)


def is_revisit(record_type: Column) -> Column:
    return record_type == "revisit"


def text_kept(media: Column) -> Column:
    """False for scripts and style sheets, whose text is dropped."""
    return ~F.coalesce(media, F.lit("")).rlike(r"^(?:application/javascript|text/javascript|text/css)")


def cdx_kept(line: Column) -> Column:
    """Lines of the index without requests, metadata and application/http after their start."""
    return reduce(lambda a, b: a & b, [F.instr(line, mark) <= 1 for mark in (" application/http 200 ", " warc/request ", " warc/metadata ")])


def log_line_valid(tokens: Column) -> Column:
    """Twelve tokens; no negative status but -9998; a URI with a host."""
    status = F.get(tokens, F.lit(1))
    return (F.size(tokens) == 12) & (~status.startswith("-") | (status == "-9998")) & urls.crawl_log_host(F.get(tokens, F.lit(3))).isNotNull()


def has_outlinks(record_type: Column, url: Column) -> Column:
    """Responses (and records of archives that name no type) of http URLs with a path."""
    return F.coalesce(record_type, F.lit("arc")).isin("response", "arc") & F.coalesce(url.rlike(r"^https?://([^/:]+)(:[0-9]+)?/.*$"), F.lit(False))


def excluded_by_prefix(df: DataFrame, url: str, prefixes: DataFrame, prefix: str = "prefix") -> DataFrame:
    """Rows whose URL begins with none of the listed prefixes; rows without a URL stay."""
    hit = values_with_prefix(df, url, prefixes, prefix)
    return df.join(hit, df[url] == hit["_v"], "left_anti")


def keep_captures(df: DataFrame, config: dict) -> DataFrame:
    """Record filters of a run: type, URL, protocol, patterns and status, as listed in ``config``."""
    return df.where(
        record_type_in(F.col("record_type"), config.get("record_types", []))
        & has_url(F.col("url"))
        & protocol_in(F.col("url"), config.get("protocols", ["http"]))
        & url_matches_none(F.col("url"), config.get("url_exclude", []))
        & status_begins(F.col("status_code"), F.col("url"), config.get("statuses", []))
    )
