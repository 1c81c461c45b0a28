"""Documents from captures: one wide, typed row per capture, by narrow column transforms only."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wrackline.functions import bound, content_types, dates, html, payload, text, urls
from wrackline.operators import filters


#: URLs are cut to this length; normalised ones lose a size that a srcset left behind.
MAX_URL, URL_REWRITES = 2000, ((r"%20[0-9.]+[wx]$", ""),)


@dataclass(frozen=True)
class Config:
    """What a run keeps and adds."""

    record_types: tuple[str, ...] = ()
    protocols: tuple[str, ...] = ("http",)
    url_exclude: tuple[str, ...] = ()
    statuses: tuple[str, ...] = ()
    institution: str | None = None
    collection: str | None = None
    collection_id: str | None = None
    normalise_urls: bool = True
    max_text_length: int = 512 * 1024
    max_payload_bytes: int = 50_000_000
    hash_stage: str = "dechunked"
    store_text: bool = True
    max_values: dict[str, int] = field(default_factory=dict)
    suffixes: tuple[str, ...] = urls.SUFFIXES


def http_header(headers: Column, name: str) -> Column:
    """The first value of a header, whatever its case."""
    return F.get(F.filter(headers, lambda h: F.lower(h["name"]) == name.lower()), F.lit(0))["value"]


def http_values(headers: Column, *names: str) -> Column:
    """All values of some headers, in their order."""
    lower = [n.lower() for n in names]
    return F.transform(F.filter(headers, lambda h: F.lower(h["name"]).isin(*lower)), lambda h: h["value"])


def envelope(records: DataFrame, suffixes: tuple[str, ...] = urls.SUFFIXES) -> DataFrame:
    """Columns from record and HTTP headers; no payload is read, so a scan may leave it out."""
    h = F.col("warc_headers")
    target = urls.sanitise_header(h["WARC-Target-URI"])
    stamp = h["WARC-Date"]
    return records.withColumns({"url": text.adjust(target, MAX_URL), "_target": target, "_stamp": stamp}).withColumns(
        {
            "id": payload.capture_id(F.col("_stamp"), F.col("_target")),
            "crawl_date": dates.crawl_date(F.col("_stamp")),
            "wayback_date": dates.wayback_date(F.col("_stamp")),
            "record_type": h["WARC-Type"],
            "warc_key_id": h["WARC-Record-ID"],
            "warc_ip": h["WARC-IP-Address"],
            "status_code": F.regexp_extract(F.coalesce("http_status", F.lit("")), r"^\S+\s+(\d{3})", 1).try_cast("int"),
            "content_type_served": F.substring(http_header(F.col("http_headers"), "content-type"), 1, 200),
            "server": http_values(F.col("http_headers"), "server", "x-powered-by"),
            "location": http_header(F.col("http_headers"), "location"),
            "resourcename": urls.resource_name(F.col("url")),
            "content_type_ext": F.nullif(urls.extension(F.col("url")), F.lit("")),
            "url_path": urls.path(F.col("url")),
            "url_type": urls.url_type(F.col("url")),
            "host": urls.host(F.col("url")),
        }
    ).withColumns(
        {
            "crawl_year": F.year("crawl_date"),
            "parse_error": F.when(F.col("crawl_date").isNull(), F.concat(F.lit("unparsable date: "), F.coalesce("_stamp", F.lit("none")))),
            "domain": urls.private_suffix(F.col("host"), suffixes),
            "public_suffix": urls.public_suffix(F.col("host"), suffixes),
            "host_surt": urls.host_surts(F.col("host")),
        }
    ).drop("_stamp", "_target")


def _settled(df: DataFrame) -> DataFrame:
    """``df`` with a column that keeps the optimizer from writing the expressions so far into later ones."""
    return df.withColumn("_settled", F.monotonically_increasing_id())


def build_documents(records: DataFrame, config: Config | None = None) -> DataFrame:
    """A document per kept record: filters, envelope, payload, types, text and links.

    Cheap filters on headers come before any work on payloads. A revisit keeps
    its envelope and served type only. Scripts and style sheets get no text.
    """
    config = config or Config()
    docs = filters.keep_captures(_settled(envelope(records, config.suffixes)), {"record_types": list(config.record_types), "protocols": list(config.protocols), "url_exclude": list(config.url_exclude), "statuses": list(config.statuses)})
    revisit = filters.is_revisit(F.col("record_type"))
    head = F.col("http_headers")
    decoded = payload.decoded_payload(F.when(~revisit, F.col("payload")), http_header(head, "transfer-encoding"), http_header(head, "content-encoding"), config.hash_stage, config.max_payload_bytes)
    docs = docs.withColumn("_decoded", decoded)
    docs = docs.withColumns(
        {
            "content_length": F.when(~revisit, F.length("payload").cast("bigint")),
            "hash": F.when(revisit, F.col("warc_headers")["WARC-Payload-Digest"]).otherwise(F.col("_decoded.hash")),
            "content_first_bytes": F.when(~revisit, payload.first_bytes(F.col("payload"))),
            "content_type_tika": bound(F.when(~revisit, F.col("_decoded.payload")), lambda p: payload.sniffed_type(p)),
            "institution": F.lit(config.institution).cast("string"),
            "collection": F.lit(config.collection).cast("string"),
            "collection_id": F.lit(config.collection_id).cast("string"),
        }
    )
    full = content_types.full_type(F.col("content_type_tika"), F.lit(None).cast("string"), F.col("warc_headers")["WARC-Identified-Payload-Type"], F.col("content_type_served"), F.col("warc_headers")["Content-Type"])
    docs = docs.withColumn("content_type_full", F.when(revisit, F.col("content_type_served")).otherwise(full))
    docs = _settled(docs.withColumn("content_type", content_types.content_type(F.col("content_type_full"), F.col("content_length"), F.col("record_type"))))
    is_page = filters.is_html(F.col("content_type")) & filters.text_kept(F.col("content_type"))
    charset = html.charset_of(F.col("_decoded.payload"), F.col("content_type_served"))
    docs = docs.withColumn("content_encoding", F.when(is_page, charset))
    docs = docs.withColumn("_page", html.html_features(F.when(is_page, html.decode_page(F.col("_decoded.payload"), F.col("content_encoding"))), F.col("url")))
    links = F.coalesce(F.col("_page.links"), F.array().cast("array<string>"))
    docs = docs.withColumns({"links": links, "_sets": urls.link_sets(links, config.suffixes)})
    body = F.substring(F.col("_page.text"), 1, config.max_text_length)
    failures = F.concat_ws("; ", "parse_error", "_decoded.error", payload.digest_check(F.col("hash"), F.when(~revisit, payload.sha1_base32(F.col("warc_headers")["WARC-Payload-Digest"]))))
    docs = docs.withColumns(
        {
            "content_type_norm": content_types.norm(F.col("content_type")),
            "type": content_types.kind(F.col("content_type")),
            "title": text.adjust(F.col("_page.title")),
            "content": body,
            "content_text_length": F.length(body).cast("bigint"),
            "description": F.col("_page.meta")["description"],
            "keywords": F.col("_page.meta")["keywords"],
            "author": F.col("_page.meta")["author"],
            "generator": F.array_compact(F.array(F.col("_page.meta")["generator"])),
            "publication_date": F.col("_page.publication_date"),
            "elements_used": F.col("_page.elements"),
            "license_url": F.col("_page.licenses"),
            "links_images": F.col("_page.links_images"),
            "links_hosts": F.col("_sets.hosts"),
            "links_domains": F.col("_sets.domains"),
            "links_public_suffixes": F.col("_sets.suffixes"),
            "links_hosts_surts": F.col("_sets.surts"),
            "postcode": text.postcodes(F.coalesce(body, F.lit(""))),
            "postcode_district": text.postcode_districts(F.coalesce(body, F.lit(""))),
            "content_metadata": F.transform(F.map_entries("_page.meta"), lambda e: F.concat(e["key"], F.lit("="), F.substring(e["value"], 1, 100))),
            "last_modified": dates.extract_date(F.regexp_replace(http_header(head, "last-modified"), "^[A-Za-z]+, ", "")),
            "parse_error": F.nullif(failures, F.lit("")),
        }
    )
    if config.normalise_urls:
        docs = docs.withColumns({"url_norm": text.adjust(urls.canonical_url(F.col("url")), MAX_URL, URL_REWRITES), "redirect_to_norm": urls.resolve_url(F.col("url"), F.col("location"))})
    for name, most in config.max_values.items():
        docs = docs.withColumn(name, text.limit_values(F.col(name), most))
    if not config.store_text:
        docs = docs.withColumnRenamed("content", "text")
    return docs.drop("_decoded", "_page", "_sets", "_settled", "location", "payload")


def as_json(documents: DataFrame, column: str = "json") -> DataFrame:
    """(json): each document as one JSON object without nulls."""
    return documents.select(F.to_json(F.struct(*documents.columns)).alias(column))
