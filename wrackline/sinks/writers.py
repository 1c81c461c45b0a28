"""Sinks. File sinks use Spark's committers; service sinks send batches through a transport that the caller gives.

A transport is a picklable callable ``send(body: bytes) -> int`` (an HTTP status);
none is shipped that opens connections by itself.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable, Iterator
from datetime import datetime, timezone
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Transport = Callable[[bytes], int]


def write_documents(df: DataFrame, path: str, form: str = "jsonl", compressed: bool = True, per_source: bool = False, mode: str = "errorifexists") -> None:
    """Documents as jsonl, parquet or xml files; ``per_source`` puts each archive's documents into its own folder."""
    writer = df.write.mode(mode)
    if per_source:
        writer = df.withColumn("archive", F.col("source_file")).write.mode(mode).partitionBy("archive")
    if form == "jsonl":
        (writer.option("compression", "gzip") if compressed else writer).json(path)
    elif form == "parquet":
        writer.option("compression", "zstd").parquet(path)
    elif form == "xml":
        (writer.option("compression", "gzip") if compressed else writer).option("rowTag", "doc").option("rootTag", "add").xml(path)
    else:
        raise ValueError(f"unknown form: {form}")


def write_text(df: DataFrame, path: str, column: str = "value", compressed: bool = False, mode: str = "errorifexists") -> None:
    """One column as lines, without keys."""
    writer = df.select(F.col(column).alias("value")).write.mode(mode)
    (writer.option("compression", "gzip") if compressed else writer).text(path)


def write_datasets(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Rows with ``dataset`` and ``year`` into a folder for each, as Parquet."""
    df.write.mode(mode).partitionBy("dataset", "year").option("compression", "zstd").parquet(path)


def oai_records(df: DataFrame) -> DataFrame:
    """(value): Dublin Core records of slash pages that have id, url, domain and date; the domain stands in for a title."""
    safe = lambda c: F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "&", "&amp;"), "<", "&lt;"), ">", "&gt;")
    tag = lambda name, c: F.concat(F.lit(f"<dc:{name}>"), safe(c), F.lit(f"</dc:{name}>"))
    rows = df.where("url_type = 'slashpage' AND id IS NOT NULL AND url IS NOT NULL AND domain IS NOT NULL AND crawl_date IS NOT NULL")
    date = F.date_format("crawl_date", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return rows.select(
        F.concat(
            F.lit("<record><header><identifier>"), safe(F.col("id")), F.lit("</identifier><datestamp>"), date, F.lit("</datestamp></header><metadata><oai_dc:dc>"),
            tag("title", F.coalesce("title", "domain")), tag("identifier", F.col("url")), tag("date", date), tag("source", F.col("domain")),
            F.lit("</oai_dc:dc></metadata></record>"),
        ).alias("value")
    )


def batches(rows: Iterable[str], max_docs: int = 500, max_bytes: int = 20_000_000) -> Iterator[list[str]]:
    """Rows in groups that stay within both limits (a larger row goes alone)."""
    group: list[str] = []
    size = 0
    for row in rows:
        n = len(row.encode())
        if group and (len(group) >= max_docs or size + n > max_bytes):
            yield group
            group, size = [], 0
        group.append(row)
        size += n
    if group:
        yield group


def bulk_body(documents: list[str], index: str, now: str) -> bytes:
    """A bulk request of an OpenSearch-like service: id as _id, every field an array, index_time added."""
    lines = []
    for text in documents:
        doc = json.loads(text)
        fields = {k: v if isinstance(v, list) else [v] for k, v in doc.items() if v is not None}
        fields["index_time"] = [now]
        fields.setdefault("content_type_norm", ["other"])
        lines += [json.dumps({"index": {"_index": index, "_id": doc.get("id")}}), json.dumps(fields, ensure_ascii=False)]
    return ("\n".join(lines) + "\n").encode()


def update_body(documents: list[str]) -> bytes:
    """An XML update of a Solr-like service."""
    out = ["<add>"]
    for text in documents:
        out.append("<doc>")
        for name, value in json.loads(text).items():
            out += [f'<field name="{escape(name)}">{escape(str(v))}</field>' for v in (value if isinstance(value, list) else [value]) if v is not None]
        out.append("</doc>")
    return ("".join(out) + "</add>").encode()


def send_documents(df: DataFrame, transport: Transport, body: str = "bulk", index: str = "documents", max_docs: int = 500, max_bytes: int = 20_000_000, retries: int = 20, pause: float = 1.0) -> dict[str, int]:
    """Send documents in batches from the executors; returns counts of sent, dropped and retried (summed by Spark)."""
    rows = df.select(F.to_json(F.struct(*df.columns)).alias("json"))

    def send(frames):
        import pandas as pd

        def texts():
            for frame in frames:
                yield from frame["json"]

        sent = dropped = again = 0
        for group in batches(texts(), max_docs, max_bytes):
            now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
            data = bulk_body(group, index, now) if body == "bulk" else update_body(group) if body == "xml" else ("\n".join(group) + "\n").encode()
            for attempt in range(retries + 1):
                if 200 <= transport(data) < 300:
                    sent += len(group)
                    break
                again += 1
                time.sleep(min(pause * 2 ** min(attempt, 8), 300) if attempt < retries else 0)
            else:
                dropped += len(group)
        yield pd.DataFrame({"sent": [sent], "dropped": [dropped], "retries": [again]})

    totals = rows.mapInPandas(send, "sent bigint, dropped bigint, retries bigint").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("sent", "dropped", "retries")]).first()
    return totals.asDict()


def send_lines(df: DataFrame, transport: Transport, column: str = "value", max_lines: int = 10_000, retries: int = 10, pause: float = 30.0) -> dict[str, int]:
    """Post lines of an index in batches; a batch that fails beyond ``retries`` raises."""

    def checked(data: bytes) -> int:
        for attempt in range(retries + 1):
            status = transport(data)
            if 200 <= status < 300:
                return status
            if attempt < retries:
                time.sleep(pause)
        raise RuntimeError(f"posting failed {retries + 1} times")

    def send(frames):
        import pandas as pd

        sent = 0
        for group in batches((v for frame in frames for v in frame[column]), max_lines, 1 << 30):
            checked(("\n".join(group) + "\n").encode())
            sent += len(group)
        yield pd.DataFrame({"sent": [sent]})

    return {"sent": df.select(column).mapInPandas(send, "sent bigint").agg(F.coalesce(F.sum("sent"), F.lit(0))).first()[0]}


def counters(df: DataFrame) -> DataFrame:
    """(counter, n): records, errors, nulls, records without headers, dropped, as rows."""
    one = df.agg(
        F.count(F.lit(1)).alias("NUM_RECORDS"),
        F.count_if(F.col("parse_error").isNotNull()).alias("NUM_ERRORS"),
        F.count_if(F.col("id").isNull()).alias("NUM_NULLS"),
        F.count_if(F.coalesce(F.size("http_headers"), F.lit(0)) <= 0).alias("NUM_EMPTY_HEADERS"),
    )
    return one.unpivot([], list(one.columns), "counter", "n")
