"""Content types: resolution from several witnesses, and coarse classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OCTETS = "application/octet-stream"


def base_type(media: Column) -> Column:
    return F.trim(F.regexp_replace(media, ";.*$", ""))


def full_type(sniffed: Column, signature: Column, identified: Column, served: Column, record: Column) -> Column:
    """The best of the witnesses: sniffed, by signature (with its parameters), identified in a header, served, of the record."""
    weak = lambda c: c.isNull() | (c == "") | (base_type(c) == OCTETS)
    first = F.when(weak(sniffed), signature).when((base_type(sniffed) == base_type(signature)) & signature.contains("version"), F.concat_ws("; ", sniffed, F.regexp_extract(signature, r";\s*(.*)$", 1))).otherwise(sniffed)
    known = lambda c: F.when(~weak(c), c)
    return F.when(weak(first), F.coalesce(known(identified), known(served), known(record), first, F.lit(OCTETS))).otherwise(first)


def content_type(full: Column, length: Column, record_type: Column) -> Column:
    """Without parameters; x-empty for no bytes, unless a revisit."""
    return F.when((length == 0) & (F.coalesce(record_type, F.lit("")) != "revisit"), "application/x-empty").otherwise(base_type(full))


def _ladder(media: Column, names: tuple[str, ...]) -> Column:
    image, audio, video, html, pdf, word, excel, powerpoint, text, other = names
    m = F.coalesce(media, F.lit(""))
    return (
        F.when(m.startswith("image/"), image)
        .when(m.startswith("audio/") | (m == "application/vnd.rn-realaudio"), audio)
        .when(m.startswith("video/") | m.isin("application/mp4", "application/vnd.rn-realmedia"), video)
        .when(m.startswith("text/htm") | m.startswith("application/xhtml"), html)
        .when(m.startswith("application/pdf"), pdf)
        .when(m.endswith("word"), word)
        .when(m.endswith("excel"), excel)
        .when(m.endswith("powerpoint"), powerpoint)
        .when(m.startswith("text/plain"), text)
        .otherwise(other)
    )


def norm(media: Column) -> Column:
    """Coarse class: image, audio, video, html, pdf, word, excel, powerpoint, text or other; first fit counts."""
    return _ladder(media, ("image", "audio", "video", "html", "pdf", "word", "excel", "powerpoint", "text", "other"))


def kind(media: Column) -> Column:
    """The class as shown to readers."""
    return _ladder(media, ("Image", "Audio", "Video", "Web Page", "Document", "Document", "Data", "Presentation", "Document", "Other"))


def format_triple(served: Column, sniffed: Column, signature: Column) -> Column:
    """Served, sniffed and signature type, tab-separated; missing ones empty."""
    return F.concat_ws("\t", *[F.coalesce(c, F.lit("")) for c in (served, sniffed, signature)])
