"""Functions over payload bytes: digests, decoding, signatures, image headers, fuzzy hashes."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import struct
import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- digests -----------------------------------------------------------------


def capture_id(stamp: Column, url: Column) -> Column:
    """Digits of the capture time, a slash and the base64 MD5 of the URL."""
    return F.concat(F.regexp_replace(stamp, "[^0-9]", ""), F.lit("/"), F.base64(F.unhex(F.md5(url))))


def base32_digest(value: str | None) -> str | None:
    """``sha1:`` and 40 hex digits as base32; any other value unchanged."""
    if value is None or not re.fullmatch(r"sha1:[0-9a-fA-F]{40}", value):
        return value
    return "sha1:" + base64.b32encode(bytes.fromhex(value[5:])).decode()


def sha1_base32(value: Column) -> Column:
    @F.pandas_udf(T.StringType())
    def run(values: pd.Series) -> pd.Series:
        return values.map(base32_digest, na_action="ignore")

    return run(value)


def payload_digest(payload: Column) -> Column:
    """``sha1:`` and the base32 SHA-1 of the bytes."""
    return sha1_base32(F.concat(F.lit("sha1:"), F.sha1(payload)))


def digest_check(computed: Column, header: Column) -> Column:
    """A message if a header's digest differs from the computed one; none without a header."""
    return F.when(header.isNotNull() & (computed != header), F.concat(F.lit("Digest validation failed: header "), header, F.lit(", computed "), computed))


def first_bytes(payload: Column, n: int = 4) -> Column:
    """Hex of the first ``n`` bytes; short payloads are padded with zeros."""
    return F.rpad(F.lower(F.hex(F.substring(payload, 1, n))), 2 * n, "0")


def spaced_hex(payload: Column, n: int = 32) -> Column:
    """The first bytes as hex pairs with spaces."""
    return F.trim(F.regexp_replace(first_bytes(payload, n), "(..)", "$1 "))


# --- transfer and content decoding ------------------------------------------------


def dechunk(data: bytes, hinted: bool = True) -> bytes:
    """Bytes without HTTP chunk sizes, if hinted and if they look chunked; else unchanged. After a faulty size the rest stays."""
    size = re.compile(rb"([0-9a-fA-F]{1,8})(?:;[^\r\n]*)?\r?\n")
    if not hinted or not size.match(data):
        return data
    out, at = [], 0
    while at < len(data):
        m = size.match(data, at)
        if not m:  # a faulty size: what is left is kept as it is
            return b"".join([*out, data[at:]])
        n = int(m.group(1), 16)
        if n == 0:
            return b"".join(out)
        out.append(data[m.end() : m.end() + n])
        at = m.end() + n
        if data[at : at + 2] == b"\r\n":
            at += 2
        elif data[at : at + 1] == b"\n":
            at += 1
    return b"".join(out)


def gunzip(data: bytes, limit: int) -> tuple[bytes, str | None]:
    """(bytes of all gzip members up to a limit, error of a cut or faulty one); bytes after the last member are ignored."""
    out, size, left = [], 0, data
    while left[:2] == b"\x1f\x8b" and size < limit:
        engine = zlib.decompressobj(31)
        try:
            out.append(engine.decompress(left, limit - size))
        except zlib.error as e:
            if not out:
                raise
            return b"".join(out), f"error in gzip member {len(out) + 1}: {e}"
        size += len(out[-1])
        if not engine.eof:
            return b"".join(out), None if size >= limit else "gzip data end early"
        left = engine.unused_data
    if not out:
        raise zlib.error("no gzip data")
    return b"".join(out), None


def decompress(data: bytes, encoding: str | None, limit: int = 1 << 28) -> tuple[bytes, str | None]:
    """(bytes, error): gzip and deflate undone; without a hint gzip is found by its magic; others are kept with an error."""
    hint = (encoding or "").strip().lower()
    try:
        if hint in ("gzip", "x-gzip") or not hint and data[:2] == b"\x1f\x8b":
            return gunzip(data, limit)
        if hint == "deflate":
            try:
                return zlib.decompressobj().decompress(data, limit), None
            except zlib.error:
                return zlib.decompressobj(-15).decompress(data, limit), None
    except zlib.error as e:
        return data, f"{type(e).__name__} in {hint or 'gzip'}: {e}"
    if hint in ("", "identity", "none"):
        return data, None
    return data, f"unsupported content encoding: {hint}"


_DECODED = T.StructType([T.StructField("payload", T.BinaryType()), T.StructField("hash", T.StringType()), T.StructField("truncated", T.BooleanType()), T.StructField("error", T.StringType())])


def decoded_payload(payload: Column, transfer: Column, encoding: Column, stage: str = "dechunked", max_bytes: int = 50_000_000) -> Column:
    """struct(payload, hash, truncated, error): dechunked and decompressed payload.

    ``stage`` names the bytes that are hashed: ``first``, ``dechunked`` or ``decompressed``.
    Payloads are cut to ``max_bytes`` after hashing.
    """
    if stage not in ("first", "dechunked", "decompressed"):
        raise ValueError(f"unknown hash stage: {stage}")

    def one(data: bytes | None, chunked: str | None, enc: str | None):
        if data is None:
            return None, None, None, None
        raw = bytes(data)
        plain = dechunk(raw, "chunked" in (chunked or "").lower())
        full, error = decompress(plain, enc)
        at = {"first": raw, "dechunked": plain, "decompressed": full}[stage]
        return full[:max_bytes], "sha1:" + base64.b32encode(hashlib.sha1(at).digest()).decode(), len(full) > max_bytes, error

    @F.pandas_udf(_DECODED)
    def run(data: pd.Series, chunked: pd.Series, enc: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(*row) for row in zip(data, chunked, enc)], columns=_DECODED.names)

    return run(payload, transfer, encoding)


# --- signatures -------------------------------------------------------------------

#: Fixed values: (offset, signature, media type); the first match counts.
SIGNATURES: tuple[tuple[int, bytes, str], ...] = (
    (0, b"\x89PNG\r\n\x1a\n", "image/png"),
    (0, b"GIF87a", "image/gif"),
    (0, b"GIF89a", "image/gif"),
    (0, b"\xff\xd8\xff", "image/jpeg"),
    (0, b"BM", "image/bmp"),
    (0, b"II*\x00", "image/tiff"),
    (0, b"MM\x00*", "image/tiff"),
    (8, b"WEBP", "image/webp"),
    (0, b"%PDF-", "application/pdf"),
    (0, b"PK\x03\x04", "application/zip"),
    (0, b"\x1f\x8b", "application/gzip"),
    (0, b"BZh", "application/x-bzip2"),
    (0, b"7z\xbc\xaf\x27\x1c", "application/x-7z-compressed"),
    (0, b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1", "application/x-tika-msoffice"),
    (0, b"{\\rtf", "application/rtf"),
    (0, b"%!PS", "application/postscript"),
    (0, b"OggS", "application/ogg"),
    (0, b"fLaC", "audio/x-flac"),
    (0, b"ID3", "audio/mpeg"),
    (8, b"WAVE", "audio/x-wav"),
    (8, b"AVI ", "video/x-msvideo"),
    (4, b"ftyp", "video/mp4"),
    (0, b"\x1aE\xdf\xa3", "video/webm"),
    (0, b"FLV\x01", "video/x-flv"),
    (0, b"FWS", "application/x-shockwave-flash"),
    (0, b"CWS", "application/x-shockwave-flash"),
    (0, b"wOFF", "application/font-woff"),
    (0, b"wOF2", "font/woff2"),
    (0, b"WARC/", "application/warc"),
    (0, b"filedesc://", "application/x-internet-archive"),
    (32769, b"CD001", "application/x-iso9660-image"),
    (0, b"SQLite format 3\x00", "application/x-sqlite3"),
    (0, b"<?xml", "application/xml"),
)


def sniffed_type(payload: Column, extra: tuple[tuple[int, bytes, str], ...] = ()) -> Column:
    """Media type by signature, then by how a text begins; octet-stream if none fits, x-empty if there are no bytes."""
    out = F.when(F.length(payload) == 0, "application/x-empty")
    for offset, magic, media in (*extra, *SIGNATURES):
        out = out.when(F.substring(payload, offset + 1, len(magic)) == F.lit(magic), media)
    head = F.lower(F.decode(F.substring(payload, 1, 1024), "ISO-8859-1"))
    out = out.when(head.rlike(r"^\s*(?:<!doctype html|<html|<head|<body|<!--|<title)"), "text/html")
    out = out.when(~head.rlike("[\\x00-\\x08\\x0e-\\x1a\\x1c-\\x1f]"), "text/plain")
    return F.when(payload.isNotNull(), out.otherwise("application/octet-stream"))


def pdf_version(payload: Column) -> Column:
    return F.nullif(F.regexp_extract(F.decode(F.substring(payload, 1, 1024), "ISO-8859-1"), r"%PDF-(\d\.\d)", 1), F.lit(""))


def extended_type(media: Column, version: Column, software: Column, source: Column) -> Column:
    """``type; version=..; software=..; source=..`` with the parts that are there."""
    part = lambda name, c: F.when(c.isNotNull(), F.concat(F.lit(f"{name}="), F.when(c.rlike(r"[;\s\"]"), F.concat(F.lit('"'), F.regexp_replace(c, '"', "'"), F.lit('"'))).otherwise(c)))
    return F.concat_ws("; ", media, part("version", version), part("software", software), part("source", source))


def image_size(data: bytes | None) -> tuple[int | None, int | None]:
    """(width, height) of a PNG, GIF, BMP or JPEG header."""
    if not data:
        return None, None
    d = bytes(data)
    try:
        if d[:8] == b"\x89PNG\r\n\x1a\n":
            return struct.unpack(">II", d[16:24])
        if d[:6] in (b"GIF87a", b"GIF89a"):
            return struct.unpack("<HH", d[6:10])
        if d[:2] == b"BM":
            w, h = struct.unpack("<ii", d[18:26])
            return w, abs(h)
        if d[:2] == b"\xff\xd8":
            at = 2
            while at + 9 <= len(d):
                if d[at] != 0xFF:
                    at += 1
                    continue
                mark = d[at + 1]
                if mark in (0xC0, 0xC1, 0xC2, 0xC3, 0xC5, 0xC6, 0xC7, 0xC9, 0xCA, 0xCB, 0xCD, 0xCE, 0xCF):
                    h, w = struct.unpack(">HH", d[at + 5 : at + 9])
                    return w, h
                at += 2 if mark == 0xFF or 0xD0 <= mark <= 0xD9 else 2 + struct.unpack(">H", d[at + 2 : at + 4])[0]
    except struct.error:
        pass
    return None, None


_IMAGE = T.StructType([T.StructField("width", T.LongType()), T.StructField("height", T.LongType()), T.StructField("size", T.LongType())])


def image_info(payload: Column) -> Column:
    """struct(width, height, size) read from an image's header, size in pixels."""

    @F.pandas_udf(_IMAGE)
    def run(data: pd.Series) -> pd.DataFrame:
        sizes = [image_size(d) for d in data]
        return pd.DataFrame({"width": pd.array([w for w, _ in sizes], dtype="Int64"), "height": pd.array([h for _, h in sizes], dtype="Int64"), "size": pd.array([w * h if w is not None else None for w, h in sizes], dtype="Int64")})

    return run(payload)


def xml_root(data: bytes | None) -> str | None:
    """``namespace#local`` of an XML document's root element, in lower case."""
    if not data:
        return None
    from xml.parsers import expat

    found: list[str] = []

    class Stop(Exception):
        pass

    def start(name, _):
        found.append(name)
        raise Stop

    parser = expat.ParserCreate(namespace_separator="#")
    parser.StartElementHandler = start
    try:
        parser.Parse(bytes(data), True)
    except (Stop, expat.ExpatError):
        pass
    return found[0].lower() if found else None


def xml_root_namespace(payload: Column) -> Column:
    @F.pandas_udf(T.StringType())
    def run(data: pd.Series) -> pd.Series:
        return data.map(xml_root, na_action="ignore")

    return run(payload)


# --- fuzzy hash (context triggered piecewise hashing, as published) -------------------

_B64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def ctph(data: bytes) -> tuple[int, str, str]:
    """(block size, hash at it, hash at twice it) of some bytes."""
    n, block = len(data), 3
    while block * 64 < n:
        block *= 2
    while True:
        h1 = h2 = 0x28021967
        s1: list[str] = []
        s2: list[str] = []
        window = [0] * 7
        a = b = c = 0
        for i, byte in enumerate(data):
            b = b - a + 7 * byte
            a = a + byte - window[i % 7]
            window[i % 7] = byte
            c = (c << 5 & 0xFFFFFFFF) ^ byte
            h1 = (h1 * 0x01000193 & 0xFFFFFFFF) ^ byte
            h2 = (h2 * 0x01000193 & 0xFFFFFFFF) ^ byte
            rolling = (a + b + c) & 0xFFFFFFFF
            if rolling % block == block - 1:
                if len(s1) < 63:
                    s1.append(_B64[h1 & 63])
                    h1 = 0x28021967
                if rolling % (2 * block) == 2 * block - 1 and len(s2) < 31:
                    s2.append(_B64[h2 & 63])
                    h2 = 0x28021967
        if block > 3 and len(s1) < 32:  # judged before the last piece is added
            block //= 2
            continue
        if n and (a + b + c) & 0xFFFFFFFF:
            s1.append(_B64[h1 & 63])
            s2.append(_B64[h2 & 63])
        return block, "".join(s1), "".join(s2)


_CTPH = T.StructType([T.StructField("block_size", T.IntegerType()), T.StructField("hash", T.StringType()), T.StructField("hash_double", T.StringType())])


def fuzzy_hash(text: Column) -> Column:
    """struct(block_size, hash, hash_double) of a text in lower case with single spaces."""
    clean = F.trim(F.lower(F.regexp_replace(text, r"\s+", " ")))

    @F.pandas_udf(_CTPH)
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = [ctph(t.encode("utf-8")) if t is not None else (None, None, None) for t in texts]
        out = pd.DataFrame(rows, columns=_CTPH.names)
        return out.assign(block_size=out.block_size.astype("Int32"))

    return run(clean)


def gzip_bytes(data: bytes) -> bytes:
    return gzip.compress(data, mtime=0)
