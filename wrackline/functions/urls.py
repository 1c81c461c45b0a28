"""URL, host and path functions."""

from __future__ import annotations

import re
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wrackline.functions import bound

MALFORMED = "malformed.host"
#: Public suffixes of more than one label, besides those below ``.uk``; pass your own list for a full one.
SUFFIXES = ("co.jp", "ac.jp", "com.au", "org.au", "net.au", "co.nz", "org.nz", "com.br", "co.za", "co.in", "co.kr", "com.cn", "com.mx", "com.ar", "com.tr", "googleapis.com", "blogspot.com", "blogspot.dk", "blogspot.co.uk", "github.io")

_HOST = r"^(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)*[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?$"


# --- canonical form ---------------------------------------------------------

# fixed values: session identifiers that canonical URLs lack
_SESSION = (
    re.compile(r"^(.+)(?:jsessionid=[0-9a-zA-Z]{32})(?:&(.*))?$", re.I),
    re.compile(r"^(.+)(?:phpsessid=[0-9a-zA-Z]{32})(?:&(.*))?$", re.I),
    re.compile(r"^(.+)(?:sid=[0-9a-zA-Z]{32})(?:&(.*))?$", re.I),
)
_KEEP_ESCAPED = {0x23: "%23"}


def _plain(url: str) -> str:
    """Trimmed, lower case, without user info, www of a URL with a path, session ids and an empty query."""
    out = (url.lstrip() if "?" in url else url.strip()).lower()
    out = re.sub(r"^((?:https?|ftps?)://)[^/@]+@", r"\1", out)
    out = re.sub(r"^(https?://)www\d*\.([^/]*/.+)$", r"\1\2", out)
    for pattern in _SESSION:
        m = pattern.match(out)
        if m:
            out = m.group(1) + (m.group(2) or "")
    while out[-1:] in ("?", "&") and "?" in out:
        out = out[:-1]
    return out


def _escape_byte(b: int) -> str:
    return f"%{b:02x}"


def canonicalise(url: str | None, high_order: bool = True, unambiguous: bool = True) -> str | None:
    """The canonical form of a URL: http scheme, repaired and normalised escapes, no trailing slash but at a bare host.

    ``high_order`` shows two-byte UTF-8 characters raw, ``unambiguous`` unescapes
    what needs no escape and drops a leading www. Null stays null, an empty text
    stays empty.
    """
    if url is None:
        return None
    text = _plain(url)
    if text.startswith("https://"):
        text = "http://" + text[8:]
    if unambiguous:
        text = re.sub(r"^([a-z]+://)(?:www\d*|ww2|ww)\.(.+)$", r"\1\2", text)
    raw = bytearray()  # high-order escapes as bytes, faulty percent signs escaped
    source = text.encode("utf-8", "surrogatepass")
    i = 0
    while i < len(source):
        if source[i] == 0x25:
            code = source[i + 1 : i + 3]
            if re.fullmatch(rb"[0-9a-fA-F]{2}", code):
                value = int(code, 16)
                raw += bytes([value]) if value >= 0x80 else source[i : i + 3]
                i += 3
                continue
            raw += b"%25"
        else:
            raw.append(source[i])
        i += 1
    out, query, i = [], False, 0
    while i < len(raw):
        b = raw[i]
        if b == 0x25:
            value = int(raw[i + 1 : i + 3], 16)
            if not unambiguous or value in (0x23, 0x25, 0x5C, 0x20) or value < 0x20 or value == 0x7F:
                out.append("+" if query and value == 0x20 else _escape_byte(value))
            else:
                out.append(chr(value))
            i += 3
            continue
        if b < 0x80:
            query = query or b == 0x3F
            if b == 0x20:
                out.append("+" if query else "%20")
            elif b == 0x5C or b < 0x20 or b == 0x7F:
                out.append(_escape_byte(b))
            else:
                out.append(chr(b))
        elif 0xC2 <= b <= 0xDF and i + 1 < len(raw) and 0x80 <= raw[i + 1] <= 0xBF:
            pair = bytes(raw[i : i + 2])
            out.append(pair.decode("utf-8") if high_order else "".join(map(_escape_byte, pair)))
            i += 1
        else:
            out.append(_escape_byte(b))
        i += 1
    result = "".join(out)
    while result.endswith("/"):
        result = result[:-1]
    return result + "/" if re.fullmatch(r"https?://[^/]+", result) else result


def canonical_url(url: Column, high_order: bool = True, unambiguous: bool = True) -> Column:
    @F.pandas_udf(T.StringType())
    def run(urls: pd.Series) -> pd.Series:
        return urls.map(lambda u: canonicalise(u, high_order, unambiguous), na_action="ignore")

    return run(url)


def fix_url_errors(url: Column) -> Column:
    """Repairs faulty escapes only."""
    return canonical_url(url, False, False)


def resolve(base: str | None, relative: str | None, normalise: bool = True) -> str | None:
    """``relative`` resolved against ``base``; null if either is null or the base has no host."""
    if base is None or relative is None or not urlsplit(base).netloc:
        return None
    try:
        full = urljoin(base, relative) if relative else base
    except ValueError:
        return None
    return canonicalise(full) if normalise else full


def resolve_url(base: Column, relative: Column, normalise: bool = True) -> Column:
    @F.pandas_udf(T.StringType())
    def run(bases: pd.Series, relatives: pd.Series) -> pd.Series:
        return pd.Series([resolve(b, r, normalise) for b, r in zip(bases, relatives)], dtype=object)

    return run(base, relative)


# --- hosts -------------------------------------------------------------------


def sanitise_header(value: Column) -> Column:
    """Drops angle brackets around a header value when both are there."""
    return F.regexp_replace(value, r"^<([^\n]*)>$", "$1")


def host(url: Column) -> Column:
    """The host of a URL, ``malformed.host`` where it has no valid one, null for null."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return bound(found, lambda f: F.when(f.isNull(), F.lit(None).cast("string")).when(f.rlike(_HOST) & (F.length(f) <= 255), F.lower(f)).otherwise(F.lit(MALFORMED)))


def valid_host(host_: Column) -> Column:
    return host_.rlike(_HOST) & (F.length(host_) <= 255)


def canonical_host(host_: Column) -> Column:
    """Lower case, without scheme, trailing slash and www."""
    bare = F.regexp_replace(F.lower(F.trim(host_)), r"^https?://|/$", "")
    return F.regexp_replace(bare, r"^www[0-9]*\.", "")


def _labels(host_: Column) -> Column:
    return F.split(host_, r"\.")


def _is_address(host_: Column) -> Column:
    return host_.rlike(r"^[0-9.]+$") | host_.contains(":") | (host_ == F.lit(MALFORMED))


def _suffix(parts: Column, suffixes: tuple[str, ...]) -> Column:
    n = F.size(parts)
    tail = lambda k: F.array_join(F.slice(parts, F.greatest(n - k + 1, F.lit(1)), k), ".")
    many = F.when((F.element_at(parts, -1) == "uk") & (n >= 2), 2).when((n >= 3) & tail(3).isin(*suffixes), 3).when((n >= 2) & tail(2).isin(*suffixes), 2)
    return many.otherwise(F.when(F.element_at(parts, -1) == "uk", F.lit(None).cast("int")).otherwise(1))


def _tail(parts: Column, n: Column) -> Column:
    return F.array_join(F.slice(parts, F.greatest(F.size(parts) - n + 1, F.lit(1)), n), ".")


def public_suffix(host_: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """Below ``.uk`` the last two labels; else the longest listed suffix, or the last label."""
    of = lambda parts: bound(_suffix(parts, suffixes), lambda n: F.when(n.isNotNull(), _tail(parts, n)))
    return bound(host_, lambda h: F.when(~_is_address(h), bound(_labels(h), of)))


def private_suffix(host_: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """The public suffix and one label more (the registered domain); the host itself if it has no more."""
    of = lambda parts: bound(F.coalesce(_suffix(parts, suffixes), F.lit(1)) + 1, lambda n: _tail(parts, n))
    return bound(host_, lambda h: F.when(_is_address(h), h).when(h.isNotNull(), bound(_labels(h), of)))


def host_levels(host_: Column) -> Column:
    """``[uk, co.uk, bbc.co.uk]``; empty for addresses and malformed hosts."""
    of = lambda parts: F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: _tail(parts, i))
    none = F.array().cast("array<string>")
    return bound(host_, lambda h: F.when(h.isNull() | _is_address(h) | (h == ""), none).otherwise(bound(_labels(h), of)))


def surt(host_: Column) -> Column:
    """``bbc.co.uk`` -> ``(uk,co,bbc,``."""
    return F.concat(F.lit("("), F.array_join(F.reverse(_labels(host_)), ","), F.lit(","))


def host_surts(host_: Column) -> Column:
    """The SURT of every level of a host."""
    return F.transform(host_levels(host_), lambda h: surt(h))


def url_surt(url: Column) -> Column:
    """``(uk,co,bbc,)/path``: host SURT and the rest; the URL itself where it has no host."""
    name = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(.*)$", 1)
    key = F.concat(F.lit("("), F.array_join(F.reverse(_labels(F.regexp_replace(F.lower(name), r"^www[0-9]*\.", ""))), ","), F.lit(",)"), rest)
    return F.when(name == "", url).otherwise(key)


def crawl_log_host(uri: Column) -> Column:
    """Host with port of an http(s) URI with a path, name of a ``dns:`` one, else null."""
    web = F.regexp_extract(uri, r"^https?://([^/]+)/.*$", 1)
    return F.when(uri.startswith("dns:"), F.replace(uri, F.lit("dns:"), F.lit(""))).when(web != "", web)


def distinct_suffixes(links: Column) -> Column:
    """Distinct public suffixes of an array of URLs."""
    return F.array_distinct(F.array_compact(F.transform(links, lambda u: public_suffix(host(u)))))


# --- paths -------------------------------------------------------------------


def path(url: Column) -> Column:
    """The path of a URL; ``/`` where it is empty."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return bound(found, lambda f: F.when(f == "", F.lit("/")).otherwise(f))


def url_type(url: Column) -> Column:
    """``slashpage``, ``robots.txt`` or ``normal``, by path."""
    return bound(path(url), _path_type)


def _path_type(p: Column) -> Column:
    return F.when((p == "/") | (p == "") | p.rlike(r"^/index\.[a-z]+$"), "slashpage").when(p == "/robots.txt", "robots.txt").otherwise("normal")


def resource_name(url: Column) -> Column:
    """The last path segment, without query."""
    last = F.element_at(F.split(url, "/"), -1)
    return F.regexp_extract(F.regexp_extract(last, r"^([^?]*)", 1), r"^([^&]*)", 1)


def extension(url: Column) -> Column:
    """Extension of the resource name, lower case letters and digits only; empty if there is none."""
    found = F.regexp_extract(resource_name(url), r"\.([^.]*)$", 1)
    return F.regexp_replace(F.lower(found), "[^0-9a-z]", "")


def endpoint(url: str) -> dict[str, str | int]:
    """Scheme, host, port (80 by default) and index of a search endpoint's URL."""
    parts = urlsplit(url)
    index = parts.path.strip("/").split("/")[0] if parts.path else ""
    if parts.scheme not in ("http", "https") or not parts.hostname or not index:
        raise ValueError(f"no search endpoint: {url}")
    return {"scheme": parts.scheme, "host": parts.hostname, "port": parts.port or 80, "index": index}


# --- sets of linked hosts --------------------------------------------------------

LINK_SETS = T.StructType([T.StructField(n, T.ArrayType(T.StringType())) for n in ("hosts", "domains", "suffixes", "surts")])
_URL_HOST = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")
_VALID_HOST, _ADDRESS = re.compile(_HOST), re.compile(r"^[0-9.]+$")


def _host_of(url: str) -> str:
    """As :func:`host`."""
    m = _URL_HOST.match(url)
    return m.group(1).lower() if m and len(m.group(1)) <= 255 and _VALID_HOST.match(m.group(1)) else MALFORMED


def link_sets(links: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """struct(hosts, domains, suffixes, surts): distinct values of an array of URLs, in their order, in one Arrow pass."""
    listed = frozenset(suffixes)

    def of(name: str) -> tuple[str, str | None, list[str]]:
        if name == MALFORMED or _ADDRESS.match(name):
            return name, None, []
        parts = name.split(".")
        levels = ["(" + ",".join(reversed(parts[-k:])) + "," for k in range(1, len(parts) + 1)]
        uk = parts[-1] == "uk"
        n = 2 if uk and len(parts) > 1 else 3 if len(parts) > 2 and ".".join(parts[-3:]) in listed else 2 if len(parts) > 1 and ".".join(parts[-2:]) in listed else None if uk else 1
        return ".".join(parts[-(n or 1) - 1 :]), n and ".".join(parts[-n:]), levels

    @F.pandas_udf(LINK_SETS)
    def run(column: pd.Series) -> pd.DataFrame:
        memo: dict[str, tuple[str, str | None, list[str]]] = {}
        out = []
        for urls_ in column:
            if urls_ is None:
                out.append((None, None, None, None))
                continue
            names = dict.fromkeys(_host_of(u) for u in urls_)
            for name in names:
                if name not in memo:
                    memo[name] = of(name)
            known = [memo[name] for name in names]
            out.append((list(names), list(dict.fromkeys(d for d, _, _ in known)), list(dict.fromkeys(s for _, s, _ in known if s)), list(dict.fromkeys(x for _, _, levels in known for x in levels))))
        return pd.DataFrame(out, columns=LINK_SETS.names)

    return run(links)
