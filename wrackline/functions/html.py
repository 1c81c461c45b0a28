"""Features of HTML pages: links, images, elements, licences, first paragraph, dates."""

from __future__ import annotations

from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

FEATURES = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("links", T.ArrayType(T.StringType())),
        T.StructField("links_images", T.ArrayType(T.StringType())),
        T.StructField("licenses", T.ArrayType(T.StringType())),
        T.StructField("elements", T.ArrayType(T.StringType())),
        T.StructField("first_paragraph", T.StringType()),
        T.StructField("publication_date", T.StringType()),
        T.StructField("meta", T.MapType(T.StringType(), T.StringType())),
        T.StructField("text", T.StringType()),
        T.StructField("errors", T.IntegerType()),
    ]
)
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = {"p", "div", "br", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "title", "section", "article", "ul", "ol", "table", "header", "footer", "nav", "aside"}


class _Page(HTMLParser):
    def __init__(self, base: str):
        super().__init__(convert_charrefs=True)
        self.base, self.open = base, []
        self.links, self.images, self.licenses, self.elements = [], [], [], {}
        self.title, self.paragraph, self.in_paragraph, self.published, self.meta = None, None, False, None, {}
        self.text, self.errors = [], 0

    def _absolute(self, link: str | None) -> str | None:
        try:
            return urljoin(self.base, link.strip()) if link and link.strip() else None
        except ValueError:
            self.errors += 1
            return None

    def _add(self, to: list[str], link: str | None) -> None:
        full = self._absolute(link)
        if full:
            to.append(full)

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        self.elements.setdefault(tag)
        if tag == "link" and a.get("rel"):
            self.elements.setdefault(f"link/@rel={a['rel'].lower()}")
        if tag == "meta" and a.get("name"):
            self.elements.setdefault(f"meta/@name={a['name'].lower()}")
            self.meta[a["name"].lower()] = a.get("content") or ""
            if a["name"].lower() in ("originalpublicationdate", "dcterms.created", "article:published_time"):
                self.published = self.published or a.get("content")
        if tag == "base" and a.get("href"):
            self.base = self._absolute(a["href"]) or self.base
        if tag == "a" and a.get("href"):
            self._add(self.links, a["href"])
        if tag in ("a", "link", "area") and "license" in (a.get("rel") or "").lower().split():
            self._add(self.licenses, a.get("href"))
        if tag in ("body", "table", "td") and a.get("background"):
            self._add(self.images, a["background"])
        if tag == "img" and a.get("src"):
            self._add(self.images, a["src"])
        if a.get("srcset") and (tag == "img" or tag == "source" and "picture" in self.open):
            for part in a["srcset"].split(","):
                self._add(self.images, part.strip().split(" ")[0])
        if tag == "p" and self.paragraph is None:
            self.in_paragraph = True
            self.buffer = []
        if tag in _BLOCK:
            self.text.append("\n")
        if tag not in _VOID:
            self.open.append(tag)

    def handle_endtag(self, tag):
        if tag in self.open:
            while self.open and self.open[-1] != tag:
                self.open.pop()
                self.errors += 1
            self.open.pop()
        else:
            self.errors += 1
        if tag == "p" and self.in_paragraph:
            found = " ".join("".join(self.buffer).split())
            self.in_paragraph = False
            self.paragraph = found or None
        if tag in _BLOCK:
            self.text.append("\n")

    def handle_data(self, data):
        if self.open and self.open[-1] in ("script", "style"):
            return
        if self.open and self.open[-1] == "title":
            self.title = (self.title or "") + data
            return
        if self.in_paragraph:
            self.buffer.append(data)
        self.text.append(data)


def features(page: str | None, base: str | None) -> tuple | None:
    if page is None:
        return None
    p = _Page(base or "")
    try:
        p.feed(page)
        p.close()
    except Exception:  # noqa: BLE001 - a broken page keeps what was read
        p.errors += 1
    lines = (" ".join(line.split()) for line in "".join(p.text).split("\n"))
    return (p.title and " ".join(p.title.split()), list(dict.fromkeys(p.links)), list(dict.fromkeys(p.images)), list(dict.fromkeys(p.licenses)), sorted(p.elements), p.paragraph, p.published, p.meta, "\n".join(x for x in lines if x), p.errors)


def html_features(page: Column, base: Column) -> Column:
    """A struct of features of a page's source; null for null."""

    @F.pandas_udf(FEATURES)
    def run(pages: pd.Series, bases: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([features(p, b) or (None,) * len(FEATURES) for p, b in zip(pages, bases)], columns=FEATURES.names)

    return run(page, base)


def charset_of(payload: Column, served: Column) -> Column:
    """The charset that the header or the page itself names, in lower case."""
    head = F.decode(F.substring(payload, 1, 2048), "ISO-8859-1")
    of = lambda c: F.nullif(F.lower(F.regexp_extract(c, r"(?i)charset\s*=\s*[\"']?([A-Za-z0-9_:.-]+)", 1)), F.lit(""))
    return F.coalesce(of(served), of(head))


def decode_page(payload: Column, charset: Column) -> Column:
    """Text of a payload by charset; UTF-8 where none is named and the bytes are valid, else windows-1252."""

    def one(data, name):
        if data is None:
            return None
        raw = bytes(data)
        for enc in (name, "utf-8"):
            if enc:
                try:
                    return raw.decode(enc)
                except (LookupError, UnicodeDecodeError):
                    continue
        return raw.decode("cp1252", "replace")

    @F.pandas_udf(T.StringType())
    def run(data: pd.Series, names: pd.Series) -> pd.Series:
        return pd.Series([one(d, n) for d, n in zip(data, names)], dtype=object)

    return run(payload, charset)
