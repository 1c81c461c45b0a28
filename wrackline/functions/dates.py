"""Dates of captures and dates in text, and coordinates."""

from __future__ import annotations

import re
from datetime import datetime

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wrackline.functions import bound


def crawl_date(stamp: Column) -> Column:
    """Timestamp of 12, 14, 16 or more digits (punctuation ignored); null for other lengths."""
    digits = F.regexp_replace(stamp, "[^0-9]", "")
    full = bound(digits, lambda d: F.when(F.length(d) == 12, F.concat(d, F.lit("00"))).when(F.length(d) >= 14, F.substring(d, 1, 14)))
    return F.try_to_timestamp(full, F.lit("yyyyMMddHHmmss"))


def wayback_date(stamp: Column) -> Column:
    """The 14-digit number of a stamp."""
    return F.date_format(crawl_date(stamp), "yyyyMMddHHmmss").cast("bigint")


def year(stamp: Column) -> Column:
    """The first four digits; ``unknown`` for none or 0000."""
    found = F.regexp_extract(stamp, r"^(\d{4})", 1)
    return F.when(stamp.isNull() | (found == "") | (found == "0000"), "unknown").otherwise(found)


#: English month names (fixed values).
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
_MONTH = {name[:n]: k + 1 for k, name in enumerate(MONTHS) for n in (3, len(name))}
_SEP = r"\s?[-:/.,\s]\s?"
_DAY, _MON, _YEAR = r"(?P<d>\d{1,2})(?:st|nd|rd|th)?", r"(?P<m>\d{1,2}|[A-Za-z]{3,9})", r"(?P<y>\d{4})"
_TIME = r"(?:[T\s,]+(?P<H>\d{1,2}):(?P<M>\d{2})(?::(?P<S>\d{2}))?)?"
_FORMS = [re.compile(r"(?<!\d)" + _SEP.join(f) + r"(?!\d)" + _TIME) for f in ((_DAY, _MON, _YEAR), (_MON, _DAY, _YEAR), (_YEAR, _MON, _DAY))]


def date_in(text: str | None) -> datetime | None:
    """The first date of a text read day first, then month first, then year first, with its time if one follows."""
    if not text:
        return None
    for form in _FORMS:
        for m in form.finditer(text):
            month = m["m"].lower()
            number = int(month) if month.isdigit() else _MONTH.get(month)
            try:
                return datetime(int(m["y"]), number or 0, int(m["d"]), int(m["H"] or 0), int(m["M"] or 0), int(m["S"] or 0))
            except ValueError:
                continue
    return None


def extract_date(text: Column) -> Column:
    @F.pandas_udf(T.TimestampType())
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([date_in(t) for t in texts], dtype="datetime64[us]")

    return run(text)


def dms_to_degrees(text: Column) -> Column:
    """Degrees of ``51° 30' 12.3"`` (comma decimals allowed, a minus sign applies to the whole)."""
    clean = F.replace(text, F.lit(","), F.lit("."))
    part = lambda i: F.coalesce(F.nullif(F.regexp_extract(clean, r"^\s*(-?)\s*([\d.]+)\s*°\s*(?:([\d.]+)\s*['′])?\s*(?:([\d.]+)\s*[\"″])?", i), F.lit("")).try_cast("double"), F.lit(0.0))
    sign = F.when(F.regexp_extract(clean, r"^\s*(-?)", 1) == "-", -1.0).otherwise(1.0)
    return F.when(clean.contains("°"), sign * (part(2) + part(3) / 60 + part(4) / 3600))


def valid_location(lat: Column, lon: Column) -> Column:
    """Coordinates that are not zero and in range."""
    return (lat != 0) & (lon != 0) & lat.between(-90, 90) & lon.between(-180, 180)
