"""Text clean-up, tokens, n-grams and extraction."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wrackline.functions import bound

#: Pattern of UK postcodes in running text (a fixed value).
POSTCODE = r"[A-Z]{1,2}[0-9R][0-9A-Z]? [0-9][ABD-HJLNP-UW-Z]{2}"
#: The letters that a whole UK postcode may have at each place, and its outward forms.
_FIRST, _SECOND, _INWARD = "[A-PR-UWYZ]", "[A-HK-Y]", "[0-9][ABD-HJLNP-UW-Z]{2}"
POSTCODE_FORMS = (f"{_FIRST}[0-9]{{1,2}}", f"{_FIRST}{_SECOND}[0-9]{{1,2}}", f"{_FIRST}[0-9][A-HJKS-UW]", f"{_FIRST}{_SECOND}[0-9][A-Z]")
#: Labels of sentiment scores.
SENTIMENTS = ("Very Negative", "Negative", "Mildly Negative", "Neutral", "Mildly Positive", "Positive", "Very Positive")


def adjust(value: Column, max_length: int | None = None, rewrites: Sequence[tuple[str, str]] = ()) -> Column:
    """Clean field value: no control characters, single spaces, rewrites in order, cut to length; null when empty.

    Control characters go before white space is collapsed, so lines run together.
    """
    out = F.regexp_replace(F.coalesce(value, F.lit("")), r"\p{Cntrl}", "")
    out = F.trim(F.regexp_replace(F.make_valid_utf8(out), r"\s+", " "))
    for pattern, to in rewrites:
        out = F.regexp_replace(out, pattern, to)
    if max_length is not None:
        out = F.substring(out, 1, max_length)
    return bound(out, lambda v: F.when(v != "", v))


def limit_values(values: Column, max_values: int, distinct: bool = True) -> Column:
    """At most ``max_values`` of an array, by default distinct ones."""
    return F.slice(F.array_distinct(values) if distinct else values, 1, max_values)


def trim_spaces(text: Column) -> Column:
    """White space runs to a line break if they hold one, else to a space; none at the ends."""
    runs = F.regexp_replace(text, r"\s*\n\s*", "\n")
    return F.regexp_replace(F.regexp_replace(runs, r"[^\S\n]+", " "), r"^\s+|\s+$", "")


def postcodes(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"({POSTCODE})"), F.lit(0)))


def postcode_districts(text: Column) -> Column:
    return F.array_distinct(F.transform(postcodes(text), lambda p: F.substring_index(p, " ", 1)))


def is_postcode(text: Column) -> Column:
    """Whether a whole text is a valid postcode, in any case and with or without blanks before its last three signs."""
    return text.rlike(f"(?i)^(?:(?:{'|'.join(POSTCODE_FORMS)}) *{_INWARD}|GIR *0AA)$")


def sentiment(score: Column) -> Column:
    """One of seven labels from a signed score, on a logarithmic scale."""
    bucket = (F.lit(7.0) * (F.lit(0.5) + F.signum(score) * F.log1p(F.abs(score)) / 40)).cast("int")
    return F.element_at(F.array(*map(F.lit, SENTIMENTS)), F.greatest(F.lit(0), F.least(F.lit(6), bucket)) + 1)


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def path_tokens(text: Column, stop: Sequence[str] = ("http", "https", "www", "com", "org", "net", "html", "htm", "index")) -> Column:
    """Words of a URL or path without stop words."""
    return F.filter(tokens(text), lambda w: ~w.isin(*stop))


def _runs(size: Column, least: int, most: int, cut: Callable[[Column, int], Column]) -> Column:
    none = F.array().cast("array<string>")

    def of(n: int) -> Column:
        return F.when(size >= n, F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: cut(i, n))).otherwise(none)

    return F.flatten(F.array(*[of(n) for n in range(least, most + 1)]))


def shingles(words: Column, least: int, most: int) -> Column:
    """Runs of ``least`` to ``most`` words, joined by a space."""
    return bound(words, lambda w: _runs(F.size(w), least, most, lambda i, n: F.array_join(F.slice(w, i, n), " ")))


def char_ngrams(text: Column, least: int = 2, most: int = 5) -> Column:
    """All substrings of ``least`` to ``most`` characters."""
    return bound(text, lambda t: _runs(F.length(t), least, most, lambda i, n: t.substr(i, F.lit(n))))


def letter_trigrams(text: Column) -> Column:
    """Trigrams of lower-case letters; other characters become one separator ``_``."""
    spaced = F.concat(F.lit("_"), F.regexp_replace(F.lower(text), r"[^\p{L}]+", "_"), F.lit("_"))
    return char_ngrams(F.regexp_replace(spaced, "_+", "_"), 3, 3)


def path_levels(path: Column, up: bool = False) -> Column:
    """``/a/b`` -> ``[/a, /a/b]``, or its tails ``[a/b, b]``."""
    return bound(F.filter(F.split(path, "/"), lambda p: p != ""), lambda parts: _path_levels(parts, up))


def _path_levels(parts: Column, up: bool) -> Column:
    size = F.size(parts)
    numbers = F.when(size > 0, F.sequence(F.lit(1), size)).otherwise(F.array().cast("array<int>"))
    if up:
        return F.transform(numbers, lambda i: F.array_join(F.slice(parts, i, size), "/"))
    return F.transform(numbers, lambda i: F.concat(F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")))


def possessive(text: Column) -> Column:
    """English words without 's."""
    return F.regexp_replace(text, r"['’][sS]\b", "")


def tight(text: Column) -> Column:
    """Words with inner hyphens closed and plural s dropped, as for part numbers."""
    return F.transform(F.filter(F.split(F.lower(F.regexp_replace(text, r"(?<=\w)-(?=\w)", "")), r"[^\p{L}\p{N}]+"), lambda w: w != ""), lambda w: F.regexp_replace(w, "s$", ""))


def reversed_tokens(text: Column) -> Column:
    return F.transform(tokens(text), F.reverse)


def phonetic(text: Column) -> Column:
    """Sound codes of the words."""
    return F.array_distinct(F.transform(tokens(text), F.soundex))


def without_elision(text: Column, articles: Sequence[str] = ("l", "m", "t", "qu", "n", "s", "j", "d", "c", "b", "dh")) -> Column:
    """Leading elided articles (l', d', ...) dropped from words."""
    return F.regexp_replace(F.lower(text), r"\b(?:" + "|".join(articles) + r")['’](?=\p{L})", "")


def without_stopwords(words: Column, stop: Sequence[str]) -> Column:
    return F.filter(words, lambda w: ~w.isin(*stop)) if stop else words


def split_srcset(srcset: Column) -> Column:
    """The addresses of a srcset attribute."""
    return F.filter(F.transform(F.split(srcset, ","), lambda p: F.substring_index(F.trim(p), " ", 1)), lambda p: p != "")


def software_of(text: Column) -> Column:
    """The software named by an image's text entry, without its keyword."""
    return F.nullif(F.trim(F.regexp_extract(text, r"(?i)^(?:keyword=)?software[:=, ]+(?:value=)?(.*)$", 1)), F.lit(""))


def document_size(values: Column) -> Column:
    """Approximate bytes of a document in memory from the array of its values."""
    return F.aggregate(values, F.lit(300).cast("bigint"), lambda n, v: n + 80 + 2 * F.coalesce(F.length(v), F.lit(0)))


def faces(values: Column, kind: str) -> Column:
    """Sorted face boxes of one kind, joined by a space."""
    return F.array_join(F.filter(F.array_sort(values), lambda v: v.startswith(kind)), " ")


def host_pairs(host: Column, linked: Column) -> Column:
    """``host<TAB>linked host`` for each linked host."""
    return F.transform(linked, lambda h: F.concat_ws("\t", host, h))
