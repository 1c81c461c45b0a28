"""Lines repeated over one source's documents.

Method: per source (domain), a line-count table is kept incrementally. Its
state is two tables: ``crossed`` (source and line with at least ``min_urls``
distinct urls) and ``pending`` (the distinct source, line and url triples of
all other lines). A new partition of documents is merged as a delta: triples of
lines that crossed before are dropped, the rest joins the pending ones, and
lines that now reach the threshold are the newly crossed ones. Only documents
that contain a newly crossed line, and new documents, are rebuilt, without any
crossed line. :func:`incremental_lines` and :func:`incremental_clean` load a
table so; :func:`repeated_lines` gives the same rows at once.

Sources and lines are named by a 128-bit pair of hashes, urls by a 64-bit one.
A hot source spreads over all tasks, as every shuffle is on (source, line), and
a line on most pages of the corpus is a heavy key of :func:`semi_join_heavy`.

Defined results: lines are split at ``\\n`` and numbered from 1; two lines are
the same if their letters agree ignoring case, any run of other characters
counting as one gap; lines without letters, and rows whose source, url or text
is null, are never cases; repeated rows are cases each, but count one url.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wrackline.operators.skew import semi_join_heavy
from wrackline.session import staged

KEY = ["k1", "k2"]


def line_form(line: Column) -> Column:
    """A line's letters in lower case; each run of other characters is one gap, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{M}]+", " "))


def line_keys(df: DataFrame, key: str, source: str, url: str, text: str) -> DataFrame:
    """(key, line_no, k1, k2, u): the hashed (source, line) and url of each line with letters."""
    rows = df.select(F.col(key), F.col(source).cast("string").alias("_s"), F.xxhash64(F.col(url).cast("string")).alias("u"), F.col(text).cast("string").alias("_t"), F.col(url).isNotNull().alias("_u"))
    rows = rows.where("_s IS NOT NULL AND _t IS NOT NULL AND _u")
    lines = rows.select(key, "u", "_s", F.posexplode(F.split("_t", "\n")).alias("_p", "_line"))
    formed = lines.select(key, (F.col("_p") + 1).cast("int").alias("line_no"), "u", "_s", line_form(F.col("_line")).alias("_f")).where("_f <> ''")
    return formed.select(key, "line_no", F.xxhash64("_s", "_f").alias("k1"), F.xxhash64("_f", F.lit(7), "_s").alias("k2"), "u")


@dataclass
class LineCounts:
    """State of the incremental line-count tables."""

    crossed: DataFrame | None = None  # k1, k2
    pending: DataFrame | None = None  # k1, k2, u


def merge_delta(state: LineCounts, delta: DataFrame, min_urls: int = 5) -> tuple[LineCounts, DataFrame]:
    """(new state, newly crossed lines): ``delta`` has k1, k2 and u of the new documents' lines."""
    fresh = delta.select(*KEY, "u")
    if state.crossed is not None:
        fresh = fresh.join(state.crossed, KEY, "left_anti")
    if state.pending is not None:
        fresh = fresh.unionByName(state.pending)
    fresh = fresh.distinct()
    counted = fresh.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_urls"))
    newly = counted.where(F.col("n_urls") >= min_urls).select(*KEY)
    crossed = newly if state.crossed is None else state.crossed.unionByName(newly)
    return LineCounts(crossed, fresh.join(newly, KEY, "left_anti")), newly


def crossed_lines(lines: DataFrame, crossed: DataFrame) -> DataFrame:
    """The rows of ``lines`` whose (source, line) is in ``crossed``."""
    weighed = lines.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).join(crossed, KEY, "left_semi")
    return semi_join_heavy(lines, staged(weighed, "crossed-lines"), KEY, "n")


def repeated_lines(df: DataFrame, key: str, source: str, url: str, text: str, min_urls: int = 5) -> DataFrame:
    """(key, line_no) of lines on at least ``min_urls`` distinct urls of their source, from an empty state.

    The count of urls and the count of rows of a line come from one shuffle.
    """
    lines = line_keys(df, key, source, url, text)
    per_url = lines.groupBy(*KEY, "u").agg(F.count(F.lit(1)).alias("c"))
    counted = per_url.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_urls"), F.sum("c").alias("n"))
    crossed = staged(counted.where(F.col("n_urls") >= min_urls).select(*KEY, "n"), "crossed-lines")
    return semi_join_heavy(lines, crossed, KEY, "n").select(key, "line_no")


def deltas(df: DataFrame, key: str, source: str, url: str, text: str, by: str) -> tuple[DataFrame, list[str]]:
    """(the rows of :func:`line_keys` with ``delta``, written once; the deltas in order): one delta a value of ``by``, null being one too."""
    delta = F.coalesce(F.col(by).cast("string"), F.lit(""))
    keyed = line_keys(df.withColumn("_delta", F.struct(F.col(key).alias("k"), delta.alias("d"))), "_delta", source, url, text)
    keyed = keyed.select(F.col("_delta.k").alias(key), "line_no", *KEY, "u", F.col("_delta.d").alias("delta"))
    names = sorted(r[0] for r in df.select(delta).distinct().collect())
    return staged(keyed, "line-keys"), names


def load(keyed: DataFrame, names: list[str], min_urls: int = 5) -> Iterator[tuple[str, LineCounts, DataFrame]]:
    """(delta, state after it, newly crossed lines) of each delta in turn; every state table is written before the next delta."""
    state = LineCounts()
    for name in names:
        merged, newly = merge_delta(state, keyed.where(F.col("delta") == name), min_urls)
        newly = staged(newly, "newly-crossed")
        crossed = newly if state.crossed is None else state.crossed.unionByName(newly)
        state = LineCounts(crossed, staged(merged.pending, "pending"))
        yield name, state, newly


def found_lines(keyed: DataFrame, key: str, crossed: DataFrame) -> DataFrame:
    """(key, line_no) of all lines in ``crossed``."""
    return crossed_lines(keyed, crossed).select(key, "line_no")


def incremental_lines(df: DataFrame, key: str, source: str, url: str, text: str, by: str, min_urls: int = 5) -> DataFrame:
    """(key, line_no) as :func:`repeated_lines`, from one delta a value of ``by`` merged into written state tables."""
    keyed, names = deltas(df, key, source, url, text, by)
    state = None
    for _, state, _ in load(keyed, names, min_urls):
        pass
    return found_lines(keyed, key, state.crossed) if state else keyed.select(key, "line_no")


def incremental_clean(df: DataFrame, key: str, source: str, url: str, text: str, by: str, min_urls: int = 5) -> DataFrame:
    """(key, content_clean) of every row: after each delta only its own documents and those with newly crossed lines are rebuilt. Keys must be unique."""
    keyed, names = deltas(df, key, source, url, text, by)
    delta = F.coalesce(F.col(by).cast("string"), F.lit(""))
    out = df.select(key, F.col(text).alias("content_clean")).limit(0)
    for name, state, newly in load(keyed, names, min_urls):
        seen = df.where(delta <= name)
        built = staged(rebuild(seen, key, text, keyed.where(F.col("delta") <= name), newly, state.crossed, df.where(delta == name).select(key)), "rebuilt")
        out = out.join(built.select(key), key, "left_anti").unionByName(built)
    return out


def without_lines(df: DataFrame, key: str, text: str, found: DataFrame, out: str = "content_clean") -> DataFrame:
    """``df`` with ``out``: ``text`` without the lines of ``found`` (key, line_no). Keys must be unique."""
    cut = found.groupBy(key).agg(F.collect_set("line_no").alias("_cut"))
    kept = F.filter(F.split(F.col(text), "\n"), lambda line, i: ~F.array_contains(F.col("_cut"), i + 1))
    joined = df.join(cut, key, "left")
    return joined.withColumn(out, F.when(F.col("_cut").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))).drop("_cut")


def rebuild(df: DataFrame, key: str, text: str, lines: DataFrame, newly: DataFrame, crossed: DataFrame | None = None, fresh: DataFrame | None = None) -> DataFrame:
    """(key, content_clean) of only the documents that contain a newly crossed line or are listed in ``fresh`` (key).

    They lose all lines of ``crossed``, the state's lines that crossed now or
    before; without it ``newly`` are all there are.
    """
    touched = crossed_lines(lines, newly).select(key)
    touched = (touched if fresh is None else touched.unionByName(fresh.select(key))).distinct()
    changed = df.join(touched, key, "left_semi")
    found = crossed_lines(lines, newly if crossed is None else crossed).select(key, "line_no")
    return without_lines(changed.select(key, text), key, text, found).select(key, "content_clean")
