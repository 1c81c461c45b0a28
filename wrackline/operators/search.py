"""Queries of the index layer over a document table: terms, ranking, snippets, similarity, places."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wrackline.functions import text


def all_text(columns: Sequence[str]) -> Column:
    """The text of several fields, for searching."""
    return F.concat_ws(" ", *columns)


def search(df: DataFrame, query: str, column: str, id_: str, rows: int = 50, start: int = 0, where: Column | None = None, phrase_boost: float = 2.0) -> DataFrame:
    """(id, score, snippet): documents with all query words, by term frequency with a boost for the phrase; ties by id."""
    words = [w for w in query.lower().split() if w]
    if not words:
        raise ValueError("empty query")
    low = F.lower(F.col(column))
    tokens = text.tokens(F.col(column))
    kept = df if where is None else df.where(where)
    for w in words:  # cheap text test first, exact token test after
        kept = kept.where(low.contains(w))
    def occurrences(word: str) -> Column:
        return F.size(F.filter(F.col("_tokens"), lambda t: t == word))

    counts = [occurrences(w) for w in words]
    scored = kept.select(F.col(id_), F.col(column), tokens.alias("_tokens")).select(id_, column, *[c.alias(f"_n{i}") for i, c in enumerate(counts)])
    for i in range(len(words)):
        scored = scored.where(F.col(f"_n{i}") > 0)
    total = sum(F.col(f"_n{i}") for i in range(len(words))).cast("double")
    phrase = " ".join(words)
    boost = F.when(F.lower(F.col(column)).contains(phrase), phrase_boost).otherwise(1.0)
    at = F.instr(F.lower(F.col(column)), words[0])
    snippet = F.col(column).substr(F.greatest(at - 40, F.lit(1)), F.lit(120))
    return scored.select(id_, (total * boost).alias("score"), snippet.alias("snippet")).orderBy(F.desc("score"), id_).offset(start).limit(rows)


def top_terms(df: DataFrame, column: str, limit: int = 10_000) -> DataFrame:
    """(term, n): the most frequent words by occurrences."""
    words = df.where(F.col(column).isNotNull()).select(F.explode(text.tokens(F.col(column))).alias("term"))
    return words.groupBy("term").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "term").limit(limit)


def similar_hashes(hashes: DataFrame, key: str, hash_: str, queries: DataFrame, gram: int = 7, least: float = 0.5, max_queries: int = 100_000) -> DataFrame:
    """(query, key, similarity): fuzzy hashes that share character n-grams with a query, by Jaccard similarity of n-grams."""
    grams = lambda d: d.where(F.col(hash_).isNotNull()).select(key, F.array_distinct(text.char_ngrams(F.col(hash_), gram, gram)).alias("_g"))
    q = grams(queries).select(F.col(key).alias("query"), F.size("_g").alias("_nq"), F.explode("_g").alias("_x"))
    side = F.broadcast(q) if queries.count() <= max_queries else q
    d = grams(hashes).select(key, F.size("_g").alias("_nd"), F.explode("_g").alias("_x"))
    shared = d.join(side, "_x").groupBy("query", key, "_nq", "_nd").agg(F.count(F.lit(1)).alias("_s"))
    return shared.withColumn("similarity", F.col("_s") / (F.col("_nq") + F.col("_nd") - F.col("_s"))).where(F.col("similarity") >= least).select("query", key, "similarity")


def distance_km(lat: Column, lon: Column, to_lat: float, to_lon: float) -> Column:
    """Great-circle distance to a place."""
    a = F.pow(F.sin(F.radians(F.lit(to_lat) - lat) / 2), 2) + F.cos(F.radians(lat)) * F.cos(F.radians(F.lit(to_lat))) * F.pow(F.sin(F.radians(F.lit(to_lon) - lon) / 2), 2)
    return 2 * 6371.0088 * F.asin(F.sqrt(a))


def within(df: DataFrame, lat: str, lon: str, to_lat: float, to_lon: float, km: float) -> DataFrame:
    """Rows within a radius, nearest first; a latitude band is filtered before the trigonometry."""
    band = km / 111.0
    near = df.where(F.col(lat).between(to_lat - band, to_lat + band)).withColumn("distance_km", distance_km(F.col(lat), F.col(lon), to_lat, to_lon))
    return near.where(F.col("distance_km") <= km).orderBy("distance_km")


def by_url(df: DataFrame, url: str, prefix: bool = False, column: str = "url") -> DataFrame:
    """Documents of a URL, or of all URLs that begin with it (both are pushed to the scan)."""
    return df.where(F.col(column).startswith(url) if prefix else F.col(column) == url)


def word_vectors(df: DataFrame, column: str, size: int = 100, least: int = 5, window: int = 5, seed: int = 42):
    """A Word2Vec model of the words of a column; ``findSynonyms(word, 10)`` gives the nearest."""
    from pyspark.ml.feature import Word2Vec

    words = df.where(F.col(column).isNotNull()).select(text.tokens(F.col(column)).alias("words"))
    return Word2Vec(vectorSize=size, minCount=least, windowSize=window, seed=seed, inputCol="words", outputCol="vector").fit(words)
