"""Queries of problem 6: per-key results without imbalance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wrackline.operators import skew
from wrackline.session import table


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of host or domain that hold at least 5 % of all mementos."""
    return skew.dominant_keys(table(spark, sf_dir, "mementos"), ["host", "domain"]).select("key_field", "key_value")


def _profile(key: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return skew.key_profile(
            table(spark, sf_dir, "mementos"),
            key,
            {
                "n": F.count(F.lit(1)),
                "n_content": F.count("content"),
                "bytes": F.sum("content_length"),
                "first_crawl": F.min("wayback_date"),
                "last_crawl": F.max("wayback_date"),
            },
            {"n_urls": "url"},
        )

    return query


def _profile_sql(key: str) -> str:
    return f"""
        SELECT {key}, count(*) AS n, count(content) AS n_content, CAST(sum(content_length) AS BIGINT) AS bytes,
               min(wayback_date) AS first_crawl, max(wayback_date) AS last_crawl, count(DISTINCT url) AS n_urls
        FROM mementos WHERE {key} IS NOT NULL GROUP BY {key}"""


QUERIES = {"p6_found": p6_found, "p6_host_profile": _profile("host"), "p6_domain_profile": _profile("domain")}

SQL = {
    "p6_found": """
        WITH v AS (SELECT 'host' AS key_field, host AS key_value FROM mementos
                   UNION ALL SELECT 'domain', domain FROM mementos)
        SELECT key_field, key_value FROM v WHERE key_value IS NOT NULL GROUP BY ALL
        HAVING count(*) >= 0.05 * (SELECT count(*) FROM mementos)""",
    "p6_host_profile": _profile_sql("host"),
    "p6_domain_profile": _profile_sql("domain"),
}
