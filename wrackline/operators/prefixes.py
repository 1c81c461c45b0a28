"""Values that begin with one of many listed prefixes, without comparing each value with each prefix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def values_with_prefix(df: DataFrame, column: str, prefixes: DataFrame, prefix: str = "prefix") -> DataFrame:
    """(_v): the distinct values of ``column`` that begin with a listed prefix.

    Each distinct value is cut at the lengths that occur in the list (a scalar
    subquery: at most as many numbers as the longest prefix has characters), so
    that one semi join on equal text finds the hits; Spark broadcasts the list
    only while it is small. Null and empty prefixes match nothing.
    """
    listed = prefixes.where(F.col(prefix).isNotNull() & (F.col(prefix) != "")).select(F.col(prefix).alias("_x")).distinct()
    lengths = listed.agg(F.collect_set(F.length("_x")).alias("n")).scalar()
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("_v")).distinct().withColumn("_n", lengths)
    heads = values.select("_v", F.explode(F.transform(F.filter("_n", lambda n: n <= F.length("_v")), lambda n: F.col("_v").substr(F.lit(1), n))).alias("_x"))
    return heads.join(listed, "_x", "left_semi").select("_v").distinct()
