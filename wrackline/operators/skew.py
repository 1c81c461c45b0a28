"""Per-key results and joins that stay balanced when a few keys hold most rows.

Every aggregate here is algebraic: Spark's hash aggregation combines rows into
one compact state per key inside each map task (spilling its hash map when it
outgrows memory), so only partial states are shuffled and a key with a third of
all rows costs its reducer one state per map task, not its rows.

Defined results: a null key never is a key (its rows still count in totals);
an empty table gives an empty result; equal rows count as often as they occur;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """(key_field, key_value, n) of each non-null value of each of ``keys``.

    All key columns are combined in one shuffle: rows are first folded by the
    tuple of keys, and only these partial counts are unpivoted.
    """
    tuples = df.groupBy(*[F.col(k).cast("string").alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("_n"))
    pairs = F.array(*[F.struct(F.lit(k).alias("key_field"), F.col(f"_k{i}").alias("key_value")) for i, k in enumerate(keys)])
    long = tuples.select(F.explode(pairs).alias("_p"), "_n").select("_p.key_field", "_p.key_value", "_n")
    return long.where(F.col("key_value").isNotNull()).groupBy("key_field", "key_value").agg(F.sum("_n").alias("n"))


def dominant_keys(df: DataFrame, keys: list[str], share: float = 0.05) -> DataFrame:
    """(key_field, key_value, n, n_rows) of key values that hold at least ``share`` of all rows.

    The number of all rows is a scalar subquery (one row), at most ``1/share``
    values of a field can qualify.
    """
    total = df.agg(F.count(F.lit(1)).alias("n_rows")).scalar()
    return key_counts(df, keys).withColumn("n_rows", total).where(F.col("n") >= share * F.col("n_rows"))


def key_profile(df: DataFrame, key: str, measures: dict[str, Column], distinct: dict[str, str] | None = None) -> DataFrame:
    """One row per non-null ``key`` with algebraic ``measures`` and exact distinct counts.

    ``distinct`` maps an output column to the column counted. Distinct counts
    are taken in two steps, on (key, value) and then on the key, so the values
    of a hot key are spread over all reducers.
    """
    rows = df.where(F.col(key).isNotNull())
    out = rows.groupBy(key).agg(*[m.alias(n) for n, m in measures.items()])
    for name, of in (distinct or {}).items():
        values = rows.where(F.col(of).isNotNull()).select(F.col(key).alias("_key"), F.col(of).alias("_v")).groupBy("_key", "_v").agg(F.count(F.lit(1)).alias("_c"))
        per_key = values.groupBy("_key").agg(F.count(F.lit(1)).alias(name))
        out = out.join(per_key, out[key] == per_key["_key"], "left").drop("_key").withColumn(name, F.coalesce(F.col(name), F.lit(0)))
    return out


def semi_join_heavy(rows: DataFrame, keyed: DataFrame, on: list[str], weight: str, heavy_share: float = 2e-4) -> DataFrame:
    """Rows whose ``on`` columns occur in ``keyed``, balanced under hot keys.

    ``keyed`` has one row per key and a column ``weight``: the number of rows of
    ``rows`` with that key. Keys that hold at least ``heavy_share`` of the total
    weight are at most ``1/heavy_share`` (5,000) many, whatever the data, so
    these are broadcast; no remaining key holds more than that share, so the
    rest is an ordinary shuffled semi join. No row is dropped or moved twice.
    """
    total = F.coalesce(keyed.agg(F.sum(weight)).scalar(), F.lit(0))
    bar = heavy_share * total
    heavy = keyed.where(F.col(weight) >= bar).select(*on, F.lit(True).alias("_heavy"))
    light = keyed.where(F.col(weight) < bar).select(*on)
    marked = rows.join(F.broadcast(heavy), on, "left")
    hot = marked.where(F.col("_heavy")).drop("_heavy")
    cold = marked.where(F.col("_heavy").isNull()).drop("_heavy").join(light, on, "left_semi")
    return hot.unionByName(cold)
