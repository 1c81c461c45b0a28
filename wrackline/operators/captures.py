"""Capture order and revisits: lengths, carried-forward responses, reduplication.

Defined results: records without a digest (null or empty) have no exemplar and
stay as they are; ties in time go to the least record by its sorted entries;
repeated rows are records each; files are ordered by offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wrackline.session import staged

#: Bits of the bitmap of digests with revisits.
MARKS = 1 << 26


def compressed_length(df: DataFrame, file: str, offset: str, file_size: str, out: str = "compressed_length") -> DataFrame:
    """Distance to the next record of the file, of the last one to the file's end."""
    after = F.lead(offset).over(Window.partitionBy(file).orderBy(offset))
    return df.withColumn(out, F.coalesce(after, F.col(file_size)) - F.col(offset))


def carry_forward(df: DataFrame, file: str, offset: str, is_state: Column, state: Column, out: str) -> DataFrame:
    """``out``: the last ``state`` before a row within its file, among rows where ``is_state`` holds."""
    before = Window.partitionBy(file).orderBy(offset).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.last(F.when(is_state, state), ignorenulls=True).over(before))


def metadata_with_response(df: DataFrame, file: str, offset: str, record_type: str, url: str, columns: list[str]) -> DataFrame:
    """Metadata records with the columns of the response or revisit just before them, if that has the same URL and no metadata took it yet."""
    typed = df.withColumn("_state", F.col(record_type).isin("response", "revisit")).withColumn("_use", F.col(record_type) == "metadata")
    order = Window.partitionBy(file).orderBy(offset)
    group = F.sum(F.col("_state").cast("int")).over(order)
    carried = carry_forward(typed.withColumn("_group", group), file, offset, F.col("_state"), F.struct(url, *columns), "_response")
    nth = F.sum(F.col("_use").cast("int")).over(Window.partitionBy(file, "_group").orderBy(offset))
    kept = carried.withColumn("_nth", nth).where("_use AND _nth = 1").where(F.col(f"_response.{url}") == F.col(url))
    return kept.select(*[c for c in df.columns if c not in columns], *[F.col(f"_response.{c}").alias(f"response_{c}") for c in columns])


def reduplicate(mdx: DataFrame, record: str = "mdx_map", share: float = 0.005) -> DataFrame:
    """Records with each revisit overlaid on the first response of its digest, its type ``reduplicated``.

    The exemplar of a digest is an algebraic minimum (partial before the
    shuffle), staged once for the digests with revisits. A bitmap of the
    revisits' hashed digests (``MARKS`` bits, 8 MB broadcast whatever the data)
    keeps most other responses out of that shuffle; those that share a bit by
    chance are dropped after it. Digests with at least ``share`` of all such
    revisits (at most ``1/share`` by pigeonhole) are broadcast, and their
    revisits are spread; all others are joined by digest with a shuffle,
    whatever their size.
    """
    entry = F.col(record)
    rows = mdx.select(entry, entry["digest"].alias("_digest"), F.coalesce(entry["record-type"], F.lit("")).alias("_type"))
    usable = F.col("_digest").isNotNull() & (F.col("_digest") != "")
    response, revisit = usable & (F.col("_type") == "response"), usable & (F.col("_type") == "revisit")
    rank = F.when(response, F.struct(F.coalesce(entry["timestamp"], F.lit("~")), F.to_json(F.array_sort(F.map_entries(entry)))))
    bit = F.pmod(F.xxhash64("_digest"), F.lit(MARKS)) + 1
    bucket, at = F.bitmap_bucket_number(bit), F.bitmap_bit_position(bit)
    every = mdx.sparkSession.range(1, MARKS + 1, 1 << 15).toDF("_bit")  # one bit of each bucket
    marks = rows.where(revisit).select(bit.alias("_bit")).union(every).groupBy(F.bitmap_bucket_number("_bit").alias("_b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    near = rows.where(response | revisit).join(F.broadcast(marks), bucket == F.col("_b"), "left").where(revisit | (F.getbit(byte, (at % 8).cast("int")) == 1))
    found = near.groupBy(F.col("_digest").alias("_d")).agg(F.min_by(record, rank).alias("_exemplar"), F.count_if(revisit).alias("_n"), F.count_if(response).alias("_m"))
    exemplars = staged(found.where("_n > 0 AND _m > 0").drop("_m"), "exemplars")
    least = (exemplars.agg(F.sum("_n")).first()[0] or 0) * share
    hot = exemplars.where(F.col("_n") >= least).select(F.col("_d").alias("_h"), F.col("_exemplar").alias("_hot"))
    rest = exemplars.where(F.col("_n") < least).drop("_n")
    others = rows.where(~revisit).select(record)
    spread = F.xxhash64(F.to_json(F.array_sort(F.map_entries(entry)))).cast("string")
    keyed = rows.where(revisit).join(F.broadcast(hot), F.col("_digest") == F.col("_h"), "left").withColumn("_k", F.when(F.col("_h").isNull(), F.col("_digest")).otherwise(spread))
    joined = keyed.join(rest.hint("merge"), F.col("_k") == F.col("_d"), "left").withColumn("_exemplar", F.coalesce("_hot", "_exemplar"))
    overlay = F.map_from_entries(
        F.concat(
            F.map_entries(F.map_filter("_exemplar", lambda k, _: ~F.map_contains_key(entry, k) & (k != "record-type"))),
            F.map_entries(F.map_filter(entry, lambda k, _: k != "record-type")),
            F.array(F.struct(F.lit("record-type").alias("key"), F.lit("reduplicated").alias("value"))),
        )
    )
    done = joined.select(F.when(F.col("_exemplar").isNull(), entry).otherwise(overlay).alias(record))
    return others.unionByName(done)


def persist_log(df: DataFrame, surt_key: str, columns: list[str]) -> DataFrame:
    """(value): SURT and base64 JSON of the columns, one line a record."""
    return df.select(F.concat_ws(" ", F.col(surt_key), F.base64(F.encode(F.to_json(F.struct(*columns)), "UTF-8"))).alias("value"))
