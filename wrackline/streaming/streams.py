"""Streaming forms of the batch operators; state is bounded by watermarks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def landing(spark: SparkSession, path: str, schema, form: str = "parquet", max_files: int = 1000) -> DataFrame:
    """New files of a folder as a stream."""
    return spark.readStream.format(form).schema(schema).option("maxFilesPerTrigger", max_files).load(path)


def landing_archives(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    return spark.readStream.format("warc").option("path", path).option("maxFilesPerTrigger", max_files).load()


def captures_per_window(df: DataFrame, time: str, keys: list[str], length: str, slide: str | None = None, late: str = "1 day") -> DataFrame:
    """Captures per tumbling or sliding window and key."""
    window = F.window(time, length, slide) if slide else F.window(time, length)
    return df.withWatermark(time, late).groupBy(window, *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n")


def sessions(df: DataFrame, time: str, keys: list[str], gap: str, late: str = "1 day") -> DataFrame:
    """Sessions of events that follow each other within a gap."""
    return df.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")


def without_duplicates(df: DataFrame, key: list[str], time: str, late: str = "1 day") -> DataFrame:
    """The first row of each key within the watermark."""
    return df.withWatermark(time, late).dropDuplicatesWithinWatermark(key)


def revisits_with_response(revisits: DataFrame, responses: DataFrame, time: str, within: str = "1 day") -> DataFrame:
    """Stream-stream left join of revisits with responses of the same digest in a time range; unmatched ones follow when the watermark passes."""
    left = revisits.withWatermark(time, within).alias("v")
    right = responses.withWatermark(time, within).alias("r")
    near = F.expr(f"v.digest = r.digest AND r.{time} >= v.{time} - INTERVAL {within} AND r.{time} <= v.{time} + INTERVAL {within}")
    return left.join(right, near, "leftOuter").select("v.*", F.col("r.url").alias("response_url"), F.col(f"r.{time}").alias("response_time"))


def first_response_state(df: DataFrame, time: str, late: str = "1 day", wait_ms: int = 86_400_000, salts: int = 16) -> DataFrame:
    """(digest, url, record_type, response_url): revisits resolved by kept state of each digest's first response.

    ``df`` has digest, url, record_type and an event time. The state of a digest
    is one URL; revisits that come first are held (as their URLs) until a
    response comes, or come out as they are when the watermark passes their time
    by ``wait_ms``. A digest's revisits are spread over ``salts`` states, each of
    which gets every response, so that a hot digest is not one task's work; the
    response itself comes out once.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known, waiting = state.get if state.exists else (None, [])
        waiting, out = list(waiting or []), []
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({"digest": [key[0]] * len(waiting), "url": waiting, "record_type": ["revisit"] * len(waiting), "response_url": [None] * len(waiting)})
            return
        last = 0
        for frame in frames:
            for url, kind, stamp in zip(frame["url"], frame["record_type"], frame[time]):
                last = max(last, int(stamp.timestamp() * 1000))
                if kind == "response":
                    known = known or url
                    if key[1] == 0:
                        out.append((url, kind, None))
                else:
                    waiting.append(url)
        if known:
            out += [(u, "reduplicated", known) for u in waiting]
            waiting = []
        state.update((known, waiting))
        state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + wait_ms)
        yield pd.DataFrame([(key[0], *row) for row in out], columns=["digest", "url", "record_type", "response_url"])

    numbers = F.sequence(F.lit(0), F.lit(salts - 1))
    own = F.array(F.pmod(F.xxhash64("url"), F.lit(salts)).cast("int"))
    salted = df.withWatermark(time, late).withColumn("_salt", F.explode(F.when(F.col("record_type") == "response", numbers).otherwise(own)))
    return salted.groupBy("digest", "_salt").applyInPandasWithState(step, "digest string, url string, record_type string, response_url string", "known string, waiting array<string>", "append", GroupStateTimeout.EventTimeTimeout)


def with_reloaded_exclusions(df: DataFrame, load: Callable[[], DataFrame], exclude: Callable[[DataFrame, DataFrame], DataFrame], write: Callable[[DataFrame, int], None], checkpoint: str):
    """A started query that reads the exclusion list anew for every micro-batch before it writes."""

    def batch(rows: DataFrame, number: int) -> None:
        write(exclude(rows, load()), number)

    return df.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_to_memory(df: DataFrame, name: str, mode: str = "append", seconds: int = 120) -> DataFrame:
    """Run a stream over what is there and give its result as a table (for tests and small results)."""
    query = df.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    try:
        if not query.awaitTermination(seconds):
            raise TimeoutError(f"the stream {name} did not end in {seconds} s; its result is not whole")
    finally:
        query.stop()
    return df.sparkSession.table(name)


def run_to_folder(df: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """Run a stream over what is there and give its result, written to ``folder/out`` with its progress in ``folder/progress``.

    ``complete`` writes the whole result of each micro-batch over the last one.
    """
    spark, out = df.sparkSession, f"{folder}/out"
    if mode == "append":
        writer = df.writeStream.format("parquet").option("path", out)
    else:
        writer = df.writeStream.outputMode(mode).foreachBatch(lambda rows, number: rows.write.mode("overwrite").parquet(out))
    writer.option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(out)
