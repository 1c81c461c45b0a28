"""Counting in Python with partial sums before the shuffle."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A task's partial counts are handed on when they have so many keys, which bounds its memory and changes no sum.
FLUSH_KEYS = 200_000


#: A batch is worked on in slices of about so many bytes of text and at most so many rows, which bounds a worker's memory.
SLICE_BYTES, SLICE_ROWS = 3_000_000, 2048


def slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices, by the sizes of the texts of a column; a longer text is a slice of its own."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            end = max(start + 1, min(start + SLICE_ROWS, int(np.searchsorted(ends, before + SLICE_BYTES, side="right"))))
            yield batch.slice(start, end - start)
            start = end


def sums(df: DataFrame, keys: str, count: Callable[[pa.RecordBatch, Counter], None]) -> DataFrame:
    """(keys..., n): ``count`` adds a batch's key tuples to a counter; tasks pre-sum, then the shuffle sums."""
    fields = T.StructType.fromDDL(keys)
    names = [f.name for f in fields]
    schema = T.StructType([*fields.fields, T.StructField("n", T.LongType())])
    kinds = [pa.string() if isinstance(f.dataType, T.StringType) else pa.int64() for f in fields]

    def flushed(counter: Counter) -> pa.RecordBatch:
        keys_ = list(counter)
        columns = [pa.array([k[i] for k in keys_], type=kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(list(counter.values()), type=pa.int64())], names=[*names, "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter = Counter()
        for batch in batches:
            count(batch, counter)
            if len(counter) >= FLUSH_KEYS:
                yield flushed(counter)
                counter = Counter()
        yield flushed(counter)

    return df.mapInArrow(run, schema).groupBy(*names).agg(F.sum("n").alias("n"))
