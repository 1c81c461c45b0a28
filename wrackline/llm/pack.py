"""Packing of texts, sized in tokens, into containers of fixed capacity.

Method: large-item matching. A container holds at most two pieces above a third
of its capacity: going down the sizes, each such piece is matched with the
largest other one that fits beside it. Smaller pieces then go, largest first,
into the container with the smallest gap that takes them (best fit).

Sizes are whole numbers up to the capacity, so this runs on the histogram of
sizes: at most ``capacity`` counts reach the driver, however many texts there
are. The plan it yields says which ranks of each size go to which run of
containers; ranks are taken by (size, hash bucket), so that a size held by a
third of all texts is spread over many tasks.

Defined results: a text is split only if it alone exceeds the capacity, into
full pieces and one rest; null and empty texts are pieces of no tokens and are
dealt round the containers (container 0 if there is no other); repeated rows
are pieces of their own; an empty table gives no rows; capacities that are null
or below one are ignored.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wrackline.llm import bpe
from wrackline.session import staged


class Plan:
    """Runs of containers for runs of ranks: rank ``r`` of size ``s`` in [lo, hi) is in ``base + (r - lo) // per``."""

    def __init__(self) -> None:
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.containers = 0
        self.used: dict[int, int] = {}

    def place(self, size: int, count: int, base: int, per: int = 1) -> None:
        at = self.used.get(size, 0)
        self.runs.append((size, at, at + count, base, per))
        self.used[size] = at + count

    def opened(self, count: int) -> int:
        self.containers += count
        return self.containers - count


def match_sizes(histogram: dict[int, int], capacity: int) -> Plan:
    """The plan for ``{size: how many}``; sizes are 1 to ``capacity``."""
    plan = Plan()
    left = {s: n for s, n in histogram.items() if n > 0 and s > 0}
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of containers (first, how many)
    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        s = large[-1]
        at = bisect.bisect_right(large, capacity - s) - 1
        if at == len(large) - 1 and left[s] == 1:
            at -= 1
        if at < 0:
            base = plan.opened(left[s])
            plan.place(s, left[s], base)
            gaps.setdefault(capacity - s, []).append((base, left[s]))
            left[s] = 0
        else:
            t = large[at]
            many = left[s] // 2 if t == s else min(left[s], left[t])
            base = plan.opened(many)
            plan.place(s, many, base)
            plan.place(t, many, base)
            gaps.setdefault(capacity - s - t, []).append((base, many))
            left[s] -= many
            left[t] -= many
            if not left[t] and t != s:
                large.pop(at)
        if not left[s]:
            large.remove(s)
    known = sorted(g for g in gaps if g > 0)
    for s in sorted((s for s in left if left[s] and 3 * s <= capacity), reverse=True):
        n = left[s]
        while n:
            at = bisect.bisect_left(known, s)
            if at == len(known):
                per = capacity // s
                runs = [(plan.opened(k), k, p) for k, p in ((n // per, per), (int(n % per > 0), n % per)) if k]
                gap, n = capacity, 0
                for base, k, p in runs:
                    plan.place(s, k * p, base, p)
                    _add_gap(gaps, known, gap - p * s, base, k)
                continue
            gap = known[at]
            base, many = gaps[gap].pop()
            per = gap // s
            full = min(many, n // per)
            if full:
                plan.place(s, full * per, base, per)
                n -= full * per
                _add_gap(gaps, known, gap - per * s, base, full)
            rest = many - full
            if rest and n:
                plan.place(s, n, base + full, n)
                _add_gap(gaps, known, gap - n * s, base + full, 1)
                full, rest, n = full + 1, rest - 1, 0
            if rest:
                gaps[gap].append((base + full, rest))
            if not gaps[gap]:
                del gaps[gap]
                known.remove(gap)
    return plan


def _add_gap(gaps: dict[int, list[tuple[int, int]]], known: list[int], gap: int, base: int, many: int) -> None:
    if gap > 0:
        if gap not in gaps:
            gaps[gap] = []
            bisect.insort(known, gap)
        gaps[gap].append((base, many))


def pieces(sizes: DataFrame, key: str, n_tokens: str, packs: list[tuple[int, int]]) -> DataFrame:
    """(pack_id, key, piece_no, start_token, n_tokens) of each text for each (pack_id, capacity)."""
    pack = F.explode(F.array(*[F.struct(F.lit(p).cast("int").alias("pack_id"), F.lit(c).cast("bigint").alias("capacity")) for p, c in packs]))
    rows = sizes.select(F.col(key), F.coalesce(F.col(n_tokens), F.lit(0)).cast("bigint").alias("_n"), pack.alias("_p"))
    last = F.greatest(F.ceil(F.col("_n") / F.col("_p.capacity")) - 1, F.lit(0)).cast("int")
    rows = rows.withColumn("piece_no", F.explode(F.sequence(F.lit(0), last)))
    start = F.col("piece_no").cast("bigint") * F.col("_p.capacity")
    return rows.select("_p.pack_id", key, "piece_no", start.alias("start_token"), F.least(F.col("_n") - start, F.col("_p.capacity")).alias("n_tokens"))


def ranked(rows: DataFrame, group: list[str], order: list[str], per_bucket: int = 1_000_000) -> DataFrame:
    """``rows`` with ``rank``, from 0 within ``group``, spread over hash buckets.

    A group is numbered bucket by bucket: rows within a bucket by a window, the
    buckets' first numbers from their counts. The number of buckets follows the
    number of rows, so that no window task gets much more than ``per_bucket``
    rows of one group.
    """
    buckets = max(8, rows.count() // per_bucket + 1)
    rows = rows.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = rows.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(*group, "_b", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_first"))
    inside = F.row_number().over(Window.partitionBy(*group, "_b").orderBy(*order)) - 1
    return rows.withColumn("_i", inside).join(firsts, [*group, "_b"]).withColumn("rank", F.col("_first") + F.col("_i")).drop("_b", "_i", "_first")


def pack(sizes: DataFrame, key: str, n_tokens: str, packs: list[tuple[int, int]]) -> DataFrame:
    """(pack_id, container, key, piece_no, start_token, n_tokens): every text in containers of every capacity."""
    parts = staged(pieces(sizes, key, n_tokens, packs), "pieces")
    found = parts.groupBy("pack_id", "n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()  # at most capacity + 1 rows a pack
    lookup = {}
    for pack_id, capacity in packs:
        plan = match_sizes({r["n_tokens"]: r["n"] for r in found if r["pack_id"] == pack_id}, capacity)
        runs = np.array(sorted(plan.runs), dtype=np.int64).reshape(-1, 5)
        first = np.searchsorted(runs[:, 0], np.arange(capacity + 2))
        lookup[pack_id] = (runs, first, plan.containers)
    shared = sizes.sparkSession.sparkContext.broadcast(lookup)
    rows = ranked(parts, ["pack_id", "n_tokens"], [key, "piece_no"])
    kind = sizes.schema[key].dataType
    schema = T.StructType([T.StructField("pack_id", T.IntegerType()), T.StructField("container", T.LongType()), T.StructField(key, kind), T.StructField("piece_no", T.IntegerType()), T.StructField("start_token", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packs_, size, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("pack_id", "n_tokens", "rank"))
            container = np.zeros(batch.num_rows, dtype=np.int64)
            for pack_id, (runs, first, containers) in shared.value.items():
                for s in np.unique(size[packs_ == pack_id]):
                    at = np.flatnonzero((packs_ == pack_id) & (size == s))
                    if s == 0:
                        container[at] = rank[at] % max(1, containers)
                        continue
                    own = runs[first[s] : first[s + 1]]
                    run = own[np.searchsorted(own[:, 1], rank[at], side="right") - 1]
                    container[at] = run[:, 3] + (rank[at] - run[:, 1]) // run[:, 4]
            yield pa.RecordBatch.from_arrays([batch.column("pack_id"), pa.array(container), batch.column(key), batch.column("piece_no"), batch.column("start_token"), batch.column("n_tokens")], names=schema.names)

    return rows.select("pack_id", key, "piece_no", "start_token", "n_tokens", "rank").mapInArrow(place, schema)


def pack_texts(documents: DataFrame, key: str, text: str, pack_sizes: DataFrame, folder: str | None = None) -> DataFrame:
    """Pack ``documents`` for each row of ``pack_sizes`` (pack_id, tokenizer, capacity; a parameter table of a few rows)."""
    wanted: dict[str, list[tuple[int, int]]] = {}
    for row in pack_sizes.select("pack_id", "tokenizer", "capacity").where("pack_id IS NOT NULL AND tokenizer IS NOT NULL AND capacity >= 1").distinct().collect():
        wanted.setdefault(row["tokenizer"], []).append((row["pack_id"], row["capacity"]))
    out = None
    for name, packs in sorted(wanted.items()):
        counted = staged(bpe.encode_column(documents, key, text, bpe.tokenizer_file(name, folder), lengths_only=True), "token-counts")
        done = pack(counted, key, "n_tokens", sorted(packs))
        out = done if out is None else out.unionByName(done)
    if out is None:
        return documents.limit(0).selectExpr("CAST(NULL AS INT) pack_id", "CAST(NULL AS BIGINT) container", key, "0 piece_no", "CAST(0 AS BIGINT) start_token", "CAST(0 AS BIGINT) n_tokens")
    return out
