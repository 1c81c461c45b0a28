"""Byte-level BPE encoding of a text column with a public rank file.

Method: a text is cut into pre-tokens. Tier one resolves a pre-token that is
itself a vocabulary entry through a minimal perfect hash (hash, displace and
compare: one table slot per entry, no probing). Tier two encodes every other
pre-token with a heap of candidate merges over a doubly linked list of its
bytes. Each Python worker keeps a bounded memo of chunks it has seen.

Defined results: null and empty text both give the empty list; special-token
strings in a text are ordinary text; lone surrogates cannot occur in Parquet
strings; texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import heapq
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: the published pre-tokenisation pattern of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space of Unicode, the class that the pattern means by its white space escape (as escapes for a character class).
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Characters of all chunks in a worker's memo; reaching it empties the memo and changes no result.
MEMO_CHARS = 16_000_000

def tokenizer_file(name: str, folder: str | None = None) -> str:
    """Path of a public tokenizer's rank file; ``folder`` defaults to $TOKENIZER_DIR or /opt/tokenizers."""
    return os.path.join(folder or os.environ.get("TOKENIZER_DIR", "/opt/tokenizers"), f"{name}.tiktoken")


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id of a rank file (base64 token and rank per line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: merge the neighbours of lowest rank first, leftmost on ties."""
    n = len(piece)
    if n == 1:
        return [ranks[piece]]
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        rank, i, stop = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or end[j] != stop or ranks.get(piece[i:stop]) != rank:
            continue
        alive[j] = False
        end[i] = stop
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            longer = ranks.get(piece[i : end[after[i]]])
            if longer is not None:
                heapq.heappush(heap, (longer, i, end[after[i]]))
        if before[i] >= 0:
            longer = ranks.get(piece[before[i] : stop])
            if longer is not None:
                heapq.heappush(heap, (longer, before[i], stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = after[i]
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), elementwise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _hashes(words: list[str]) -> np.ndarray:
    from pandas.util import hash_array

    return hash_array(np.array(words, dtype=object), categorize=False)


class PerfectHash:
    """Minimal perfect hash from the strings of a fixed vocabulary to their ids (hash and displace)."""

    def __init__(self, words: list[str], ids: list[int]):
        keys = _hashes(words)
        if len(np.unique(keys)) != len(keys):
            raise ValueError("hash collision between vocabulary entries")
        n = self.n = max(1, len(words))
        self.buckets = max(1, n // 4)
        bucket = (keys % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        self.shift = np.zeros(self.buckets, dtype=np.uint64)
        slot_of = np.full(n, -1, dtype=np.int64)
        taken = np.zeros(n, dtype=bool)
        for b in np.argsort(starts[:-1] - starts[1:], kind="stable"):
            members = order[starts[b] : starts[b + 1]]
            if not len(members):
                break
            for base in range(0, 1 << 30, 256):
                shifts = np.arange(base, base + 256, dtype=np.uint64)
                slots = (_mix(keys[members][None, :] + (shifts[:, None] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(n)).astype(np.int64)
                free = ~taken[slots].any(axis=1)
                if len(members) > 1:
                    ranked = np.sort(slots, axis=1)
                    free &= (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
                hit = np.flatnonzero(free)
                if len(hit):
                    self.shift[b] = shifts[hit[0]]
                    taken[slots[hit[0]]] = True
                    slot_of[members] = slots[hit[0]]
                    break
        self.keys = np.zeros(n, dtype=np.uint64)
        self.ids = np.zeros(n, dtype=np.int32)
        self.words: list[str | None] = [None] * n
        self.keys[slot_of] = keys
        self.ids[slot_of] = np.asarray(ids, dtype=np.int32)
        for word, slot in zip(words, slot_of.tolist()):
            self.words[slot] = word

    def find(self, words: list[str]) -> list[int]:
        """The id of each word, -1 where it is no vocabulary entry."""
        if not words:
            return []
        keys = _hashes(words)
        shift = self.shift[(keys % np.uint64(self.buckets)).astype(np.int64)]
        slot = (_mix(keys + (shift + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(self.n)).astype(np.int64)
        same = self.keys[slot] == keys
        return [i if s and self.words[at] == w else -1 for w, at, s, i in zip(words, slot.tolist(), same.tolist(), self.ids[slot].tolist())]


class Encoder:
    """Encodes texts; picklable, its memo is each worker's own."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        whole = [(t, i) for t, i in ranks.items() if merge_bytes(t, ranks) == [i]]
        words, ids = [], []
        for token, i in whole:
            try:
                words.append(token.decode("utf-8"))
            except UnicodeDecodeError:
                continue
            ids.append(i)
        self.table = PerfectHash(words, ids)
        self._start()

    def _start(self) -> None:
        self.split = regex.compile(PATTERN).findall
        self.odd_space = re.compile(f" [{_SPACE}]| $").search
        self.before_word = re.compile(f" (?=[^{_SPACE}])").split
        self._forget()

    def _forget(self) -> None:
        self.first: dict[str, int] = {}  # chunk at a text's start -> its number
        self.later: dict[str, int] = {}  # chunk after a space -> its number
        self.pieces: dict[str, list[int]] = {}
        self.chars = 0
        self.size = np.zeros(0, dtype=np.int64)
        self.start = np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.int32)

    def __getstate__(self):
        return {"ranks": self.ranks, "table": self.table}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._start()

    def _cut(self, text: str) -> list[str]:
        """Chunks of a text: a pre-token always begins before a space that a non-space follows."""
        return self.before_word(text) if self.odd_space(text) else text.split(" ")

    def _learn(self, first: list[str], later: list[str]) -> None:
        """Number unseen chunks and store their ids."""
        cut = [self.split(c) for c in first] + [self.split(" " + c) for c in later]
        new = list({p for pieces in cut for p in pieces if p not in self.pieces})
        for piece, i in zip(new, self.table.find(new)):
            self.pieces[piece] = [i] if i >= 0 else merge_bytes(piece.encode("utf-8"), self.ranks)
        ids = [[i for p in pieces for i in self.pieces[p]] for pieces in cut]
        at = len(self.size)
        self.first.update(zip(first, range(at, at + len(first))))
        self.later.update(zip(later, range(at + len(first), at + len(cut))))
        self.chars += 3 * sum(map(len, first)) + 3 * sum(map(len, later))
        size = np.array([len(x) for x in ids], dtype=np.int64)
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, np.array([i for x in ids for i in x], dtype=np.int32)])

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of the texts, laid out as an Arrow list array."""
        if self.chars > MEMO_CHARS:
            self._forget()
        cut = [self._cut(t) for t in texts if t]
        heads = [c[0] for c in cut]
        tails = [c[1:] for c in cut]
        new_heads = set(heads).difference(self.first)
        new_tails = set().union(*tails).difference(self.later)
        if new_heads or new_tails:
            self._learn(list(new_heads), list(new_tails))
        first, later = self.first, self.later
        numbers: list[int] = []
        for head, tail in zip(heads, tails):
            numbers.append(first[head])
            numbers.extend(map(later.__getitem__, tail))
        codes = np.array(numbers, dtype=np.int64)
        size = self.size[codes]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.start[codes] - (ends - size), size) + np.arange(total)]
        chunks = np.zeros(len(texts) + 1, dtype=np.int64)
        chunks[1:][[bool(t) for t in texts]] = [len(c) for c in cut]
        bounds = np.concatenate([[0], ends])
        return bounds[np.cumsum(chunks)], ids

    def encode(self, text: str | None) -> list[int]:
        return self.encode_batch([text])[1].tolist()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a rank file, built once per process (a fixed vocabulary of about 50,000 entries)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(load_ranks(path))
    return _ENCODERS[path]


def _shared(df: DataFrame, path: str):
    return df.sparkSession.sparkContext.broadcast(encoder(path))


def encode_column(df: DataFrame, key: str, text: str, path: str, ids: str = "ids", lengths_only: bool = False) -> DataFrame:
    """(key, ids) of each row, or (key, n_tokens) with ``lengths_only``; a narrow map, no shuffle.

    The vocabulary is broadcast: its size is that of the rank file, whatever the data.
    """
    shared = _shared(df, path)
    kind = df.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("n_tokens", T.LongType()) if lengths_only else T.StructField(ids, T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = shared.value
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            step = 512
            for at in range(0, batch.num_rows, step):
                offsets, flat = enc.encode_batch(texts.slice(at, step).to_pylist())
                if lengths_only:
                    column = pa.array(np.diff(offsets), type=pa.int64())
                else:
                    column = pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), pa.array(flat, type=pa.int32()))
                yield pa.RecordBatch.from_arrays([keys.slice(at, step), column], names=[key, "n_tokens" if lengths_only else ids])

    return df.select(F.col(key), F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)
