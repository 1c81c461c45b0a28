"""Distinct character n-grams of whole texts, in one Arrow pass.

Method: in a chunk of texts, the characters are numbered in their order, so that
the ``most`` characters from a place on, with the text's number before them, are
one integer. The sorted distinct integers are the leaves of a trie; each prefix
that differs from the former leaf's is an n-gram, and they come out sorted.

Defined results: those of ``sort_array(array_distinct(text.char_ngrams(...)))``;
a text shorter than ``least`` has an empty list. Texts that are no valid UTF-8,
or of more different characters than fit an integer, are cut one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that are worked on at once (one longer text is a chunk alone), and bits of an integer.
CHUNK, BITS = 1 << 15, 63


def _width(first: int) -> int:
    """Bytes of the character that begins with a byte, as Spark counts them."""
    return 2 if 0xC2 <= first <= 0xDF else 3 if 0xE0 <= first <= 0xEF else 4 if 0xF0 <= first <= 0xF4 else 1


def _one_by_one(data: bytes, least: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at, starts = 0, []
    while at < len(data):
        starts.append(at)
        at += _width(data[at])
    starts.append(len(data))
    found = sorted({data[starts[i] : starts[i + n]] for n in range(least, most + 1) for i in range(len(starts) - n)})
    return np.array([len(found)]), np.array([len(g) for g in found], dtype=np.int64), np.frombuffer(b"".join(found), dtype=np.uint8)


def _grams(data: bytes, ends: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(n-grams of each text, bytes of each n-gram, their bytes); ``ends``: where the texts begin and end in ``data``. None if they don't fit."""
    if data.isascii():
        points = np.frombuffer(data, dtype=np.uint8)
    else:
        try:
            points = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), dtype="<u4")
        except UnicodeDecodeError:
            return None
        heads = (np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80
        ends = np.concatenate(([0], np.cumsum(heads)))[ends]
    texts = len(ends) - 1
    if not len(points):
        return np.zeros(texts, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    there = np.zeros(int(points.max()) + 1, dtype=bool)
    there[points] = True
    alphabet = np.flatnonzero(there)
    bits = len(alphabet).bit_length()
    if bits * most + (texts - 1).bit_length() > BITS:
        return None
    number = np.zeros(len(there), dtype=np.int64)
    number[alphabet] = np.arange(1, len(alphabet) + 1)

    # the texts' characters, each text followed by zeros, so that no n-gram runs on
    pad, counts = most - 1, np.diff(ends)
    text = np.repeat(np.arange(texts), counts + pad)
    row = np.zeros(len(text) + pad, dtype=np.int64)
    row[np.arange(len(points)) + pad * np.repeat(np.arange(texts), counts)] = number[points]
    leaf = text
    for n in range(most):
        leaf = (leaf << bits) | row[n : n + len(text)]
    leaf = leaf[(row[: len(text)] > 0) & (row[least - 1 : least - 1 + len(text)] > 0)]
    leaf.sort()
    leaf = leaf[np.concatenate(([True], leaf[1:] != leaf[:-1]))] if len(leaf) else leaf

    mask, sizes = (1 << bits) - 1, most - least + 1
    new = np.empty((len(leaf), sizes), dtype=bool)
    for n in range(least, most + 1):
        prefix = leaf >> (bits * (most - n))
        new[:, n - least] = (prefix & mask) > 0
        new[1:, n - least] &= prefix[1:] != prefix[:-1]
    grams = np.flatnonzero(new.ravel())
    of = grams // sizes

    # each leaf's bytes from its left, eight to a word; shifts by 64 bits and more give 0
    coded = [b"", *(chr(c).encode("utf-8") for c in alphabet)]
    bytes_, lengths = np.array([int.from_bytes(c, "little") for c in coded], dtype=np.uint64), np.array([len(c) for c in coded], dtype=np.int64)
    words = np.zeros((len(leaf), -(-int(lengths.max()) * most // 8)), dtype="<u8")
    filled, length = np.zeros(len(leaf), dtype=np.int64), np.empty((len(leaf), sizes), dtype=np.int64)
    for n in range(most):
        char = (leaf >> (bits * (most - 1 - n))) & mask
        sign = np.take(bytes_, char)
        for w in range(words.shape[1]):
            off = (8 * filled - 64 * w).astype(np.uint64)
            words[:, w] |= (sign << off) | (sign >> (~off + np.uint64(1)))
        filled += np.take(lengths, char)
        if n + 1 >= least:
            length[:, n + 1 - least] = filled
    length = np.take(length.ravel(), grams)
    before = np.cumsum(length) - length
    signs = np.take(words.view(np.uint8).ravel(), np.arange(int(length.sum())) + np.repeat(8 * words.shape[1] * of - before, length))
    return np.bincount(np.take(leaf >> (bits * most), of), minlength=texts), length, signs


def _chunks(data: bytes, ends: np.ndarray, least: int, most: int) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """(texts, their n-grams) of the texts, in halves where they don't fit."""
    texts, part = len(ends) - 1, data[ends[0] : ends[-1]]
    found = _grams(part, ends - ends[0], least, most)
    if found is None and texts > 1:
        yield from _chunks(data, ends[: texts // 2 + 1], least, most)
        yield from _chunks(data, ends[texts // 2 :], least, most)
    else:
        yield texts, found or _one_by_one(part, least, most)


def distinct_ngrams(df: DataFrame, key: str, text: str, least: int = 2, most: int = 5, out: str = "grams") -> DataFrame:
    """(key, out): the sorted distinct substrings of ``least`` to ``most`` characters of every text that is not null."""
    schema = T.StructType([df.schema[key], T.StructField(out, T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string())
            ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, dtype=np.int64)
            data = texts.buffers()[2].to_pybytes() if len(texts) and texts.buffers()[2] else b""
            at = 0
            while at < len(texts):
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + CHUNK, side="right")) - 1)
                for n, (each, length, signs) in _chunks(data, ends[at : to + 1], least, most):
                    grams = pa.StringArray.from_buffers(len(length), pa.py_buffer(np.concatenate(([0], np.cumsum(length))).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(signs)))
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(each))).astype(np.int32)), grams)
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), lists], names=schema.names)
                    at += n

    return df.where(F.col(text).isNotNull()).select(key, F.col(text)).mapInArrow(run, schema)
