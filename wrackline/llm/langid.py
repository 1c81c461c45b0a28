"""Language of texts and of their segments.

Method: multinomial naive Bayes over hashed character n-grams (1 to 4, inside
words padded by a space). The log-probability matrix (buckets x languages) is
trained on the driver from a small table of labelled samples and broadcast: its
size is fixed by ``BUCKETS`` and the number of languages. Texts are scored in
sparse batches with numpy: the n-grams of a batch's unseen words are summed
into one row per word, kept in a bounded memo, and a text or segment is the
sum of its words' rows.

Defined results: null and empty texts, and texts without letters, have no
language; ties go to the language first in order; confidence is the posterior
of the best language, tempered to the mean evidence per n-gram.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

BUCKETS = 1 << 16
ORDERS = (1, 2, 3, 4)
#: At most so many labelled samples are used for training (a documented bound of the driver's work).
MAX_SAMPLES = 20_000
#: Characters in a worker's word memo; reaching it empties the memo and changes no result.
MEMO_CHARS = 4_000_000

words_of = re.compile(r"[^\W\d_]+").findall


def cut_words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(lower-case words of all texts, number of the text of each)."""
    split = pc.split_pattern(pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\pL\p{Nl}\p{No} ]+", " "), " ")
    words = split.flatten()
    full = pc.greater(pc.binary_length(words), 0)
    owner = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    return words.filter(full).dictionary_encode(), owner[full.to_numpy(zero_copy_only=False)]


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of every n-gram of the words, ordered by order and then by word."""
    codes = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    space = codes == 32
    owner = np.cumsum(space) - 1
    at, bucket = [], []
    for n in ORDERS:
        m = len(codes) - n + 1
        if m <= 0:
            continue
        keep = np.ones(m, dtype=bool)
        if n == 1:
            keep = ~space
        else:
            for k in range(1, n - 1):
                keep &= ~space[k : k + m]
            if n == 2:
                keep &= ~(space[:m] & space[1 : 1 + m])
        h = np.full(m, np.uint64(n * 0x9E3779B9), dtype=np.uint64)
        for k in range(n):
            h = (h ^ codes[k : k + m]) * np.uint64(0x100000001B3)
            h ^= h >> np.uint64(29)
        keep[-1] &= not space[m - 1] or n == 1
        at.append(owner[:m][keep])
        bucket.append((h[keep] % np.uint64(BUCKETS)).astype(np.int64))
    return np.concatenate(at), np.concatenate(bucket)


class LanguageModel:
    """A trained model; picklable, its memo is each worker's own."""

    def __init__(self, samples: list[tuple[str, str]], smoothing: float = 0.3):
        self.langs = sorted({lang for lang, text in samples if lang and text})
        counts = np.zeros((BUCKETS, max(1, len(self.langs))), dtype=np.float64)
        for k, lang in enumerate(self.langs):
            words = [w for at, text in samples if at == lang and text for w in words_of(text.lower())]
            if words:
                np.add.at(counts[:, k], ngrams(words)[1], 1)
        counts += smoothing
        self.matrix = np.log(counts / counts.sum(axis=0)).astype(np.float32)
        self._forget()

    def _forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.chars = 0
        self.scores = np.zeros((0, self.matrix.shape[1]), dtype=np.float32)
        self.grams = np.zeros(0, dtype=np.int32)

    def __getstate__(self):
        return {"langs": self.langs, "matrix": self.matrix}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._forget()

    def number(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(row of each word, offsets of the texts) for texts given as lists of lower-case words."""
        self.learn(set().union(*texts))
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)
        rows = np.fromiter((self.rows[w] for t in texts for w in t), dtype=np.int64, count=int(offsets[-1]))
        return rows, offsets

    def number_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`number` of the words of whole texts."""
        words, owner = cut_words(pa.array(texts, type=pa.large_string()))
        names = words.dictionary.to_pylist()
        self.learn(set(names))
        rows = np.fromiter((self.rows[w] for w in names), dtype=np.int64, count=len(names))[words.indices.to_numpy()]
        return rows, np.searchsorted(owner, np.arange(len(texts) + 1))

    def learn(self, words: set[str]) -> None:
        """Score the words that are not in the memo."""
        if self.chars > MEMO_CHARS:
            self._forget()
        new = list(words.difference(self.rows))
        if new:
            owner, bucket = ngrams(new)
            order = np.argsort(owner, kind="stable")
            starts = np.searchsorted(owner[order], np.arange(len(new)))
            scores = np.add.reduceat(self.matrix[bucket[order]], starts, axis=0)
            self.rows.update(zip(new, range(len(self.scores), len(self.scores) + len(new))))
            self.scores = np.concatenate([self.scores, scores])
            self.grams = np.concatenate([self.grams, np.diff(np.append(starts, len(order))).astype(np.int32)])
            self.chars += sum(map(len, new))

    def score(self, rows: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log-probabilities of each text, its number of n-grams)."""
        n = len(offsets) - 1
        out = np.zeros((n, len(self.langs)), dtype=np.float64)
        grams = np.zeros(n, dtype=np.int64)
        full = np.flatnonzero(np.diff(offsets) > 0)
        if len(full):
            out[full] = np.add.reduceat(self.scores[rows], offsets[:-1][full], axis=0, dtype=np.float64)
            grams[full] = np.add.reduceat(self.grams[rows], offsets[:-1][full])
        return out, grams

    def classify(self, texts: list[str | None]) -> tuple[list[str | None], np.ndarray]:
        """(language or None, confidence) of each text."""
        cut = [words_of(t.lower()) if t else [] for t in texts]
        scores, grams = self.score(*self.number(cut))
        best, sure = decide(scores, grams)
        return [self.langs[b] if g else None for b, g in zip(best.tolist(), grams.tolist())], np.where(grams > 0, sure, 0.0)


def decide(scores: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the best language, its tempered posterior) of each row of scores."""
    scaled = scores / np.sqrt(np.maximum(grams, 1))[:, None]
    scaled = np.exp(scaled - scaled.max(axis=1, keepdims=True))
    return scores.argmax(axis=1), scaled.max(axis=1) / scaled.sum(axis=1)


def train(samples: DataFrame, lang: str = "lang", text: str = "text") -> LanguageModel:
    """A model from a table of labelled samples; at most ``MAX_SAMPLES`` of them are read."""
    rows = samples.where(f"{lang} IS NOT NULL AND {text} IS NOT NULL").select(lang, text).limit(MAX_SAMPLES).collect()
    return LanguageModel([(r[0], r[1]) for r in rows])
