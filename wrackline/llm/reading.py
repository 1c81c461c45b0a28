"""Reading level of texts.

Method: a Rasch-style latent difficulty model. A text of language L has a
latent level t; a word w of the anchored vocabulary occurs in it at the rate
exp(a[w] + b[w] t) per word, so that b[w] is the word's difficulty. Graded
texts anchor the scale (their t is their level). The parameters are estimated
by distributed alternating optimisation: texts are placed on the scale given
the words (the sum of their words' difficulties is sufficient), then words are
refitted given the texts, from counts of word by level bin that are summed over
the whole corpus. Counts of the corpus are scaled to the size of the graded
texts, so that the result does not depend on the corpus size.

Readers are also loaded by long sentences, which the graded levels trade against
word difficulty, so a text's level is a linear reading, per language, of its
place t and the log of its words per sentence. It is fitted on the graded texts
by cross-fitting: a fold's texts are placed with words fitted without it. Levels
are whole numbers; the cut between two of them is put where, within reach of
the middle, the whole corpus's texts are thinnest, from one histogram a language.

The vocabulary is that of the graded texts (a small table of labelled rows, at
most ``MAX_GRADED`` of which are used), so that the model's size is bounded and
it is broadcast. Texts are read once; the alternation runs over compact staged
counts.

Languages without graded texts get their level from words per sentence and
letters per word relative to clean samples of the language, by a regression on
the graded texts; ``anchored`` is false for these.

Defined results: null and empty texts and texts without letters have neither
language nor level; repeated rows are rated each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wrackline.llm import langid
from wrackline.session import staged

#: At most so many graded texts are used (a documented bound: texts x vocabulary are held on the driver).
MAX_GRADED = 2_000
FOLDS = 5
#: The alternation ends when word difficulties move less than this on average (weighted by use), or after so many rounds.
TOLERANCE, ROUNDS = 0.01, 6
#: The cut between two levels lies where the corpus is thinnest, at most so far from the middle between them; only texts of so many words are asked.
CUT_REACH, CUT_WORDS = 0.3, 40
#: Levels are counted in bins of this width and smoothed over a kernel of so many bins.
CUT_BIN, CUT_KERNEL = 0.02, 5.0
#: A language whose mean word is longer than this many letters is taken as written without spaces.
UNSPACED_LETTERS = 12.0
GRID = np.arange(-3.0, 9.001, 0.02)
BINS = np.arange(-3.0, 9.001, 0.25)
#: A sentence: from a letter to the next end mark or line end.
_SENTENCE = re.compile(r"[^\W\d_][^.!?。！？\n]*").findall
_NUMBERED = re.compile(r"\w+")


class Words:
    """Word parameters of one language."""

    def __init__(self, counts: np.ndarray, totals: np.ndarray, at: np.ndarray):
        """``counts``: words x bins, ``totals``: words of the texts in each bin, ``at``: level of each bin."""
        n = counts.sum(axis=1)
        self.a = np.log((n + 0.5) / max(1.0, totals.sum()))
        self.b = np.zeros(len(n))
        mid = float((totals * at).sum() / max(1.0, totals.sum()))
        x = at - mid
        for _ in range(40):
            rate = np.exp(np.clip(self.a[:, None] + self.b[:, None] * x, -30, 5)) * totals
            ga, gb = n + 0.05 - rate.sum(1) - 0.05, counts @ x - rate @ x - 2.0 * self.b
            haa, hab, hbb = rate.sum(1) + 1e-3, rate @ x, rate @ (x * x) + 2.0
            det = haa * hbb - hab * hab
            step_a, step_b = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
            self.a += np.clip(step_a, -1, 1)
            self.b += np.clip(step_b, -0.5, 0.5)
            if max(np.abs(step_a).max(initial=0), np.abs(step_b).max(initial=0)) < 1e-5:
                break
        self.a -= self.b * mid
        self.mass = np.exp(np.clip(self.a[:, None] + self.b[:, None] * GRID, -30, 5)).sum(axis=0)

    def place(self, difficulty: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The level of texts with summed difficulty and number of words (flat prior over the grid)."""
        out = np.empty(len(n))
        for at in range(0, len(n), 2048):
            part = slice(at, at + 2048)
            out[part] = GRID[(difficulty[part, None] * GRID - n[part, None] * self.mass).argmax(axis=1)]
        return out


class ReadingModel:
    """Anchored vocabulary, word parameters, cut points; picklable and bounded by the graded texts."""

    def __init__(self, graded: list[tuple[str, int, str]], languages: langid.LanguageModel, samples: list[tuple[str, str]]):
        graded = [(lang, level, langid.words_of(text.lower()), text) for lang, level, text in sorted(graded)]
        self.languages = languages
        self.langs = sorted({g[0] for g in graded})
        self.levels = sorted({g[1] for g in graded})
        self.vocabulary = {lang: {w: i for i, w in enumerate(sorted({w for g in graded if g[0] == lang for w in g[2]}))} for lang in self.langs}
        self.texts: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for lang in self.langs:
            own = [g for g in graded if g[0] == lang]
            matrix = np.zeros((len(own), len(self.vocabulary[lang])))
            for k, g in enumerate(own):
                np.add.at(matrix[k], [self.vocabulary[lang][w] for w in g[2]], 1)
            self.texts[lang] = (matrix, np.array([g[1] for g in own], dtype=float))
        self.corpus = {lang: np.zeros((len(self.vocabulary[lang]), len(BINS))) for lang in self.langs}
        self.letters = {lang: np.mean([len(w) for at, text in samples if at == lang and text for w in langid.words_of(text)] or [5.0]) for lang in languages.langs}
        level = np.array([g[1] for g in graded], dtype=float)
        shape = np.array([self.shape(lang, words, text) for lang, _, words, text in graded]).reshape(-1, 2)
        self.pace = {lang: shape[[g[0] == lang for g in graded], 0] for lang in self.langs}
        self.style = np.linalg.lstsq(np.column_stack([shape, np.ones(len(shape))]), level, rcond=None)[0] if len(shape) else np.zeros(3)
        self.cuts: dict[str, np.ndarray] = {}
        self.fit()

    def shape(self, lang: str, words: list[str], text: str) -> tuple[float, float]:
        """(log of words per sentence, letters per word in units of the language's mean); unspaced scripts are counted by letters."""
        letters = sum(map(len, words)) / self.letters.get(lang, 5.0)
        size = letters if self.letters.get(lang, 5.0) > UNSPACED_LETTERS else len(words)
        return float(np.log(max(size, 0.5) / max(1, len(_SENTENCE(text))))), letters / max(1, len(words))

    def _fitted(self, lang: str, keep: np.ndarray) -> Words:
        matrix, level = self.texts[lang]
        at = np.array(self.levels, dtype=float)
        anchored = np.column_stack([matrix[keep & (level == v)].sum(axis=0) for v in self.levels])
        corpus = self.corpus[lang]
        scale = anchored.sum() / corpus.sum() if corpus.sum() else 0.0
        counts = np.column_stack([anchored, corpus * scale])
        return Words(counts, counts.sum(axis=0), np.concatenate([at, BINS]))

    def fit(self) -> None:
        """Refit words and the reading of levels from the anchors and the corpus counts."""
        self.words, self.reading = {}, {}
        for lang in self.langs:
            matrix, level = self.texts[lang]
            fold = np.arange(len(level)) % FOLDS
            placed = np.zeros(len(level))
            for f in range(FOLDS):
                out = fold == f
                if out.any() and (~out).any():
                    words = self._fitted(lang, ~out)
                    placed[out] = words.place(matrix[out] @ words.b, matrix[out].sum(axis=1))
            self.words[lang] = self._fitted(lang, np.ones(len(level), dtype=bool))
            self.reading[lang] = np.linalg.lstsq(np.column_stack([placed, self.pace[lang], np.ones(len(level))]), level, rcond=None)[0]

    def difficulties(self) -> np.ndarray:
        return np.concatenate([self.words[lang].b for lang in self.langs] or [np.zeros(0)])

    def moved(self, before: np.ndarray) -> float:
        """Mean change of word difficulties, words weighted by their use in the corpus."""
        use = np.concatenate([self.corpus[lang].sum(axis=1) for lang in self.langs] or [np.zeros(0)])
        return float((np.abs(self.difficulties() - before) * use).sum() / max(1.0, use.sum()))

    def set_cuts(self, histogram: dict[tuple[str, int], int]) -> None:
        """Cut points of each language from numbers of texts by bin of ``CUT_BIN``."""
        self.cuts = {}
        reach = np.arange(-40, 41)
        kernel = np.exp(-0.5 * (reach / CUT_KERNEL) ** 2)
        for lang in self.langs:
            out = []
            for low, high in zip(self.levels, self.levels[1:]):
                mid = (low + high) / 2
                bins = np.arange(round((mid - CUT_REACH) / CUT_BIN), round((mid + CUT_REACH) / CUT_BIN) + 1)
                dense = np.array([sum(k * histogram.get((lang, int(b + r)), 0) for k, r in zip(kernel, reach)) for b in bins])
                # the nearer to the middle the better, where the corpus does not tell
                far = np.abs(bins * CUT_BIN - mid) / CUT_REACH
                out.append(float(bins[np.argmin(dense / max(dense.max(), 1e-9) + 0.05 * far)] * CUT_BIN))
            self.cuts[lang] = np.array(out)

    def level(self, lang: str | None, theta: np.ndarray) -> np.ndarray:
        """The whole level of places on the scale; without cut points the nearest one."""
        middles = (np.array(self.levels[1:], dtype=float) + np.array(self.levels[:-1], dtype=float)) / 2
        return np.array(self.levels)[np.searchsorted(self.cuts.get(lang, middles), np.nan_to_num(theta), side="right")]

    def scaled(self, lang: str, placed: np.ndarray, pace: np.ndarray) -> np.ndarray:
        """Level (unrounded) of texts by place and log of words per sentence."""
        a, b, c = self.reading[lang]
        return a * placed + b * pace + c


_COUNTS = "lang STRING, confidence DOUBLE, n_words INT, style DOUBLE, ids ARRAY<INT>, n ARRAY<INT>"


def word_counts(df: DataFrame, key: str, text: str, shared) -> DataFrame:
    """(key, lang, confidence, n_words, style, ids, n): language, style (log of words per sentence, or the level by style where the language has no anchors) and counts over the anchored vocabulary of each text."""
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), *T.StructType.fromDDL(_COUNTS).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: ReadingModel = shared.value
        row_word: dict[str, np.ndarray] = {}
        memo, known = None, -1
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                keys = batch.column(0).slice(at, 512)
                texts = batch.column(1).slice(at, 512).to_pylist()
                cut = [langid.words_of(t.lower()) if t else [] for t in texts]
                rows, offsets = model.languages.number(cut)
                scores, grams = model.languages.score(rows, offsets)
                best, sure = langid.decide(scores, grams)
                langs = [model.languages.langs[b] if g else None for b, g in zip(best.tolist(), grams.tolist())]
                # memo rows -> anchored word numbers, one table per language
                if memo is not model.languages.rows or known != len(memo):
                    memo, known = model.languages.rows, len(model.languages.rows)
                    row_word = {lang: np.array([v.get(w, -1) for w in memo], dtype=np.int64) for lang, v in model.vocabulary.items()}
                owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
                found = np.full(len(rows), -1, dtype=np.int64)
                of_lang = np.array([model.langs.index(x) if x in model.langs else -1 for x in langs])
                for k, lang in enumerate(model.langs):
                    own = of_lang[owner] == k
                    found[own] = row_word[lang][rows[own]]
                hit = found >= 0
                pairs, n = np.unique(owner[hit] << 32 | found[hit], return_counts=True)
                ends = np.concatenate([[0], np.cumsum(np.bincount(pairs >> 32, minlength=len(texts)))])
                shape = [model.shape(x, w, t) if x else (0.0, 0.0) for x, w, t in zip(langs, cut, texts)]
                style = [None if not x else s[0] if k >= 0 else float(np.dot([*s, 1.0], model.style)) for x, s, k in zip(langs, shape, of_lang.tolist())]
                size = [len(_NUMBERED.findall(t)) if t else 0 for t in texts]
                offs = pa.array(ends, type=pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(langs, type=pa.string()), pa.array(np.where(grams > 0, sure, 0.0)), pa.array(size, type=pa.int32()), pa.array(style, type=pa.float64()),
                     pa.ListArray.from_arrays(offs, pa.array(pairs & 0xFFFFFFFF, type=pa.int32())), pa.ListArray.from_arrays(offs, pa.array(n, type=pa.int32()))],
                    names=schema.names,
                )

    return df.select(F.col(key), F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)


def _placed(model: ReadingModel, batch: pa.RecordBatch):
    """(lang numbers, levels on the scale, offsets, ids, n) of a batch of counts."""
    langs = batch.column("lang").to_pylist()
    of_lang = np.array([model.langs.index(x) if x in model.langs else -1 for x in langs], dtype=np.int64)
    ids_list, n_list = batch.column("ids"), batch.column("n")
    ids, n = ids_list.flatten().to_numpy(), n_list.flatten().to_numpy()
    lengths = np.diff(ids_list.offsets.to_numpy())
    owner = np.repeat(np.arange(len(langs)), lengths)
    placed = np.full(len(langs), np.nan)
    for k, lang in enumerate(model.langs):
        own = of_lang[owner] == k
        at = np.flatnonzero(of_lang == k)
        if len(at):
            difficulty = np.bincount(owner[own], weights=model.words[lang].b[ids[own]] * n[own], minlength=len(langs))
            total = np.bincount(owner[own], weights=n[own], minlength=len(langs))
            placed[at] = model.words[lang].place(difficulty[at], total[at])
            placed[at[total[at] == 0]] = np.nan
    return of_lang, placed, owner, ids, n


def _bin_counts(counts: DataFrame, shared) -> DataFrame:
    """(lang, word, bin, n) summed over the corpus: the words' side of the alternation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: ReadingModel = shared.value
        sums = [np.zeros((len(model.vocabulary[lang]), len(BINS))) for lang in model.langs]
        for batch in batches:
            of_lang, placed, owner, ids, n = _placed(model, batch)
            where = np.clip(np.round((np.nan_to_num(placed) - BINS[0]) / (BINS[1] - BINS[0])), 0, len(BINS) - 1).astype(np.int64)
            for k in range(len(model.langs)):
                own = (of_lang[owner] == k) & ~np.isnan(placed[owner])
                np.add.at(sums[k], (ids[own], where[owner[own]]), n[own])
        for k, s in enumerate(sums):
            word, at = np.nonzero(s)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(word), k), type=pa.int32()), pa.array(word, type=pa.int32()), pa.array(at, type=pa.int32()), pa.array(s[word, at].astype(np.int64))], names=["lang", "word", "bin", "n"])

    return counts.select("lang", "ids", "n").mapInArrow(run, "lang INT, word INT, bin INT, n BIGINT").groupBy("lang", "word", "bin").agg(F.sum("n").alias("n"))


def _theta(model: ReadingModel, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(lang numbers, place on the scale of levels) of a batch of counts."""
    of_lang, placed, *_ = _placed(model, batch)
    style = batch.column("style").to_numpy(zero_copy_only=False).astype(float)
    theta = style.copy()
    for k, lang in enumerate(model.langs):
        own = of_lang == k
        theta[own] = model.scaled(lang, placed[own], style[own])
    return of_lang, theta


def _level_counts(counts: DataFrame, shared) -> DataFrame:
    """(lang, bin, n): texts of the corpus by place on the scale."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: ReadingModel = shared.value
        for batch in batches:
            of_lang, theta = _theta(model, batch)
            own = (of_lang >= 0) & ~np.isnan(theta) & (batch.column("n_words").to_numpy(zero_copy_only=False) >= CUT_WORDS)
            pairs, n = np.unique(np.column_stack([of_lang[own], np.round(theta[own] / CUT_BIN).astype(np.int64)]), axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([model.langs[k] for k in pairs[:, 0].tolist()], type=pa.string()), pa.array(pairs[:, 1].astype(np.int32)), pa.array(n)], names=["lang", "bin", "n"])

    return counts.select("lang", "n_words", "style", "ids", "n").mapInArrow(run, "lang STRING, bin INT, n BIGINT").groupBy("lang", "bin").agg(F.sum("n").alias("n"))


def rate(df: DataFrame, key: str, text: str, graded: DataFrame, samples: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(key, lang, confidence, n_words, theta, reading_level, anchored) of every text."""
    sc = df.sparkSession.sparkContext
    rows = graded.where("lang IS NOT NULL AND reading_level IS NOT NULL AND text IS NOT NULL").select("lang", "reading_level", "text").limit(MAX_GRADED).collect()
    clean = [(r["lang"], r["text"]) for r in samples.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text").limit(langid.MAX_SAMPLES).collect()]
    model = ReadingModel([tuple(r) for r in rows], langid.LanguageModel(clean), clean)
    shared = sc.broadcast(model)
    counts = staged(word_counts(df, key, text, shared), "word-counts")
    for _ in range(rounds):
        summed = _bin_counts(counts, sc.broadcast(model)).collect()  # at most vocabulary x bins rows
        for lang in model.langs:
            model.corpus[lang][:] = 0
        for r in summed:
            model.corpus[model.langs[r["lang"]]][r["word"], r["bin"]] = r["n"]
        before = model.difficulties()
        model.fit()
        if model.moved(before) < TOLERANCE:
            break
    model.set_cuts({(r["lang"], r["bin"]): r["n"] for r in _level_counts(counts, sc.broadcast(model)).collect()})  # at most languages x bins rows
    final = sc.broadcast(model)
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), *T.StructType.fromDDL("lang STRING, confidence DOUBLE, n_words INT, theta DOUBLE, reading_level INT, anchored BOOLEAN").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: ReadingModel = final.value
        for batch in batches:
            of_lang, theta = _theta(model, batch)
            level = np.zeros(len(theta), dtype=np.int32)
            if model.levels:
                for k in np.unique(of_lang).tolist():
                    level[of_lang == k] = model.level(model.langs[k] if k >= 0 else None, theta[of_lang == k])
            none = np.isnan(theta)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column("lang"), batch.column("confidence"), batch.column("n_words"), pa.array(theta, mask=none), pa.array(level, mask=none), pa.array(of_lang >= 0)], names=schema.names
            )

    return counts.mapInArrow(run, schema)
