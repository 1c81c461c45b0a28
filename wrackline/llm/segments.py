"""Languages of pages and of their segments, against the label they came with.

The model is that of :mod:`langid`, also trained on wrongly decoded copies of
its samples, so that a garbled page keeps its language. Main text is that of
:mod:`boilerplate`; of it, prose lines (by :mod:`spam`) are cut into sentences,
each sentence is scored, and neighbouring sentences of one language form a
segment. A sentence leaves the page's language only by a clear margin, and only
if it is whole.

Defined results: pages without prose, or whose main text is mostly lists, have
no running text; they get one row with segment number 0 and no sentences: the
language of all their lines. Nulls, empty texts and texts without letters give
no rows; a label is compared by its language alone (letter case, region and
three-letter codes do not matter), for pages with running text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wrackline.llm import langid, spam
from wrackline.llm.counting import slices
from wrackline.llm.boilerplate import BODY, Wrapper, label_input, labelled

#: Three-letter codes (ISO 639-2) of two-letter ones (ISO 639-1).
CODES = {"eng": "en", "deu": "de", "ger": "de", "fra": "fr", "fre": "fr", "spa": "es", "por": "pt", "dan": "da", "pol": "pl", "rus": "ru", "jpn": "ja", "ita": "it", "nld": "nl", "dut": "nl", "swe": "sv", "nor": "no", "fin": "fi", "ces": "cs", "cze": "cs", "ukr": "uk", "zho": "zh", "chi": "zh", "kor": "ko"}
#: Encodings (read as, truly) of the wrongly decoded training copies.
COPIES = (("cp1252", "utf-8"), ("mac_roman", "utf-8"), ("cp437", "utf-8"), ("cp1251", "utf-8"), ("cp1252", "cp1251"), ("cp1251", "koi8-r"), ("cp1252", "koi8-r"), ("cp1252", "cp932"), ("cp1252", "euc-jp"))
#: A sentence is in another language than the page if that is likelier by so many nats, and if it has so many words
#: (in scripts without spaces: letters).
MARGIN, MIN_WORDS, MIN_LETTERS = 10.0, 4, 8

_SENTENCE = re.compile(r"[^.!?。！？]*[.!?。！？]+[\"”»“«’')\]]*|[^.!?。！？]+$").findall
_END = re.compile(r"[.!?。！？][\"”»“«’')\]]*\s*$").search


def label_language(label: Column) -> Column:
    """The two-letter language of a label, null if it names none in two letters."""
    base = F.lower(F.trim(F.regexp_extract(label, r"^\s*([A-Za-z]{2,3})(?:[-_].*)?\s*$", 1)))
    table = F.create_map(*[F.lit(x) for pair in CODES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, base), F.when(F.length(base) == 2, base))


def with_copies(samples: list[tuple[str, str]]) -> list[tuple[str, str]]:
    out = list(samples)
    for wrong, right in COPIES:
        for lang, text in samples:
            raw = text.encode(right, "ignore")
            bad = raw.decode(wrong, "ignore") if wrong != "cp1252" else "".join(bytes([b]).decode("cp1252", "replace") if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in raw)
            if bad != text and sum(c.isascii() for c in text) < 0.5 * len(text):
                out.append((lang, bad))
    return out


def _sentences(lines: list[str], at: list[int], symbols: str, sizes: list[int], labels: list[int]) -> list[tuple[int, str]]:
    """(line number, sentence) of the prose of a page's main text; none if lists prevail. ``at``: the lines that are not empty.

    Short lines before the first long one (bylines) get number 0: they are no full sentences.
    """
    states = [0] * len(symbols)  # as without list symbols every line is prose or template
    if any(s in "UHKSL" for s in symbols):
        states = spam.Model().viterbi(symbols, spam.steps_of(sizes))
        size = [0, 0]
        for s, state, n in zip(symbols, states, sizes):
            if s not in "TM":
                size[state in (1, 2)] += n
        if size[1] > size[0]:
            return []
    out, begun = [], False
    for k, s, state in zip(at, symbols, states):
        if s == "P" and state in (0, 3) and labels[k] == BODY:
            begun = begun or len(lines[k]) > 60 or lines[k] and lines[k][0] >= "\u3040"
            out += [(k + 1 if begun else 0, x) for x in _SENTENCE(lines[k])]
    return out


def page_segments(df: DataFrame, key: str, wrapper: Wrapper, model: langid.LanguageModel) -> DataFrame:
    """(key, segment_no, first_line, last_line, n_sentences, lang, confidence) of the running text of pages."""
    sc = df.sparkSession.sparkContext
    shared, shared_model = sc.broadcast(wrapper), sc.broadcast(model)
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), *T.StructType.fromDDL("segment_no INT, first_line INT, last_line INT, n_sentences INT, lang STRING, confidence DOUBLE").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, m = shared.value, shared_model.value
        for batch in slices(batches, 3):
            page, line, text = [], [], []
            rows, all_lines, of_page, labels = labelled(batch, w)
            shown, symbols, sizes = spam.observe_batch(all_lines, of_page, labels)
            all_lines, labels = all_lines.to_pylist(), labels.tolist()
            first = np.searchsorted(of_page, np.arange(len(rows) + 1)).tolist()
            bounds = np.searchsorted(of_page[shown], np.arange(len(rows) + 1)).tolist()
            for p, k in enumerate(rows):
                a, b = first[p], first[p + 1]
                own = slice(bounds[p], bounds[p + 1])
                found = _sentences(all_lines[a:b], (shown[own] - a).tolist(), "".join(symbols[own]), sizes[own].tolist(), labels[a:b])
                for n, s in found or [(a - b, "\n".join(all_lines[a:b]))]:
                    page.append(k), line.append(n), text.append(s)
            scores, grams = m.score(*m.number_all(text))
            out: list[tuple] = []
            if text:
                pages = np.array(page)
                bounds = np.concatenate([[0], np.flatnonzero(np.diff(pages)) + 1, [len(pages)]])
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    out += _cut(page[a], line[a:b], text[a:b], scores[a:b], grams[a:b], m.langs)
            columns = list(zip(*out)) if out else [[]] * 7
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.float64()]
            arrays = [pa.array(c, type=kind) for c, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(arrays[0]), *arrays[1:]], names=schema.names)

    return label_input(df, key, wrapper).mapInArrow(run, schema)


def _is_sentence(text: str) -> bool:
    words = langid.words_of(text)
    return len(words) >= MIN_WORDS or sum(len(w) for w in words if w[0] >= "\u3040") >= MIN_LETTERS


def _cut(page: int, line: list[int], text: list[str], scores: np.ndarray, grams: np.ndarray, langs: list[str]) -> list[tuple]:
    """The segments of one page's sentences."""
    if not grams.sum():
        return []
    main = int(scores.sum(axis=0).argmax())
    if line[0] < 0:  # no running text
        return [(page, 0, 1, -line[0], 0, langs[main], float(langid.decide(scores, grams)[1][0]))]
    best = scores.argmax(axis=1)
    away = (best != main) & (scores.max(axis=1) - scores[:, main] >= MARGIN)
    own = [int(b) if a and n and _END(t) and _is_sentence(t) else main for a, b, t, n in zip(away.tolist(), best.tolist(), text, line)]
    out, at = [], 0
    while at < len(own):
        to = at
        while to + 1 < len(own) and own[to + 1] == own[at]:
            to += 1
        part = scores[at : to + 1].sum(axis=0, keepdims=True)
        scaled = np.exp((part[0] - part[0].max()) / np.sqrt(max(1, grams[at : to + 1].sum())))
        out.append((page, len(out) + 1, line[at], line[to], to - at + 1, langs[own[at]], float(scaled[own[at]] / scaled.sum())))
        at = to + 1
    return out


def page_languages(segments: DataFrame, key: str) -> DataFrame:
    """(key, lang, n_sentences, confidence): the languages of each page with letters."""
    return segments.groupBy(key, "lang").agg(F.sum("n_sentences").cast("int").alias("n_sentences"), (F.sum(F.col("confidence") * F.greatest("n_sentences", F.lit(1))) / F.sum(F.greatest("n_sentences", F.lit(1)))).alias("confidence"))


def mislabelled(df: DataFrame, key: str, label: str, segments: DataFrame) -> DataFrame:
    """(key, lang) of pages whose label names no language, another one, or one of several; ``key`` must be unique."""
    langs = segments.where("segment_no > 0").groupBy(key).agg(F.sort_array(F.collect_set("lang")).alias("langs"))
    named = label_language(F.col(label))
    joined = df.select(key, named.alias("_named")).join(langs, key)
    wrong = joined.where(F.col("_named").isNull() | (F.size("langs") > 1) | ~F.array_contains("langs", F.coalesce("_named", F.lit(""))))
    return wrong.select(key, F.explode("langs").alias("lang"))
