"""Pages of keywords, links or product tags instead of sentences.

Method: each line of a page is labelled prose, link list, tag list or menu by a
hidden Markov model, and a page is flagged by the share of the words of its main
text that are in link or tag lists. A line is observed as one of a few symbols,
from its repeated words, separators, numbers, addresses and hashtags; lines of
the page template (see :mod:`boilerplate`) are observed as template. A long line
counts as several observations of its symbol. Labels come from the Viterbi path,
so that an odd short line within prose stays prose and a run of list lines does
not.

The model is estimated by Baum-Welch on all pages, from a prior that names the
states: expected counts are summed over the distinct sequences of symbols, so a
round reads one row for each of these. The prior counts as a fixed share of all
observations, so that the result does not depend on the number of pages.

Defined results: null and empty texts are no pages and get no row; a page
without observed prose or list lines has share 0; repeated rows are rated each;
a run of letters of a script without spaces counts as a word per two letters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wrackline.llm import langid
from wrackline.llm.boilerplate import BODY, EMPTY, Wrapper, label_input, labelled
from wrackline.llm.counting import slices
from wrackline.session import staged

STATES = ("prose", "links", "tags", "menu")
SYMBOLS = "PUHKSLTM"
#: The prior: start, transition and emission probabilities (rows: states; columns of the last: symbols).
START = np.array([0.45, 0.05, 0.05, 0.45])
MOVE = np.array([[0.88, 0.02, 0.02, 0.08], [0.04, 0.88, 0.02, 0.06], [0.04, 0.02, 0.88, 0.06], [0.28, 0.04, 0.04, 0.64]])
EMIT = np.array(
    [
        [0.765, 0.005, 0.005, 0.005, 0.04, 0.02, 0.155, 0.005],
        [0.01, 0.62, 0.02, 0.05, 0.05, 0.19, 0.05, 0.01],
        [0.01, 0.03, 0.31, 0.32, 0.15, 0.12, 0.05, 0.01],
        [0.01, 0.002, 0.0005, 0.002, 0.01, 0.03, 0.10, 0.8455],
    ]
)
#: A word of two letters or more is repeated if it makes up this share of the page's words, and occurs so often.
REPEAT_SHARE, REPEAT_COUNT = 0.04, 4
#: A line is of keywords if this share of its words is repeated.
KEYWORD_SHARE = 0.5
#: A page is flagged if this share of the words of its main text is in link or tag lists.
FLAG_SHARE = 0.5
#: So many words of a line are one observation, up to so many observations a line.
STEP_WORDS, MAX_STEPS = 30, 9
#: The prior's share of the observations; estimation ends if no probability moves further, or after so many rounds.
PRIOR_SHARE, TOLERANCE, ROUNDS = 0.5, 0.005, 12

_WORDS = re.compile(r"[^\W\d_]+").findall
_ADDRESS = re.compile(r"https?://\S+|www\.\S+")
_TAG = re.compile(r"#\w+").findall
_NUMBER = re.compile(r"(?<!\w)\d[\d.,]*(?!\w)").findall
_BARS = "|;/·•,"
_END = r"""[.!?。！？…]["”»“«’')\]]*[\s\pZ]*$"""


def address_or_tags(line: str) -> str:
    """U for a line of addresses, H for one of hashtags, else nothing."""
    addresses = _ADDRESS.findall(line)
    rest = len(_WORDS(_ADDRESS.sub(" ", line))) if addresses else 0
    if addresses and rest <= 4 * len(addresses) and not line.lstrip().startswith("["):
        return "U"
    tags = _TAG(line)
    return "H" if len(tags) >= 3 and sum(map(len, tags)) > 0.5 * len(line) else ""


def observe_batch(lines: pa.Array, page: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(numbers of the lines that are not empty; what the model observes of each; its number of words)."""
    symbols, sizes = np.full(len(labels), "M", dtype="U1"), np.zeros(len(labels), dtype=np.int64)
    body = np.flatnonzero(labels == BODY)
    text = lines.take(pa.array(body))
    words, owner = langid.cut_words(text)
    code, names = words.indices.to_numpy().astype(np.int64), words.dictionary
    length = pc.utf8_length(names).to_numpy()
    weight = np.where(pc.match_substring_regex(names, r"^[\x{3040}-\x{10ffff}]").to_numpy(zero_copy_only=False), (length + 1) // 2, 1)
    n = np.bincount(owner, minlength=len(body))
    # words that make up too much of their page
    of_page = page[body][owner]
    pairs, back, many = np.unique(of_page << 32 | code, return_inverse=True, return_counts=True)
    bar = np.maximum(REPEAT_COUNT - 1, REPEAT_SHARE * np.bincount(of_page, minlength=int(page.max(initial=0)) + 1))
    repeated = (many > bar[pairs >> 32]) & (length[pairs & 0xFFFFFFFF] > 1)
    hits = np.bincount(owner, weights=repeated[back], minlength=len(body))
    bars = sum(pc.count_substring(text, sign).to_numpy() for sign in _BARS)
    figures = np.zeros(len(body), dtype=bool)
    for k in np.flatnonzero((bars >= 2) & (n <= 8)).tolist():
        figures[k] = len(_NUMBER(text[k].as_py())) >= 2
    end = pc.match_substring_regex(text, _END).to_numpy(zero_copy_only=False)
    keyword = (n >= 2) & (hits >= KEYWORD_SHARE * n)
    found = np.select(
        [keyword & (n >= 6), figures, keyword & (bars > 0), keyword, ~end & (pc.count_substring(text, "|").to_numpy() >= 2), (n >= 12) | end & ((n >= 5) | (pc.utf8_length(text).to_numpy() >= 30))],
        ["K", "S", "L", "T", "L", "P"], "T",
    )
    for k in np.flatnonzero(pc.match_substring_regex(text, r"://|www\.|#").to_numpy(zero_copy_only=False)).tolist():
        found[k] = address_or_tags(text[k].as_py()) or found[k]
    symbols[body], sizes[body] = found, np.bincount(owner, weights=weight[code], minlength=len(body))
    at = np.flatnonzero(labels != EMPTY)
    return at, symbols[at], sizes[at]


class Model:
    """Start, transition and emission probabilities; picklable."""

    def __init__(self, start: np.ndarray = START, move: np.ndarray = MOVE, emit: np.ndarray = EMIT):
        self.start, self.move, self.emit = start, move, emit
        self.logs = [np.log(np.maximum(x, 1e-12)) for x in (start, move, emit)]

    def viterbi(self, symbols: str, steps: list[int]) -> list[int]:
        """The likeliest states of a sequence of symbols, each observed ``steps`` times."""
        start, move, emit = self.logs
        seen = [SYMBOLS.index(s) for s in symbols]
        score = start + emit[:, seen[0]] * steps[0]
        back = []
        for s, w in zip(seen[1:], steps[1:]):
            step = score[:, None] + move
            back.append(step.argmax(axis=0))
            score = step.max(axis=0) + emit[:, s] * w
        path = [int(score.argmax())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]

    def expected(self, sequences: list[tuple[str, str]], many: list[int]) -> np.ndarray:
        """Expected counts (start; transitions; emissions, in one row) of sequences (symbols, steps as digits) that occur ``many`` times each."""
        out = np.zeros(len(STATES) * (1 + len(STATES) + len(SYMBOLS)))
        start, move, emit = out[:4], out[4:20].reshape(4, 4), out[20:].reshape(4, -1)
        order = sorted(range(len(sequences)), key=lambda k: len(sequences[k][0]))
        while order:  # blocks of sequences of like length and bounded size
            n = 1
            while n < len(order) and n < 2000 and (n + 1) * len(sequences[order[n]][0]) <= 200_000:
                n += 1
            part, order = order[:n], order[n:]
            size = np.array([len(sequences[k][0]) for k in part])
            top = int(size.max())
            seen = np.array([[SYMBOLS.index(c) for c in sequences[k][0]] + [0] * (top - len(sequences[k][0])) for k in part])
            steps = np.array([[int(c) for c in sequences[k][1]] + [0] * (top - len(sequences[k][1])) for k in part])
            b = np.exp((self.logs[2].T[seen] - self.logs[2].T[seen].max(axis=2, keepdims=True)) * steps[:, :, None])
            alpha = np.zeros((len(part), top, 4))
            now = self.start * b[:, 0]
            alpha[:, 0] = now / now.sum(axis=1, keepdims=True)
            for t in range(1, top):
                now = alpha[:, t - 1] @ self.move * b[:, t]
                alpha[:, t] = now / now.sum(axis=1, keepdims=True)
            weight = np.array([many[k] for k in part], dtype=float)
            beta = np.ones((len(part), 4))
            for t in range(top - 1, -1, -1):
                live = (t < size) * weight
                gamma = alpha[:, t] * beta
                gamma *= (live / gamma.sum(axis=1))[:, None]
                np.add.at(emit.T, seen[:, t], gamma * steps[:, t, None])
                if t == 0:
                    start += gamma.sum(axis=0)
                    break
                ahead = b[:, t] * beta
                pair = alpha[:, t - 1, :, None] * self.move * ahead[:, None, :]
                move += (pair * (live / pair.sum(axis=(1, 2)))[:, None, None]).sum(axis=0)
                before = ahead @ self.move.T
                beta = np.where((t < size)[:, None], before / before.sum(axis=1, keepdims=True), 1.0)
        return out

    def refitted(self, counts: np.ndarray) -> Model:
        """The model of the summed counts and the prior."""

        def part(own: np.ndarray, prior: np.ndarray) -> np.ndarray:
            own = own.reshape(prior.shape)
            mass = own + PRIOR_SHARE * np.maximum(own.sum(axis=-1, keepdims=True), 1.0) * prior
            return mass / mass.sum(axis=-1, keepdims=True)

        return Model(part(counts[:4], START), part(counts[4:20], MOVE), part(counts[20:], EMIT))

    def distance(self, other: Model) -> float:
        return max(np.abs(a - b).max() for a, b in ((self.start, other.start), (self.move, other.move), (self.emit, other.emit)))


def estimate(sequences: DataFrame) -> Model:
    """The model of all pages by Baum-Welch; ``sequences`` has symbols, steps and n."""
    model = Model()
    for _ in range(ROUNDS):
        shared = sequences.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    symbols, steps, n = (batch.column(c).to_pylist() for c in range(3))
                    counts = shared.value.expected(list(zip(symbols, steps)), n)
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(counts), dtype=np.int32)), pa.array(counts)], names=["at", "value"])

        summed = sequences.select("symbols", "steps", "n").mapInArrow(run, "at INT, value DOUBLE").groupBy("at").agg(F.sum("value").alias("value")).collect()  # one row a parameter
        counts = np.zeros(len(STATES) * (1 + len(STATES) + len(SYMBOLS)))
        for r in summed:
            counts[r["at"]] = r["value"]
        model, before = model.refitted(counts), model
        if model.distance(before) < TOLERANCE:
            break
    return model


def observe(lines: list[str], labels: list[int]) -> tuple[str, list[int]]:
    """(symbols, number of words) of one page's lines that are not empty."""
    _, symbols, sizes = observe_batch(pa.array(lines, type=pa.large_string()), np.zeros(len(lines), dtype=np.int64), np.array(labels))
    return "".join(symbols), sizes.tolist()


def steps_of(sizes: list[int]) -> list[int]:
    """How many observations each line is."""
    return [min(MAX_STEPS, 1 + n // STEP_WORDS) for n in sizes]


def rate(symbols: str, sizes: list[int], model: Model | None = None) -> tuple[int, int, int, float]:
    """(words of prose, of link lists, of tag lists, share of lists in the main text) of an observed page."""
    size = [0, 0, 0, 0]
    if any(s in "UHKSL" for s in symbols):
        for s, state, n in zip(symbols, (model or Model()).viterbi(symbols, steps_of(sizes)), sizes):
            if s not in "TM":
                size[state] += n
    else:  # only prose, titles and template: no state but prose gets words
        size[0] = sum(n for s, n in zip(symbols, sizes) if s == "P")
    prose, links, tags, menu = size
    total = prose + links + tags + menu
    return prose + menu, links, tags, (links + tags) / total if total else 0.0


def rate_pages(df: DataFrame, key: str, wrapper: Wrapper) -> DataFrame:
    """(key, prose, links, tags, list_share, flagged) of each page; ``df`` has url, host, domain, content and title."""
    sc = df.sparkSession.sparkContext
    shared = sc.broadcast(wrapper)
    seen = T.StructType([T.StructField("key", df.schema[key].dataType), *T.StructType.fromDDL("symbols STRING, sizes ARRAY<INT>, steps STRING").fields])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 3):
            at, lines, page, labels = labelled(batch, shared.value)
            shown, codes, words = observe_batch(lines, page, labels)
            bounds = np.searchsorted(page[shown], np.arange(len(at) + 1)).tolist()
            symbols = ["".join(codes[a:b]) for a, b in zip(bounds, bounds[1:])]
            sizes = [words[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
            steps = ["".join(map(str, steps_of(n))) for n in sizes]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, type=pa.int64())), pa.array(symbols, type=pa.string()), pa.array(sizes, type=pa.list_(pa.int32())), pa.array(steps, type=pa.string())], names=seen.names)

    observed = staged(label_input(df, key, wrapper).mapInArrow(look, seen), "observed-lines")
    sequences = staged(observed.where("symbols <> ''").groupBy("symbols", "steps").agg(F.count(F.lit(1)).alias("n")), "symbol-sequences")
    model = sc.broadcast(estimate(sequences))
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), *T.StructType.fromDDL("prose INT, links INT, tags INT, list_share DOUBLE, flagged BOOLEAN").fields])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rated = [rate(s, n, model.value) for s, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            prose, links, tags, share = zip(*rated) if rated else ((), (), (), ())
            flagged = [s >= FLAG_SHARE for s in share]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prose, type=pa.int32()), pa.array(links, type=pa.int32()), pa.array(tags, type=pa.int32()), pa.array(share, type=pa.float64()), pa.array(flagged, type=pa.bool_())], names=schema.names)

    return observed.select("key", "symbols", "sizes").mapInArrow(judge, schema)
