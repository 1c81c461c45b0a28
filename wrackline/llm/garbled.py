"""Text that was decoded with the wrong character encoding.

Method: garbled text is joined with clean near-twins on the text stripped of
its non-ASCII characters. Units of comparison are words and, for scripts
without ASCII letters, lines. In each group of equal stripped form the most
frequent unit is taken as clean; rare ones are aligned with it run by run (a run
of non-ASCII characters between the same ASCII characters), and the pairs of
runs name the transformations (right encoding, wrong encoding) that explain
them. Encodings that mix ASCII bytes into garbled characters have no such twin:
their words are joined after decoding instead. Transformations with at least
``MIN_SUPPORT`` twins that no better supported one explains are learned and
applied to all remaining records, line by line: a line is garbled if every
non-ASCII word of it can be turned back by one transformation and the result
is clearly likelier by the corpus's character pairs. So a clean line that
only quotes garbled characters stays, as its own non-ASCII characters cannot be
turned back.

Characters that were lost (U+FFFD) are restored by the clean twin of the word
where there is one.

Defined results: null and empty texts are never garbled; texts are split into
lines at ``\\n``; an end cut inside a character is tolerated; repeated rows give
a row each.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wrackline.llm.counting import slices, sums
from wrackline.session import staged

#: Encodings that a text may have been read with, and that it may truly have.
READ_AS = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250", "iso8859-2", "cp1251", "koi8-r", "cp866", "iso8859-5")
TRULY = ("utf-8", "cp1252", "cp1250", "iso8859-2", "cp1251", "koi8-r", "cp866", "iso8859-5", "mac_roman", "cp437", "cp850", "cp932", "euc-jp")
FAMILIES = tuple((w, r) for w in READ_AS for r in TRULY if w != r and {w, r} != {"cp1252", "latin-1"}) + (("cp932", "utf-8"), ("euc-jp", "utf-8"))
_NUMBER = {f: k for k, f in enumerate(FAMILIES)}
#: Encodings of several bytes a character; encodings whose undefined bytes may stand as C1 controls.
_WIDE, _WITH_C1 = ("utf-8", "cp932", "euc-jp"), ("cp1252", "cp1250", "cp1251")
MIN_SUPPORT = 3
#: A clean twin is at least so many times as frequent as the garbled unit.
MIN_RATIO = 5
#: Character pairs and lost words with a smaller share of all are left out of what is broadcast: at most 1/share entries.
LEAST_SHARE = 1e-6
#: A line is garbled if turning it back gains so many nats in all, and so many for each of its non-ASCII words.
MIN_GAIN, MIN_GAIN_WORD = 3.0, 1.5

_EDGE = "“”„«»‘’\"'()[]{}.,;:!?…"
_RUN = re.compile(r"[^\x00-\x7f]+")
_LOST = "�"
_C1 = re.compile(r"[\x80-\x9f]").search


def encode_as(text: str, codec: str) -> bytes | None:
    """The bytes that ``codec`` reads as ``text``; bytes it leaves undefined may stand as C1 controls."""
    try:
        return text.encode(codec)
    except UnicodeEncodeError:
        if codec not in _WITH_C1 or not _C1(text):
            return None
    out = bytearray()
    for c in text:
        try:
            out += c.encode(codec)
        except UnicodeEncodeError:
            if not 0x80 <= ord(c) < 0xA0:
                return None
            out.append(ord(c))
    return bytes(out)


def turn_back(text: str, family: tuple[str, str], cut: bool = False, raws: dict[str, bytes | None] | None = None) -> str | None:
    """``text`` read again with the true encoding; None if it cannot be. ``cut`` drops an incomplete last character of UTF-8; ``raws`` keeps its bytes by codec."""
    raw = encode_as(text, family[0]) if raws is None or family[0] not in raws else raws[family[0]]
    if raws is not None:
        raws[family[0]] = raw
    if raw is None:
        return None
    try:
        return raw.decode(family[1])
    except UnicodeDecodeError as e:
        return raw[: e.start].decode(family[1]) if cut and e.reason == "unexpected end of data" else None


def words_in(line: str) -> list[str]:
    """The blank-separated words with non-ASCII characters."""
    return [w for w in line.split(" ") if not w.isascii()]


def bare(word: str) -> str:
    return word.strip(_EDGE)


def pair_of(pair: str) -> str:
    """A character pair ignoring case, but for a mark where a capital follows a small letter."""
    return pair.lower() + ("^" if pair[0].islower() and pair[1].isupper() else "")


def pairs_of(word: str) -> list[str]:
    """Character pairs with a non-ASCII member; edges are blanks."""
    return [pair_of(p) for p in map(add, f" {word}", f"{word} ") if not p.isascii()]


def stripped(unit: str) -> str:
    """The ASCII characters of a unit, in lower case, digits as 0."""
    return re.sub(r"\d", "0", _RUN.sub("", unit)).lower()


def runs(unit: str) -> list[tuple[int, str]]:
    """(number of ASCII characters before it, run) of each run of non-ASCII characters."""
    out, seen, last = [], 0, 0
    for m in _RUN.finditer(unit):
        seen += m.start() - last
        out.append((seen, m.group()))
        last = m.end()
    return out


def explaining(garbled: str, clean: str) -> list[int]:
    """Numbers of the families that turn every run of ``garbled`` into the run of ``clean`` at its place."""
    a, b = runs(garbled), runs(clean)
    if [p for p, _ in a] != [p for p, _ in b] or a == b:
        return []
    out = []
    for k, family in enumerate(FAMILIES):
        if all(turn_back(x, family) == y for (_, x), (_, y) in zip(a, b)):
            out.append(k)
    return out


class Restorer:
    """Learned transformations, character pairs, word counts and lost words; picklable and bounded."""

    #: Lost words too rare to be broadcast (form, back); stays in the driver.
    rare: DataFrame | None = None

    def __init__(self, families: list[int], pairs: dict[str, int], words: dict[str, int], lost: dict[str, str]):
        self.families, self.pairs, self.words, self.lost = families, pairs, words, lost
        self._start()

    def _start(self) -> None:
        self.memo: dict[tuple[str, bool], dict[int, tuple[str, float, int]]] = {}
        self.slot = {k: i for i, k in enumerate([*self.families, *(k + 1000 for k in self.families)])}
        self.logs: dict[str, float] = {}
        self.rows: dict[str, int] = {}
        self.gains = np.empty((0, max(1, len(self.slot))), dtype=np.float32)
        self.base = math.log(max(1, sum(self.pairs.values())))

    def __getstate__(self):
        return {"families": self.families, "pairs": self.pairs, "words": self.words, "lost": self.lost}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._start()

    def likely(self, word: str) -> float:
        total, known = 0.0, self.logs
        for pair in map(add, f" {word}", f"{word} "):
            value = known.get(pair)
            if value is None:
                if len(known) > 200_000:
                    known.clear()
                value = known[pair] = 0.0 if pair.isascii() else math.log(self.pairs.get(pair_of(pair), 0) + 0.2) - self.base
            total += value
        return total + math.log(self.words.get(word, 0) + 1)

    def readings(self, word: str, cut: bool) -> dict[int, tuple[str, float, int]]:
        """:meth:`read_back` by a bounded memo."""
        known = self.memo.get((word, cut))
        if known is None:
            if len(self.memo) > 20_000:
                self.memo.clear()
            known = self.read_back(word, cut)
            if len(word) <= 200:
                self.memo[(word, cut)] = known
        return known

    def read_back(self, word: str, cut: bool) -> dict[int, tuple[str, float, int]]:
        """family -> (word turned back, what that gains, 1 if it changed); twice as family + 1000."""
        known, as_is = {}, self.likely(word)
        raws: dict[str, bytes | None] = {}
        for k in self.families:
            back = turn_back(word, FAMILIES[k], raws=raws)
            if back is None:
                if cut and FAMILIES[k][1] == "utf-8" and (back := turn_back(word, FAMILIES[k], True)) is not None:
                    known[k] = (back, 0.0, 0)  # no evidence by itself
            elif back == word:
                known[k] = known[k + 1000] = (word, 0.0, 0)
            elif self.words.get(word, 0) >= MIN_RATIO * max(1, self.words.get(back, 0)):
                continue  # an established word by itself
            elif len(word) == 1 and self.words.get(back, 0) < MIN_RATIO * self.words.get(word, 0):
                continue  # a sign alone has no neighbours to judge by
            elif not any(0x80 <= ord(c) < 0xA0 or c == _LOST for c in back):
                known[k] = (back, self.likely(back) - as_is, 1)
                if FAMILIES[k][1] == "utf-8" and (again := turn_back(back, FAMILIES[k])) is not None:
                    known[k + 1000] = (again, self.likely(again) - as_is, 1)
        return known

    def _gain_rows(self, words: list[str]) -> np.ndarray:
        """Row of each word in ``gains``: what it gains by each transformation, -inf where it cannot be turned back."""
        if len(self.rows) > 100_000:
            self.rows, self.gains = {}, self.gains[:0]
        new = [w for w in words if w not in self.rows]
        if new:
            fresh = np.full((len(new), self.gains.shape[1]), -np.inf, dtype=np.float32)
            for row, w in zip(fresh, new):
                for k, (_, gain, _) in self.read_back(w, False).items():
                    row[self.slot[k]] = gain
            self.rows.update(zip(new, range(len(self.gains), len(self.gains) + len(new))))
            self.gains = np.concatenate([self.gains, fresh])
        return np.fromiter((self.rows[w] for w in words), dtype=np.int64, count=len(words))

    def restore_lines(self, lines: pa.Array) -> dict[int, tuple[str, str]]:
        """number -> :meth:`restore_line` of the garbled ones of ``lines``. Lines whose words gain too little in sum by every transformation are not tried."""
        out = {}
        for start in range(0, len(lines), 20_000):
            part = lines.slice(start, 20_000)
            split = pc.split_pattern(part, " ")
            words = split.flatten()
            odd = pc.invert(pc.string_is_ascii(words))
            owner = np.repeat(np.arange(len(part)), np.diff(split.offsets.to_numpy()))[odd.to_numpy(zero_copy_only=False)]
            tried = set(np.flatnonzero(pc.match_substring_regex(part, f"{_LOST}|ï¿½").to_numpy(zero_copy_only=False)).tolist())
            if len(owner):
                coded = words.filter(odd).dictionary_encode()
                gains = self.gains_of(coded.dictionary.to_pylist(), coded.indices.to_numpy())
                starts = np.flatnonzero(np.diff(owner, prepend=-1))
                best = np.add.reduceat(gains, starts, axis=0).max(axis=1)
                tried.update(owner[starts[best >= MIN_GAIN - 0.01]].tolist())
            for k in sorted(tried):
                if fixed := self.restore_line(part[k].as_py()):
                    out[start + k] = fixed
        return out

    def gains_of(self, words: list[str], index: np.ndarray) -> np.ndarray:
        rows = self._gain_rows(words)  # may grow the table
        return self.gains[rows[index]]

    def restore_line(self, line: str, cut: bool = False) -> tuple[str, str] | None:
        """(restored line, "read as>true encoding") of a garbled line, None for any other."""
        if line.isascii():
            return None
        words = words_in(line)
        found: list[dict[int, tuple[str, float, int]]] = []
        common: set[int] = set()
        for k, w in enumerate(words):
            found.append(self.readings(w, cut and k == len(words) - 1 and line.endswith(w)))
            common = set(found[0]) if k == 0 else common.intersection(found[k])
            if not common:
                break  # no transformation turns all words back
        best = None
        for k in common and set(found[0]).intersection(*found[1:]):
            gain, changed = sum(f[k][1] for f in found), sum(f[k][2] for f in found)
            if changed and gain >= max(MIN_GAIN, MIN_GAIN_WORD * changed) and (best is None or gain > best[0]):
                best = gain, k
        if best:
            swap = iter([f[best[1]][0] for f in found])
            text = " ".join(w if w.isascii() else next(swap) for w in line.split(" "))
            wrong, right = FAMILIES[best[1] % 1000]
            return text, f"{wrong}>{right}" + (" twice" if best[1] >= 1000 else "")
        if _LOST in line and any(_LOST in w and (bare(w).strip(_LOST) or w.strip(_LOST) == "") for w in words) or "ï¿½" in line:
            return " ".join(self._found(w) if _LOST in w else w for w in line.split(" ")), "lost"
        return None

    def _found(self, word: str) -> str:
        core = bare(word)
        back = self.lost.get(core.lower())
        if back is None:
            return word
        if core[:1].isupper() or core[:1] == _LOST and core[1:2].isupper():
            back = back[:1].upper() + back[1:]
        return word.replace(core, back)

    def restore_batch(self, texts: list[str]) -> list[tuple[str, int, str] | None]:
        """:meth:`restore` of many texts with non-ASCII characters."""
        if not texts:
            return []
        split = pc.split_pattern(pa.array(texts, type=pa.large_string()), "\n")
        ends = split.offsets.to_numpy()[1:]
        lines = split.flatten()
        odd = ~pc.string_is_ascii(lines).to_numpy(zero_copy_only=False)
        odd[ends - 1] = False
        numbers = np.flatnonzero(odd)
        coded = lines.take(pa.array(numbers)).dictionary_encode()
        fixed = self.restore_lines(coded.dictionary)
        code = coded.indices.to_numpy()
        hit = np.isin(code, np.fromiter(fixed, dtype=code.dtype, count=len(fixed)))
        changed: dict[int, dict[int, tuple[str, str]]] = {}
        for line, c in zip(numbers[hit].tolist(), code[hit].tolist()):
            changed.setdefault(int(np.searchsorted(ends, line, side="right")), {})[line] = fixed[c]
        out: list[tuple[str, int, str] | None] = []
        for k, text in enumerate(texts):
            own = changed.get(k, {})
            if done := self.restore_line(text[text.rfind("\n") + 1 :], True):
                own[int(ends[k]) - 1] = done
            if not own:
                out.append(None)
                continue
            first = int(ends[k - 1]) if k else 0
            parts = text.split("\n")
            for line, (back, _) in own.items():
                parts[line - first] = back
            out.append(("\n".join(parts), len(own), ", ".join(sorted({how for _, how in own.values()}))))
        return out

    def restore(self, text: str | None) -> tuple[str, int, str] | None:
        """(restored text, number of garbled lines, transformations) of a text with garbled lines."""
        if not text or text.isascii():
            return None
        return self.restore_batch([text])[0]


def units(df: DataFrame, texts: list[str]) -> DataFrame:
    """(kind, unit, n): words with non-ASCII characters, and lines of scripts without ASCII letters that hold some, with their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            for column in batch.columns:
                column = column.drop_null().cast(pa.large_string())
                lines = pc.split_pattern(column.filter(pc.invert(pc.string_is_ascii(column))), "\n").flatten()
                lines = lines.filter(pc.invert(pc.string_is_ascii(lines)))
                split = pc.split_pattern(lines, " ")
                words = split.flatten()
                odd = pc.invert(pc.string_is_ascii(words))
                owner = np.repeat(np.arange(len(lines)), np.diff(split.offsets.to_numpy()))[odd.to_numpy(zero_copy_only=False)]
                words = words.filter(odd)
                foreign = np.zeros(len(lines), dtype=bool)
                foreign[owner[~pc.match_substring_regex(words, "[A-Za-z]").to_numpy(zero_copy_only=False)]] = True
                whole = lines.filter(pa.array(foreign))
                whole = whole.filter(pc.match_substring_regex(whole, "(?:[A-Za-z][^A-Za-z]*){6}"))
                whole = pc.utf8_trim_whitespace(pc.replace_substring_regex(whole, r"\p{Nd}", "0"))
                for kind, found in (("w", words), ("l", whole)):
                    counts = pc.value_counts(found)
                    yield pa.RecordBatch.from_arrays([pa.array([kind] * len(counts), type=pa.string()), counts.field(0).cast(pa.string()), counts.field(1)], names=["kind", "unit", "n"])

    return df.select(*[F.col(t).cast("string") for t in texts]).mapInArrow(count, "kind STRING, unit STRING, n BIGINT").groupBy("kind", "unit").agg(F.sum("n").alias("n"))


class Decoder:
    """Turns many units back by all families at once; only what can be a known word comes out."""

    def __init__(self, known: np.ndarray):
        """``known``: code points that known words consist of."""
        self.known = np.zeros(0x110000, dtype=bool)
        self.known[known] = True
        self.known[:128] = True
        self.encode, self.decode = {}, {}
        for w in READ_AS:
            table = np.full(0x10000, -1, dtype=np.int16)
            for byte in range(256):
                table[ord(bytes([byte]).decode(w, "replace"))] = byte
            table[0xFFFD] = -1
            if w in _WITH_C1:
                for c in range(0x80, 0xA0):
                    if table[c] < 0:
                        table[c] = c
            self.encode[w] = table
        for r in TRULY:
            if r not in _WIDE:
                out = np.array([ord(bytes([byte]).decode(r, "replace")) for byte in range(256)], dtype=np.int32)
                self.decode[r] = np.where((out == 0xFFFD) | ~self.known[out], -1, out)

    def readings(self, units: list[str]) -> Iterator[tuple[int, int, str]]:
        """(number of the unit, family, what it reads when turned back) for each family that changes it into known characters."""
        units = ["\0" if u == "" else u for u in units]
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        ends = np.cumsum([len(u) for u in units])
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        for w in READ_AS:
            raw = np.where(codes < 0x10000, self.encode[w][np.minimum(codes, 0xFFFF)], -1)
            fits = np.flatnonzero(np.minimum.reduceat(raw, starts) >= 0)
            if not len(fits):
                continue
            for r in TRULY:
                family = _NUMBER.get((w, r))
                if family is None:
                    continue
                if r in self.decode:
                    back = np.where(raw >= 0, self.decode[r][np.maximum(raw, 0)], -1)
                    changed = np.maximum.reduceat((back != codes) & (back >= 128), starts)
                    for k in fits[(np.minimum.reduceat(back, starts)[fits] >= 0) & changed[fits]].tolist():
                        yield k, family, back[starts[k] : ends[k]].astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")
                    continue
                high = raw >= 0x80
                after = np.concatenate([raw[1:], [0]])
                after[ends - 1] = 0
                if r == "utf-8":
                    bad = high & ~((raw >= 0xC2) & (raw <= 0xF4) | (raw <= 0xBF)) | (raw >= 0xC2) & ~((after >= 0x80) & (after <= 0xBF))
                elif r == "euc-jp":
                    before = np.concatenate([[0], raw[:-1]])
                    before[starts] = 0
                    bad = high & (after < 0x80) & (before < 0x80)
                else:
                    bad = np.zeros(len(raw), dtype=bool)
                may = fits[~np.maximum.reduceat(bad, starts)[fits]]
                for k in may.tolist():
                    if (text := self._wide(raw[starts[k] : ends[k]].astype(np.uint8).tobytes(), r)) is not None and text != units[k]:
                        yield k, family, text
        for family, (w, r) in enumerate(FAMILIES):
            if w in _WIDE:
                for k, u in enumerate(units):
                    if (raw := encode_as(u, w)) is not None and (text := self._wide(raw, r)) is not None and text != u:
                        yield k, family, text

    def _wide(self, raw: bytes, codec: str) -> str | None:
        try:
            text = raw.decode(codec)
        except UnicodeDecodeError:
            return None
        return None if text.isascii() or not all(self.known[ord(c)] for c in text) else text


def learn(df: DataFrame, texts: list[str]) -> Restorer:
    """Learn transformations, character pairs and lost words from all records of ``texts``."""
    table = staged(units(df, texts), "garbled-units")

    def trim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.utf8_trim(batch.column(1), _EDGE), batch.column(2)], names=["kind", "unit", "n"])

    def shape(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            form = pc.utf8_lower(pc.replace_substring_regex(pc.replace_substring_regex(batch.column(1), "[^\\x00-\\x7f]+", ""), "[0-9]", "0"))
            yield pa.RecordBatch.from_arrays([*batch.columns, form], names=["kind", "unit", "n", "form"])

    # near-twins: the most frequent unit of each stripped form, joined with the rare ones
    core = table.mapInArrow(trim, "kind STRING, unit STRING, n BIGINT").groupBy("kind", "unit").agg(F.sum("n").alias("n"))
    formed = core.mapInArrow(shape, "kind STRING, unit STRING, n BIGINT, form STRING").where(F.length(F.regexp_replace("form", "[^a-z]", "")) >= 3)
    clean = formed.groupBy("kind", "form").agg(F.max_by("unit", F.struct("n", "unit")).alias("clean"), F.max("n").alias("n_clean"))
    twins = staged(formed.join(clean, ["kind", "form"]).where((F.col("n") * MIN_RATIO <= F.col("n_clean")) & (F.col("unit") != F.col("clean"))).select("kind", "unit", "n", "clean"), "near-twins")

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [explaining(g, c) for g, c in zip(batch.column("unit").to_pylist(), batch.column("clean").to_pylist())]
            found = [f for f in found if f]
            yield pa.RecordBatch.from_arrays([pa.array(found, type=pa.list_(pa.int32()))], names=["families"])

    by_runs = twins.select("unit", "clean").mapInArrow(explain, "families ARRAY<INT>")

    words = table.where("kind = 'w'").select("unit", "n")

    # units that match after decoding; a known word has MIN_RATIO times their count, so at least MIN_RATIO
    def characters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(sorted({ord(c) for u in batch.column(0).to_pylist() for c in u}), type=pa.int32())], names=["c"])

    known_words = words.where(F.col("n") >= MIN_RATIO)
    # at most as many rows as Unicode has characters
    decoder = df.sparkSession.sparkContext.broadcast(Decoder(np.array([r["c"] for r in known_words.select("unit").mapInArrow(characters, "c INT").distinct().collect()], dtype=np.int64)))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            if batch.num_rows:
                found = list(decoder.value.readings(batch.column(0).to_pylist()))
                at, family, back = zip(*found) if found else ((), (), ())
                rows = pa.array(at, type=pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(family, type=pa.int32()), pa.array(back, type=pa.string())], names=["unit", "n", "family", "back"])

    decoded = words.mapInArrow(decode, "unit STRING, n BIGINT, family INT, back STRING").where("length(back) >= 3")
    known = known_words.select(F.col("unit").alias("back"), F.col("n").alias("n_clean"))
    by_decoding = decoded.join(known, "back").where(F.col("n") * MIN_RATIO <= F.col("n_clean")).groupBy("unit").agg(F.sort_array(F.collect_set("family")).alias("families")).select("families")
    chosen = cover(staged(by_runs.unionByName(by_decoding).groupBy("families").agg(F.count(F.lit(1)).alias("n")), "explaining-families"))

    def pair_counts(batch: pa.RecordBatch, into: Counter) -> None:
        for u, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for p in pairs_of(u):
                into[(p,)] += n

    pairs = staged(sums(words, "pair STRING", pair_counts), "character-pairs")
    total = pairs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    kept = pairs.where(F.col("n") >= LEAST_SHARE * total).collect()  # at most 1/LEAST_SHARE rows

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit, clean, n = (batch.column(c).to_pylist() for c in range(3))
            kept = [(u.lower(), c.lower(), k) for u, c, k in zip(unit, clean, n) if [p for p, _ in runs(u)] == [p for p, _ in runs(c)]]
            form, back, many = zip(*kept) if kept else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(form, type=pa.string()), pa.array(back, type=pa.string()), pa.array(many, type=pa.int64())], names=["form", "back", "n"])

    lost = twins.where("kind = 'w'").where(F.col("unit").contains(_LOST) & ~F.col("clean").contains(_LOST)).select("unit", "clean", "n")
    per_form = lost.mapInArrow(alike, "form STRING, back STRING, n BIGINT").groupBy("form").agg(F.max_by("back", F.struct("n", "back")).alias("back"), F.max("n").alias("n"))
    forms = staged(per_form, "lost-words")
    mapped = {r["form"]: r["back"] for r in forms.where(F.col("n") >= LEAST_SHARE * total).collect()}  # at most 1/LEAST_SHARE rows
    n_words = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    common = words.where((F.col("n") >= LEAST_SHARE * n_words) & (F.col("n") > 1)).collect()  # at most 1/LEAST_SHARE rows
    learned = Restorer(chosen, {r["pair"]: r["n"] for r in kept}, {r["unit"]: r["n"] for r in common}, mapped)
    learned.rare = forms.where(F.col("n") < LEAST_SHARE * total).select("form", "back")
    return learned


def cover(support: DataFrame) -> list[int]:
    """Families, best first, that each explain at least ``MIN_SUPPORT`` units that no better one explains; ``support`` has families and n."""
    chosen: list[int] = []
    while True:
        left = support.where(~F.arrays_overlap("families", F.array(*[F.lit(c) for c in chosen]))) if chosen else support
        best = left.select(F.explode("families").alias("f"), "n").groupBy("f").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "f").first()
        if best is None or best["n"] < MIN_SUPPORT:
            return chosen
        chosen.append(best["f"])


def restore(df: DataFrame, key: str, texts: list[str], restorer: Restorer | None = None) -> DataFrame:
    """(key, field_name, n_lines, transformation, restored) of each garbled value of the columns ``texts``."""
    restorer = restorer or learn(df, texts)
    found = garbled_values(df, key, texts, restorer)
    return found if restorer.rare is None else restore_rare(staged(found, "restored"), restorer.rare)


def restore_rare(found: DataFrame, rare: DataFrame) -> DataFrame:
    """``found`` with lost words that are not broadcast restored by a shuffled join of the affected texts' words with ``rare``."""
    open_ = F.contains(F.col("restored"), F.lit(_LOST))
    affected = found.where(open_).withColumns({"_h": F.xxhash64("restored"), "_g": F.xxhash64(F.lit(7), "restored")})

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, form = [], []
            for k, text in enumerate(batch.column(2).to_pylist()):
                for f in {bare(w).lower() for line in text.split("\n") for w in line.split(" ") if _LOST in w}:
                    at.append(k), form.append(f)
            rows = pa.array(at, type=pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(form, type=pa.string())], names=["_h", "_g", "form"])

    words = affected.select("_h", "_g", "restored").mapInArrow(forms, "_h BIGINT, _g BIGINT, form STRING").distinct()
    known = words.join(rare.hint("shuffle_merge"), "form").groupBy("_h", "_g").agg(F.collect_list("form").alias("_forms"), F.collect_list("back").alias("_backs"))
    joined = affected.join(known, ["_h", "_g"], "left").select(*found.columns, "_forms", "_backs")
    at = found.columns.index("restored")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_columns - 2
            out = []
            for text, own, backs in zip(*(batch.column(c).to_pylist() for c in (at, n, n + 1))):
                if own:
                    fix = Restorer([], {}, {}, dict(zip(own, backs)))
                    text = "\n".join(" ".join(fix._found(w) if _LOST in w else w for w in line.split(" ")) for line in text.split("\n"))
                out.append(text)
            columns = [pa.array(out, type=pa.string()) if c == at else batch.column(c) for c in range(n)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:n])

    return found.where(~open_).unionByName(joined.mapInArrow(run, found.schema))


def garbled_values(df: DataFrame, key: str, texts: list[str], restorer: Restorer) -> DataFrame:
    """As :func:`restore`, but with only the broadcast lost words restored."""
    shared = df.sparkSession.sparkContext.broadcast(restorer)
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), *T.StructType.fromDDL("field_name STRING, n_lines INT, transformation STRING, restored STRING").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fix: Restorer = shared.value
        for batch in slices(batches, 1):
            at, names, out = [], [], []
            for c, name in enumerate(texts, 1):
                column = batch.column(c).to_pylist()
                mixed = [k for k, text in enumerate(column) if text and not text.isascii()]
                for k, done in zip(mixed, fix.restore_batch([column[k] for k in mixed])):
                    if done:
                        at.append(k), names.append(name), out.append(done)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, type=pa.int64())), pa.array(names, type=pa.string()), pa.array([o[1] for o in out], type=pa.int32()), pa.array([o[2] for o in out], type=pa.string()), pa.array([o[0] for o in out], type=pa.string())],
                names=schema.names,
            )

    return df.select(F.col(key), *[F.col(t).cast("string") for t in texts]).mapInArrow(run, schema)
