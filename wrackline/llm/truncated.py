"""Texts that stop before their own end, and how often each source cuts them.

Method: word trigrams are counted inside sentences, before sentence marks, and
at open ends (of lines that a further line follows), in SQL. The final trigram
of each text that ends open is joined with these counts. Its last word may
itself be cut, so it is compared as a beginning: the counts are those of all
trigrams with its first two words and a third one that begins with its last. If
it is frequent but almost never ends a line openly, the text was cut there.

Where the counts are thin, less specific evidence decides: the share of open
ends among lines of the same build (first character, punctuation, kind of the
last word, length), as many lines properly end open, without a mark (titles,
links, menus); and whether the last word is known at all. A last line that
occurs elsewhere as a whole line (with the site's name left out) is complete. A
length that far more texts have than its neighbouring lengths is a length limit,
and a recorded length above the text's own tells of a broken transfer: open ends
with either count as cut too. ``by_trigram`` tells whether the trigram decides.

Only trigrams with the first two words of a final one, and last words, are
counted: they are picked before the count by broadcast joins while there are at
most ``MAX_BROADCAST`` open ends (counted), and after a count of all, with
partial sums before its shuffle, beyond. Lines' builds come from one pass in
whole Arrow batches.

Defined results: null and empty texts are not cut; a text that ends in a
sentence mark, or whose last line is empty, is not cut; repeated rows are
judged each and count once in the search for limits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wrackline.llm.boilerplate import cut_lines
from wrackline.llm.counting import slices
from wrackline.session import staged

#: Open ends up to this number are broadcast (some 50 bytes each).
MAX_BROADCAST = 200_000
#: A trigram almost never ends a line if so small a share of its occurrences does; counts below the second number are thin.
RARE_END, THIN = 0.05, 3
#: A length is a limit if so many distinct texts have it, and so many times as many as the lengths around it on average.
LIMIT_TEXTS, LIMIT_RATIO = 10, 5

_CLOSED = r"""[.!?。！？…]["”»“«’')\]]*$|>>$|[\])]$"""
_CLOSING_MARK = r"""[.!?。！？…]["”»“«’')\]]*$"""

# each sentence mark is the token ".", each line end a line feed
_TOKENS = r"""array_remove(split(regexp_replace(replace(lower({text}), '\n', ' \n '), '[.!?。！？…]+', ' . '), '[^\\p{{{{L}}}}\\p{{{{N}}}}.\n]+'), '')"""


def _pick(cases: list[tuple[pa.Array, str]], otherwise: str) -> np.ndarray:
    """The value of the first case that holds, of each row."""
    out = np.full(len(cases[0][0]), otherwise, dtype=object)
    for holds, value in reversed(cases):
        out[holds.to_numpy(zero_copy_only=False)] = value
    return out


def builds_of(lines: pa.Array, closed: np.ndarray) -> list[str]:
    """What lines are built like: first character, punctuation (a closing mark aside), kind of the last word, length."""
    head = pc.utf8_slice_codeunits(pc.utf8_ltrim_whitespace(lines), 0, 1)
    rest = pc.utf8_slice_codeunits(pc.utf8_ltrim_whitespace(lines), 1)
    rest = pc.if_else(pa.array(closed), pc.replace_substring_regex(rest, _CLOSING_MARK, ""), rest)
    signs = pc.replace_substring_regex(rest, r"[\pL\pM\pN\s\pZ]+", "").dictionary_encode()
    sets = np.array(["".join(sorted(set(x))) for x in signs.dictionary.to_pylist()], dtype=object)
    first = _pick([(pc.match_substring_regex(head, r"\p{Lu}"), "A"), (pc.match_substring_regex(head, r"\p{Ll}"), "a"), (pc.match_substring_regex(head, "[0-9]"), "0")], "")
    other = np.flatnonzero(first == "")
    first[other] = head.take(pa.array(other)).to_pylist()
    kind = _pick([(pc.match_substring_regex(lines, r"(?:^|[^\pL\pN])\p{Ll}[\pL\pM]*[^\pL\pN]*$"), "l"), (pc.match_substring_regex(lines, r"[\pL\pM][^\pL\pN]*$"), "u")], "0")
    size = np.searchsorted([4, 8, 14, 24], pc.count_substring(lines, " ").to_numpy() + 1)
    return [f"{a}{b}{c}/{d}" for a, b, c, d in zip(first, sets[signs.indices.to_numpy()], kind, size.tolist())]


def forms_of(low: pa.Array) -> pa.Array:
    """The letters of lower-case lines; only ASCII ones where there are enough, so that a garbled copy has the same form."""
    plain = pc.replace_substring_regex(low, "[^a-z]+", "")
    few = pc.less(pc.binary_length(plain), 6)
    return pc.replace_with_mask(plain, few, pc.replace_substring_regex(low.filter(few), r"[^\pL]+", ""))


def built_lines(texts: DataFrame) -> DataFrame:
    """(u, last, open, form, build, id, bare) of the lines of ``texts`` (id, u, site, text) with letters or digits that are not a closed last one; id and bare of last ones."""
    schema = T.StructType([*T.StructType.fromDDL("u BIGINT, last BOOLEAN, open BOOLEAN, form STRING, build STRING, bare STRING").fields, T.StructField("id", texts.schema["id"].dataType)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 3):
            sites, bodies = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            lines, page = cut_lines(bodies)
            low, _ = cut_lines([t.lower().replace(s, "") if s and len(s) >= 4 else t.lower() for t, s in zip(bodies, sites)])
            last = np.concatenate([page[1:] != page[:-1], [True]]) if len(page) else np.zeros(0, dtype=bool)
            bare = pc.utf8_rtrim(lines, " \t\r\xa0")
            open_ = ~pc.match_substring_regex(bare, _CLOSED).to_numpy(zero_copy_only=False)
            keep = pc.match_substring_regex(bare, r"[\pL\pN]").to_numpy(zero_copy_only=False) & (~last | open_)
            at = pa.array(np.flatnonzero(keep))
            bare, rows, last, open_ = bare.take(at), page[keep], last[keep], open_[keep]
            ends = pa.array(last)
            none = pa.scalar(None, type=pa.string())
            build = builds_of(bare, ~open_) if len(rows) else []
            ids = batch.column(0).take(pa.array(np.where(last, rows, 0), mask=~last))
            yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(rows)), ends, pa.array(open_), forms_of(low.take(at)).cast(pa.string()), pa.array(build, type=pa.string()), pc.if_else(ends, bare.cast(pa.string()), none), ids], names=schema.names)

    return texts.select("id", "u", "site", "text").mapInArrow(run, schema)


def judge(df: DataFrame, key: str, text: str, url: str, source: str | None = None, declared: str | None = None) -> DataFrame:
    """(key, cut, by_trigram, limit, broken, open_share, inside, closed, ends) of each text that ends open in an unknown last line."""
    spark = df.sparkSession
    texts = df.where(F.col(text).isNotNull()).select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"), F.xxhash64(F.coalesce(F.col(url).cast("string"), F.lit(""))).alias("u"), (F.lower(F.split_part(F.col(source).cast("string"), F.lit("."), F.lit(1))) if source else F.lit("")).alias("site"), (F.col(declared) if declared else F.lit(None)).cast("bigint").alias("declared"))
    built = staged(built_lines(texts).select("u", "last", "open", F.xxhash64("form").alias("form"), "build", "id", "bare"), "lines-built")
    # builds of lines that a further line follows: a few thousand
    builds = spark.sql("SELECT build, count_if(open) AS n_open, count(*) AS n_build FROM {b} WHERE NOT last GROUP BY build", b=built)
    # last lines that are whole lines elsewhere
    known = spark.sql("SELECT form FROM {b} WHERE NOT last GROUP BY form HAVING count(DISTINCT u) >= 3", b=built)
    unknown = staged(
        spark.sql(
            "SELECT id, build, bare, w[size(w) - 1] AS word, CASE WHEN size(w) >= 3 THEN xxhash64(w[size(w) - 3], w[size(w) - 2]) END AS g FROM (SELECT *, " + _TOKENS.format(text="concat('\\n', bare)") + " AS w FROM {b} LEFT ANTI JOIN {k} USING (form) WHERE last)",
            b=built, k=known,
        ),
        "unknown-ends",
    )
    few = unknown.count() <= MAX_BROADCAST
    starts = spark.sql("SELECT DISTINCT g FROM {u} WHERE g IS NOT NULL", u=unknown)
    last_words = spark.sql("SELECT DISTINCT word FROM {u}", u=unknown)
    grams = spark.sql(
        "SELECT xxhash64(x.w, x.w2) AS h, x.w3 AS c, CASE x.w4 WHEN '.' THEN 1 WHEN '\\n' THEN 2 ELSE 0 END AS ended FROM (SELECT explode(arrays_zip(w, w2, w3, w4)) AS x FROM (SELECT w, slice(w, 2, size(w)) AS w2, slice(w, 3, size(w)) AS w3, slice(w, 4, size(w)) AS w4 FROM (SELECT " + _TOKENS.format(text="text") + " AS w FROM {t}))) WHERE x.w3 NOT IN ('.', '\\n') AND x.w4 IS NOT NULL",
        t=texts,
    )
    if few:
        grams = spark.sql("SELECT g AS h, coalesce(word, c) AS c, word IS NOT NULL AS asked, ended FROM {x} x LEFT JOIN {f} f ON x.h = f.g LEFT JOIN {r} r ON x.c = r.word WHERE g IS NOT NULL OR word IS NOT NULL", x=grams, f=F.broadcast(starts), r=F.broadcast(last_words))
    else:
        grams = spark.sql("SELECT h, c, true AS asked, ended FROM {x}", x=grams)
    hits = staged(spark.sql("SELECT h, c, asked, count_if(ended = 0) AS inside, count_if(ended = 1) AS closed, count_if(ended = 2) AS ends FROM {x} GROUP BY h, c, asked", x=grams), "gram-counts")
    # third words by their beginnings: a longer word than the final one speaks for inside
    begun = spark.sql(
        "SELECT g, p AS word, sum(CASE WHEN p = c THEN inside ELSE inside + closed + ends END) AS inside, sum(CASE WHEN p = c THEN closed ELSE 0 END) AS closed, sum(CASE WHEN p = c THEN ends ELSE 0 END) AS ends FROM (SELECT h AS g, c, inside, closed, ends, explode(transform(sequence(1, length(c)), i -> left(c, i))) AS p FROM {h} LEFT SEMI JOIN {f} f ON h = f.g) GROUP BY g, p",
        h=hits, f=starts,
    )
    counts = spark.sql("SELECT * FROM {b} LEFT SEMI JOIN (SELECT g AS g2, word AS word2 FROM {u}) ON g = g2 AND word = word2", b=begun, u=unknown)
    common = spark.sql("SELECT c AS word FROM {h} WHERE asked GROUP BY c HAVING sum(inside + closed + ends) >= 3", h=hits)
    sizes = spark.sql("SELECT id, length(text) AS chars, octet_length(text) AS bytes, declared, xxhash64(text) AS h FROM {t}", t=texts)
    limits = None
    for unit in ("chars", "bytes"):
        many = spark.sql(f"SELECT {unit} AS n, count(DISTINCT h) AS c FROM {{z}} GROUP BY {unit}", z=sizes)
        near = spark.sql("SELECT n + d AS n, sum(c) / 10 AS around FROM (SELECT n, c, explode(array(-5, -4, -3, -2, -1, 1, 2, 3, 4, 5)) AS d FROM {m}) GROUP BY n + d", m=many)
        found = spark.sql(f"SELECT n, '{unit}' AS unit FROM {{m}} LEFT JOIN {{r}} USING (n) WHERE c >= {LIMIT_TEXTS} AND c >= {LIMIT_RATIO} * coalesce(around, 0)", m=many, r=near)
        limits = found if limits is None else limits.unionByName(found)
    return spark.sql(
        f"""
        SELECT id AS {key}, coalesce(by_trigram OR limit_hit OR broken OR thin AND (open_share < 0.25 OR lower_end AND NOT common), false) AS cut,
               by_trigram, limit_hit AS limit, broken, open_share, inside, closed, ends
        FROM (SELECT *, NOT thin AND ends <= {RARE_END} * (inside + closed + ends) AND open_share < CASE WHEN ends = 0 AND inside >= 30 THEN 0.99 WHEN ends = 0 AND inside >= 10 THEN 0.9 ELSE 0.6 END AS by_trigram
              FROM (SELECT u.id, u.lower_end, coalesce(c.inside, 0) AS inside, coalesce(c.closed, 0) AS closed, coalesce(c.ends, 0) AS ends, coalesce(c.inside + c.closed + c.ends, 0) < {THIN} AS thin, r.word IS NOT NULL AS common,
                           (coalesce(b.n_open, 0) + 0.2) / (coalesce(b.n_build, 0) + 1) AS open_share,
                           l1.n IS NOT NULL OR l2.n IS NOT NULL AS limit_hit, coalesce(z.declared > z.chars, false) AS broken
                    FROM {{u}} u JOIN {{z}} z ON u.id = z.id
                    LEFT JOIN {{c}} c ON u.g = c.g AND u.word = c.word LEFT JOIN {{b}} b ON u.build = b.build LEFT JOIN {{r}} r ON u.word = r.word
                    LEFT JOIN {{l}} l1 ON z.chars = l1.n AND l1.unit = 'chars' LEFT JOIN {{l}} l2 ON z.bytes = l2.n AND l2.unit = 'bytes'))""",
        u=unknown.withColumn("lower_end", F.col("bare").rlike(r"\s\p{Ll}+$")), z=sizes, c=counts, b=builds, r=common, l=staged(limits, "limits"),
    )


def source_rates(df: DataFrame, key: str, source: str, text: str, cut: DataFrame) -> DataFrame:
    """(source, n_texts, n_cut, cut_share) of each source; ``cut`` has the keys of cut texts."""
    joined = df.where(F.col(text).isNotNull() & F.col(source).isNotNull()).select(key, source).join(cut.select(key).distinct().withColumn("_cut", F.lit(1)), key, "left")
    return joined.groupBy(source).agg(F.count(F.lit(1)).alias("n_texts"), F.count("_cut").alias("n_cut")).withColumn("cut_share", F.col("n_cut") / F.col("n_texts"))
