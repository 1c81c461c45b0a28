"""Nearest neighbours among fixed, small sets: named colours and language profiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wrackline.functions import text

#: The colour names of the SVG standard with red, green and blue, in the standard's order.
COLOURS = """
aliceblue 240 248 255, antiquewhite 250 235 215, aqua 0 255 255, aquamarine 127 255 212, azure 240 255 255, beige 245 245 220,
bisque 255 228 196, black 0 0 0, blanchedalmond 255 235 205, blue 0 0 255, blueviolet 138 43 226, brown 165 42 42,
burlywood 222 184 135, cadetblue 95 158 160, chartreuse 127 255 0, chocolate 210 105 30, coral 255 127 80, cornflowerblue 100 149 237,
cornsilk 255 248 220, crimson 220 20 60, cyan 0 255 255, darkblue 0 0 139, darkcyan 0 139 139, darkgoldenrod 184 134 11,
darkgray 169 169 169, darkgreen 0 100 0, darkgrey 169 169 169, darkkhaki 189 183 107, darkmagenta 139 0 139, darkolivegreen 85 107 47,
darkorange 255 140 0, darkorchid 153 50 204, darkred 139 0 0, darksalmon 233 150 122, darkseagreen 143 188 143, darkslateblue 72 61 139,
darkslategray 47 79 79, darkslategrey 47 79 79, darkturquoise 0 206 209, darkviolet 148 0 211, deeppink 255 20 147, deepskyblue 0 191 255,
dimgray 105 105 105, dimgrey 105 105 105, dodgerblue 30 144 255, firebrick 178 34 34, floralwhite 255 250 240, forestgreen 34 139 34,
fuchsia 255 0 255, gainsboro 220 220 220, ghostwhite 248 248 255, gold 255 215 0, goldenrod 218 165 32, gray 128 128 128,
grey 128 128 128, green 0 128 0, greenyellow 173 255 47, honeydew 240 255 240, hotpink 255 105 180, indianred 205 92 92,
indigo 75 0 130, ivory 255 255 240, khaki 240 230 140, lavender 230 230 250, lavenderblush 255 240 245, lawngreen 124 252 0,
lemonchiffon 255 250 205, lightblue 173 216 230, lightcoral 240 128 128, lightcyan 224 255 255, lightgoldenrodyellow 250 250 210, lightgray 211 211 211,
lightgreen 144 238 144, lightgrey 211 211 211, lightpink 255 182 193, lightsalmon 255 160 122, lightseagreen 32 178 170, lightskyblue 135 206 250,
lightslategray 119 136 153, lightslategrey 119 136 153, lightsteelblue 176 196 222, lightyellow 255 255 224, lime 0 255 0, limegreen 50 205 50,
linen 250 240 230, magenta 255 0 255, maroon 128 0 0, mediumaquamarine 102 205 170, mediumblue 0 0 205, mediumorchid 186 85 211,
mediumpurple 147 112 219, mediumseagreen 60 179 113, mediumslateblue 123 104 238, mediumspringgreen 0 250 154, mediumturquoise 72 209 204, mediumvioletred 199 21 133,
midnightblue 25 25 112, mintcream 245 255 250, mistyrose 255 228 225, moccasin 255 228 181, navajowhite 255 222 173, navy 0 0 128,
oldlace 253 245 230, olive 128 128 0, olivedrab 107 142 35, orange 255 165 0, orangered 255 69 0, orchid 218 112 214,
palegoldenrod 238 232 170, palegreen 152 251 152, paleturquoise 175 238 238, palevioletred 219 112 147, papayawhip 255 239 213, peachpuff 255 218 185,
peru 205 133 63, pink 255 192 203, plum 221 160 221, powderblue 176 224 230, purple 128 0 128, red 255 0 0,
rosybrown 188 143 143, royalblue 65 105 225, saddlebrown 139 69 19, salmon 250 128 114, sandybrown 244 164 96, seagreen 46 139 87,
seashell 255 245 238, sienna 160 82 45, silver 192 192 192, skyblue 135 206 235, slateblue 106 90 205, slategray 112 128 144,
slategrey 112 128 144, snow 255 250 250, springgreen 0 255 127, steelblue 70 130 180, tan 210 180 140, teal 0 128 128,
thistle 216 191 216, tomato 255 99 71, turquoise 64 224 208, violet 238 130 238, wheat 245 222 179, white 255 255 255,
whitesmoke 245 245 245, yellow 255 255 0, yellowgreen 154 205 50
"""


def palette() -> list[tuple[str, int, int, int]]:
    return [(n, int(r), int(g), int(b)) for n, r, g, b in (entry.split() for entry in COLOURS.replace("\n", " ").split(","))]


def nearest_colour(red: Column, green: Column, blue: Column) -> Column:
    """The named colour with the least sum of differences, the first on ties; an expression over a fixed palette, no join."""
    entries = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(r).alias("r"), F.lit(g).alias("g"), F.lit(b).alias("b")) for n, r, g, b in palette()])
    scored = F.transform(entries, lambda c, i: F.struct((F.abs(red - c["r"]) + F.abs(green - c["g"]) + F.abs(blue - c["b"])).alias("d"), i.alias("i"), c["name"].alias("name")))
    return F.when(red.isNotNull() & green.isNotNull() & blue.isNotNull(), F.array_min(scored)["name"])


def profiles(samples: DataFrame, lang: str = "lang", sample: str = "text") -> DataFrame:
    """(lang, gram, share): letter trigram shares of each language."""
    grams = samples.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.explode(text.letter_trigrams(F.col(sample))).alias("gram"))
    counted = grams.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("n"))
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    return counted.join(totals, "lang").select("lang", "gram", (F.col("n") / F.col("total")).alias("share"))


def nearest_profile(df: DataFrame, key: str, column: str, known: DataFrame, certain: float = 0.022, max_rows: int = 2_000_000) -> DataFrame:
    """(key, lang, distance, certain): the language whose trigram profile is nearest (Euclid), the first on ties; texts without letters give no row.

    The profiles (languages x trigrams of a small table of samples; more than
    ``max_rows`` rows are an error) are broadcast as one matrix, and each text is
    counted and compared within its task, without a shuffle.
    """
    rows = known.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"profiles of more than {max_rows} rows")
    langs = sorted({r["lang"] for r in rows})
    grams = sorted({r["gram"] for r in rows if len(r["gram"]) == 3})
    codes = np.array([_gram_code(g) for g in grams], dtype=np.uint64)
    order = np.argsort(codes)
    at = {grams[k]: i for i, k in enumerate(order.tolist())}
    matrix = np.zeros((len(grams) + 1, len(langs)))
    for r in rows:
        if r["gram"] in at:
            matrix[at[r["gram"]], langs.index(r["lang"])] = r["share"]
    shared = df.sparkSession.sparkContext.broadcast((codes[order], matrix, langs))
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), *T.StructType.fromDDL("lang STRING, distance DOUBLE, certain BOOLEAN").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, matrix, langs = shared.value
        norm = (matrix * matrix).sum(axis=0)
        for batch in batches:
            spaced = pc.replace_substring_regex(pc.utf8_lower(batch.column(1)), r"[^\pL]+", "_").to_pylist()
            rows, best, far = [], [], []
            for k, text_ in enumerate(spaced):
                body = text_.strip("_")
                if not body or not langs:
                    continue
                c = np.frombuffer(f"_{body}_".encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
                found, n = np.unique(c[:-2] << np.uint64(42) | c[1:-1] << np.uint64(21) | c[2:], return_counts=True)
                where = np.minimum(np.searchsorted(codes, found), max(0, len(codes) - 1))
                where = np.where(codes[where] == found, where, len(codes)) if len(codes) else np.zeros(len(found), dtype=int)
                total = n.sum()
                distance = np.sqrt(np.maximum(0.0, (n * n).sum() / (total * total) + norm - 2 * (n @ matrix[where]) / total))
                rows.append(k), best.append(langs[int(distance.argmin())]), far.append(float(distance.min()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, type=pa.int64())), pa.array(best, type=pa.string()), pa.array(far, type=pa.float64()), pa.array([d < certain for d in far], type=pa.bool_())], names=schema.names)

    return df.where(F.col(column).isNotNull()).select(F.col(key), F.col(column).cast("string").alias("_text")).mapInArrow(run, schema)


def _gram_code(gram: str) -> int:
    a, b, c = map(ord, gram)
    return a << 42 | b << 21 | c
