"""Exact removal of repeated passages: hashed units, earliest occurrence kept.

A unit is a sentence of a line: texts are cut after \\n, after . ! ? that a blank
follows, and after the sentence signs of other scripts, so a passage is found wherever
it stands in a line, with or without spaces. Units are normalised (ASCII lower case,
words without the white space between them) and grouped by a 128-bit digest over the
whole table. Of each group the first occurrence by (id, row, offset) stays; all later
ones go.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from rolecall.llm import wordbytes
from rolecall.sources.sinks import stage

#: Signs that end a sentence before a blank, and those that end it anywhere.
SIGNS = ".!?"
SIGNS_ANYWHERE = "。！？｡．؟۔।॥።။។"

_SIGN = np.array([chr(b) in SIGNS for b in range(256)])


def _cuts(part: np.ndarray) -> np.ndarray:
    """Mask of the bytes after which a unit ends, up to the blanks that follow."""
    after = part == 10
    after[1:] |= wordbytes.SPACE[part[1:]] & _SIGN[part[:-1]]
    for sign in SIGNS_ANYWHERE:
        code = sign.encode()
        n = len(code)
        if n <= len(part):
            here = np.ones(len(part) - n + 1, bool)
            for k, byte in enumerate(code):
                here &= part[k : len(part) - n + 1 + k] == byte
            after[n - 1 :] |= here
    return after


def text_units(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, row, unit, start, end, d1, d2) of every unit with a word; offsets in code points,
    end exclusive; start and end take the white space between units along. ``row`` tells
    rows apart that share an id; it is a number of this run, so store the result."""

    def cut(arrow):
        for batch in arrow:
            data, offsets = wordbytes.utf8(batch["text"])
            for first, last in wordbytes.steps(offsets):
                part, of = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
                begin = np.unique(np.concatenate([of[:-1][of[:-1] < of[1:]], np.flatnonzero(_cuts(part)) + 1]))
                begin = begin[begin < len(part)]
                end = np.append(begin[1:], len(part))
                row = np.searchsorted(of, begin, "right") - 1
                # a text's last unit ends with the text
                end = np.minimum(end, of[row + 1])
                # units that begin within a run of other bytes than blanks begin a word there
                starts = np.zeros(len(part), bool)
                starts[begin[begin > 0]] = ~wordbytes.SPACE[part[begin[begin > 0]]] & ~wordbytes.SPACE[part[begin[begin > 0] - 1]]
                words = wordbytes.find_words(wordbytes.LOWER[part], of, cut=starts)
                hashes = wordbytes.hash_words(wordbytes.LOWER[part], words)
                a, b = np.searchsorted(words.start, begin), np.searchsorted(words.start, end)
                digests = [_digest(hashes, a, b, base) for base in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)]
                points = np.concatenate([[0], np.cumsum(part & 0xC0 != 0x80)])
                has = np.flatnonzero(b > a)
                at = row[has]
                number = np.arange(len(at)) - np.searchsorted(at, at)
                take = pa.array(first + at)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["id"].take(take), batch["row"].take(take), pa.array(number, pa.int32()),
                        pa.array(points[begin[has]] - points[of[at]], pa.int32()), pa.array(points[end[has]] - points[of[at]], pa.int32()),
                        *[pa.array(d[has].view(np.int64)) for d in digests],
                    ],
                    ["id", "row", "unit", "start", "end", "d1", "d2"],
                )

    source = df.select(F.col(id_column).cast("bigint").alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    return source.mapInArrow(cut, "id bigint, row bigint, unit int, start int, end int, d1 bigint, d2 bigint")


def _digest(hashes: np.ndarray, a: np.ndarray, b: np.ndarray, base: int) -> np.ndarray:
    """Hash of the words a..b in order."""
    up, down = wordbytes.powers(base, len(hashes))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(wordbytes.mix(hashes ^ np.uint64(base)) * up[:-1], out=sums[1:])
    return wordbytes.mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))


def repeated_units(df: DataFrame, id_column: str = "doc_id", text: str = "text", least_chars: int = 0) -> DataFrame:
    """(id, start, end, kept_id, kept_start) of every unit to remove: each later occurrence
    of a unit, in the text's own offsets.

    Rows are told apart even where ids repeat or are null; occurrences are ranked by id
    (null ids last), row and offset, so of exact copies one stays whole. Null, empty and
    blank texts have no units; an empty table gives an empty result. With
    ``least_chars`` only those go that stand, next to each other in their text, in runs of so
    many characters: short phrases that texts share by chance stay.

    Units are written once. Digests are counted map-side, and their groups are stored
    before the join back, so a digest that very many units share can be split among tasks;
    no task holds a group. What is gathered are the units of one row.
    """
    units = stage(text_units(df, id_column, text), "units")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "row", "start")
    groups = units.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n"), F.min(rank).alias("kept")).where("n > 1")
    groups = stage(groups.select("d1", "d2", F.col("kept.id").alias("kept_id"), F.col("kept.row").alias("kept_row"), F.col("kept.start").alias("kept_start")), "repeated")
    later = units.join(groups, ["d1", "d2"]).where((F.col("row") != F.col("kept_row")) | (F.col("start") != F.col("kept_start")))
    if least_chars > 0:
        of_row = Window.partitionBy("row").orderBy("unit")
        run = later.withColumn("run", F.col("unit") - F.row_number().over(of_row))
        size = F.sum(F.col("end") - F.col("start")).over(Window.partitionBy("row", "run"))
        later = run.withColumn("size", size).where(F.col("size") >= least_chars)
    return later.select(F.col("id").alias(id_column), "start", "end", "kept_id", "kept_start")


def remove_units(df: DataFrame, removed: DataFrame, id_column: str = "doc_id", text: str = "text", spans: str = "removed") -> DataFrame:
    """``df`` with the removed units cut out of ``text``, and their offsets in the original
    as ``spans`` (array<struct<start, end>>; empty where nothing was removed; a column of
    that name is replaced). Ids tell the rows apart here, so they must be unique."""
    key, found = "id_of_removed", "spans_of_row"
    while key in df.columns or found in df.columns:
        key, found = f"{key}_", f"{found}_"
    own = removed.groupBy(F.col(id_column).alias(key)).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias(found))
    joined = df.drop(spans).join(own, F.col(id_column).eqNullSafe(F.col(key)), "left").drop(key)
    cut = F.coalesce(found, F.array().cast("array<struct<start:int,end:int>>"))
    rest = F.aggregate(
        cut, F.struct(F.lit("").alias("t"), F.lit(0).alias("at")),
        lambda a, s: F.struct(F.concat(a["t"], F.col(text).substr(a["at"] + 1, s["start"] - a["at"])).alias("t"), s["end"].alias("at")),
        lambda a: F.concat(a["t"], F.col(text).substr(a["at"] + 1, F.length(text))),
    )
    return joined.withColumn(text, F.when(F.size(cut) > 0, rest).otherwise(F.col(text))).withColumn(spans, cut).drop(found)
