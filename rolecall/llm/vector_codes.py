"""Product codes of vectors: integer k-means per part, with memoised grid cells.

A vector is cut into equal parts, and each part is coded by the nearest entry of its
position's codebook. Parts are hashed by their coarse cell, a box of the integer grid.
For each cell, the entries that no other entry dominates over the whole box are
remembered: those whose least distance to the box is at most the smallest of the
entries' greatest distances. Only these are evaluated exactly, so codes are those of
a full search. All numbers are 64-bit integers: results do not depend on the order of
rows or on how they are dealt to tasks.
"""

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rolecall.llm import wordbytes
from rolecall.sources.sinks import stage

#: Remembered cells of one codebook in one task; beyond that the memory starts anew.
CELLS = 1 << 15
_HEX = np.array([list(b"%02x" % i) for i in range(256)], np.uint8)


class Cells:
    """The entries of one codebook that may be the nearest, by coarse cell."""

    def __init__(self, entries: np.ndarray, cell_bits: int):
        self.entries, self.bits = entries, cell_bits
        self.factors = np.array([pow(0x9E3779B97F4A7C15, 2 * j + 1, 1 << 64) for j in range(entries.shape[1])], np.uint64)
        self.keys = np.zeros(0, np.uint64)
        self.cells = np.zeros((0, entries.shape[1]), np.int64)
        self.open = np.zeros((0, len(entries)), bool)

    def undominated(self, cells: np.ndarray) -> np.ndarray:
        """(cell, entry): whether some point of the box may be nearest to the entry. An
        entry at the same distance as a better one stays, so ties are decided exactly."""
        low = (cells << self.bits)[:, None, :]
        high = low + ((1 << self.bits) - 1)
        below, above = low - self.entries, self.entries - high
        least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(2)
        most = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(2)
        return least <= most.min(1, keepdims=True)

    def candidates(self, parts: np.ndarray) -> np.ndarray:
        """(part, entry): the entries to evaluate for each part."""
        cells = parts >> self.bits
        keys = wordbytes.mix((cells.astype(np.uint64) * self.factors).sum(1, dtype=np.uint64))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1) if len(self.keys) else np.zeros(len(keys), np.int64)
        known = (self.keys[at] == keys) & (self.cells[at] == cells).all(1) if len(self.keys) else np.zeros(len(keys), bool)
        out = np.empty((len(parts), len(self.entries)), bool)
        out[known] = self.open[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            _, first, of = np.unique(keys[new], return_index=True, return_inverse=True)
            fresh = self.undominated(cells[new[first]])
            same = (cells[new[first]][of] == cells[new]).all(1)
            out[new[same]] = fresh[of[same]]
            if not same.all():  # cells of one hash: the others are not remembered
                out[new[~same]] = self.undominated(cells[new[~same]])
            self._remember(keys[new[first]], cells[new[first]], fresh)
        return out

    def _remember(self, keys: np.ndarray, cells: np.ndarray, open_: np.ndarray) -> None:
        if len(self.keys) + len(keys) > CELLS:
            self.keys, self.cells, self.open = self.keys[:0], self.cells[:0], self.open[:0]
        keys, cells, open_ = keys[:CELLS], cells[:CELLS], open_[:CELLS]
        place = np.searchsorted(self.keys, keys)
        taken = place < len(self.keys)
        taken[taken] = self.keys[place[taken]] == keys[taken]
        keys, cells, open_ = (np.concatenate([a, b[~taken]]) for a, b in ((self.keys, keys), (self.cells, cells), (self.open, open_)))
        order = np.argsort(keys)
        self.keys, self.cells, self.open = keys[order], cells[order], open_[order]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each part (ties: the lower index) and its squared distance."""
        row, entry = np.nonzero(self.candidates(parts))
        distance = ((parts[row] - self.entries[entry]) ** 2).sum(1)
        many = np.bincount(row, minlength=len(parts))
        first = np.cumsum(many) - many
        best = np.minimum.reduceat(distance, first) if len(parts) else np.zeros(0, np.int64)
        hit = np.flatnonzero(distance == np.repeat(best, many))
        _, lowest = np.unique(row[hit], return_index=True)
        return entry[hit[lowest]], best


def _matrices(column: pa.Array, parts: int, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of a list column as (first row, integers of shape (rows, parts, size))."""
    values = np.asarray(column.flatten(), np.int64).reshape(len(column), parts, size)
    for first in range(0, len(column), 8192):
        yield first, values[first : first + 8192]


def _sums(vectors: DataFrame, books: np.ndarray, cell_bits: int) -> np.ndarray:
    """(part, entry, place or count): sums and numbers of the parts assigned to each entry."""
    parts, entries, size = books.shape

    def assign(arrow):
        cells = [Cells(books[p], cell_bits) for p in range(parts)]
        total = np.zeros((parts, entries, size + 1), np.int64)
        for batch in arrow:
            for _, rows in _matrices(batch["v"], parts, size):
                for p in range(parts):
                    code, _ = cells[p].nearest(rows[:, p])
                    order = np.argsort(code, kind="stable")
                    used, first = np.unique(code[order], return_index=True)
                    if len(used):
                        total[p, used, :size] += np.add.reduceat(rows[order, p], first, axis=0)
                        total[p, :, size] += np.bincount(code, minlength=entries)
        p, e, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(j, pa.int32()), pa.array(total[p, e, j])], ["p", "e", "j", "total"]
        )

    rows = vectors.select("v").mapInArrow(assign, "p int, e int, j int, total bigint")
    out = np.zeros((parts, entries, size + 1), np.int64)
    for row in rows.groupBy("p", "e", "j").agg(F.sum("total").alias("total")).collect():  # as many as the codebooks have numbers
        out[row["p"], row["e"], row["j"]] = row["total"]
    return out


def train(vectors: DataFrame, parts: int, size: int, entries: int, rounds: int, cell_bits: int) -> np.ndarray:
    """Codebooks (part, entry, place) after ``rounds`` rounds over all rows of ``vectors``
    (id, v), starting from the ``entries`` smallest ids (fewer rows: fewer entries)."""
    seeds = vectors.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    books = np.array([r["v"] for r in seeds], np.int64).reshape(len(seeds), parts, size).transpose(1, 0, 2).copy()
    for _ in range(rounds if len(seeds) else 0):
        sums = _sums(vectors, books, cell_bits)
        used = sums[:, :, size] > 0
        books[used] = sums[used][:, :size] // sums[used][:, size:]
    return books


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(vectors: DataFrame, books: np.ndarray, cell_bits: int) -> DataFrame:
    """(id, label, code, error) of every row of ``vectors`` (id, label, v); a null ``v``
    has a null code and error."""
    parts, entries, size = books.shape
    label = vectors.schema["label"].dataType.simpleString()

    def code(arrow):
        cells = [Cells(books[p], cell_bits) for p in range(parts)]
        for batch in arrow:
            has = batch["v"].is_valid()
            codes, errors = [], []
            for _, rows in _matrices(batch["v"].filter(has), parts, size):
                found = [cells[p].nearest(rows[:, p]) for p in range(parts)]
                codes.append(_HEX[np.stack([c for c, _ in found], 1)].reshape(len(rows), -1))
                errors.append(sum(d for _, d in found))
            text = np.concatenate(codes) if codes else np.zeros((0, 2 * parts), np.uint8)
            error = np.concatenate(errors) if errors else np.zeros(0, np.int64)
            strings = pa.Array.from_buffers(
                pa.string(), len(text), [None, pa.py_buffer(np.arange(len(text) + 1, dtype=np.int32) * (2 * parts)), pa.py_buffer(np.ascontiguousarray(text))]
            )
            # rows without a code take a null from the place that does not exist
            flags = np.asarray(has)
            place = pa.array(np.cumsum(flags) - 1, mask=~flags)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["label"], strings.take(place), pa.array(error).take(place)], ["id", "label", "code", "error"]
            )

    return vectors.select("id", "label", "v").mapInArrow(code, f"id bigint, label {label}, code string, error bigint")


def vector_codes(
    df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 8, entries: int = 16,
    rounds: int = 6, scale: int = 4096, cell_bits: int = 7,
) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of every usable vector.

    Rows whose vector is null or holds a null or non-finite component are dropped. A
    component x is the integer floor(scale * x). ``code`` has two hex digits a part
    (at most 256 entries), ``error`` is the squared distance to the coded entries,
    ``label_error`` its sum over rows of the same label, nulls together. Repeated rows
    and ids are rows of their own, a null id comes after all others; other columns are
    left out. Vectors that cannot be cut like most others (the most frequent length
    that ``parts`` divides; ties: the shorter) or whose distances do not fit 64 bits
    have a null code and error and take no part in training; an empty table gives an
    empty result.

    The integers are written once; each round reads them once and shuffles at most one
    number per codebook number and task. A label's rows are never gathered.
    """
    if not 0 < entries <= 256 or parts < 1:
        raise ValueError("1 to 256 entries, and at least one part")
    usable = F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.where(F.coalesce(usable, F.lit(False))).select(
        F.col(id_column).cast("bigint").alias("id"), F.col(label).alias("label"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("v"),
    )
    rows = stage(rows, "vectors")
    lengths = rows.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n")).where(f"size > 0 and size % {parts} = 0")
    most = lengths.orderBy(F.desc("n"), "size").first()
    size = most["size"] // parts if most else 1
    limit = math.isqrt(((1 << 63) - 1) // (size * parts)) // 2
    fits = (F.size("v") == size * parts) & F.forall("v", lambda x: x.between(-limit, limit))
    vectors = rows.withColumn("v", F.when(fits, F.col("v")))
    books = train(vectors.where("v is not null"), parts, size, entries, rounds, cell_bits)
    coded = stage(encode(vectors, books, cell_bits), "codes")
    # stored, so that the join may split a label that very many rows share
    by_label = stage(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label"), "label-errors")
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("_label")), "left")
    return joined.select(
        F.col("id").alias(id_column), "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )
