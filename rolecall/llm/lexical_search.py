"""Ranked lexical search: sharded inverted index, Block-Max MaxScore, merged heaps.

A shard is one row of a table: the postings of some documents in blocks that are
packed on their own, with the last document and the greatest impact of each block and
the greatest impact of each list beside them. Global bounds split a query's lists: those
whose bounds together cannot reach the worst score of the heap are non-essential. The
essential lists give the candidates; on the others the block maxima reject candidates
before a block is unpacked. A task carries its heaps from shard to shard, and the heaps
of all tasks are merged. Impacts and weights are integers, so results are exact. Terms
are compared as 64-bit hashes.
"""

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from rolecall.llm import sketches, wordbytes
from rolecall.sources.sinks import stage

#: What parts terms: every ASCII character but letters and digits.
BREAK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
BLOCK = 64  # postings of a block
WINDOW = 8192  # documents between two looks at the bounds

_ARRAYS = {  # binary columns of a shard
    "terms": np.uint64, "df": np.int32, "top": np.int32, "first_block": np.int32, "last": np.int32, "most": np.int32,
    "width": np.uint8, "at": np.int64, "packed": np.uint8,
}
_SCHEMA = "ids array<bigint>, " + ", ".join(f"{name} binary" for name in _ARRAYS)


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, wordbytes.Words]:
    data = wordbytes.LOWER[data]
    words = wordbytes.find_words(data, offsets, BREAK)
    return wordbytes.hash_words(data, words), words


def _spans(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... first[i] + many[i] - 1, for each i in turn."""
    ends = np.cumsum(many)
    return np.repeat(first - (ends - many), many) + np.arange(ends[-1] if len(ends) else 0)


def corpus_size(df: DataFrame, text: str = "text") -> tuple[int, int]:
    """(documents with a term, all terms with their repeats)."""

    def count(arrow):
        for batch in arrow:
            data, offsets = wordbytes.utf8(batch[0])
            for first, last in wordbytes.steps(offsets):
                words = wordbytes.find_words(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], BREAK)
                many = np.diff(words.first)
                yield pa.RecordBatch.from_arrays([pa.array([int((many > 0).sum())]), pa.array([int(many.sum())])], ["n", "l"])

    row = df.select(text).mapInArrow(count, "n bigint, l bigint").agg(F.sum("n").alias("n"), F.sum("l").alias("l")).first()
    return row["n"] or 0, row["l"] or 0


@dataclass
class Shard:
    ids: pa.Array
    terms: np.ndarray  # sorted hashes
    df: np.ndarray  # documents of each term
    top: np.ndarray  # greatest impact of each term
    first_block: np.ndarray  # of each term, and the end
    last: np.ndarray  # last document of each block
    most: np.ndarray  # greatest impact of each block
    width: np.ndarray  # bytes of a gap in each block
    at: np.ndarray  # first byte of each block, and the end
    packed: np.ndarray  # of each block its gaps, then its impacts of three bytes

    @staticmethod
    def of(ids: pa.Array, length: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, size: tuple[int, int]) -> "Shard":
        """The index of postings (doc, term, tf); ``size`` is the corpus's."""
        order = np.lexsort([doc, term])
        doc, term, tf = doc[order], term[order], tf[order]
        begins = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, np.int64)
        df = np.diff(np.append(begins, len(term)))
        n, total = size
        if len(length) and 90 * int(length.max()) * n >= 1 << 63:
            m = np.array([10 + 90 * int(x) * n // total for x in length], np.int64)
        else:
            m = 10 + 90 * length * n // max(total, 1)
        impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[doc]) if len(doc) else np.zeros(0, np.int64)
        blocks = -(-df // BLOCK)
        first_block = np.concatenate([[0], np.cumsum(blocks)])
        number = np.arange(first_block[-1]) - np.repeat(first_block[:-1], blocks)
        start = np.repeat(begins, blocks) + number * BLOCK
        many = np.diff(np.append(start, len(doc)))
        before = np.concatenate([[-1], doc[:-1]]) if len(doc) else doc
        before[begins] = -1
        gap = doc - before
        most = np.maximum.reduceat(impact, start) if len(start) else impact
        wide = np.maximum.reduceat(gap, start) if len(start) else gap
        width = (1 + (wide >= 1 << 8) + (wide >= 1 << 16) + (wide >= 1 << 24)).astype(np.uint8)
        at = np.concatenate([[0], np.cumsum(many * (width + 3))])
        packed = np.zeros(at[-1], np.uint8)
        inside = np.arange(len(doc)) - np.repeat(start, many)
        of_gap = np.repeat(at[:-1], many) + inside * np.repeat(width, many)
        for byte in range(4):
            has = np.repeat(width, many) > byte
            packed[of_gap[has] + byte] = (gap[has] >> (8 * byte)) & 255
        of_impact = np.repeat(at[:-1] + many * width, many) + 3 * inside
        for byte in range(3):
            packed[of_impact + byte] = (impact >> (8 * byte)) & 255
        top = np.maximum.reduceat(impact, begins) if len(begins) else impact
        return Shard(ids, term[begins], df, top, first_block, doc[start + many - 1], most, width, at, packed)

    def row(self) -> pa.RecordBatch:
        arrays = [pa.array([np.ascontiguousarray(getattr(self, name), kind).tobytes()], pa.binary()) for name, kind in _ARRAYS.items()]
        ids = pa.ListArray.from_arrays(pa.array([0, len(self.ids)], pa.int32()), self.ids)
        return pa.RecordBatch.from_arrays([ids, *arrays], ["ids", *_ARRAYS])

    @staticmethod
    def read(batch: pa.RecordBatch, i: int) -> "Shard":
        arrays = {name: np.frombuffer(batch[name][i].as_buffer(), kind) for name, kind in _ARRAYS.items()}
        return Shard(batch["ids"][i].values, **arrays)

    def unpack(self, blocks: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of some blocks; ``begin`` is the document before each."""
        width = self.width[blocks].astype(np.int64)
        at = self.at[blocks]
        many = (self.at[blocks + 1] - at) // (width + 3)
        ends = np.cumsum(many)
        inside = np.arange(ends[-1]) - np.repeat(ends - many, many)
        wide = np.repeat(width, many)
        place = np.repeat(at, many) + inside * wide
        gap = self.packed[place].astype(np.int64)
        for byte in range(1, int(width.max())):
            has = wide > byte
            gap[has] += self.packed[place[has] + byte].astype(np.int64) << (8 * byte)
        running = np.cumsum(gap)
        before = np.concatenate([[0], running])[ends - many]
        doc = running - np.repeat(before - begin, many)
        place = np.repeat(at + many * width, many) + 3 * inside
        impact = sum(self.packed[place + byte].astype(np.int64) << (8 * byte) for byte in range(3))
        return doc, impact


def build_index(df: DataFrame, size: tuple[int, int], id_column: str = "doc_id", text: str = "text", shard_bytes: int = 1 << 23) -> DataFrame:
    """One row per shard of about ``shard_bytes`` of text (one document at least), over
    all terms of all rows. No shuffle: a shard holds documents of one task."""

    def index(arrow):
        held: dict[str, list] = {"ids": [], "length": [], "doc": [], "term": [], "tf": []}
        docs = used = 0

        def close():
            parts = [np.concatenate(held[k]) for k in ("length", "doc", "term", "tf")]
            shard = Shard.of(pa.concat_arrays(held["ids"]), *parts, size)
            for rows in held.values():
                rows.clear()
            return shard.row()

        for batch in arrow:
            data, offsets = wordbytes.utf8(batch["text"])
            for first, last in wordbytes.steps(offsets):
                hashes, words = _terms(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                order = np.lexsort([words.row, hashes])
                term, row = hashes[order], words.row[order]
                begins = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (row[1:] != row[:-1])])) if len(term) else np.zeros(0, np.int64)
                held["ids"].append(batch["id"].slice(first, last - first))
                held["length"].append(np.diff(words.first))
                held["doc"].append(docs + row[begins])
                held["term"].append(term[begins])
                held["tf"].append(np.diff(np.append(begins, len(term))))
                docs, used = docs + last - first, used + int(offsets[last] - offsets[first])
                if used >= shard_bytes:
                    yield close()
                    docs = used = 0
        if docs:
            yield close()

    rows = df.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(index, _SCHEMA)


@dataclass
class Query:
    row: int
    item_id: int | None
    terms: np.ndarray  # numbers in the block's sorted terms


class Heap:
    """The best ``k`` of a query: highest score first, then the lowest id, a null id last."""

    def __init__(self, k: int):
        self.k = k
        self.score = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)
        self.ids = np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """A document below this score is none of the best."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: pa.Array) -> None:
        score = np.concatenate([self.score, score])
        null = np.concatenate([self.null, np.asarray(ids.is_null())])
        ids = np.concatenate([self.ids, np.asarray(ids.fill_null(0), np.int64)])
        order = np.lexsort([ids, null, -score])[: self.k]
        self.score, self.null, self.ids = score[order], null[order], ids[order]


def max_score(shard: Shard, terms: np.ndarray, weights: np.ndarray, heap: Heap) -> int:
    """Adds the shard's best documents to the heap. ``terms`` are places in the shard's
    terms. Returns the number of unpacked postings blocks."""
    bound = weights * shard.top[terms]
    order = np.argsort(bound, kind="stable")
    terms, weights = terms[order], weights[order].astype(np.int64)
    below = np.concatenate([[0], np.cumsum(bound[order])])  # of all lists before
    first, end = shard.first_block[terms].astype(np.int64), shard.first_block[terms + 1].astype(np.int64)
    unpacked = 0

    def postings(j, blocks):
        nonlocal unpacked
        unpacked += len(blocks)
        return shard.unpack(blocks, np.where(blocks > first[j], shard.last[blocks - 1], -1))

    for low in range(0, len(shard.ids), WINDOW):
        high = min(low + WINDOW, len(shard.ids))
        essential = int(np.searchsorted(below[1:], heap.least))
        if essential == len(terms):  # not even all lists together reach it
            return unpacked
        score = np.zeros(high - low, np.int64)
        for j in range(essential, len(terms)):
            last = shard.last[first[j] : end[j]]
            blocks = first[j] + np.arange(np.searchsorted(last, low), min(np.searchsorted(last, high - 1) + 1, len(last)))
            if len(blocks):
                doc, impact = postings(j, blocks)
                here = (doc >= low) & (doc < high)
                score[doc[here] - low] += weights[j] * impact[here]
        doc = np.flatnonzero(score)
        score, doc = score[doc], doc + low
        for j in range(essential - 1, -1, -1):
            may = score + below[j + 1] >= heap.least
            score, doc = score[may], doc[may]
            if not len(doc):
                break
            block = first[j] + np.searchsorted(shard.last[first[j] : end[j]], doc)
            has = block < end[j]
            most = np.zeros(len(doc), np.int64)
            most[has] = weights[j] * shard.most[block[has]]
            may = score + most + below[j] >= heap.least
            score, doc, block, has = score[may], doc[may], block[may], has[may]
            blocks = np.unique(block[has])
            if len(blocks):
                of, impact = postings(j, blocks)
                place = np.minimum(np.searchsorted(of, doc), len(of) - 1)
                same = of[place] == doc
                score[same] += weights[j] * impact[place[same]]
        best = score >= heap.least
        if best.any():
            score, doc = score[best], doc[best]
            # as many as the heap holds, and what ties with the last of them
            if len(score) > heap.k:
                enough = score >= np.partition(score, len(score) - heap.k)[len(score) - heap.k]
                score, doc = score[enough], doc[enough]
            heap.add(score, shard.ids.take(pa.array(doc)))
    return unpacked


def search(index: DataFrame, size: tuple[int, int], items: DataFrame, item_id: str, text: str, k: int, block_bytes: int) -> DataFrame:
    """(item_id, rank, doc_id, score); see ``ranked_search``. ``index`` must be stored."""
    spark = index.sparkSession
    rows = items.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(text).alias("text")).withColumn("row", F.monotonically_increasing_id())
    rows = stage(rows, "items")
    blocks = 1 + (rows.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0) // block_bytes
    found = []
    for block in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).collect()  # about block_bytes
        found.append(_search_block(index, size, sorted(own, key=lambda r: r["row"]), k))
    best = Window.partitionBy("row").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    heaps = reduce(DataFrame.unionAll, found)
    return heaps.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        F.col("item_id").alias(item_id), "rank", "doc_id", "score"
    )


def _search_block(index: DataFrame, size: tuple[int, int], rows: list, k: int) -> DataFrame:
    spark = index.sparkSession
    hashes, words = _terms(*wordbytes.utf8(pa.array([r["text"] for r in rows], pa.string())))
    terms, number = np.unique(hashes, return_inverse=True)
    queries = [
        Query(r["row"], r["item_id"], np.unique(number[words.first[i] : words.first[i + 1]]))
        for i, r in enumerate(rows) if words.first[i] < words.first[i + 1]
    ]

    def count(batch, array):
        for i in range(batch.num_rows):
            own = np.frombuffer(batch["terms"][i].as_buffer(), np.uint64)
            _, mine, at = np.intersect1d(terms, own, assume_unique=True, return_indices=True)
            array[mine] += np.frombuffer(batch["df"][i].as_buffer(), np.int32)[at]

    df = sketches.add_up(index.select("terms", "df"), count, max(1, len(terms)), np.int64)[: len(terms)].tolist()
    weights = np.array([math.floor(1000 * math.log((2 * size[0] + 2) / (2 * x + 1))) for x in df], np.int64)
    shared = spark.sparkContext.broadcast((terms, weights, queries))

    def ranked(arrow):
        terms, weights, queries = shared.value
        heaps = [Heap(k) for _ in queries]
        for batch in arrow:
            for i in range(batch.num_rows):
                shard = Shard.read(batch, i)
                at = np.minimum(np.searchsorted(shard.terms, terms), max(len(shard.terms) - 1, 0))
                held = shard.terms[at] == terms if len(shard.terms) else np.zeros(len(terms), bool)
                for query, heap in zip(queries, heaps, strict=True):
                    own = query.terms[held[query.terms]]
                    if len(own):
                        max_score(shard, at[own], weights[own], heap)
        for query, heap in zip(queries, heaps, strict=True):
            if len(heap.score):
                n = len(heap.score)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([query.row] * n, pa.int64()), pa.array([query.item_id] * n, pa.int64()),
                        pa.array(heap.ids, mask=heap.null), pa.array(heap.score),
                    ],
                    ["row", "item_id", "doc_id", "score"],
                )

    return index.mapInArrow(ranked, "row bigint, item_id bigint, doc_id bigint, score bigint")


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = 10, id_column: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", shard_bytes: int = 1 << 23, block_bytes: int = 1 << 24,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of each item with the highest
    score above 0; equal scores by ascending id.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII; only
    A-Z is lower-cased. Every row of both tables counts, repeated ids and texts included;
    a null id of a document comes after all others. Null and empty texts have no terms:
    such documents are not found, such items find nothing. Other columns are left out.

    The index is written once and read once per block of items (``block_bytes`` of
    text, small enough to be sent to every task). Only the heaps are shuffled.
    """
    size = corpus_size(docs, text)
    index = stage(build_index(docs, size, id_column, text, shard_bytes), "search-index")
    return search(index, size, items, item_id, item_text, k, block_bytes).withColumnRenamed("doc_id", id_column)
