"""Packing of tokenised documents into sequences: best fit, then swaps between bins."""

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rolecall.llm import batches, tokens
from rolecall.sources.sinks import stage


def token_pieces(
    df: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text", capacity: int = 4096, end_id: int = 1
) -> DataFrame:
    """(id, piece, start, length, ids): each document's ids with ``end_id`` appended, cut
    every ``capacity`` ids; ``ids`` holds little-endian unsigned 32-bit integers.

    ``tokenizer`` is the path of a tokenizers file that every executor has. A null or
    blank text is the end id alone; null and repeated document ids are kept as they are.
    No shuffle.
    """

    def cut(arrow):
        batches.give_back()  # what another stage left in this worker
        encoder = tokens.encoder(tokenizer)
        for batch in arrow:
            names = batch["id"]
            for first, ids, ends in encoder.encode(batch["text"]):
                rows = len(ends) - 1
                whole = np.insert(ids, ends[1:], np.uint32(end_id)).astype("<u4")
                ends = ends + np.arange(rows + 1)
                length = np.diff(ends)
                many = -(-length // capacity)
                row = np.repeat(np.arange(rows), many)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                start = piece * capacity
                size = np.minimum(capacity, length[row] - start)
                # pieces follow each other without a gap
                bounds = pa.py_buffer(np.concatenate([[0], np.cumsum(size) * 4]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        names.take(pa.array(first + row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(size, pa.int64()),
                        pa.Array.from_buffers(pa.binary(), len(row), [None, bounds, pa.py_buffer(whole)]),
                    ],
                    ["id", "piece", "start", "length", "ids"],
                )
            batches.give_back()

    source = df.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"))
    return source.mapInArrow(cut, "id bigint, piece int, start bigint, length bigint, ids binary").withColumnRenamed("id", id_column)


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each size: largest first, each into the fullest bin that takes it."""
    owner = np.empty(len(sizes), np.int64)
    room: list[tuple[int, int]] = []
    bins = 0
    for k in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[k])
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b, bins = capacity, bins, bins + 1
        owner[k] = b
        if left > size:
            insort(room, (left - size, b))
    return owner


class _Bins:
    def __init__(self, sizes: np.ndarray, owner: np.ndarray, capacity: int):
        self.size, self.owner = sizes.astype(np.int64), owner.copy()
        self.fill = np.bincount(owner, sizes, int(owner.max()) + 1).astype(np.int64)
        self.gap = capacity - self.fill

    def give(self, item: int, to: int) -> None:
        size, source = self.size[item], self.owner[item]
        self.fill[source] -= size
        self.gap[source] += size
        self.fill[to] += size
        self.gap[to] -= size
        self.owner[item] = to

    def _best(self, gain: np.ndarray, donor: int) -> int:
        """The item whose bin gains most from an exchange that raises the squared fill."""
        bins = self.owner
        good = (gain > 0) & (gain <= self.gap[bins]) & (bins != donor) & (self.fill[bins] + gain > self.fill[donor])
        at = np.flatnonzero(good)
        return int(at[np.argmax(gain[at])]) if len(at) else -1

    def improve(self, donor: int) -> bool:
        """One move or exchange that lowers the donor's fill and raises another's by as much."""
        mine = np.flatnonzero(self.owner == donor)
        mine = mine[np.argsort(-self.size[mine], kind="stable")]
        for i in mine.tolist():
            fits = np.flatnonzero(self.gap >= self.size[i])
            fits = fits[(fits != donor) & (self.fill[fits] > 0) & (self.fill[fits] + self.size[i] > self.fill[donor])]
            if len(fits):
                self.give(i, int(fits[np.argmin(self.gap[fits])]))
                return True
        for i in mine.tolist():
            k = self._best(self.size[i] - self.size, donor)
            if k >= 0:
                to = int(self.owner[k])
                self.give(k, donor)
                self.give(i, to)
                return True
        for n, i in enumerate(mine.tolist()):
            for j in mine[n + 1 :].tolist():
                k = self._best(self.size[i] + self.size[j] - self.size, donor)
                if k >= 0:
                    to = int(self.owner[k])
                    self.give(k, donor)
                    self.give(i, to)
                    self.give(j, to)
                    return True
        return False


def pack(sizes: np.ndarray, capacity: int, passes: int = 3) -> np.ndarray:
    """The bin of each size (1 to ``capacity``): best fit, then local search.

    The emptiest underfull bins give documents away: by a move, one for one, or two for
    one, each of which raises the sum of squared fills, until a bin is empty or no
    exchange helps; at most ``passes`` times over the bins. Bins never grow in number.
    """
    if not len(sizes):
        return np.zeros(0, np.int64)
    owner = best_fit(sizes, capacity)
    # bins that are full take no part
    fill = np.bincount(owner, sizes)
    open_ = np.flatnonzero(fill[owner] < capacity)
    if len(open_):
        names, small = np.unique(owner[open_], return_inverse=True)
        bins = _Bins(sizes[open_], small, capacity)
        for _ in range(passes):
            changed = False
            for donor in np.argsort(bins.fill, kind="stable").tolist():
                # a bin with less room than its own smallest document cannot be emptied by small steps: it may still give
                while bins.fill[donor] and bins.gap[donor] and bins.improve(donor):
                    changed = True
            if not changed:
                break
        owner[open_] = names[bins.owner]
    return np.unique(owner, return_inverse=True)[1]


def pack_pieces(pieces: DataFrame, capacity: int = 4096, group_pieces: int = 8192, most_tasks: int = 20_000) -> DataFrame:
    """Adds sequence_id and offset to pieces with a ``length`` of 1 to ``capacity``;
    columns of these names are replaced.

    The rows are stored with a number each and dealt to groups of about
    ``group_pieces`` by that number, whatever they hold. Each group is packed in one
    task, so the number of groups grows with the rows and each costs at most one
    underfull sequence more; there are as many tasks as groups, up to ``most_tasks``.
    Offsets are gapless from 0 in every sequence.
    """
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    kept = [f"c{i}" for i in range(len(columns))]  # whatever the columns are called
    named = pieces.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(columns, kept, strict=True)])
    numbered = stage(named.withColumn("row", F.monotonically_increasing_id()), "pieces")
    groups = 1 + numbered.count() // group_pieces
    length = kept[columns.index("length")]
    dealt = numbered.select("row", F.col(length).alias("length"), F.pmod(F.xxhash64("row"), F.lit(groups)).alias("group"))

    def place(arrow):
        for table in batches.runs(arrow, ["group"]):
            sizes, rows = np.asarray(table["length"]), np.asarray(table["row"])
            order = np.argsort(rows)  # the same packing whatever the order of arrival
            sizes, rows = sizes[order], rows[order]
            owner = pack(sizes, capacity)
            inside = np.argsort(owner, kind="stable")
            ends = np.cumsum(sizes[inside])
            first = np.searchsorted(owner[inside], np.arange(owner.max() + 1))
            before = (ends - sizes[inside])[first]
            offset = np.empty(len(sizes), np.int64)
            offset[inside] = ends - sizes[inside] - before[owner[inside]]
            group = table["group"][0].as_py()
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array((group << 32) + owner), pa.array(offset)], ["row", "sequence_id", "offset"])

    tasks = int(min(groups, most_tasks))
    placed = dealt.repartition(tasks, "group").sortWithinPartitions("group").mapInArrow(place, "row bigint, sequence_id bigint, offset bigint")
    joined = numbered.join(placed, "row")
    return joined.select(*[F.col(k).alias(c) for c, k in zip(columns, kept, strict=True)], "sequence_id", "offset")


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the ids of every sequence, from placed pieces that carry ``ids``."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(inside.alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids")
    )
