"""Arrays of fixed size that are added up over all rows, and row filters made of them."""

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_SLOT = 1 << 18  # bytes of an array in a row, before compression


def add_up(df: DataFrame, fill: Callable, size: int, dtype=np.int32, either: bool = False) -> np.ndarray:
    """Sum (or with ``either`` the bitwise or) of one array of ``size`` entries per task.

    ``fill(batch, array)`` enters an Arrow batch. Tasks send their arrays compressed, in
    slots; a slot's arrays are added up as they come. The driver gets the one array,
    whose size does not depend on the rows.
    """
    dtype, join = np.dtype(dtype), np.bitwise_or if either else np.add
    width = _SLOT // dtype.itemsize

    def enter(batches: Iterable[pa.RecordBatch]):
        array = np.zeros(-(-size // width) * width, dtype)
        for batch in batches:
            fill(batch, array)
        slots = array.reshape(-1, width)
        used = np.flatnonzero(slots.any(axis=1))
        squeeze = zstandard.ZstdCompressor(level=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([squeeze.compress(slots[i].tobytes()) for i in used], pa.binary())], ["slot", "entries"]
        )

    def total(batches: Iterable[pa.RecordBatch]):
        sums: dict[int, np.ndarray] = {}
        loosen, squeeze = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for slot, entries in zip(batch["slot"].to_pylist(), batch["entries"], strict=True):
                entries = np.frombuffer(loosen.decompress(entries.as_py()), dtype)
                sums[slot] = join(sums[slot], entries) if slot in sums else entries
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([squeeze.compress(x.tobytes()) for x in sums.values()], pa.binary())], ["slot", "entries"]
        )

    schema = "slot int, entries binary"
    sums = df.mapInArrow(enter, schema).repartition("slot").mapInArrow(total, schema)
    out, loosen = np.zeros(-(-size // width) * width, dtype), zstandard.ZstdDecompressor()
    for row in sums.collect():  # at most size / width rows
        out[row["slot"] * width : (row["slot"] + 1) * width] = np.frombuffer(loosen.decompress(bytes(row["entries"])), dtype)
    return out[:size]


def id_filter(ids: DataFrame, id_column: str, least_bits: int = 23, most_bits: int = 30) -> np.ndarray:
    """A bitmap of which two bits are set for each id (a Bloom filter): it knows every id
    of ``ids`` and a few more. It has 2**least_bits bits, or 16 per id up to
    2**most_bits (128 MB, the most that is sent to a task); up to 67 million ids it lets
    less than 2 of 100 others pass, beyond that more, and never an id of ``ids`` get lost."""
    bits = min(most_bits, max(least_bits, int(16 * ids.count()).bit_length()))

    def fill(batch, array):
        keys = np.asarray(batch[id_column].drop_null(), np.int64)
        for place in _places(keys, bits):
            np.bitwise_or.at(array, place >> np.uint64(3), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))

    return add_up(ids.select(id_column), fill, 1 << (bits - 3), np.uint8, either=True)


def _places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    from rolecall.llm.wordbytes import mix

    hashed = mix(keys.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
    return [hashed >> np.uint64(64 - bits), (hashed & np.uint64((1 << 32) - 1)) >> np.uint64(32 - bits)]


def holds(bitmap: np.ndarray, ids) -> np.ndarray:
    """Whether the filter may hold each id of an Arrow array; a null is in none."""
    bits = int(len(bitmap) * 8).bit_length() - 1
    known = np.asarray(ids.is_valid())
    keys = np.asarray(ids.fill_null(0), np.int64)
    for place in _places(keys, bits):
        known &= (bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
    return known


def may_be_in(spark: SparkSession, bitmap: np.ndarray, id_column: str) -> Column:
    """True for every id of the filter and for few others; a null id is in none."""
    shared = spark.sparkContext.broadcast(bitmap)

    @F.arrow_udf("boolean")
    def check(ids: pa.Array) -> pa.Array:
        return pa.array(holds(shared.value, ids))

    return check(F.col(id_column))
