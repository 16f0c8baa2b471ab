"""Token ids in files: fixed-size blocks, transposed into planes, each compressed.

A store is a Parquet folder, so any file system that Spark writes serves, and Spark's
commit keeps lost tasks from leaving half files. A row is a segment: whole documents in
order, and their ids in blocks of a fixed number of ids (the last one shorter). A block
is transposed into byte or bit planes; each plane is one zstandard frame, so the high
planes of small ids shrink to almost nothing. The chunk index (part, segment, n_ids,
doc_ids, lengths, planes, plane_ends) stands in columns of its own and is read without
the ids: ``plane_ends`` are the frames' ends in ``payload``, block after block.
"""

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from rolecall.llm import tokens

STORE = (
    "part int, segment int, n_ids bigint, doc_ids array<bigint>, lengths array<bigint>, planes string, "
    "block_ids int, plane_ends array<bigint>, payload binary"
)
_SCHEMA = pa.schema([
    ("part", pa.int32()), ("segment", pa.int32()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("lengths", pa.list_(pa.int64())), ("planes", pa.string()), ("block_ids", pa.int32()),
    ("plane_ends", pa.list_(pa.int64())), ("payload", pa.binary()),
])


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The byte planes (4) or bit planes (32) of 32-bit ids, lowest first."""
    flat = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [np.ascontiguousarray(flat[:, k]).tobytes() for k in range(4)]
    return [np.packbits((flat[:, k // 8] >> (k % 8)) & 1).tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    out = np.zeros((n, 4), np.uint8)
    for k, plane in enumerate(planes):
        raw = np.frombuffer(plane, np.uint8)
        if kind == "byte":
            out[:, k] = raw
        else:
            out[:, k // 8] |= np.unpackbits(raw, count=n) << np.uint8(k % 8)
    return out.view("<u4").ravel()


def write_tokens(
    df: DataFrame, path: str, tokenizer: str, id_column: str = "doc_id", text: str = "text", end_id: int = 2,
    planes: str = "byte", block_ids: int = 65_536, segment_ids: int = 262_144, level: int = 3,
) -> None:
    """Encodes every document, appends ``end_id``, and writes the ids in ascending id order
    (nulls first; equal ids by the hash of their text).

    One range shuffle of the texts. Ranges hold the text's hash too, so a third of all
    rows with one id is still dealt to many tasks. ``tokenizer`` is the path of a
    tokenizers file that every executor has. Null and blank texts are the end id alone.
    A segment holds ``segment_ids`` ids or one longer document.
    """
    if planes not in ("byte", "bit"):
        raise ValueError(f"planes are byte or bit, not {planes}")

    def segments(arrow):
        part, number = TaskContext.get().partitionId(), 0
        encoder, squeeze = tokens.encoder(tokenizer), zstandard.ZstdCompressor(level=level)
        held: list[np.ndarray] = []
        names: list[int | None] = []
        lengths: list[int] = []
        size = 0

        def segment():
            ids = np.concatenate(held)
            frames = [
                squeeze.compress(plane) for at in range(0, len(ids), block_ids) for plane in to_planes(ids[at : at + block_ids], planes)
            ]
            row = {
                "part": part, "segment": number, "n_ids": len(ids), "doc_ids": list(names), "lengths": list(lengths), "planes": planes,
                "block_ids": block_ids, "plane_ends": np.cumsum([len(f) for f in frames]).tolist(), "payload": b"".join(frames),
            }
            return pa.RecordBatch.from_pylist([row], _SCHEMA)

        for batch in arrow:
            ids_of_batch = batch["id"].to_pylist()
            for first, ids, ends in encoder.encode(batch["text"]):
                ids = np.insert(ids, ends[1:], np.uint32(end_id))
                ends = ends + np.arange(len(ends))
                for row in range(len(ends) - 1):
                    held.append(ids[ends[row] : ends[row + 1]])
                    names.append(ids_of_batch[first + row])
                    lengths.append(int(ends[row + 1] - ends[row]))
                    size += lengths[-1]
                    if size >= segment_ids:
                        yield segment()
                        number, size = number + 1, 0
                        held, names, lengths = [], [], []
        if names:
            yield segment()

    order = ["id", F.xxhash64("text")]
    rows = df.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(segments, STORE).write.parquet(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of a store, and its ids as
    little-endian unsigned 32-bit integers if asked for. ``start`` counts the ids of all
    documents before it; it comes from the index alone, summed by part and by segment."""
    store = spark.read.schema(STORE).parquet(path)

    def decode(arrow):
        loosen = zstandard.ZstdDecompressor()
        for batch in arrow:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                per_block = 4 if row["planes"] == "byte" else 32
                ends, payload, blocks = [0, *row["plane_ends"]], row["payload"], []
                for k in range(0, len(ends) - 1, per_block):
                    n = min(row["block_ids"], row["n_ids"] - len(blocks) * row["block_ids"])
                    frames = [loosen.decompress(payload[a:b]) for a, b in zip(ends[k : k + per_block], ends[k + 1 : k + per_block + 1], strict=True)]
                    blocks.append(from_planes(frames, n, row["planes"]))
                ids = np.concatenate(blocks)
                at = np.concatenate([[0], np.cumsum(row["lengths"])])
                docs = [ids[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                n = len(docs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * n, pa.int32()), pa.array([row["segment"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                        pa.array(at[:-1], pa.int64()), pa.array(row["lengths"], pa.int64()), pa.array([zlib.crc32(d) for d in docs], pa.int64()),
                        pa.array(docs if with_ids else [None] * n, pa.binary()),
                    ],
                    ["part", "segment", "doc_id", "inside", "n_tokens", "ids_crc32", "ids"],
                )

    docs = store.mapInArrow(decode, "part int, segment int, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint, ids binary")
    index = store.select("part", "segment", "n_ids")
    before = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row per part: as many as the writing tasks
    parts = index.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).select("part", before(Window.orderBy("part")).alias("_part_start"))
    starts = index.select("part", "segment", before(Window.partitionBy("part").orderBy("segment")).alias("_segment_start")).join(parts, "part")
    start = F.col("_part_start") + F.col("_segment_start") + F.col("inside")
    columns = ["doc_id", start.alias("start"), "n_tokens", "ids_crc32"] + (["ids"] if with_ids else [])
    return docs.join(starts, ["part", "segment"]).select(*columns)
