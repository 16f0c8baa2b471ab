"""Arrow batches that are sorted by a key, group after group, and the memory they leave."""

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of rows with equal (long, not null) keys."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [np.asarray(batch[k]) for k in keys]
        change = np.flatnonzero(np.any([v[1:] != v[:-1] for v in values], axis=0)) + 1
        for a, b in zip([0, *change], [*change, batch.num_rows], strict=True):
            now = tuple(v[a] for v in values)
            if now != key and held:
                yield pa.Table.from_batches(held)
                held = []
            key = now
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def give_back() -> None:
    """Unused memory of this Python worker goes back to the system: Arrow and the C library
    keep it, and a worker lives on from stage to stage beside its executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)
