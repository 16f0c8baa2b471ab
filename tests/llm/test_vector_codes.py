"""Vector codes against plain loops over all entries."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from rolecall.llm import oracle, queries, vector_codes

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, id string, v int"


def plain(rows, parts=8, entries=16, rounds=6):
    """{place in rows: (code, error)} and the digest, with Python integers."""
    kept = {i: [math.floor(4096 * x) for x in v] for i, (_, v, _) in enumerate(rows)
            if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    size = len(next(iter(kept.values()))) // parts
    cut = {i: [v[p * size : (p + 1) * size] for p in range(parts)] for i, v in kept.items()}
    seeds = sorted(kept, key=lambda i: (rows[i][0] is None, rows[i][0] or 0, kept[i]))[:entries]
    books = [[list(cut[i][p]) for i in seeds] for p in range(parts)]

    def nearest(part, book):
        costs = [sum((a - b) ** 2 for a, b in zip(part, e, strict=True)) for e in book]
        return costs.index(min(costs)), min(costs)

    for _ in range(rounds):
        for p in range(parts):
            members = [[] for _ in books[p]]
            for v in cut.values():
                members[nearest(v[p], books[p])[0]].append(v[p])
            books[p] = [[sum(c) // len(m) for c in zip(*m, strict=True)] if m else e for m, e in zip(members, books[p], strict=True)]
    out = {}
    for i, v in cut.items():
        found = [nearest(v[p], books[p]) for p in range(parts)]
        out[i] = "".join(f"{c:02x}" for c, _ in found), sum(d for _, d in found)
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def rows_of(seed, n=300, size=16):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.2) for _ in range(size)] for _ in range(6)]
    f32 = lambda x: float(np.float32(x))
    rows = [(i * 7 % n, [f32(c + rng.gauss(0, 0.02)) for c in rng.choice(centres)], rng.choice([1, 2, None])) for i in range(n)]
    rows += [(500 + i, rows[3][1], 1) for i in range(n // 3)]  # copies
    rows += [(5, None, 1), (6, [None] * size, 1), (7, [math.nan] * size, 2), (8, [math.inf] + [0.0] * (size - 1), 2), (9, [-math.inf] * size, None)]
    return rows + [(0, rows[1][1], 2), (0, [0.0] * size, 2), (None, rows[2][1], None), (None, rows[2][1], None), (900, [0.25] * size, 3), (901, [-0.25] * size, 3)]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
def test_as_plain(spark, seed):
    rows = rows_of(seed)
    want, digest = plain(rows)
    sums: dict = {}
    for i, (_, error) in want.items():
        sums[rows[i][2]] = sums.get(rows[i][2], 0) + error
    expected = sorted(((rows[i][0], *want[i], sums[rows[i][2]], digest) for i in want), key=repr)
    found = vector_codes.vector_codes(table(spark, rows).repartition(5))
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected


@pytest.mark.parametrize("bits", [0, 3, 7, 12])
def test_cells_keep_the_nearest(bits):
    rng = np.random.default_rng(bits)
    entries = rng.integers(-60, 60, (16, 4)) * 20
    entries[5] = entries[3]  # a tie everywhere
    cells = vector_codes.Cells(entries, bits)
    for _ in range(3):  # later rounds meet remembered cells
        parts = rng.integers(-1500, 1500, (700, 4))
        parts[:50] = entries[rng.integers(0, 16, 50)]
        cost = ((parts[:, None, :] - entries) ** 2).sum(2)
        code, distance = cells.nearest(parts)
        assert (code == cost.argmin(1)).all() and (distance == cost.min(1)).all()
    assert cells.candidates(parts).sum(1).max() <= 16 and not (cells.keys[1:] < cells.keys[:-1]).any()


def test_memory_of_cells_is_bounded(monkeypatch):
    monkeypatch.setattr(vector_codes, "CELLS", 50)
    rng = np.random.default_rng(1)
    entries = rng.integers(-500, 500, (8, 3))
    cells = vector_codes.Cells(entries, 4)
    for _ in range(5):
        parts = rng.integers(-500, 500, (200, 3))
        assert (cells.nearest(parts)[0] == ((parts[:, None, :] - entries) ** 2).sum(2).argmin(1)).all()
        assert len(cells.keys) <= 50


def test_odd_tables(spark):
    assert vector_codes.vector_codes(table(spark, [])).collect() == []
    assert vector_codes.vector_codes(table(spark, [(1, None, 1), (2, [math.nan] * 8, 1)])).collect() == []
    # fewer rows than entries, other lengths, numbers whose squares are too large
    rows = [(1, [0.5] * 8, 1), (2, [1.0] * 8, 1), (3, [0.5] * 16, 1), (4, [], 2), (5, [0.5] * 7, 2), (6, [3e38] * 8, 1)]
    found = {r["vec_id"]: (r["code"], r["error"], r["label_error"]) for r in vector_codes.vector_codes(table(spark, rows)).collect()}
    assert found == {1: ("00" * 8, 0, 0), 2: ("01" * 8, 0, 0), 3: (None, None, 0), 4: (None, None, None), 5: (None, None, None), 6: (None, None, 0)}
    assert [r["code"] for r in vector_codes.vector_codes(table(spark, [(4, [], 2)])).collect()] == [None]


def test_as_sql(spark, tmp_path):
    rows = rows_of(4)
    table(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    connection = duckdb.connect()
    for path in (f"{tmp_path}/embeddings.parquet/*.parquet", "/root/testdata/sf0.001/embeddings.parquet"):
        connection.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM read_parquet('{path}')")
        answer = connection.execute(oracle.ORACLE["op11_vector_codes"]).fetchall()
        found = queries.QUERIES["op11_vector_codes"](spark, path.split("/embeddings.parquet")[0]).collect()
        assert sorted(map(tuple, found), key=repr) == sorted(answer, key=repr)
