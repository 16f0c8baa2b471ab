"""Ranked search against scores of every document."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from rolecall.llm import lexical_search, oracle, queries, wordbytes


def terms_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain(docs, items, k=10):
    counts = [(i, Counter(terms_of(t))) for i, t in docs]
    n_docs, total = sum(1 for _, c in counts if c), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in df}
    out = []
    for item, text in items:
        asked = set(terms_of(text))
        scores = []
        for i, c in counts:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // total if total else 0
            score = sum(weight[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank + 1, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("the", "Ño", "q", "x1", "日本") for b in range(120)]
    heavy = [1 / (1 + i) for i in range(len(vocabulary))]
    text = lambda n: rng.choice([" ", "\n", "-"]).join(rng.choices(vocabulary, heavy, k=n))
    docs = [(i * 5 % 701, text(rng.choice([0, 1, 8, 60, 300]))) for i in range(400)]
    docs += [(1000 + i, docs[7][1] or "the0 q1") for i in range(200)]  # a third are copies: ties
    docs += [(2000, None), (2001, ""), (2002, " -?\n"), (None, docs[9][1]), (None, docs[9][1]), (5, docs[9][1]), (5, docs[9][1]), (2003, "q1 " * 50000)]
    items = [(i, text(rng.choice([1, 3, 12, 40]))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "none of these"), (3, items[3][1]), (None, items[4][1]), (103, docs[7][1])]
    return docs, items


@pytest.fixture
def found(spark, docs_of):
    def search(docs, items, **options):
        benchmark = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id bigint, text string, doc_id int, score string")
        table = docs_of(docs).withColumnRenamed("lang", "rank").repartition(3)
        return sorted((tuple(r) for r in lexical_search.ranked_search(table, benchmark, **options).collect()), key=repr)

    return search


@pytest.mark.parametrize("seed", [1, 2])
def test_as_plain(found, seed):
    docs, items = corpus(seed)
    want = plain(docs, items)
    assert found(docs, items) == want
    assert found(docs, items, shard_bytes=3000, block_bytes=300) == want
    assert found(docs, items, k=3) == plain(docs, items, 3)


def test_empty_tables(found):
    assert found([], [(1, "a")]) == [] and found([(1, "a")], []) == []
    assert found([(1, None), (2, " ")], [(1, "a"), (2, None)]) == []
    assert found([(1, "a b"), (2, "b")], [(9, "A a")]) == plain([(1, "a b"), (2, "b")], [(9, "a")])


def shard_of(n, rng):
    docs = np.arange(n)
    rows = [np.sort(rng.choice(n, size, replace=False)) for size in (n, n // 2, n // 10, 40, 5, 1)]
    doc, term = np.concatenate(rows), np.repeat(np.arange(6, dtype=np.uint64) * np.uint64(1 << 60), [len(r) for r in rows])
    tf, length = rng.integers(1, 30, len(doc)), rng.integers(30, 900, n)
    return lexical_search.Shard.of(pa.array(docs), length, doc, term, tf, (n, int(length.sum()))), rows


def test_shards_come_back(tmp_path):
    shard, rows = shard_of(70_000, np.random.default_rng(1))
    again = lexical_search.Shard.read(shard.row(), 0)
    for t, want in enumerate(rows):
        blocks = np.arange(again.first_block[t], again.first_block[t + 1])
        doc, impact = again.unpack(blocks, np.where(blocks > blocks[0], again.last[blocks - 1], -1))
        assert (doc == want).all() and impact.max() == again.top[t] and len(want) == again.df[t]
        some = blocks[1::3]
        if len(some):
            part, _ = again.unpack(some, again.last[some - 1])
            assert set(part) <= set(want.tolist())


def test_blocks_are_rejected_before_they_are_unpacked():
    shard, _ = shard_of(70_000, np.random.default_rng(2))
    weights = np.array([3, 10, 2000, 9000, 9500, 9900])
    heap = lexical_search.Heap(10)
    unpacked = lexical_search.max_score(shard, np.arange(6), weights, heap)
    assert len(heap.score) == 10 and unpacked < len(shard.most) / 3
    scores = np.zeros(70_000, np.int64)
    for t in range(6):
        blocks = np.arange(shard.first_block[t], shard.first_block[t + 1])
        doc, impact = shard.unpack(blocks, np.where(blocks > blocks[0], shard.last[blocks - 1], -1))
        scores[doc] += weights[t] * impact
    order = np.lexsort([np.arange(70_000), -scores])[:10]
    assert (heap.ids == order).all() and (heap.score == scores[order]).all()


def test_terms_are_runs_of_letters_and_digits():
    text = "Ab-9 É日本\x00x\x7fy_z ²"
    hashes, words = lexical_search._terms(*wordbytes.utf8(pa.array([text])))
    raw = text.encode()
    cut = [raw[a:z].decode() for a, z in zip(words.start, words.end, strict=True)]
    assert [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in cut] == terms_of(text)


def test_as_sql(spark):
    path = "/root/testdata/sf0.001"
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/{name}.parquet')")
    answer = connection.execute(oracle.ORACLE["op12_ranked_search"]).fetchall()
    rows = queries.QUERIES["op12_ranked_search"](spark, path).collect()
    assert sorted(map(tuple, rows)) == sorted(answer)
