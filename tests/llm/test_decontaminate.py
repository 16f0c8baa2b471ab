"""Benchmark hits against brute force over items and windows."""

import random

import numpy as np
import pytest

from rolecall.llm import decontaminate, queries


def items_and_texts(seed):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("the", "ño", "q", "x1") for b in range(200)] + ["of", "a"] * 40
    items = [" ".join(rng.choices(vocabulary, k=rng.choice([3, 5, 12, 30, 60]))) for _ in range(40)]
    items[3] = "who wrote the q7 x15 the9 of q11 x13? x1199 the150"
    texts = []
    for k in range(120):
        words = rng.choices(vocabulary, k=rng.choice([0, 10, 100, 700]))
        for item in rng.sample(items, rng.choice([0, 0, 1, 2])):
            part = item.split(" ")
            kind = rng.random()
            if kind < 0.3:
                part = part[: len(part) // 2]
            elif kind < 0.4 and len(part) > 20:
                part[len(part) // 3] = "changed"
            at = rng.randrange(len(words) + 1)
            words[at:at] = part
        texts.append(rng.choice([" ", "\n", ", "]).join(words))
    return items, texts + ["", None, items[0].upper(), items[1]]


def brute_force(items, texts):
    """Items of which some half-aligned window holds the shares asked for."""
    index = decontaminate.Index.of(list(range(len(items))), items)
    half, out = index.window // 2, set()
    for t, text in enumerate(texts):
        words = "".join(c if ord(c) > 127 or c.isalnum() else " " for c in (text or "")).split()
        words = [w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w) for w in words]
        for begin in range(0, len(words), half):
            window = words[begin : begin + index.window]
            for i, item in enumerate(items):
                of = "".join(c if c.isalnum() else " " for c in item).split()
                cut = len(item.split("?")[0].split()) if "?" in item else 0
                shares = []
                for part in (of[:cut], of[cut:]):  # without a question, the whole item
                    k = min(5, len(part))
                    grams = {tuple(part[j : j + k]) for j in range(len(part) - k + 1)}
                    held = {tuple(window[j : j + k]) for j in range(len(window) - k + 1)}
                    shares.append(len(grams & held) / len(grams) if part else 1)
                if min(shares) >= 0.8:
                    out.add((t, i))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_as_brute_force(spark, docs_of, seed):
    items, texts = items_and_texts(seed)
    docs = docs_of(list(enumerate(texts)))
    benchmark = spark.createDataFrame([*enumerate(items), (None, "no id"), (99, None), (98, " ?! ")], "item_id bigint, text string")
    hits = docs.select("doc_id", decontaminate.benchmark_hits(docs, benchmark).alias("h")).collect()
    assert len(hits) == len(texts)
    assert {(r["doc_id"], h["item_id"]) for r in hits for h in r["h"]} == brute_force(items, texts)


def test_blocks_give_the_same(spark, docs_of):
    items, texts = items_and_texts(4)
    docs, benchmark = docs_of(list(enumerate(texts))), spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    one = docs.select("doc_id", decontaminate.benchmark_hits(docs, benchmark).alias("h")).collect()
    some = docs.select("doc_id", decontaminate.benchmark_hits(docs, benchmark, block_bytes=2000).alias("h")).collect()
    pairs = lambda rows: {(r["doc_id"], h["item_id"]) for r in rows for h in r["h"]}
    assert pairs(one) == pairs(some)


def test_block_max_wand_finds_every_item():
    items, _ = items_and_texts(5)
    index = decontaminate.Index.of(list(range(len(items))), items)
    rng = np.random.default_rng(1)
    for _ in range(60):
        query = np.sort(rng.choice(len(index.terms), 60, replace=False)).tolist()
        scores = np.zeros(len(index.items))
        for t in query:
            a, z = index.first[t], index.first[t + 1]
            scores[index.posting[a:z]] += index.impact[a:z]
        least = float(np.quantile(scores, 0.8))
        expected = set(np.flatnonzero(scores >= least).tolist())
        assert {i for i, _ in decontaminate.block_max_wand(index, query, least - 1e-12)} == expected


def test_empty_tables(spark, docs_of, tmp_path):
    docs_of([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert queries.QUERIES["op3_benchmark_leaks"](spark, str(tmp_path)).collect() == []
    docs = docs_of([(1, "some text")])
    empty = spark.read.parquet(f"{tmp_path}/benchmark.parquet")
    assert docs.select(decontaminate.benchmark_hits(docs, empty)).collect()[0][0] == []


def test_an_edit_at_every_word(spark, docs_of):
    """One changed word anywhere leaves 0.8 of an item of 30 words or more."""
    rng = random.Random(6)
    items = [" ".join(f"w{rng.randrange(500)}" for _ in range(n)) for n in (30, 41, 60)]
    texts = []
    for item in items:
        for k in range(len(item.split())):
            words = item.split()
            words[k] = "changed"
            texts.append(" ".join(["before", "it", *words, "and", "behind"]))
    docs = docs_of(list(enumerate(texts)))
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    hits = docs.select("doc_id", decontaminate.benchmark_hits(docs, benchmark).alias("h")).collect()
    wanted = [i for i, item in enumerate(items) for _ in item.split()]
    assert {r["doc_id"]: [h["item_id"] for h in r["h"]] for r in hits} == {k: [i] for k, i in enumerate(wanted)}


def test_question_and_answer_are_both_asked_for(spark, docs_of):
    question, answer = " ".join(f"q{i}" for i in range(40)), " ".join(f"a{i}" for i in range(10))
    benchmark = spark.createDataFrame([(1, f"{question}? {answer}"), (2, f"{question}?")], "item_id bigint, text string")
    docs = docs_of([(1, f"x {question} {answer} y"), (2, f"x {question} another answer y"), (3, f"{answer}")])
    hits = {r["doc_id"]: [h["item_id"] for h in r["h"]] for r in docs.select("doc_id", decontaminate.benchmark_hits(docs, benchmark).alias("h")).collect()}
    assert hits == {1: [1, 2], 2: [2], 3: []}


def test_many_items_are_indexed_in_seconds():
    import time

    rng = np.random.default_rng(1)
    texts = [" ".join(map(str, row)) for row in rng.integers(0, 50_000, (20_000, 12)).tolist()]
    begin = time.perf_counter()
    index = decontaminate.Index.of(list(range(len(texts))), texts)
    assert len(index.items) == 20_000 and time.perf_counter() - begin < 15


def test_one_long_text(spark, docs_of):
    item = " ".join(f"w{i}" for i in range(30))
    docs = docs_of([(1, "common words of a text " * 60_000 + item), (2, "x" * 1_000_000), (3, "w1 " * 300_000)])
    benchmark = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    hits = {r["doc_id"]: [h["item_id"] for h in r["h"]] for r in docs.select("doc_id", decontaminate.benchmark_hits(docs, benchmark).alias("h")).collect()}
    assert hits == {1: [7], 2: [], 3: []}
