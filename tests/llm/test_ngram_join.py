"""The n-gram join against all pairs in plain Python."""

import random
import re

import pytest

from rolecall.llm import ngram_join


def brute_force(rows, width=4, percent=85):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        k = max(len(words) - width + 1, 1) if words else 0
        sets.append({tuple(words[i : i + width]) for i in range(k)})
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b, c = sets[j], len(a & sets[j])
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * c >= percent * (len(a) + len(b) - c):
                parent[root(i)] = root(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i)]
        out.append((doc, len(sets[i]), None if doc is None else min(ids)))
    return sorted(out, key=repr)


def near_copies(rng, text, changes):
    words = text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed, groups=12, copies=14):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("al", "be", "ço", "du", "é") for b in range(60)]
    passage = " ".join(rng.choices(vocabulary, k=60))
    texts = []
    for _ in range(groups):
        base = " ".join(rng.choices(vocabulary, k=rng.choice([3, 20, 80, 400])))
        if rng.random() < 0.4:
            base += "\n" + passage
        texts += [base, base.upper().replace("É", "é").replace("Ç", "ç"), base.replace(" ", "\t\n")]
        texts += [near_copies(rng, base, rng.choice([0, 1, 1, 2, 3, 9])) for _ in range(copies)]
    texts += [passage, "", None, " \n\t", "a", "A", "a b c", "a b c d", "a b c d " * 200, "a  b\x0bc d", " a b c d"]
    rng.shuffle(texts)
    ids = rng.sample(range(10**6), len(texts))
    return list(zip(ids, texts, strict=True))


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_as_all_pairs(docs_of, seed):
    rows = corpus(seed)
    assert found(ngram_join.ngram_components(docs_of(rows))) == brute_force(rows)


def test_blocks_in_parts(docs_of):
    """Blocks far above their size are searched in parts, with the same result."""
    rows = corpus(3, groups=3, copies=60)
    assert found(ngram_join.ngram_components(docs_of(rows), block_tokens=600)) == brute_force(rows)


def test_long_lists_by_join(docs_of, monkeypatch):
    """Lists that may be long are met by a join, with the same result."""
    monkeypatch.setattr(ngram_join, "LONG_LIST", 3)
    rows = corpus(4, groups=5)
    assert found(ngram_join.ngram_components(docs_of(rows))) == brute_force(rows)


def test_one_text_of_each_set_meets_a_block(docs_of, monkeypatch):
    """Rows that repeat a chosen id, and copies under other ids, bring their set's text once."""
    rng = random.Random(6)
    base = " ".join(f"w{rng.randrange(10**6)}" for _ in range(100))
    rows = [(5, base)] * 60 + [(k, base) for k in range(10, 20)] + [(7, f"{base} end"), (7, f"{base} end"), (9, "start " + base)]
    search, met = ngram_join._search, []
    monkeypatch.setattr(ngram_join, "_search", lambda blocks, *a: met.extend(tuple(r) for r in blocks.select("lead", "part", "node").collect()) or search(blocks, *a))
    assert found(ngram_join.ngram_components(docs_of(rows).repartition(3))) == brute_force(rows)
    assert met and len(met) == len(set(met))


def test_one_of_each(docs_of):
    rows = [(5, "a b c d e"), (5, "a b c d e"), (3, "A b c d e"), (3, "x y z q w"), (None, "a b c d e"), (7, None), (8, ""), (9, "x y z q w v")]
    kept = ngram_join.one_of_each(docs_of(rows)).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept), key=repr) == sorted(
        [(3, "A b c d e"), (3, "x y z q w"), (None, "a b c d e"), (7, None), (8, ""), (9, "x y z q w v")], key=repr
    )


def test_edge_rows(docs_of):
    rows = [(None, "a b c d e"), (5, "a b c d e"), (5, "a b c d e"), (3, "A B  C d e"), (9, None), (9, ""), (None, None), (1, "x")]
    assert found(ngram_join.ngram_components(docs_of(rows))) == brute_force(rows)
    assert found(ngram_join.ngram_components(docs_of([]))) == []


def test_links_of_block_chain():
    """A chain of links is followed although the first query reaches only its neighbour."""
    import numpy as np

    sets = [np.arange(i, i + 40, dtype=np.uint64) for i in range(0, 30, 3)]
    links = list(ngram_join.links_of_block(sets, 85))
    assert len(links) == len(sets) - 1


def test_screen_keeps_what_links():
    """Sets of many sizes: no pair that links is lost, sets that meet by chance are dropped."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(7)
    blocks, kinds = [], []
    for size in (1, 7, 40, 63, 64, 65, 120, 130, 500, 1000, 1030):
        base = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        near = [np.append(base[k:], rng.integers(0, 1 << 63, more, dtype=np.uint64)) for k, more in ((0, size // 9), (size // 14, size // 14))]
        chance = [np.append(base[:2], rng.integers(0, 1 << 63, size, dtype=np.uint64)) for _ in range(3)]
        blocks.append([base, *near, *chance])
        kinds.append([True] * 3 + [False] * 3)
    sets = [np.unique(x) for block in blocks for x in block]
    n = np.array([len(x) for x in sets])
    parity = pa.array(map(ngram_join.parities, sets), pa.binary())
    begins = np.arange(0, len(sets), 6)
    everyone = np.ones(len(sets), bool)
    may = ngram_join.may_link(begins, n, parity, everyone, 85).tolist()
    linked = [any(100 * len(np.intersect1d(x, y)) >= 85 * len(np.union1d(x, y)) for j, y in enumerate(sets) if j != k and j // 6 == k // 6) for k, x in enumerate(sets)]
    assert all(m for m, there in zip(may, linked, strict=True) if there) and sum(linked) >= 20
    # of those that share two tokens by chance, hardly one is left
    assert sum(m for m, k in zip(may, sum(kinds, []), strict=True) if not k) <= 3
    # with one far set a block (its first one) only pairs with that one count
    first = np.arange(len(sets)) % 6 == 0
    with_first = [any(100 * len(np.intersect1d(x, y)) >= 85 * len(np.union1d(x, y)) for j, y in enumerate(sets) if j != k and j // 6 == k // 6 and 0 in (j % 6, k % 6)) for k, x in enumerate(sets)]
    some = ngram_join.may_link(begins, n, parity, first, 85).tolist()
    assert all(m for m, there in zip(some, with_first, strict=True) if there)


def test_sets_that_meet_by_chance_bring_no_text(docs_of, monkeypatch):
    """Only sets that may link have their texts brought to a block, and the result is that of all pairs."""
    rng = random.Random(8)
    run = lambda a, b: [f"r{a}x{b}x{k}" for k in range(10)]  # words that two texts share
    rows = [(2 * k, " ".join(w for d in (1, 2, 3) for w in (*run(k, (k + d) % 100), *run((k - d) % 100, k)))) for k in range(100)]
    rng.shuffle(rows)
    rows += [(k + 1, f"{text} end") for k, text in rows[:10]]
    search, met = ngram_join._search, []
    monkeypatch.setattr(ngram_join, "_search", lambda blocks, *a: met.extend(tuple(r) for r in blocks.select("lead", "part", "node").collect()) or search(blocks, *a))
    monkeypatch.setattr(ngram_join, "SKETCH", 16)  # no shingle is told to be rare
    assert found(ngram_join.ngram_components(docs_of(rows))) == brute_force(rows)
    assert len({node for _, _, node in met}) <= 30  # 20 of 110 are linked


@pytest.mark.parametrize("screened", [0, 1e5])
def test_screened_or_not(docs_of, monkeypatch, screened):
    """Blocks above the limit are searched as they are, in parts too, with the same result."""
    monkeypatch.setattr(ngram_join, "SCREENED", screened)
    rows = corpus(5, groups=3, copies=40)
    assert found(ngram_join.ngram_components(docs_of(rows), block_tokens=600)) == brute_force(rows)


def test_divide_skip_as_counted(monkeypatch):
    """Sets in enough lists, with every way to look them up."""
    import numpy as np

    rng = np.random.default_rng(9)
    for sets, probes in ((12, 1 << 14), (90, 1), (90, 1 << 14)):
        monkeypatch.setattr(ngram_join, "PROBES", probes)
        pool = np.sort(rng.choice(1 << 40, 80, replace=False)).astype(np.uint64)
        mine = [np.unique(rng.choice(pool[: 60 + k % 20], 50)) for k in range(sets)]
        links = list(ngram_join.links_of_block(mine, 55))
        parent = list(range(sets))

        def root(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in links:
            same = len(np.intersect1d(mine[a], mine[b]))
            assert 100 * same >= 55 * (len(mine[a]) + len(mine[b]) - same)
            parent[root(a)] = root(b)
        for a in range(sets):
            for b in range(a):
                same = len(np.intersect1d(mine[a], mine[b]))
                assert 100 * same < 55 * (len(mine[a]) + len(mine[b]) - same) or root(a) == root(b)
