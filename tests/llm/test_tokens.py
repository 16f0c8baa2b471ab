"""Word-wise ids against the tokenizer itself, packing, and the store's round trip."""

import random
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from rolecall.llm import packing, queries, token_store, tokens
from rolecall.llm.queries import TOKENIZER

TEXTS = [
    None, "", " \n\t ", "it's we'll I'D don't.", "a b  x", "é ́x a.́", "<|endoftext|> a<|startoftext|>b", "İIΣ σΣ",
    "1234 ½,5.6;7 ³", "日本語 テスト!!", "\x1c a\x85b", "ﬁ ǅ ẞ", "a,b.c!d?e;f:g 1,000.5 x,,y ..z é, …,",
    "# # end # id", "word " * 9000,
]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def corpus():
    rng = random.Random(3)
    parts = ["the", "The,", "été.", "x-y", "don't", "\n", " ", "  ", "中", "42", "à", "!?", "\U0001f600", "<|endoftext|>", "'s", "'", ",", " "]
    return TEXTS + ["".join(rng.choices(parts, k=rng.randrange(60))) for _ in range(300)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_ids_as_the_tokenizer_gives(plain):
    encoder = tokens.Encoder(TOKENIZER)
    texts = corpus()
    for _ in range(2):  # the second time all words are known
        got = [ids[a:b].tolist() for _, ids, ends in encoder.encode(pa.array(texts)) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        assert got == [plain(t) for t in texts]


def test_word_table():
    table, rng = tokens.WordTable(bits=8), np.random.default_rng(0)
    keys = np.unique(rng.integers(1, 1 << 62, 120).astype(np.uint64) << np.uint64(3))
    table.add(keys[:50], 0)
    table.add(keys[50:], 50)
    assert table.find(keys).tolist() == list(range(len(keys)))
    assert table.find(keys + np.uint64(1)).tolist() == [-1] * len(keys)


def test_word_table_grows():
    table, rng = tokens.WordTable(bits=4), np.random.default_rng(0)
    keys = np.unique(rng.integers(1, 1 << 62, 5000).astype(np.uint64))
    table.add(keys[:7], 0)
    assert not table.full
    table.add(keys[7:3000], 7)
    table.add(keys[3000:], 3000)
    assert table.full and table.find(keys).tolist() == list(range(len(keys)))
    assert table.find(keys + np.uint64(1 << 62)).tolist() == [-1] * len(keys)


def test_one_text_with_more_words_than_slots(plain, monkeypatch):
    small = tokens.WordTable
    monkeypatch.setattr(tokens, "WordTable", lambda: small(bits=6))
    encoder = tokens.Encoder(TOKENIZER)
    texts = [" ".join(f"w{i}x{k}" for i in range(3000)) for k in range(2)] + ["w1x1 w2x1"]
    for text in [*texts, texts[0]]:
        assert [ids.tolist() for _, ids, _ in encoder.encode(pa.array([text]))] == [plain(text)]


@pytest.mark.parametrize("seed", range(4))
def test_pack_is_whole_and_improves(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, [4096, 1500, 2500, 300][seed], 700) if seed != 2 else rng.integers(900, 2500, 700)
    owner, first = packing.pack(sizes, 4096), packing.best_fit(sizes, 4096)
    assert np.bincount(owner, sizes).max() <= 4096 and set(owner) == set(range(owner.max() + 1))
    assert owner.max() <= first.max()
    assert (np.bincount(owner, sizes) ** 2).sum() >= (np.bincount(first, sizes) ** 2).sum()


def test_local_search_empties_a_bin():
    """Best fit leaves 6+4 / 5+5 style gaps that one exchange closes."""
    bins = packing._Bins(np.array([6, 3, 5, 4, 2]), np.array([0, 0, 1, 1, 2]), 10)
    while any(bins.fill[d] and bins.gap[d] and bins.improve(d) for d in np.argsort(bins.fill, kind="stable").tolist()):
        pass
    assert sorted(bins.fill.tolist()) == [0, 10, 10]


def test_packing_query(spark, docs_of, tmp_path, plain):
    texts = corpus()
    docs_of(list(enumerate(texts))).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.QUERIES["op5_packing"](spark, str(tmp_path)).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(range(len(texts)))
    for doc, pieces in by_doc.items():
        ids = [*plain(texts[doc]), 1]
        for k, r in enumerate(sorted(pieces, key=lambda r: r["piece"])):
            want = ids[k * 4096 : (k + 1) * 4096]
            assert (r["piece"], r["start"], r["length"], r["ids_crc32"]) == (k, k * 4096, len(want), crc(want))
        assert sum(r["length"] for r in pieces) == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 4096
    assert len(by_sequence) <= -(-sum(r["length"] for r in rows) // 4096) + 1


def test_sequences_hold_the_ids(spark, docs_of, tmp_path, plain):
    docs = docs_of([(1, "a b c"), (1, "a b c"), (2, "d " * 5000), (None, "e")])
    packing.token_pieces(docs, TOKENIZER).write.parquet(f"{tmp_path}/pieces")
    placed = packing.pack_pieces(spark.read.parquet(f"{tmp_path}/pieces"), group_pieces=2)
    ids = [np.frombuffer(r["ids"], "<u4").tolist() for r in packing.sequences(placed).collect()]
    want = [[*plain(t), 1] for t in ("a b c", "a b c", "d " * 5000, "e")]
    assert sum(map(len, ids)) == sum(map(len, want)) and max(map(len, ids)) <= 4096
    assert sum(i.count(1) for i in ids) == sum(w.count(1) for w in want)


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind):
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 8, 1000):
        ids = rng.integers(0, 1 << 32, n).astype(np.uint32)
        assert (token_store.from_planes(token_store.to_planes(ids, kind), n, kind) == ids).all()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_store_round_trip(spark, docs_of, tmp_path, plain, kind):
    texts = corpus()
    ids = [None, None, *range(5, 5 + len(texts) - 4), 7, 7]
    rows = list(zip(ids, texts, strict=True))
    random.Random(1).shuffle(rows)
    token_store.write_tokens(docs_of(rows).repartition(5), f"{tmp_path}/store", TOKENIZER, planes=kind, block_ids=500, segment_ids=1200)
    back = token_store.read_tokens(spark, f"{tmp_path}/store", with_ids=True).orderBy("start").collect()
    at, got = 0, []
    for r in back:
        assert r["start"] == at and r["ids_crc32"] == zlib.crc32(r["ids"]) and r["n_tokens"] * 4 == len(r["ids"])
        at += r["n_tokens"]
        got.append((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist())))
    names = [d for d, _ in got]
    assert names == sorted(names, key=lambda d: -1 if d is None else d)
    assert sorted(got, key=repr) == sorted(((d, (*plain(t), 2)) for d, t in rows), key=repr)


def test_store_query_and_empty_tables(spark, docs_of, tmp_path, plain):
    docs_of([(3, "c d"), (1, "a"), (2, None)]).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in queries.QUERIES["op9_token_store"](spark, str(tmp_path)).collect()}
    assert [(rows[i]["start"], rows[i]["n_tokens"]) for i in (1, 2, 3)] == [(0, 2), (2, 1), (3, 3)]
    assert rows[3]["ids_crc32"] == crc([*plain("c d"), 2])
    docs_of([]).write.parquet(f"{tmp_path}/empty/documents.parquet")
    for name in ("op5_packing", "op9_token_store"):
        assert queries.QUERIES[name](spark, f"{tmp_path}/empty").collect() == []


def test_packing_with_names_that_clash(spark):
    df = spark.createDataFrame([(i, 1 + i % 4096, 7, 8, 9, "x") for i in range(20_000)], "row int, length int, sequence_id int, offset int, `group` int, `c0` string")
    placed = packing.pack_pieces(df, group_pieces=1000)
    assert placed.columns == ["row", "length", "group", "c0", "sequence_id", "offset"]
    rows = placed.collect()
    assert sorted(r["row"] for r in rows) == list(range(20_000)) and all(r["length"] == 1 + r["row"] % 4096 and r["group"] == 9 for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False)) and sum(parts[-1]) <= 4096


def test_memory_of_a_worker_stays_small():
    """Arrays of the words' hashes and ids are made for a part of a batch at a time."""
    words = np.random.default_rng(5).integers(0, 1 << 40, 250_000).astype(str)
    texts = pa.array([" ".join(words[k : k + 500]) for k in range(0, len(words), 500)])
    code = (
        "import sys, tracemalloc, numpy, pyarrow as pa\n"
        "from rolecall.llm import tokens, wordbytes\n"
        "texts = pa.array(sys.stdin.read().split('\\n'))\n"
        f"encoder = tokens.Encoder({TOKENIZER!r})\n"
        "tracemalloc.start()\n"
        "for _ in encoder.encode(texts): pass\n"
        "print(tracemalloc.get_traced_memory()[1] >> 20)\n"
    )
    root = Path(tokens.__file__).resolve().parents[2]
    told = subprocess.run([sys.executable, "-c", code], input="\n".join(texts.to_pylist()), capture_output=True, text=True, check=True, cwd=root)
    assert int(told.stdout) < 48, told.stdout


def test_freed_memory_goes_back_to_the_system():
    code = (
        "import pyarrow as pa\n"
        "from rolecall.llm import batches\n"
        "def held():\n"
        "    with open('/proc/self/statm') as f: return int(f.read().split()[1]) >> 8\n"
        "batches.give_back()\n"
        "before = held()\n"
        "rows = [str(k) * 20 for k in range(400_000)]\n"
        "arrays = [pa.array(rows[k : k + 2000]) for k in range(0, len(rows), 2000)]\n"
        "most = held()\n"
        "del rows, arrays\n"
        "batches.give_back()\n"
        "print(most - before, held() - before)\n"
    )
    root = Path(tokens.__file__).resolve().parents[2]
    told = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=root)
    most, left = map(int, told.stdout.split())
    assert most > 80 and left < most / 3, told.stdout
