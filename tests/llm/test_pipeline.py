"""The whole pipeline against plain Python, stage by stage and end to end."""

import random
import re
import zlib

import corpus_pipeline
import numpy as np
import pytest
from test_decontaminate import brute_force as leaks_of
from test_ngram_join import brute_force as components_of
from test_ngram_join import near_copies
from test_secret_scan import plain as secrets_of
from tokenizers import Tokenizer

from rolecall.llm.queries import TOKENIZER

WORDS = [f"{a}{i}" for a in ("al", "é", "the", "q") for i in range(400)]


def prose(rng, n):
    out = []
    while n > 0:
        k = min(n, rng.randrange(20, 30))
        out.append(" ".join(rng.choices(WORDS, k=k)) + ".")
        n -= k
    return "\n".join(out)


def corpus():
    rng = random.Random(8)
    items = [" ".join(rng.choices(WORDS, k=30)) for _ in range(12)]
    texts = [prose(rng, rng.choice([60, 120, 400])) for _ in range(25)]
    texts += [near_copies(rng, t, rng.choice([0, 1, 2])) for t in texts[:8] for _ in range(3)]
    texts += [f"{texts[20 + k]} start {items[k]} end of it all here now." for k in range(4)]
    texts += [f"{prose(rng, 80)}\nthe password={'%018x' % rng.getrandbits(72)} and AKIA{'ABCDEF12345678'} are kept in line with all of the others, so they say."
              for _ in range(5)]
    texts += ["Home | About | Contact | Help\n" + prose(rng, 90) + "\nclick here", "x | y | z | w\n" * 40, "LOUD WORDS ARE HERE NOW!\n" * 30]
    texts += ["go go go " * 50, "short text.", "", None, prose(rng, 9000)]
    rng.shuffle(texts)
    return list(zip(rng.sample(range(10_000), len(texts)), texts, strict=True)), items


def keeps_line(line):
    words = re.findall(r"[^\x20\x09-\x0D]+", line)
    separators, symbols = len(re.findall(r"[|•·»›]", line)), len(re.findall(r"[#*$%&|<>]", line))
    phrases = "lorem ipsum|enable javascript|cookie policy|privacy policy|terms of use|terms of service|all rights reserved|click here|read more|sign up|log in|subscribe"
    bad = (
        (len(words) < 20 and not re.search(r"[.!?…:;。！？।]+[\"'”’»)\]]*[\x20\x09-\x0D]*\Z", line))
        or (separators >= 3 and separators * 4 >= len(words)) or (symbols >= 3 and symbols * 4 > len(words))
        or (len(words) >= 5 and line.upper() == line and line.lower() != line)
        or (len(words) < 20 and re.search(phrases, line, re.I))
    )
    return not words or not bad


def cleaned(text):
    """The cleaned text, or None when the document goes."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in (i, i + 1, i + 2)} if len(words) < 3000 else set()
    kept = "\n".join(x for x in (text or "").split("\n") if keeps_line(x))
    chars = lambda t: sum(map(len, re.findall(r"[^\x20\x09-\x0D]+", t)))
    if len(words) < 50 or 2 * len(again) > len(words) or 2 * chars(kept) < chars(text or ""):
        return None
    return kept


def masked(text):
    spans = sorted((int(a), int(b)) for _, a, b in (s.split(":") for s in secrets_of(text)))
    out, at = [], 0
    for a, b in spans:
        if a >= at:
            out += [text[at:a], "[SECRET]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def expected(rows, items):
    rows = [(d, c) for d, t in rows if (c := cleaned(t)) is not None]
    rows = [r for r, (d, _, c) in zip(sorted(rows, key=lambda r: r[0]), sorted(components_of(rows)), strict=True) if d == c]
    held = {k for k, _ in leaks_of(items, [t for _, t in rows])}
    rows = [r for k, r in enumerate(rows) if k not in held]
    return {d: masked(t) for d, t in rows}


@pytest.fixture(scope="module")
def tables(spark, docs_of, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    rows, items = corpus()
    docs_of(rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_as_brute_force(spark, tables):
    rows, items = corpus()
    want = expected(rows, items)
    assert 10 < len(want) < len(rows) - 20
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, tables)
        assert docs.columns == list(corpus_pipeline.COLUMNS)
    got = {r["doc_id"]: r for r in docs.collect()}
    assert {d: r["text"] for d, r in got.items()} == want
    assert all(r["n_chars"] == len(r["text"]) and r["lang"] == "en" for r in got.values())

    tokenizer = Tokenizer.from_file(TOKENIZER)
    pieces = corpus_pipeline.run(spark, tables).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    assert set(by_doc) == set(want)
    for doc, parts in by_doc.items():
        ids = [*tokenizer.encode(want[doc], add_special_tokens=False).ids, 1]
        for k, p in enumerate(sorted(parts, key=lambda p: p["piece"])):
            part = np.array(ids[k * 4096 : (k + 1) * 4096], "<u4")
            assert (p["start"], p["length"], p["ids_crc32"]) == (k * 4096, len(part), zlib.crc32(part.tobytes()))
    for parts in by_sequence.values():
        parts.sort(key=lambda p: p["offset"])
        assert all(a["offset"] + a["length"] == b["offset"] for a, b in zip(parts, parts[1:], strict=False))
        assert parts[0]["offset"] == 0 and parts[-1]["offset"] + parts[-1]["length"] <= 4096


def test_empty_tables(spark, docs_of, tmp_path):
    docs_of([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_near_copies_of_five_words_and_four_fifths(spark, docs_of):
    """A text with a fifth more words behind it is a near copy (J = 96 / 116); with half more it is not."""
    words = [f"w{i}" for i in range(150)]
    rows = [(1, " ".join(words[:100])), (2, " ".join(words[:120])), (3, " ".join(words))]
    kept = corpus_pipeline.drop_near_copies(spark, docs_of(rows), "").collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({c for _, _, c in components_of(rows, 5, 80)}) == [1, 3]


def test_names_and_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "ngram_jaccard_join", "benchmark_decontamination", "secret_scan", "best_fit_packing"
    ]
