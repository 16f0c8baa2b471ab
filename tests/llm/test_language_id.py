"""The forward algorithm against all segmentations, and accuracy on held-out documents."""

import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from rolecall.llm import language_id, queries
from rolecall.llm.queries import PIECES


@pytest.fixture(scope="module")
def vocabulary():
    return language_id.Vocabulary(PIECES)


def segmentations(word):
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        for rest in segmentations(word[k:]):
            yield [word[:k], *rest]


def test_vocabulary_is_found_again(vocabulary):
    lattice = language_id.Lattice(["▁the"], vocabulary)
    found = {("▁the"[a:b], vocabulary.pieces[p[0]]) for b in range(1, 5) for a, _, p in lattice.ending(b)}
    assert ("▁the", "▁the") in found and all(a == b for a, b in found)
    assert found == {("▁the"[a:b], vocabulary.pieces[p[0]]) for a in range(4) for b, _, p in lattice.starting(a)}
    wanted = {"▁the"[a:b] for a in range(4) for b in range(a + 1, 5)} & set(vocabulary.pieces)
    assert {a for a, _ in found} == wanted


@pytest.mark.parametrize("word", ["a", "the", "étreñ", "ßчa", "thing"])
def test_sum_over_all_segmentations(vocabulary, word):
    rng = np.random.default_rng(1)
    p = rng.random((len(vocabulary.pieces), 2))
    number = {piece: i for i, piece in enumerate(vocabulary.pieces)}
    text, want = "▁" + word, np.zeros(2)
    for cut in segmentations(text):
        # a letter may also be strange
        ways = [[p[number[c]] if c in number else np.zeros(2)] + ([np.full(2, language_id.STRANGE)] if len(c) == 1 else []) for c in cut]
        want += np.prod([sum(w) for w in ways], axis=0)
    np.testing.assert_allclose(np.exp(language_id.Lattice([text], vocabulary).log_total(p)[0]), want, rtol=1e-9)


def log_sum(text, vocabulary, p):
    """The same by a plain table of logs, for words of any length."""
    number = {piece: i for i, piece in enumerate(vocabulary.pieces)}
    logs = [0.0]
    for end in range(1, len(text) + 1):
        ways = [logs[end - 1] + math.log(language_id.STRANGE)]
        ways += [logs[a] + math.log(p[number[text[a:end]]]) for a in range(max(0, end - vocabulary.longest), end) if text[a:end] in number]
        most = max(ways)
        logs.append(most + math.log(sum(math.exp(w - most) for w in ways)))
    return logs[-1]


def test_words_of_any_length(vocabulary):
    rng = random.Random(4)
    p = np.random.default_rng(4).random((len(vocabulary.pieces), 2)) / 1000
    for text in ("▁" + "".join(rng.choices("abcdeéñ日本", k=500)), "▁" + "the" * 3000, "▁" + "ж" * 47, "▁" + "x" * 16, "▁" + "q" * 15):
        total = language_id.Lattice([text, text], vocabulary).log_total(p)
        for language in (0, 1):
            np.testing.assert_allclose(total[:, language], log_sum(text, vocabulary, p[:, language]), rtol=1e-9)


@pytest.mark.parametrize("word", ["a", "the", "étreñ", "thing", "ßчaxyz"])
def test_expected_numbers_of_pieces(vocabulary, word):
    rng = np.random.default_rng(5)
    p, text = rng.random((len(vocabulary.pieces), 2)), "▁" + word
    number = {piece: i for i, piece in enumerate(vocabulary.pieces)}
    want, total = np.zeros(len(p)), 0.0
    for cut in segmentations(text):
        for strange in itertools.product(*[[False] * (c in number) + [True] * (len(c) == 1) for c in cut]):
            weight = math.prod(language_id.STRANGE if s else p[number[c], 1] for c, s in zip(cut, strange, strict=True))
            total += weight
            for c, s in zip(cut, strange, strict=True):
                if not s:
                    want[number[c]] += weight
    found = np.zeros(len(p))
    for rows, piece, expected in language_id.Lattice([text, text], vocabulary).expected(p, np.array([0, 1])):
        np.add.at(found, piece[rows == 1], expected[rows == 1])
    np.testing.assert_allclose(found, want / total, rtol=1e-9, atol=1e-12)


def test_expected_numbers_of_long_words(vocabulary):
    """Each letter is in one piece or strange, whatever the length."""
    p = np.random.default_rng(6).random((len(vocabulary.pieces), 1)) / 100
    length = np.array([len(x) for x in vocabulary.pieces])
    for text in ("▁" + "the" * 400, "▁" + "a" * 33):
        covered = sum((expected * length[piece]).sum() for _, piece, expected in language_id.Lattice([text], vocabulary).expected(p, np.array([0])))
        assert covered == pytest.approx(len(text), rel=1e-3)


def test_training_as_plain_expectation_maximisation(spark, docs_of, vocabulary):
    texts = {"en": ["the thing ½ is", "That is The the"], "fr": ["été le la", "la thing"]}
    docs = docs_of([(i, t) for i, t in enumerate(texts["en"])], "en").unionByName(docs_of([(10 + i, t) for i, t in enumerate(texts["fr"])], "fr"))
    number = {piece: i for i, piece in enumerate(vocabulary.pieces)}
    model = language_id.train(docs, PIECES, rounds=2, smooth=0.1)
    assert model.languages == ["en", "fr"]
    for column, language in enumerate(model.languages):
        words = [w for t in texts[language] for w in re.findall(r"[^\W\d_½]+", t.lower())]
        p = None
        for _ in range(3):
            counts = np.full(len(vocabulary.pieces), 0.1)
            for word in words:
                text = "▁" + word
                if p is None:
                    for a, b in itertools.combinations(range(len(text) + 1), 2):
                        if text[a:b] in number:
                            counts[number[text[a:b]]] += 1
                    continue
                cuts = [[(c, s) for c, s in zip(cut, strange, strict=True)] for cut in segmentations(text)
                        for strange in itertools.product(*[[False] * (c in number) + [True] * (len(c) == 1) for c in cut])]
                weights = [math.prod(language_id.STRANGE if s else p[number[c]] for c, s in cut) for cut in cuts]
                for cut, weight in zip(cuts, weights, strict=True):
                    for c, s in cut:
                        if not s:
                            counts[number[c]] += weight / sum(weights)
            p = counts / counts.sum()
        np.testing.assert_allclose(model.p[:, column], p, rtol=1e-6)


def test_texts_are_sums_of_words(vocabulary):
    rng = np.random.default_rng(2)
    p = rng.random((len(vocabulary.pieces), 3))
    p /= p.sum(axis=0)
    scorer = language_id.Scorer(vocabulary, p)
    long = "x" * 500
    texts = ["The THE the", "", None, "1 2 — … ½ ² ① Ⅷ", "été's", f"{long} a", "the½été"]
    for _ in range(2):
        logs, lettered = scorer.texts(pa.array(texts))
        assert lettered.tolist() == [True, False, False, False, True, True, True]
        one = scorer.of(["the", "été", "s", long, "a"])
        np.testing.assert_allclose(logs[0], 3 * one[0], rtol=1e-5)
        np.testing.assert_allclose(logs[4], one[1] + one[2], rtol=1e-5)
        np.testing.assert_allclose(logs[5], one[3] + one[4], rtol=1e-5)
        np.testing.assert_allclose(logs[6], one[0] + one[1], rtol=1e-5)
        assert not logs[[1, 2, 3]].any()


def test_one_text_with_more_words_than_slots(vocabulary):
    p = np.random.default_rng(3).random((len(vocabulary.pieces), 2))
    p /= p.sum(axis=0)
    few, many = language_id.Scorer(vocabulary, p), language_id.Scorer(vocabulary, p)
    few.bits = 4
    few._clear()
    letters = "abcdefgh"
    text = " ".join(a + b + c for a in letters for b in letters for c in letters)
    for t in (text, "the", text):
        np.testing.assert_allclose(few.texts(pa.array([t]))[0], many.texts(pa.array([t]))[0], rtol=1e-5)


def test_held_out_accuracy(spark):
    rows = queries.QUERIES["op4_language_id"](spark, "/root/testdata/sf0.001").collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(docs) and 20 < len(held) < len(rows) / 2
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_rows(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["uno", "dos", "que"], k=9)), "es", "s", 1) for i in range(30)]
    rows += [(100 + i, " ".join(rng.choices(["the", "with", "of"], k=9)), "en", "s", 1) for i in range(30)]
    rows += [(None, "the with", None, "s", 1), (900, None, "en", "s", 1), (901, "½ ² 42 ?", "en", "s", 1), (902, "", None, None, None), (7, "que", "es", "s", 1)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    out = {r["doc_id"]: r for r in queries.QUERIES["op4_language_id"](spark, str(tmp_path)).collect()}
    assert out[None]["lang_pred"] == "en" and out[None]["held_out"] is False
    assert {i: (out[i]["lang_pred"], out[i]["score"]) for i in (900, 901, 902)} == dict.fromkeys((900, 901, 902), ("und", 0.0))
    assert out[105]["lang_pred"] == "en" and out[7]["lang_pred"] == "es"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert queries.QUERIES["op4_language_id"](spark, f"{tmp_path}/none").collect() == []
    spark.createDataFrame([(1, "a", None, "s", 1)], schema).write.parquet(f"{tmp_path}/unlabelled/documents.parquet")
    assert queries.QUERIES["op4_language_id"](spark, f"{tmp_path}/unlabelled").collect()[0]["lang_pred"] == "und"
