"""Language identification by unigram pieces, summed over all segmentations of a word.

Each language has a probability for every piece of a fixed public vocabulary. A word's
probability is the sum over all ways to cut it into pieces (forward algorithm); a text's
is the product over its words. Words are runs of letters in lower case. Probabilities are
learnt by expectation maximisation with the same sums, and words are scored many at a
time; a Python worker scores a word once and finds it by a 64-bit hash from then on.
"""

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from rolecall.llm import sketches, wordbytes
from rolecall.llm.tokens import WordTable
from rolecall.sources.sinks import stage

#: Probability of a letter that no piece covers.
STRANGE = 1e-6
#: Letters after which sums are scaled, so that words of any length stay within floats.
SCALE = 16
_START = "▁"
#: Letters are the characters of the Unicode category L, in training and prediction alike.
LETTERS = r"\p{L}+"
_LETTERS = regex.compile(LETTERS)
_BREAK = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])
_PRIME = 0x9E3779B97F4A7C15


class Vocabulary:
    """The pieces of a sentencepiece file that are made of letters and the word start."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
        kept = {p.lower() for p in pieces if _LETTERS.fullmatch(p.strip(_START)) or p == _START}
        self.pieces = sorted((p for p in kept if _START not in p[1:]), key=lambda p: (len(p), p))
        self.longest = len(self.pieces[-1])
        self.table = WordTable(bits=int(2 * len(self.pieces) + 2).bit_length())
        for length, group in groupby(self.pieces, key=len):
            group = list(group)
            self.table.add(Spans(group).hashes([0], length)[:, 0], self.table.size)


def _codes(words: list[str]) -> np.ndarray:
    """Code points, one row per word; words are of one length."""
    return np.array(words, f"<U{len(words[0])}").view(np.uint32).reshape(len(words), -1)


class Spans:
    """Hashes of the letters between two places of words of one length."""

    def __init__(self, words: list[str]):
        codes = _codes(words)
        self.powers, self.back = wordbytes.powers(_PRIME, codes.shape[1])
        self.sums = np.zeros((len(words), codes.shape[1] + 1), np.uint64)
        np.cumsum(wordbytes.mix(codes.astype(np.uint64) + np.uint64(_PRIME)) * self.powers[:-1], axis=1, out=self.sums[:, 1:])

    def hashes(self, starts, end: int) -> np.ndarray:
        """(word, start); not 0."""
        starts = np.asarray(starts)
        return np.maximum(wordbytes.mix((self.sums[:, [end]] - self.sums[:, starts]) * self.back[starts]), np.uint64(1))

    def hashes_from(self, start: int, ends: np.ndarray) -> np.ndarray:
        """(word, end); not 0."""
        return np.maximum(wordbytes.mix((self.sums[:, ends] - self.sums[:, [start]]) * self.back[start]), np.uint64(1))


class Lattice:
    """All segmentations of some words of one length. Pieces are looked up as the sums
    go on, so nothing grows with the square of a word."""

    def __init__(self, words: list[str], vocabulary: Vocabulary):
        self.spans, self.vocabulary = Spans(words), vocabulary
        self.n, self.length = len(words), len(words[0])

    def ending(self, end: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(start, words, their pieces) of the pieces that end at ``end``."""
        starts = np.arange(max(0, end - self.vocabulary.longest), end)
        found = self.vocabulary.table.find(self.spans.hashes(starts, end).ravel()).reshape(self.n, -1)
        for start, piece in zip(starts.tolist(), found.T, strict=True):
            known = np.flatnonzero(piece >= 0)
            if len(known):
                yield start, known, piece[known]

    def log_total(self, p: np.ndarray) -> np.ndarray:
        """(word, language): log of the sum over all segmentations."""
        window = deque([np.ones((self.n, p.shape[1]))], maxlen=self.vocabulary.longest + 1)
        log = np.zeros((self.n, p.shape[1]))
        for end in range(1, self.length + 1):
            here = window[-1] * STRANGE
            for start, rows, piece in self.ending(end):
                here[rows] += window[start - end][rows] * p[piece]
            window.append(here)
            log = log + _rescaled(window, end)
        return log + np.log(window[-1])

    def starting(self, start: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(end, words, their pieces) of the pieces that start at ``start``."""
        ends = np.arange(start + 1, min(self.length, start + self.vocabulary.longest) + 1)
        found = self.vocabulary.table.find(self.spans.hashes_from(start, ends).ravel()).reshape(self.n, -1)
        for end, piece in zip(ends.tolist(), found.T, strict=True):
            known = np.flatnonzero(piece >= 0)
            if len(known):
                yield end, known, piece[known]

    def expected(self, p: np.ndarray, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(words, pieces, expected numbers) of all pieces, each word in its ``own`` language.
        The sums up to every place are kept with their scales; those from a place on roll."""
        before, up = np.ones((self.length + 1, self.n)), np.zeros((self.length + 1, self.n))
        window, scale = deque([before[0].copy()], maxlen=self.vocabulary.longest + 1), np.zeros(self.n)
        for end in range(1, self.length + 1):
            here = window[-1] * STRANGE
            for start, rows, piece in self.ending(end):
                here[rows] += window[start - end][rows] * p[piece, own[rows]]
            window.append(here)
            scale = scale + _rescaled(window, end)
            before[end], up[end] = here, scale
        total, top = before[-1], up[-1]
        window, scale = deque([np.ones(self.n)], maxlen=self.vocabulary.longest + 1), np.zeros(self.n)
        for start in range(self.length - 1, -1, -1):
            here = window[-1] * STRANGE
            for end, rows, piece in self.starting(start):
                later = window[start - end][rows] * p[piece, own[rows]]
                here[rows] += later
                yield rows, piece, before[start, rows] * later * np.exp(up[start, rows] + scale[rows] - top[rows]) / total[rows]
            window.append(here)
            scale = scale + _rescaled(window, self.length - start)


def _rescaled(window: deque, step: int):
    """Every ``SCALE`` steps divides the window's sums by the greatest; the log of that."""
    if step % SCALE:
        return 0.0
    most = np.max(window, axis=0)
    for sums in window:
        sums /= most
    return np.log(most)


def _by_length(words: list[str], letters: int = 160_000):
    """(indices, words) of one length each; the word start stands before every word."""
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    for length, indices in sorted(groups.items()):
        step = max(1, letters // (length + 1))
        for k in range(0, len(indices), step):
            part = indices[k : k + step]
            yield part, [_START + words[i] for i in part]


class Scorer:
    """Log probabilities of words in each language, remembered in a table of bounded size."""

    def __init__(self, vocabulary: Vocabulary, p: np.ndarray):
        self.vocabulary, self.p = vocabulary, p
        self.bits = max(10, min(21, int((1 << 26) // (4 * p.shape[1])).bit_length()))
        self._clear()

    def _clear(self) -> None:
        self.table = WordTable(self.bits)
        self.scores = np.zeros((0, self.p.shape[1]), np.float32)
        self.letters = np.zeros(0, bool)
        self.used = 0

    def of(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), self.p.shape[1]))
        for rows, group in _by_length(words):
            out[rows] = Lattice(group, self.vocabulary).log_total(self.p)
        return out

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        parts = [_LETTERS.findall(w.lower()) for w in words]
        flat = self.of([p for ps in parts for p in ps])
        ends = np.concatenate([[0], np.cumsum([len(ps) for ps in parts])])
        sums = np.concatenate([np.zeros((1, self.p.shape[1])), np.cumsum(flat, axis=0)])
        need = self.used + len(words)
        if need > len(self.scores):
            more = max(need, 2 * len(self.scores)) - len(self.scores)
            self.scores = np.concatenate([self.scores, np.zeros((more, self.p.shape[1]), np.float32)])
            self.letters = np.concatenate([self.letters, np.zeros(more, bool)])
        self.scores[self.used : need] = sums[ends[1:]] - sums[ends[:-1]]
        self.letters[self.used : need] = np.diff(ends) > 0
        self.table.add(hashes, self.used)
        self.used = need

    def texts(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of each text in each language, and whether it has a letter."""
        data, offsets = wordbytes.utf8(column)
        out = np.zeros((len(offsets) - 1, self.p.shape[1]))
        lettered = np.zeros(len(offsets) - 1, bool)
        for first, last in wordbytes.steps(offsets):
            part = wordbytes.LOWER[data[offsets[first] : offsets[last]]]
            words = wordbytes.find_words(part, offsets[first : last + 1] - offsets[first], _BREAK)
            hashes = np.maximum(wordbytes.hash_words(part, words), np.uint64(1))
            if self.table.full:
                self._clear()
            entry = self.table.find(hashes)
            new = np.flatnonzero(entry < 0)
            if len(new):
                unknown, at = np.unique(hashes[new], return_index=True)
                raw = part.tobytes()
                begin, end = words.start[new[at]].tolist(), words.end[new[at]].tolist()
                self._learn(unknown, [raw[a:b].decode() for a, b in zip(begin, end, strict=True)])
                entry[new] = self.table.find(hashes[new])
            sums = np.zeros((len(entry) + 1, self.p.shape[1]))
            np.cumsum(self.scores[entry], axis=0, dtype=float, out=sums[1:])
            out[first:last] = sums[words.first[1:]] - sums[words.first[:-1]]
            count = np.concatenate([[0], np.cumsum(self.letters[entry])])
            lettered[first:last] = count[words.first[1:]] > count[words.first[:-1]]
        return out, lettered


@dataclass
class Model:
    languages: list[str]
    p: np.ndarray  # piece, language
    vocabulary: str


def train(
    df: DataFrame, vocabulary: str, text: str = "text", lang: str = "lang", key: str = "doc_id",
    sample_docs: int = 500, rounds: int = 2, smooth: float = 0.1,
) -> Model:
    """Piece probabilities of every non-null language of ``df``.

    Fitted on a bounded sample: of each language the ``sample_docs`` documents with the
    least hash of ``key`` (documents that tie with the last are taken too). Their words
    are counted by Spark; each round of expectation maximisation is one pass over the
    distinct words, and what comes to the driver is one number per piece and language.
    ``vocabulary`` is the path of a sentencepiece file that every executor has.
    """
    spark = df.sparkSession
    labelled = df.select(F.col(lang).alias("lang"), F.xxhash64(F.col(key)).alias("h"), F.col(text).alias("text")).where("lang is not null")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    ranked = labelled.select("lang", "h").withColumn("r", rank).where(F.col("r") <= sample_docs)
    bounds = {r["lang"]: r["h"] for r in ranked.groupBy("lang").agg(F.max("h").alias("h")).collect()}
    languages = sorted(bounds)
    if not languages:
        return Model([], np.zeros((len(Vocabulary(vocabulary).pieces), 0)), vocabulary)
    limit = F.create_map(*[x for language in languages for x in (F.lit(language), F.lit(bounds[language]))])[F.col("lang")]
    number = F.create_map(*[x for i, language in enumerate(languages) for x in (F.lit(language), F.lit(i))])[F.col("lang")]
    runs = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(LETTERS), F.lit(0))
    words = stage(
        labelled.where(F.col("h") <= limit).select(number.alias("l"), F.explode(runs).alias("word"))
        .groupBy("l", "word").agg(F.count(F.lit(1)).alias("n")), "words",
    )
    size = len(_vocabulary(vocabulary).pieces)

    def passes(p):
        shared = spark.sparkContext.broadcast(p)

        def expect(batch, array):
            voc, p, counts = _vocabulary(vocabulary), shared.value, array[: size * len(languages)].reshape(size, -1)
            of, many = np.asarray(batch["l"]).astype(np.int64), np.asarray(batch["n"]).astype(float)
            for rows, group in _by_length(batch["word"].to_pylist()):
                lattice, l, n = Lattice(group, voc), of[rows], many[rows]
                if p is None:  # at first every piece found in a word counts alike
                    found = ((known, piece, 1.0) for end in range(1, lattice.length + 1) for _, known, piece in lattice.ending(end))
                else:
                    found = lattice.expected(p, l)
                for known, piece, expected in found:
                    np.add.at(counts, (piece, l[known]), expected * n[known])

        return sketches.add_up(words, expect, size * len(languages), np.float64).reshape(size, -1)

    p = None
    for _ in range(rounds + 1):
        counts = passes(p) + smooth
        p = counts / counts.sum(axis=0)
    return Model(languages, p, vocabulary)


_kept: dict[str, Vocabulary] = {}


def _vocabulary(path: str) -> Vocabulary:
    if path not in _kept:
        _kept[path] = Vocabulary(path)
    return _kept[path]


_scorers: dict[int, Scorer] = {}


def predict(df: DataFrame, model: Model, text: str = "text") -> Column:
    """struct<lang, score> of a text: the likeliest language and its share of the
    likelihood. Null texts and texts without a letter are ``und`` with score 0, as are all
    texts of a model without languages; equal languages go to the first by name. No shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    key = hash((model.p.tobytes(), tuple(model.languages)))

    @F.arrow_udf("struct<lang:string,score:double>")
    def guess(texts: pa.Array) -> pa.Array:
        model = shared.value
        if not model.languages:
            names, scores = ["und"] * len(texts), [0.0] * len(texts)
        else:
            if key not in _scorers:
                _scorers.clear()
                _scorers[key] = Scorer(_vocabulary(model.vocabulary), model.p)
            logs, lettered = _scorers[key].texts(texts)
            best = logs.argmax(axis=1)
            shares = 1 / np.exp(np.maximum(logs - logs.max(axis=1, keepdims=True), -700)).sum(axis=1)
            names = [model.languages[b] if some else "und" for b, some in zip(best.tolist(), lettered.tolist(), strict=True)]
            scores = np.where(lettered, shares, 0.0).tolist()
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return guess(F.col(text))
