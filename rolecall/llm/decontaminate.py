"""Benchmark decontamination: training passages query a BM25 index of test items.

Passages are overlapping windows of words. BM25 impacts of an item are scaled so that
any passage holding 0.8 of its five-word shingles scores 1 or more (see ``Index``), and
block-max WAND returns every item at 1 or above. Before that, one vector step per batch
adds up each item's rarer terms by window and skips the windows in which no item can
reach 1 even with all of its other terms. Found items are verified by shingles.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rolecall.llm import batches, sketches, wordbytes

#: What parts words here: every ASCII character but letters and digits.
BREAK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
WIDTH = 5
SHARE = 0.8
BLOCK = 16  # postings that share an upper bound
HIT = "array<struct<item_id:bigint,score:double,question:double,answer:double,first_word:int,last_word:int>>"
_HIT = pa.list_(pa.struct([
    ("item_id", pa.int64()), ("score", pa.float64()), ("question", pa.float64()), ("answer", pa.float64()),
    ("first_word", pa.int32()), ("last_word", pa.int32()),
]))


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, wordbytes.Words]:
    data = wordbytes.LOWER[data]
    words = wordbytes.find_words(data, offsets, BREAK)
    return wordbytes.hash_words(data, words), words


def _shingles(hashes: np.ndarray, width: int = WIDTH) -> np.ndarray:
    one = wordbytes.Words(None, None, None, np.array([0, len(hashes)]))
    return np.unique(wordbytes.shingles(hashes, one, width)[0])


@dataclass
class Item:
    item_id: int
    parts: list[tuple[int, np.ndarray]]  # shingle width and shingles of question and answer, or of the whole


@dataclass
class Index:
    """Inverted index of items with BM25 impacts.

    An item may miss a fifth of its shingles, so at most as many of its words. Its
    impacts are divided by what is left of its own score when the heaviest of these
    are gone: a passage that holds the rest scores 1.
    """

    items: list[Item]
    terms: np.ndarray  # sorted hashes
    first: np.ndarray  # first posting of each term, and the end
    posting: np.ndarray  # items of a term, ascending
    impact: np.ndarray
    window: int  # words of a passage; windows start every half of it

    @staticmethod
    def of(ids: list[int], texts: list[str], k1: float = 1.2, b: float = 0.75) -> "Index":
        data, offsets = wordbytes.utf8(pa.array(texts, pa.string()))
        hashes, words = _words(data, offsets)
        items, rows, lengths = [], [], []
        for i, (item_id, text) in enumerate(zip(ids, texts, strict=True)):
            a, z = int(words.first[i]), int(words.first[i + 1])
            if a == z:
                continue
            of = hashes[a:z]
            asked = text.encode().rfind(b"?")
            cut = int(np.searchsorted(words.start[a:z], int(offsets[i]) + asked)) if asked >= 0 else 0
            # without a question before an answer the whole item is one part
            parts = [of[:cut], of[cut:]] if 0 < cut < len(of) else [of]
            items.append(Item(item_id, [(min(WIDTH, len(p)), _shingles(p)) for p in parts]))
            rows.append(np.unique(of, return_counts=True))
            lengths.append(len(of))
        if not items:
            return Index([], np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0), 2)
        owner = np.repeat(np.arange(len(items)), [len(t) for t, _ in rows])
        tf = np.concatenate([c for _, c in rows]).astype(float)
        terms, term = np.unique(np.concatenate([t for t, _ in rows]), return_inverse=True)
        df = np.bincount(term)
        idf = np.log1p((len(items) - df + 0.5) / (df + 0.5))
        length = np.array(lengths, float)
        impact = idf[term] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * (length / length.mean())[owner]))
        begin = np.concatenate([[0], np.cumsum([len(t) for t, _ in rows])]).tolist()
        for item, a, z in zip(items, begin[:-1], begin[1:], strict=True):  # an item's postings stand together here
            missing = int((1 - SHARE) * sum(len(s) for _, s in item.parts) + 1e-9) + 1
            weights = np.sort(impact[a:z])
            left = weights[: max(1, len(weights) - missing)].sum() if len(weights) > missing else weights[:1].sum()
            impact[a:z] /= left
        order = np.lexsort([owner, term])
        first = np.concatenate([[0], np.cumsum(df)])
        return Index(items, terms, first, owner[order], impact[order], max(64, int(2.5 * max(lengths)) // 2 * 2))

    def term_of(self, hashes: np.ndarray) -> np.ndarray:
        """The term of each word, or the number of terms."""
        if not len(self.terms):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, len(self.terms))


def block_max_wand(index: Index, query: list[int], least: float = 1 - 1e-9) -> list[tuple[int, float]]:
    """(item, score) of every item whose impacts over the distinct query terms reach ``least``."""
    cursors = []  # [current item, place, end, upper bound, first place]
    for t in query:
        a, z = int(index.first[t]), int(index.first[t + 1])
        cursors.append([int(index.posting[a]), a, z, float(index.impact[a:z].max()), a])
    out = []

    def seek(c, item):
        c[1] += int(np.searchsorted(index.posting[c[1] : c[2]], item))
        c[0] = int(index.posting[c[1]]) if c[1] < c[2] else -1

    while cursors:
        cursors.sort(key=lambda c: c[0])
        total, pivot = 0.0, -1
        for j, c in enumerate(cursors):
            total += c[3]
            if total >= least:
                pivot = j
                break
        if pivot < 0:
            break
        item = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
            pivot += 1
        bound, beyond = 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else len(index.items)
        for c in cursors[: pivot + 1]:
            place = c[1] + int(np.searchsorted(index.posting[c[1] : c[2]], item))
            if place >= c[2]:
                continue
            begin = c[4] + (place - c[4]) // BLOCK * BLOCK
            end = min(begin + BLOCK, c[2])
            bound += float(index.impact[begin:end].max())
            beyond = min(beyond, int(index.posting[end - 1]) + 1)
        if bound < least:  # no item of these blocks can reach it
            for c in cursors[: pivot + 1]:
                seek(c, max(beyond, item + 1))
        elif cursors[0][0] == item:
            here = cursors[: pivot + 1]
            score = sum(float(index.impact[c[1]]) for c in here)
            if score >= least:
                out.append((item, score))
            for c in here:
                seek(c, item + 1)
        else:
            for c in cursors[:pivot]:
                if c[0] < item:
                    seek(c, item)
        cursors = [c for c in cursors if c[0] >= 0]
    return out


class Searcher:
    """The index and its terms that are rare in the corpus, for the vector step."""

    def __init__(self, index: Index, counts: np.ndarray, rest: float = 0.6):
        self.index = index
        n = len(index.items)
        term = np.repeat(np.arange(len(index.terms)), np.diff(index.first))
        # of each item's postings, common terms first: as long as they weigh less than ``rest`` together, they can wait
        order = np.lexsort([-counts[term], index.posting]) if n else np.zeros(0, np.int64)
        sums = np.cumsum(index.impact[order])
        starts = np.searchsorted(index.posting[order], np.arange(n))
        before = np.concatenate([[0.0], sums])[starts]
        running = sums - before[index.posting[order]]
        waits = running < rest
        self.rest = np.zeros(n)
        np.maximum.at(self.rest, index.posting[order][waits], running[waits])
        rare = np.zeros(len(term), bool)
        rare[order[~waits]] = True
        self.posting, self.impact = index.posting[rare], index.impact[rare]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(term[rare], minlength=len(index.terms) + 1))])

    def _windows(self, terms: np.ndarray, words: wordbytes.Words) -> np.ndarray:
        """First words of the windows in which some item may reach 1."""
        half, n = self.index.window // 2, len(self.index.items)
        known = np.flatnonzero(self.first[terms + 1] > self.first[terms]) if n else np.zeros(0, np.int64)
        many = self.first[terms[known] + 1] - self.first[terms[known]]
        at = np.repeat(self.first[terms[known]] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        item, weight = self.posting[at], self.impact[at]
        # halves are numbered through all texts; a window is a half and the next one
        halves = -(-np.diff(words.first) // half) + 1
        base = np.concatenate([[0], np.cumsum(halves)])
        row = words.row[known]
        place = np.repeat(base[row] + (known - words.first[row]) // half, many)
        key, of = np.unique(place * n + item, return_inverse=True)
        mine = np.bincount(of, weight, len(key))
        after = np.searchsorted(key, key + n)
        follows = after < len(key)
        follows[follows] = key[after[follows]] == key[follows] + n
        both = mine + np.where(follows, mine[np.minimum(after, len(key) - 1)], 0.0) if len(key) else mine
        good = [key[both + self.rest[key % n] >= 1 - 1e-9] // n] if n else []
        # the half before the first one of an item
        if n:
            good.append(key[mine + self.rest[key % n] >= 1 - 1e-9] // n - 1)
        starts = np.unique(np.concatenate(good)) if good else np.zeros(0, np.int64)
        starts = starts[starts >= 0]
        text = np.searchsorted(base, starts, "right") - 1
        first = words.first[text] + (starts - base[text]) * half
        return np.stack([text[first < words.first[text + 1]], first[first < words.first[text + 1]]])

    def search(self, column) -> list[list[dict]]:
        """For each text its verified items, each at its best window."""
        data, offsets = wordbytes.utf8(column)
        out: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
        for first, last in wordbytes.steps(offsets):
            hashes, words = _words(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
            terms = self.index.term_of(hashes)
            best: dict[tuple[int, int], dict] = {}
            for text, begin in self._windows(terms, words).T.tolist():
                end = min(begin + self.index.window, int(words.first[text + 1]))
                query = np.unique(terms[begin:end])
                held: dict[int, np.ndarray] = {}
                for i, score in block_max_wand(self.index, query[query < len(self.index.terms)].tolist()):
                    item, shares = self.index.items[i], []
                    for width, shingles in item.parts:
                        if width not in held:
                            held[width] = _shingles(hashes[begin:end], width)
                        shares.append(np.isin(shingles, held[width]).mean())
                    if min(shares) >= SHARE and score > best.get((text, i), {"score": 0})["score"]:
                        at = int(words.first[text])
                        best[text, i] = {
                            "item_id": item.item_id, "score": float(score), "question": float(shares[0]),
                            "answer": float(shares[-1]), "first_word": begin - at, "last_word": end - 1 - at,
                        }
            for (text, i), hit in sorted(best.items()):
                out[first + text].append(hit)
        return out


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    block_bytes: int = 1 << 24,
) -> Column:
    """array<struct<item_id, score, question, answer, first_word, last_word>>: the test
    items that a text contains.

    An item counts when one window of the text holds 0.8 of the five-word shingles of
    its question and 0.8 of those of its answer (what follows its last question mark);
    an item without both counts by 0.8 of all its shingles, which ``question`` and
    ``answer`` both show then. A part of fewer words is one shingle. ``score`` is the
    scaled BM25 score, the words are those of the best window. Items without words and
    with a null id are left out; null and empty texts contain none; equal items count each.

    The benchmark is indexed in blocks of about ``block_bytes`` of text, each small
    enough to be sent to every task; the texts are read twice, once to count the terms.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(item_text).alias("text")).where(
        "item_id is not null and text is not null"
    )
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()["bytes"]
    blocks = 1 + size // block_bytes
    parts = []
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        index = Index.of([r["item_id"] for r in own], [r["text"] for r in own])
        parts.append(_hits_of(docs, text, index))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def _hits_of(docs: DataFrame, text: str, index: Index) -> Column:
    spark = docs.sparkSession
    shared_index = spark.sparkContext.broadcast(index)

    def count(batch, array):
        index = shared_index.value
        data, offsets = wordbytes.utf8(batch[0])
        for first, last in wordbytes.steps(offsets):
            hashes, _ = _words(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
            array[: len(index.terms) + 1] += np.bincount(index.term_of(hashes), minlength=len(index.terms) + 1)

    counts = sketches.add_up(docs.select(text), count, len(index.terms) + 1, np.int64)
    shared = spark.sparkContext.broadcast(Searcher(index, counts))

    @F.arrow_udf(HIT)
    def search(texts: pa.Array) -> pa.Array:
        hits = pa.array(shared.value.search(texts), _HIT)
        batches.give_back()
        return hits

    return search(F.col(text))
