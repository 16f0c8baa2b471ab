"""Token ids of texts with a public tokenizer, word by word.

The tokenizer's tokens never reach across ASCII white space, nor from an ASCII letter or
digit to one of ``,.!?;:``, so a text's ids are the ids of its words one after another
(this holds for tokenizers that split texts at white space and at punctuation before
they merge, as the given ones with word ends do). Each Python worker encodes a word once and finds it by a
64-bit hash from then on, in a table of bounded size.
"""

import numpy as np
from tokenizers import Tokenizer

from rolecall.llm import wordbytes

_SIGN = np.array([chr(b) in ",.!?;:" for b in range(256)])
_PLAIN = np.array([b < 128 and chr(b).isalnum() for b in range(256)])

#: Bytes of text encoded at once, and words given to the tokenizer at once: what it returns takes some
#: hundred bytes a token until its ids are copied, and a worker keeps the most memory that it once had.
STEP_BYTES = 1 << 18
LEARN_WORDS = 4096


class WordTable:
    """Hashes to entry numbers: open addressing, all steps on whole arrays. A table that is
    full should be cleared between steps; one step may add any number of hashes."""

    def __init__(self, bits: int = 20):
        self.limit = 1 << bits >> 1
        self.size = 0
        self._make(1 << bits)

    def _make(self, slots: int) -> None:
        self.mask = np.uint64(slots - 1)
        self.keys = np.zeros(slots, np.uint64)
        self.values = np.zeros(slots, np.int32)

    @property
    def full(self) -> bool:
        return self.size > self.limit

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The entry of each hash (not 0), or -1."""
        out = np.full(len(hashes), -1, np.int32)
        left = np.arange(len(hashes))
        slot = hashes & self.mask
        while len(left):
            held = self.keys[slot]
            same = held == hashes[left]
            out[left[same]] = self.values[slot[same]]
            on = ~same & (held != 0)
            left, slot = left[on], (slot[on] + np.uint64(1)) & self.mask
        return out

    def add(self, hashes: np.ndarray, first: int) -> None:
        """New distinct hashes, with entries ``first``, ``first`` + 1, ..."""
        entries = np.arange(first, first + len(hashes), dtype=np.int32)
        self.size += len(hashes)
        if self.size * 4 > len(self.keys) * 3:  # a step with very many new words
            held = self.keys != 0
            hashes, entries = np.concatenate([self.keys[held], hashes]), np.concatenate([self.values[held], entries])
            self._make(1 << (2 * self.size - 1).bit_length())
        slot = hashes & self.mask
        while len(hashes):
            free = self.keys[slot] == 0
            places, winner = np.unique(slot[free], return_index=True)
            winner = np.flatnonzero(free)[winner]
            self.keys[places], self.values[places] = hashes[winner], entries[winner]
            on = np.ones(len(hashes), bool)
            on[winner] = False
            hashes, entries, slot = hashes[on], entries[on], (slot[on] + np.uint64(1)) & self.mask


class Encoder:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self._clear()

    def _clear(self) -> None:
        self.table = WordTable()
        self.ids = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1, np.int64)  # of each entry's ids, and the end

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        encoded = self.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(encoded.ids, np.uint32)
        counts = np.bincount(np.array(encoded.word_ids, np.int64), minlength=len(words))
        end = int(self.start[-1])
        while end + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[end : end + len(ids)] = ids
        self.table.add(hashes, len(self.start) - 1)
        self.start = np.concatenate([self.start, end + np.cumsum(counts)])

    def encode(self, column):
        """For each step of the column: (first row, ids, offsets of the rows' ids)."""
        data, offsets = wordbytes.utf8(column)
        for first, last in wordbytes.steps(offsets, STEP_BYTES):
            part = data[offsets[first] : offsets[last]]
            signs = _SIGN[part]
            signs[1:] &= _PLAIN[part[:-1]]
            signs[:1] = False
            words = wordbytes.find_words(part, offsets[first : last + 1] - offsets[first], cut=signs)
            hashes = np.maximum(wordbytes.hash_words(part, words), np.uint64(1))
            if self.table.full:
                self._clear()
            entry = self.table.find(hashes)
            new = np.flatnonzero(entry < 0)
            if len(new):
                unknown, at = np.unique(hashes[new], return_index=True)
                raw = part.tobytes()
                begin, end = words.start[new[at]].tolist(), words.end[new[at]].tolist()
                for k in range(0, len(unknown), LEARN_WORDS):
                    some = slice(k, k + LEARN_WORDS)
                    self._learn(unknown[some], [raw[a:b].decode() for a, b in zip(begin[some], end[some], strict=True)])
                entry[new] = self.table.find(hashes[new])
            size = self.start[entry + 1] - self.start[entry]
            ends = np.concatenate([[0], np.cumsum(size)])
            ids = self.ids[np.repeat(self.start[entry] - ends[:-1], size) + np.arange(ends[-1])]
            yield first, ids, ends[words.first]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker and tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
