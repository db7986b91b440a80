"""Words and word shingles of whole texts as 64-bit numbers, for many texts at once.

Words are what ASCII white space leaves, with A-Z in lower case. Numbers stand for words
and shingles: two different ones among n share a number with probability n^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

import numpy as np
import xxhash

WIDTH = 5
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_FINAL = np.uint64(0xD6E8FEB86659FD93)


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


class WordTable(dict):
    """The numbers of the words met so far, for `word_numbers` of one text after the other; it starts anew when it is full."""

    MOST = 100_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        number = self[word] = xxhash.xxh3_64_intdigest(word)
        return number


def word_numbers(
    texts: Sequence[str | None], strip: bytes = b"", known: WordTable | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all words of the texts in a row, and how many words each text has.

    Characters of `strip` at either end of a word do not count; `known` is for words that are not stripped.
    """
    lists = [words_of(text) if text else [] for text in texts]
    flat = list(chain.from_iterable(lists))
    table = known if known is not None else {word: xxhash.xxh3_64_intdigest(word.strip(strip) if strip else word) for word in dict.fromkeys(flat)}
    numbers = np.fromiter(map(table.__getitem__, flat), np.uint64, len(flat))
    return numbers, np.fromiter(map(len, lists), np.int64, len(lists))


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _FINAL
    return values ^ (values >> np.uint64(29))


def runs(numbers: np.ndarray, width: int) -> np.ndarray:
    """The number of every run of `width` neighbours, also of runs across texts."""
    if len(numbers) < width:
        return np.zeros(0, np.uint64)
    total = numbers[:len(numbers) - width + 1].copy()
    for step in range(1, width):
        total = total * _FACTOR + numbers[step:len(numbers) - width + 1 + step]
    return mixed(total)


def shingle_sets(texts: Sequence[str | None], width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingles of each text; a shorter text is one shingle, one without words none."""
    numbers, lengths = word_numbers(texts)
    every = runs(numbers, width)
    out, at = [], 0
    for length in lengths.tolist():
        if length >= width:
            out.append(np.unique(every[at:at + length - width + 1]))
        elif length:
            total = np.array([length], np.uint64)
            for i in range(at, at + length):
                total = total * _FACTOR + numbers[i:i + 1]
            out.append(mixed(total))
        else:
            out.append(np.zeros(0, np.uint64))
        at += length
    return out
