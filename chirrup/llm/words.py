"""Words of whole batches of texts, and their hashes."""

import numpy as np
import pandas as pd
import pyarrow as pa

from chirrup.llm.pretokens import words_of

# The white space between words is the space and the five ASCII controls from tab on.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins and ends of the words, and the first word of each text; `offsets` spans all of `data`."""
    solid = ~WHITE[data]
    opens = np.zeros(len(data) + 1, bool)
    opens[offsets] = True
    begin, end = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1] | opens[1:-1]
    end[:-1] &= ~solid[1:] | opens[1:-1]
    begins = np.flatnonzero(begin)
    return begins, np.flatnonzero(end) + 1, np.searchsorted(begins, offsets)


def coded_words(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.BinaryArray]:
    """Codes of the words and the distinct words."""
    if not len(begins):
        return np.zeros(0, np.int32), pa.array([], pa.binary())
    # Every second piece is a word: words and what lies between them, without a copy.
    pieces = words_of(data, np.append(np.stack([begins, ends], 1).ravel(), len(data)))
    coded = pieces.take(pa.array(np.arange(0, 2 * len(begins), 2, dtype=np.int32))).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def hashed_words(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process."""
    codes, words = coded_words(data, begins, ends)
    if not len(codes):
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False)[codes]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finalizer of the public-domain generator splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` words, by its first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    value = np.zeros(n, np.uint64)
    for k in range(size):
        value = mixed(value + hashes[k : k + n] + np.uint64(0x9E3779B97F4A7C15))
    return value


def within(first: np.ndarray, size: int) -> np.ndarray:
    """The places from which a run of `size` words stays in its text."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    total = int(counts.sum())
    return np.arange(total) + np.repeat(first[:-1] - (np.cumsum(counts) - counts), counts)
