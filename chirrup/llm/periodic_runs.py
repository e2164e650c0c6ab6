"""Periodic runs of words, by block convolution at dyadic scales.

At a scale, a text is cut into blocks of `b` words, and each block is sought in the window of the following words, at
distances from `b` to `2 b - 1` (at the first scale from 1): a number-theoretic transform gives the sums of squared
differences of word numbers at all distances, and a zero is an occurrence. A run with at least three periods `q` in that range holds a whole block and its
occurrence `q` words later, so each run is seen at one scale. Occurrences at one distance in neighbouring blocks are
one stretch, which goes on for less than a block on either side.
"""

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from chirrup.llm.common import text_or_empty
from chirrup.llm.convolution import occurrences
from chirrup.llm.pretokens import CHUNK_BYTES
from chirrup.llm.terms import text_chunks
from chirrup.llm.words import coded_words, word_spans

MIN_LENGTH = 24
PERIODS = 3

# Stretches are prolonged in groups of about so many comparisons.
GROUP = 1 << 20


@cache
def _prime_factors(n: int) -> list[int]:
    found, p = [], 2
    while p * p <= n:
        if n % p == 0:
            found.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return found + [n] * (n > 1)


def _reach(codes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The distance from each word to its next use in the text, or the number of all words."""
    order = np.argsort(text * (int(codes.max()) + 1) + codes, kind="stable")
    same = (codes[order[1:]] == codes[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    out = np.full(len(codes), len(codes))
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


def _agreeing(codes: np.ndarray, at: np.ndarray, q: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
    """For how many words from `at` on, in the direction of `step`, each word equals the one `q` later; at most `most`."""
    out = np.zeros(len(at), np.int64)
    width = int(most.max(initial=0))
    if not width:
        return out
    for a in range(0, len(at), max(GROUP // width, 1)):
        part = slice(a, a + max(GROUP // width, 1))
        steps = np.arange(width)
        inside = steps < most[part, None]
        place = np.where(inside, at[part, None] + step * steps, 0)
        equal = inside & (codes[place] == codes[np.where(inside, place + q[part, None], 0)])
        out[part] = np.where(equal.all(1), width, np.argmin(equal, 1))
    return out


def _primitive(codes: np.ndarray, start: int, period: int) -> bool:
    """Whether the first period of a run has no shorter one that divides it."""
    unit = codes[start : start + period]
    return not any((unit[: period - period // f] == unit[period // f :]).all() for f in _prime_factors(period))


def runs_of(codes: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH, periods: int = PERIODS) -> np.ndarray:
    """Runs as rows `first word, end, period`, sorted by word and period; `first` has the first word of each text, and the end.

    A run has its smallest period `q` at least `periods` times and at least `min_length` words, and no word next to it
    goes on with that period.
    """
    n, sizes = len(codes), np.diff(first)
    longest = int(sizes.max(initial=0))
    found = [np.zeros((0, 3), np.int64)]
    if longest < max(min_length, periods):
        return found[0]
    text = np.repeat(np.arange(len(sizes)), sizes)
    reach = _reach(codes, text)
    ends = first[1:][text]
    inside = np.zeros(n, np.int64)  # the farthest end of a run of a smaller scale around each word
    base = b = 1 << ((min_length + 2) // 3).bit_length() - 1
    while b == base or periods * b <= longest:
        near = 1 if b == base else b  # the smallest distance of the scale; the largest is 2 b - 1
        width = 1 << (2 * b - 1 - near + b).bit_length()
        counts = np.where(sizes >= max(min_length, periods * near), (sizes - b - near) // b + 1, 0)
        counts = np.maximum(counts, 0)
        last = np.cumsum(counts)
        starts = np.repeat(first[:-1], counts) + b * (np.arange(last[-1]) - np.repeat(last - counts, counts))
        # A word that does not come again within the window, or a run around block and window, leaves nothing to be found.
        lone = np.append(0, np.cumsum(reach >= 2 * b))
        starts = starts[(lone[starts + b] == lone[starts]) & (inside[starts] < starts + 3 * b - 1)]
        if len(starts):
            block, place = occurrences(codes, starts, b, near, width)
            at, q = starts[block], place + near
            # Within a run of a shorter period, which then divides the distance, there is no smallest period to be found.
            new = (q < 2 * b) & (at + b + q <= ends[at]) & (inside[at] < at + b + q)
            found.append(_stretches(codes, first, text, at[new], q[new], b, min_length, periods))
            for s, e, _ in found[-1].tolist():
                inside[s:e] = np.maximum(inside[s:e], e)
        b *= 2
    runs = np.unique(np.concatenate(found), axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _stretches(codes: np.ndarray, first: np.ndarray, text: np.ndarray, at: np.ndarray, q: np.ndarray, b: int, min_length: int, periods: int) -> np.ndarray:
    """The runs around blocks that occur again at their distance `q`."""
    if not len(at):
        return np.zeros((0, 3), np.int64)
    order = np.lexsort((at, q))
    at, q = at[order], q[order]
    opens = np.append(True, (np.diff(q) != 0) | (np.diff(at) != b))
    closes = np.append(opens[1:], True)
    start, end, q = at[opens], at[closes] + b, q[opens]
    own = text[start]
    start = start - _agreeing(codes, start - 1, q, np.minimum(b, start - first[own]), -1)
    end = end + _agreeing(codes, end, q, np.minimum(b, first[own + 1] - q - end), 1) + q
    long = np.flatnonzero(end - start >= np.maximum(min_length, periods * q))
    kept = [k for k in long.tolist() if _primitive(codes, int(start[k]), int(q[k]))]
    return np.stack([start[kept], end[kept], q[kept]], 1).reshape(-1, 3)


def find(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH, periods: int = PERIODS) -> DataFrame:
    """Add `n_words`, `runs` and `collapsed`: the runs of the whole text, and its words without the repeats.

    A run is `(start, length, period)` in words: a stretch whose smallest period it holds at least `periods` times (3 or
    more), of at least `min_length` words, that no neighbouring word prolongs. Runs are sorted by start and period; they
    may overlap. A word is left out of `collapsed` if a run has it after its first period; the others are joined by one
    space. A null or empty text has no words, no runs and an empty `collapsed`; equal texts get equal results; an empty
    table stays empty; columns with the three names are replaced.
    """
    if periods < 3 or min_length < 1:
        raise ValueError("a run has at least three periods and one word")

    @arrow_udf("struct<n_words: long, runs: array<struct<start: long, length: long, period: long>>, collapsed: string>")
    def search(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            parts = [_searched(data, offsets, min_length, periods) for _, data, offsets in text_chunks(column, CHUNK_BYTES)]
            yield pa.concat_arrays([_searched(np.zeros(0, np.uint8), np.zeros(1, np.int64), min_length, periods), *parts])

    names = [name for name in docs.columns if name not in ("n_words", "runs", "collapsed")]
    found = docs.select(*(F.col(f"`{name}`") for name in names), F.struct(search(text_or_empty(text)).alias("found")).alias("runs"))
    return found.select(*(F.col(f"`{name}`") for name in names), *(F.col(f"runs.found.{name}").alias(name) for name in ("n_words", "runs", "collapsed")))


def _searched(data: np.ndarray, offsets: np.ndarray, min_length: int, periods: int) -> pa.StructArray:
    begins, ends, first = word_spans(data, offsets)
    codes, _ = coded_words(data, begins, ends)
    runs = runs_of(codes.astype(np.int64), first, min_length, periods)
    edges = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 1], -1)
    kept = np.cumsum(edges[:-1]) == 0
    text = np.searchsorted(first, runs[:, 0], "right") - 1
    spans = pa.StructArray.from_arrays([pa.array(runs[:, 0] - first[text]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])], ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(text, minlength=len(offsets) - 1))).astype(np.int32)), spans)
    collapsed = pa.array(_joined(data, begins[kept], ends[kept], np.append(0, np.cumsum(kept))[first]), pa.string())
    return pa.StructArray.from_arrays([pa.array(np.diff(first)), lists, collapsed], ["n_words", "runs", "collapsed"])


def _joined(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, first: np.ndarray) -> list[str]:
    """The words of each text, joined by one space."""
    sizes = ends - begins + 1
    to = np.cumsum(sizes)
    total = int(to[-1]) if len(to) else 0
    source = np.arange(total) + np.repeat(begins - to + sizes, sizes)
    out = data[np.minimum(source, len(data) - 1)] if total else data[:0].copy()
    out[to - 1] = 0x20
    bounds = np.append(0, to)[first]
    return [out[a : max(b - 1, a)].tobytes().decode() for a, b in zip(bounds[:-1], bounds[1:])]
