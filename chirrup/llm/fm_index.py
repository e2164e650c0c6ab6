"""A compressed full-text index over sequences of words, searched backwards over a wavelet matrix, many lanes at a time."""

import numpy as np


class Bits:
    """Bits with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(np.append(bits, np.zeros(64 + (-len(bits)) % 64, bool)), bitorder="little")
        self.words = packed.view("<u8")
        self.before = np.append(0, np.cumsum(np.bitwise_count(self.words), dtype=np.int32)).astype(np.int32)
        self.zeros = int(len(bits) - bits.sum())

    def ones(self, place: np.ndarray) -> np.ndarray:
        word = place >> 6
        mask = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class FmIndex:
    """Index over `codes` (words from 1 on, 0 between sequences), whose suffixes are sorted by their first `depth` words."""

    def __init__(self, codes: np.ndarray, weights: np.ndarray, depth: int):
        n = len(codes)
        rank, length = codes.astype(np.int64), 1
        order = np.argsort(rank)
        while length < depth:
            ahead = np.zeros(n, np.int64)
            ahead[:-length or None] = rank[length:] + 1
            ahead[rank_zero(codes, length)] = 0
            key = rank * (int(ahead.max()) + 1) + ahead
            order = np.argsort(key)
            ranked = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.append(0, np.cumsum(ranked[1:] != ranked[:-1]))
            length *= 2
        self.n = n
        self.weight = np.append(0, np.cumsum(weights[order]))
        last = codes[order - 1].astype(np.int64)  # the word before each suffix
        self.width = max(1, int(codes.max()).bit_length())
        # Where each word's suffixes begin, and where its occurrences begin in the last level of the matrix.
        self.counts = np.bincount(codes, minlength=int(codes.max()) + 1)
        self.begin = np.append(0, np.cumsum(self.counts))[:-1]
        self.levels = []
        for bit in reversed(range(self.width)):
            ones = (last >> bit & 1).astype(bool)
            self.levels.append(Bits(ones))
            last = np.concatenate([last[~ones], last[ones]])
        starts = np.flatnonzero(np.append(True, last[1:] != last[:-1]))
        self.last_begin = np.zeros(len(self.counts), np.int64)
        self.last_begin[last[starts]] = starts

    def step(self, low: np.ndarray, high: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that have one more word in front."""
        # Both ends go down the levels together, in half as many calls.
        places = np.stack([low, high])
        for level, bit in zip(self.levels, reversed(range(self.width))):
            ones = level.ones(places)
            places = np.where((words >> bit & 1).astype(bool), level.zeros + ones, places - ones)
        places += self.begin[words] - self.last_begin[words]
        return places[0], places[1]

    def single(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that begin with a word."""
        return self.begin[words], self.begin[words] + self.counts[words]

    def weight_of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return self.weight[high] - self.weight[low]


def rank_zero(codes: np.ndarray, length: int) -> np.ndarray:
    """Places whose next `length` words pass the end."""
    return np.arange(max(len(codes) - length, 0), len(codes))


# A lane has at most so many windows, so that long sequences do not keep the loop running for a few lanes.
RANGE = 64


def repeated_windows(index: FmIndex, codes: np.ndarray, first: np.ndarray, window: int) -> np.ndarray:
    """For each place of the streamed `codes`, whether the window from there occurs in the index with a weight of two or more.

    `first` are the begins and the end of the sequences. A lane holds a range of undecided windows of one sequence, and
    searches backwards from the end of one of them. A search that fails has met words that are nowhere else, so none of the
    windows is repeated that hold these: the searched one and later ones that begin up to there. A search that reaches its
    window's begin goes on as far as it can, and all windows in the match are repeated. The undecided windows on both sides
    become lanes. The first window of a range is searched first, as a failure there decides most; behind a repeated one, the
    last that overlaps with it, as the match may reach back; and if it does not, the middle one of those in between.
    """
    edges = np.zeros(len(codes) + 1, np.int64)
    # The undecided windows, the searched one, whether the range is halved, and the first word that the search has taken.
    begin, end = first[:-1].astype(np.int64), first[1:].astype(np.int64) - window + 1
    lanes = -(-np.maximum(end - begin, 0) // RANGE)
    end = np.repeat(end, lanes)
    begin = np.repeat(begin - RANGE * (np.cumsum(lanes) - lanes), lanes) + RANGE * np.arange(len(end))
    end = np.minimum(begin + RANGE, end)
    start, half = begin.copy(), np.zeros(len(begin), bool)
    place = start + window - 1
    low, high = index.single(codes[place])
    while len(start):
        holds = index.weight_of(low, high) >= 2
        going = holds & (place > begin)
        on, off = np.flatnonzero(going), np.flatnonzero(~going)
        if len(on):
            place[on] -= 1
            low[on], high[on] = index.step(low[on], high[on], codes[place[on]])
        if not len(off):
            continue
        held = np.where(holds[off], place[off], place[off] + 1)
        whole = held <= start[off]
        np.add.at(edges, held[whole], 1)
        np.add.at(edges, start[off][whole] + 1, -1)
        # Left are the windows before the searched one or its match, and those after it or after a failure.
        begins = np.concatenate([begin[off], np.where(whole, start[off] + 1, held)])
        ends = np.concatenate([np.minimum(held, start[off]), end[off]])
        halves = np.concatenate([np.ones(len(off), bool), whole & half[off]])
        starts = np.concatenate([begins[: len(off)], np.where(whole, np.minimum(begins[len(off) :] + window, ends[len(off) :]) - 1, held)])
        starts = np.where(halves, (begins + ends) // 2, starts)
        left = np.flatnonzero(begins < ends)
        places = starts[left] + window - 1
        old = (begin[on], end[on], start[on], half[on], place[on], low[on], high[on])
        new = (begins[left], ends[left], starts[left], halves[left], places, *index.single(codes[places]))
        begin, end, start, half, place, low, high = (np.concatenate(pair) for pair in zip(old, new))
    return np.cumsum(edges[:-1]) > 0
