"""Mixture-controlled packing of documents into token sequences.

Sources are queues of tokens. Deficit round-robin serves them in windows: by the end of window `w` a source has got
its share of `w` windows, rounded down, and the rest is the deficit it carries into the next one. That is a closed form
of the window and of the totals of the sources, so every chunk of documents places its own tokens once it knows how
many tokens of each source come before it, and deficits pass from partition to partition without a serial pass.
"""

from bisect import bisect_right
from collections.abc import Iterator, Mapping
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chirrup.llm.common import stored, text_or_empty
from chirrup.llm.pretokens import bpe, encode_column, read_blob

SEQUENCE_TOKENS = 1024
WINDOW_TOKENS = 64 * SEQUENCE_TOKENS
END_ID = 0

_TOKENS = "chunk long, doc_id long, source string, n_tokens long, before long, ids binary"
_PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


class Mixture:
    """How many tokens of each source the first windows hold, and where a window's tokens lie."""

    def __init__(self, totals: list[int], weights: list[Fraction], window: int):
        self.totals, self.window, self.total = totals, window, sum(totals)
        self.windows = -(-self.total // window)
        self.weights = weights
        self.points: list[tuple[Fraction, Fraction, Fraction]] = []  # tokens and time at the start, weight of those served
        ends = sorted((Fraction(n) / w, w, n) for n, w in zip(totals, weights))
        tokens, time, active = Fraction(0), Fraction(0), sum(weights, Fraction(0))
        for end, weight, _ in ends:
            self.points.append((tokens, time, active))
            tokens += active * (end - time)
            time, active = end, active - weight
        self.starts = [point[0] for point in self.points]
        self.known: dict[int, list[int]] = {}

    def served(self, window: int) -> list[int]:
        """Tokens of each source in the windows before this one."""
        if window not in self.known:
            if len(self.known) > 4096:
                self.known.clear()
            if window >= self.windows:
                self.known[window] = self.totals
            else:
                tokens, time, active = self.points[bisect_right(self.starts, window * self.window) - 1]
                time += (window * self.window - tokens) / active if active else 0
                self.known[window] = [min(n, int(w * time)) for n, w in zip(self.totals, self.weights)]
        return self.known[window]

    def place(self, source: int, window: int) -> tuple[int, int, int]:
        """First and last token of a source in a window, and the place of the first among all tokens."""
        begin, end = self.served(window), self.served(window + 1)
        return begin[source], end[source], sum(begin) + sum(end[:source]) - sum(begin[:source])

    def window_of(self, source: int, token: int) -> int:
        low, high = 0, self.windows - 1
        while low < high:
            middle = (low + high) // 2
            if self.served(middle + 1)[source] > token:
                high = middle
            else:
                low = middle + 1
        return low


class Sequences:
    """Full sequences, then what is left in sequences whose lengths are powers of two, which need no padding."""

    def __init__(self, total: int, size: int):
        self.size, self.full = size, total // size
        self.begins = [self.full * size]
        for bit in reversed(range(size.bit_length())):
            if (total - self.full * size) >> bit & 1:
                self.begins.append(self.begins[-1] + (1 << bit))

    def at(self, place: int) -> tuple[int, int, int]:
        """Sequence, offset, and end of the sequence."""
        if place < self.begins[0]:
            return place // self.size, place % self.size, (place // self.size + 1) * self.size
        k = bisect_right(self.begins, place) - 1
        return self.full + k, place - self.begins[k], self.begins[k + 1]


def tokenised(docs: DataFrame, path: str, key: str, source: str, text: str) -> DataFrame:
    """The ids of each document, with the chunk it came in and its source's tokens before it in that chunk."""
    shared = docs.sparkSession.sparkContext.broadcast(read_blob(path))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = bpe(shared.value)
        kind = np.dtype("<u2") if tokenizer.n_ids <= 1 << 16 else np.dtype("<u4")
        for number, batch in enumerate(batches):
            chunk, before = (TaskContext.get().partitionId() << 32) + number, {}
            for first, last, counts, ids in encode_column(batch.column(2), tokenizer):
                part, raw, at = batch.slice(first, last - first), ids.astype(kind), 0
                end = np.array([END_ID], kind).tobytes()
                blobs, starts = [], []
                for name, n in zip(part.column(1).to_pylist(), counts.tolist()):
                    blobs.append(raw[at : at + n].tobytes() + end)
                    starts.append(before.get(name, 0))
                    before[name] = starts[-1] + n + 1
                    at += n
                size = len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * size, pa.int64()), part.column(0), part.column(1), pa.array(counts + 1, pa.int64()),
                     pa.array(starts, pa.int64()), pa.array(blobs, pa.binary())],
                    ["chunk", "doc_id", "source", "n_tokens", "before", "ids"],
                )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), text_or_empty(text).alias("text"))
    return stored(rows.mapInArrow(encode, _TOKENS))


def pack(
    docs: DataFrame,
    path: str,
    targets: Mapping[str | None, float] | None = None,
    sequence_tokens: int = SEQUENCE_TOKENS,
    window_tokens: int = WINDOW_TOKENS,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """Pieces of documents: `doc_id, start, length, doc_tokens, sequence_id, offset, ids` (little-endian, 32 bits each).

    A document is its ids by the tokenizer file at `path` and one end id. Each window of about `window_tokens` holds
    the sources in proportion to `targets` (by default: to their sizes, which lasts to the end); once a source has
    run out the others share its part. A source that `targets` does not name is served as if its weight were a
    millionth of the smallest. Sequences follow each other over the windows and are full; the last tokens go to sequences whose
    lengths are powers of two. A null text is empty and gives one end id, a null source is a source of its own, a
    repeated row is packed again, an empty table gives no rows, and columns other than the three named are not read. The
    sources are a mixture's, few: one number for each goes to the driver.
    """
    rows = tokenised(docs, path, key, source, text)
    sums = stored(rows.groupBy("chunk", "source").agg(F.sum("n_tokens").alias("n_tokens")))
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before_chunk = F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0))
    offsets = sums.select(F.col("chunk").alias("_chunk"), F.col("source").alias("_source"), before_chunk.alias("_offset"))
    totals = sorted((row.source is not None, row.source or "", row.n) for row in sums.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect())
    names = [name if known else None for known, name, _ in totals]
    sizes = [n for *_, n in totals]
    weights = [Fraction(n) for n in sizes]
    if targets:
        least = min((Fraction(str(w)) for w in targets.values() if w > 0), default=Fraction(1)) / 10**6
        weights = [max(Fraction(str(targets.get(name, 0))), least) for name in names]
    mixture, sequences, code = Mixture(sizes, weights, window_tokens), Sequences(sum(sizes), sequence_tokens), {n: k for k, n in enumerate(names)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cursor: dict[int, tuple[int, int]] = {}  # of a source: the token it stands at and that token's window
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for doc, name, n, begin, blob in zip(*(column.to_pylist() for column in batch.columns)):
                ids = np.frombuffer(blob, f"<u{len(blob) // n}").astype("<u4")
                k, at = code[name], 0
                while at < n:
                    token = begin + at
                    seen, window = cursor.get(k, (-1, 0))
                    if seen != token:
                        window = mixture.window_of(k, token)
                    low, high, place = mixture.place(k, window)
                    while high <= token:
                        window += 1
                        low, high, place = mixture.place(k, window)
                    sequence, offset, end = sequences.at(place + token - low)
                    length = min(n - at, high - token, end - (place + token - low))
                    for column, value in zip(out, (doc, at, length, n, sequence, offset, ids[at : at + length].tobytes())):
                        column.append(value)
                    at += length
                    cursor[k] = (token + length, window)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64() if c < 6 else pa.binary()) for c, x in enumerate(out)],
                ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    placed = rows.join(offsets, F.col("chunk").eqNullSafe(F.col("_chunk")) & F.col("source").eqNullSafe(F.col("_source")))
    begin = F.col("before") + F.col("_offset")
    return placed.select("doc_id", "source", "n_tokens", begin.alias("begin"), "ids").mapInArrow(cut, _PIECES)
