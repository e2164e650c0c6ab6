"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad, given measures of the line and of its neighbours. The field is fitted on a bounded sample of
labelled documents; each document's score comes from the forward-backward marginals of its lines, weighted by length.
"""

import warnings
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from chirrup.llm.common import text_or_empty
from chirrup.llm.pretokens import chunks, text_buffers, words_of

# The field is fitted on at most so many labelled documents, on at most so many lines and characters of each.
TRAIN_DOCUMENTS = 4096
TRAIN_LINES = 64
TRAIN_CHARACTERS = 50_000
STEPS = 150
ROUNDS = 2
PENALTY = 1e-3

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>@^~={}[]\\_")] = True
MARK = np.zeros(256, bool)
MARK[list(b"!?")] = True
DIGIT = np.zeros(256, bool)
DIGIT[list(b"0123456789")] = True
UPPER = np.zeros(256, bool)
UPPER[ord("A") : ord("Z") + 1] = True
STOP = np.zeros(256, bool)
STOP[list(b".,;:")] = True

N_MEASURES = 10


class Lines(NamedTuple):
    """Measures and lengths of the lines that hold a word, and the first line of each text."""

    measures: np.ndarray
    lengths: np.ndarray
    first: np.ndarray


def lines_of(data: np.ndarray, offsets: np.ndarray) -> Lines:
    """Lines end at a line break; `offsets` starts at 0 and ends at the length of `data`."""
    breaks = data == 0x0A
    starts = np.union1d(offsets[:-1][offsets[:-1] < len(data)], np.flatnonzero(breaks) + 1)
    starts = starts[starts < len(data)]
    if not len(starts):
        return Lines(np.zeros((0, N_MEASURES), np.float32), np.zeros(0), np.zeros(len(offsets), np.int64))
    total = lambda flags: np.add.reduceat(flags, starts, dtype=np.int32).astype(np.float32)
    white = WHITE[data]
    opens = np.zeros(len(data), bool)
    opens[starts] = True
    word_start = ~white
    word_start[1:] &= white[:-1] | opens[1:]
    begins = np.flatnonzero(word_start)
    ends = np.flatnonzero(~white & np.append(white[1:] | opens[1:], True)) + 1
    line = np.searchsorted(starts, begins, "right") - 1
    n_lines = len(starts)
    words = np.bincount(line, minlength=n_lines).astype(np.float32)
    # Every second piece is a word: words and what is between them, cut without a copy.
    pieces = words_of(data, np.append(np.stack([begins, ends], 1).ravel(), len(data)))
    codes = pieces.take(pa.array(np.arange(0, 2 * len(begins), 2))).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    again = np.zeros(len(codes), bool)
    again[1:] = (codes[1:] == codes[:-1]) & (line[1:] == line[:-1])
    repeats = np.bincount(line[again], minlength=n_lines)
    capitals = np.bincount(line[UPPER[data[begins]]], minlength=n_lines)
    single = np.bincount(line[ends - begins == 1], minlength=n_lines)
    shown = total(~white)
    n, w = np.maximum(shown, 1), np.maximum(words, 1)
    measures = np.stack([
        total(SYMBOL[data]) / n, total(MARK[data]) / n, total(DIGIT[data]) / n, total(UPPER[data]) / n, total(STOP[data]) / n,
        repeats / w, capitals / w, single / w, np.minimum(shown / w / 20, 1), np.minimum(np.log1p(w) / 8, 1),
    ], 1).astype(np.float32)
    kept = words > 0
    return Lines(measures[kept], shown[kept], np.searchsorted(starts[kept], offsets))


def features(lines: Lines) -> np.ndarray:
    """Squashed measures of each line, of the line before and of the line after, and where it stands."""
    own = np.concatenate([lines.measures, np.sqrt(lines.measures), (lines.measures > 0.1).astype(np.float32)], 1)
    n = len(own)
    opens, closes = np.zeros(n, np.float32), np.zeros(n, np.float32)
    held = lines.first[1:] > lines.first[:-1]
    opens[lines.first[:-1][held]] = 1
    closes[lines.first[1:][held] - 1] = 1
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[opens > 0], after[closes > 0] = 0, 0
    return np.concatenate([own, before, after, opens[:, None], closes[:, None], np.ones((n, 1), np.float32)], 1)


def marginals(logits: np.ndarray, chain: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chance that each line is good, and the expected numbers of the four transitions.

    `logits` are the good state's scores against the bad one's; `chain` is the 2 x 2 table of transition scores. All texts
    advance together, a line at a time, longest first, so the work is that of the lines.
    """
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = first[:-1][order], lengths[order]
    n, steps = len(logits), int(sizes[0]) if len(sizes) else 0
    pair = np.exp(chain)
    half = np.clip(logits, -30, 30) / 2
    node = np.exp(np.stack([-half, half], 1))
    forward, backward = np.zeros((n, 2)), np.ones((n, 2))
    active = [int(np.searchsorted(-sizes, -t, "left")) for t in range(steps + 1)]  # texts with more than t lines
    for t in range(steps):
        at = starts[: active[t]] + t
        value = node[at] if t == 0 else (forward[at - 1] @ pair) * node[at]
        forward[at] = value / value.sum(1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        value = (backward[at + 1] * node[at + 1]) @ pair.T
        backward[at] = value / value.sum(1, keepdims=True)
    good = forward * backward
    good /= np.maximum(good.sum(1, keepdims=True), 1e-300)
    inner = np.ones(n, bool)
    inner[first[:-1][lengths > 0]] = False
    at = np.flatnonzero(inner)
    joint = forward[at - 1][:, :, None] * pair[None] * (backward[at] * node[at])[:, None, :]
    joint /= np.maximum(joint.sum((1, 2), keepdims=True), 1e-300)
    return good[:, 1], joint.sum(0)


class Crf(NamedTuple):
    weights: np.ndarray
    chain: np.ndarray
    scale: tuple[float, float]
    prior: float

    def texts(self, lines: Lines) -> np.ndarray:
        """The chance of each text to be good; a text without words has the share of good ones."""
        chances, _ = marginals(features(lines) @ self.weights, self.chain, lines.first)
        mean = weighted(chances, lines)
        logit = np.log(np.clip(mean, 1e-6, 1 - 1e-6) / np.clip(1 - mean, 1e-6, 1 - 1e-6))
        score = 1 / (1 + np.exp(-(self.scale[0] * logit + self.scale[1])))
        return np.where(np.diff(lines.first) > 0, score, self.prior)


def weighted(chances: np.ndarray, lines: Lines) -> np.ndarray:
    mass = np.append(0, np.cumsum(chances * lines.lengths))
    length = np.append(0, np.cumsum(lines.lengths))
    return np.diff(mass[lines.first]) / np.maximum(np.diff(length[lines.first]), 1)


def _ascend(x: np.ndarray, first: np.ndarray, truth: np.ndarray, balance: np.ndarray, weights: np.ndarray, chain: np.ndarray) -> None:
    """Maximise the likelihood of the lines' states in place, by Adam; `balance` weighs the lines of a text."""
    inner = np.ones(len(x), bool)
    inner[first[:-1][np.diff(first) > 0]] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (truth[at - 1], truth[at]), 1)
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(chain), np.zeros_like(chain)]
    for step in range(1, STEPS + 1):
        chances, joint = marginals(x @ weights, chain, first)
        slopes = (x.T @ ((truth - chances) * balance) / len(x) - PENALTY * weights, (seen - joint) / len(x) - PENALTY * chain)
        for k, (value, slope) in enumerate(zip((weights, chain), slopes)):
            m, v = moments[2 * k], moments[2 * k + 1]
            m += 0.1 * (slope - m)
            v += 0.01 * (slope**2 - v)
            value += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)


def train(texts: list[str], good: list[int]) -> Crf:
    """Fit on whole labelled texts.

    Lines of good texts are good. Which lines of a bad text are bad is found in rounds: at first all are, then those that
    the field of the last round calls bad, and always its worst line.
    """
    label = np.array(good, np.int64)
    lines = lines_of(*reversed(text_buffers(pa.array(texts, pa.string()))))
    x, counts = features(lines), np.diff(lines.first)
    owner = np.repeat(np.arange(len(label)), counts)
    weights, chain, prior = np.zeros(x.shape[1]), np.zeros((2, 2)), float(label.mean()) if len(label) else 1.0
    if not len(x) or label.min() == label.max():
        return Crf(weights, chain, (0.0, np.log(np.clip(prior, 1e-3, 1 - 1e-3) / np.clip(1 - prior, 1e-3, 1 - 1e-3))), prior)
    truth = label[owner].copy()
    for _ in range(ROUNDS):
        balance = (1 / np.maximum(counts, 1))[owner]  # each text counts the same
        balance /= balance.mean()
        _ascend(x, lines.first, truth, balance, weights, chain)
        chances, _ = marginals(x @ weights, chain, lines.first)
        truth = np.where(label[owner] == 1, 1, (chances >= 0.5).astype(np.int64))
        for k in np.flatnonzero((label == 0) & (counts > 0)):
            truth[lines.first[k] + int(np.argmin(chances[lines.first[k] : lines.first[k + 1]]))] = 0
    mean = weighted(chances, lines)
    logit = np.log(np.clip(mean, 1e-6, 1 - 1e-6) / np.clip(1 - mean, 1e-6, 1 - 1e-6))
    a, b, held = 1.0, 0.0, counts > 0
    for _ in range(500):  # two numbers by gradient ascent, with a pull towards 1 and 0
        error = label[held] - 1 / (1 + np.exp(-(a * logit[held] + b)))
        a += 0.1 * ((error * logit[held]).mean() - 0.01 * (a - 1))
        b += 0.5 * (error.mean() - 0.001 * b)
    return Crf(weights, chain, (a, b), prior)


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    documents: int = TRAIN_DOCUMENTS, lines: int = TRAIN_LINES, characters: int = TRAIN_CHARACTERS,
) -> Crf:
    """Fit on at most `documents` labelled documents, those with the smallest hashes of their keys.

    A text of more than `lines` lines teaches by a run of so many of them, which its hash chooses, and by at most the
    first `characters` of the run; every text is scored whole. Only the text and the label are used. Documents without a
    label, and null labels, teach nothing. A sample without both labels gives all texts one score, with a warning.
    """
    known = labels.filter(F.col(label).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max(F.col(label).cast("int")).alias("_good"))
    sample = known.orderBy(F.xxhash64("_key"), "_key").limit(documents)
    rows = docs.select(F.col(key).alias("_key"), text_or_empty(text).alias("_text")).join(F.broadcast(sample), "_key")
    parts = F.split("_text", "\n")
    first = F.pmod(F.xxhash64("_key", "_text"), F.size(parts) - lines + 1).cast("int") + 1
    run = F.when(F.size(parts) > lines, F.array_join(F.slice(parts, first, F.lit(lines)), "\n")).otherwise(F.col("_text"))
    rows = rows.select("_key", F.left(run, F.lit(characters)).alias("_text"), "_good")
    found = rows.orderBy(F.xxhash64("_key"), "_key", "_text").limit(documents).collect()
    if len({row["_good"] for row in found}) < 2:
        warnings.warn(f"the {len(found)} sampled texts have no two labels; all texts get one score", stacklevel=2)
    return train([row["_text"] for row in found], [row["_good"] for row in found])


def score(docs: DataFrame, model: Crf, text: str = "text", out: str = "score") -> DataFrame:
    """Add `out`, the chance from 0 to 1 that the whole text is good.

    A null text is empty; texts without words get the share of good texts in the sample; equal texts get equal scores;
    an empty table stays empty; an existing column `out` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    @arrow_udf("double")
    def quality(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        field = Crf(*shared.value)
        for column in columns:
            offsets, data = text_buffers(column)
            scores = [field.texts(lines_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])) for a, b in chunks(offsets)]
            yield pa.array(np.concatenate([np.zeros(0), *scores]))

    return docs.withColumn(out, quality(text_or_empty(text)))
