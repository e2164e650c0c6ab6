"""Toxicity by positive-unlabelled learning with a non-negative risk estimator.

Confirmed toxic texts teach what toxic text is like; all other texts are unlabelled and hold toxic ones as well. The risk
of calling unlabelled texts toxic is corrected by the class prior: what toxic texts would add to it is taken off. Where a
flexible model makes the corrected risk negative, the step goes back instead (Kiryo et al., 2017). The loss is logistic,
so the sigmoid of the sum is the chance of a text to be toxic.
"""

import warnings
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from chirrup.llm.common import text_or_empty
from chirrup.llm.pretokens import CHUNK_BYTES
from chirrup.llm.terms import coded_terms, text_chunks
from chirrup.llm.words import mixed

# The classifier is trained on at most so many toxic and so many unlabelled texts, on at most so many characters of each.
TOXIC_TEXTS = 4096
UNLABELLED_TEXTS = 8192
TRAIN_CHARACTERS = 20_000

# A term is described by itself and by its first bytes, hashed into so many bits.
PREFIXES = (4, 5, 6, 7, 8)
FEATURE_BITS = 18

# The model has at most so many features: those that are most above their share of unlabelled texts in toxic ones, by at
# least so many standard errors and in at least so many toxic texts.
FEATURES = 1024
LEAST_ERRORS = 4.0
LEAST_TEXTS = 3

EPOCHS = 20
BATCHES = 16
STEP = 0.02
PENALTY = 1e-4
SEED = 1


class Model(NamedTuple):
    columns: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The chance of each text to be toxic; `offsets` starts at 0 and ends at the length of `data`."""
        texts, columns, values = weighed(data, offsets, self.columns)
        return _sigmoid(self.bias + np.bincount(texts, values * self.weights[columns], len(offsets) - 1))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _features(words: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Features of distinct terms, as `(term, feature)`."""
    n = len(words)
    starts = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + n + 1].astype(np.int64)
    data = np.append(np.frombuffer(words.buffers()[2], np.uint8), np.zeros(max(PREFIXES), np.uint8))
    lengths = np.diff(starts)
    terms, hashes = [np.arange(n)], [mixed(pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False))]
    prefix = np.zeros(n, np.uint64)
    for size in range(1, max(PREFIXES) + 1):
        prefix = mixed(prefix * np.uint64(31) + data[starts[:-1] + size - 1] + np.uint64(1))
        if size in PREFIXES:
            longer = np.flatnonzero(lengths > size)
            terms.append(longer)
            hashes.append(prefix[longer])
    return np.concatenate(terms), (np.concatenate(hashes) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def counted(data: np.ndarray, offsets: np.ndarray, columns: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Features of texts as `(text, feature, uses)`, and the numbers of terms; with `columns`, their places among these."""
    codes, words, first = coded_terms(data, offsets)
    lengths = np.diff(first)
    if not len(codes):
        return *(np.zeros(0, np.int64) for _ in range(3)), lengths
    terms, features = _features(words)
    if columns is not None:
        place = np.searchsorted(columns, features)
        known = np.append(columns, -1)[place] == features
        terms, features = terms[known], place[known]
    order = np.argsort(terms, kind="stable")
    features = features[order]
    starts = np.searchsorted(terms[order], np.arange(len(words) + 1))
    sizes = np.diff(starts)[codes]
    ends = np.cumsum(sizes)
    own = np.arange(ends[-1]) + np.repeat(starts[codes] - ends + sizes, sizes)
    texts = np.repeat(np.repeat(np.arange(len(lengths)), lengths), sizes)
    pairs, uses = np.unique((texts << FEATURE_BITS) + features[own], return_counts=True)
    return pairs >> FEATURE_BITS, pairs & ((1 << FEATURE_BITS) - 1), uses, lengths


def weighed(data: np.ndarray, offsets: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of texts as `(text, place of the feature, value)`: damped uses, by the root of the text's length."""
    texts, places, uses, lengths = counted(data, offsets, columns)
    return texts, places, np.log1p(uses) * (10 / np.sqrt(np.maximum(lengths, 10)))[texts]


def _chosen(toxic: list[str], unlabelled: list[str]) -> np.ndarray:
    """The features that stand out in toxic texts."""
    found = np.zeros((2, 1 << FEATURE_BITS))
    for k, texts in enumerate((toxic, unlabelled)):
        for _, data, offsets in text_chunks(pa.array(texts, pa.string()), CHUNK_BYTES):
            found[k] += np.bincount(counted(data, offsets)[1], minlength=1 << FEATURE_BITS)
    n = np.array([[len(toxic)], [len(unlabelled)]])
    share = (found.sum(0) + 1) / (n.sum() + 2)
    errors = (found[0] / n[0] - found[1] / n[1]) / np.sqrt(share * (1 - share) * (1 / n).sum())
    errors[found[0] < LEAST_TEXTS] = 0
    best = np.argsort(-errors, kind="stable")[:FEATURES]
    return np.sort(best[errors[best] > LEAST_ERRORS])


def train(toxic: list[str], unlabelled: list[str], prior: float) -> Model:
    """Minimise the non-negative risk by Adam over mixed batches; both lists hold texts, `prior` is the share of toxic ones."""
    columns = _chosen(toxic, unlabelled)
    parts, base = [], 0
    for _, data, offsets in text_chunks(pa.array(toxic + unlabelled, pa.string()), CHUNK_BYTES):
        texts, places, values = weighed(data, offsets, columns)
        parts.append((texts + base, places, values))
        base += len(offsets) - 1
    texts, places, values = (np.concatenate(part) for part in zip(*parts))
    starts = np.searchsorted(texts, np.arange(base + 1))
    parameters = np.zeros(len(columns) + 1)  # the last one is the bias
    parameters[-1] = np.log(prior / (1 - prior))
    first, second, step = np.zeros_like(parameters), np.zeros_like(parameters), 0
    rng = np.random.default_rng(SEED)
    for _ in range(EPOCHS):
        shuffled = rng.permutation(len(toxic)), rng.permutation(len(unlabelled)) + len(toxic)
        for k in range(min(BATCHES, len(toxic), len(unlabelled))):
            known, other = (rows[k :: min(BATCHES, len(toxic), len(unlabelled))] for rows in shuffled)
            rows = np.concatenate([known, other])
            sizes = starts[rows + 1] - starts[rows]
            ends = np.cumsum(sizes)
            own = np.arange(ends[-1]) + np.repeat(starts[rows] - ends + sizes, sizes)
            row, column, value = np.repeat(np.arange(len(rows)), sizes), places[own], values[own]
            sums = parameters[-1] + np.bincount(row, value * parameters[column], len(rows))
            chance, n = _sigmoid(sums), len(known)
            as_clean = np.logaddexp(0, sums)  # the loss of a text that is held to be clean
            corrected = as_clean[n:].mean() - prior * as_clean[:n].mean()
            slope_clean = np.concatenate([-prior * chance[:n] / n, chance[n:] / len(other)])
            if corrected >= 0:
                slope = slope_clean
                slope[:n] -= prior * (1 - chance[:n]) / n
            else:
                slope = -slope_clean
            total = np.append(np.bincount(column, value * slope[row], len(columns)), slope.sum())
            total[:-1] += PENALTY * parameters[:-1]
            step += 1
            first += 0.1 * (total - first)
            second += 0.001 * (total**2 - second)
            parameters -= STEP * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(columns, parameters[:-1], float(parameters[-1]))


def _sample(docs: DataFrame, key: str, text: str, size: int, characters: int) -> list[str]:
    """The texts with the smallest hashes; a share of about twice the size is taken before it is sorted."""
    place = F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`"))
    share = 2.0 * size / max(docs.count(), 1)
    near = docs.filter(F.abs(place / 2.0**63) < share) if share < 1 else docs
    texts = near.select(place.alias("place"), F.left(text_or_empty(text), F.lit(characters)).alias("text"))
    return [row["text"] for row in texts.orderBy("place", "text").limit(size).collect()]


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", class_prior: float | None = None,
    toxic_texts: int = TOXIC_TEXTS, unlabelled_texts: int = UNLABELLED_TEXTS, characters: int = TRAIN_CHARACTERS,
) -> Model:
    """Train on at most `toxic_texts` texts whose label is 1 and at most `unlabelled_texts` of all texts, picked by hash.

    A text teaches by its first `characters`; every text is scored whole. Of the labels only 1 teaches; other labels count
    for the class prior alone, which is the share of 1 among the labelled keys unless given. A key with several labels
    has the largest; null labels are none. Without a toxic text, or with a prior of 0 or 1, all texts get the prior as
    their score (0 where nothing is labelled), with a warning.
    """
    known = labels.filter(F.col(label).isNotNull()).groupBy(F.col(f"`{key}`").alias("key")).agg(F.max((F.col(label) == 1).cast("int")).alias("toxic"))
    if class_prior is None:
        class_prior = known.agg(F.avg("toxic")).first()[0] or 0.0
    picked = known.filter("toxic = 1 and key is not null").orderBy(F.xxhash64("key"), "key").limit(toxic_texts).select("key")
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.left(text_or_empty(text), F.lit(characters)).alias("text")).join(F.broadcast(picked), "key")
    toxic = [row["text"] for row in rows.orderBy(F.xxhash64("key"), "key", "text").limit(toxic_texts).collect()]
    unlabelled = _sample(docs.select(f"`{key}`", f"`{text}`"), key, text, unlabelled_texts, characters)
    if not toxic or not 0 < class_prior < 1:
        warnings.warn(f"{len(toxic)} toxic texts and a prior of {class_prior} teach nothing; all texts get one score", stacklevel=2)
        share = np.clip(class_prior, 1e-15, 1 - 1e-15)
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(share / (1 - share))))
    return train(toxic, unlabelled, class_prior)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Add `out`, the chance from 0 to 1 that the whole text is toxic.

    A null text is empty; texts without a feature of the model get the same low score; equal texts get equal scores; an
    empty table stays empty; an existing column `out` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    @arrow_udf("double")
    def toxicity(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Model(*shared.value)
        for column in columns:
            scores = [own.scores(data, offsets) for _, data, offsets in text_chunks(column, CHUNK_BYTES)]
            yield pa.array(np.concatenate([np.zeros(0), *scores]))

    return docs.withColumn(out, toxicity(text_or_empty(text)))
