"""Ranked lexical search without random access: sequential reads of impact-sorted postings, with proof.

The texts are cut once into blocks of postings, of the terms that the queries hold. Blocks meet in shards, in which each
term has its postings in falling order of impact. A query reads its lists down to a common impact, which falls round by
round. A text's score is at least what was read of it, its lower bound, and at most that plus the next impact of each
list in which it has not been met. Reading goes on until nothing else can be among the k best, ties included, and the
bounds of those have met; no posting is looked up out of order.
"""

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chirrup.llm.common import stored, text_key, text_or_empty
from chirrup.llm.terms import coded_terms, text_chunks

# Queries are worked on in parts of at most so many bytes of text (a longer one is a part of its own): what is broadcast
# and what the driver holds is bounded, whatever the number of queries.
PART_BYTES = 8 << 20

# A block of postings comes from about so many bytes of text, a shard takes blocks up to about so many postings.
BLOCK_BYTES = 2 << 20
SHARD_POSTINGS = 1 << 22

# The first blocks give each query a score that the k best reach at least.
SEED_BLOCKS = 4

# From one round of reads to the next the impact falls by this factor.
FALL = 3

# Bits of an impact: at most 1000 * ln(2 ** 63) for the weight, times a millionth part below 1,000,000.
IMPACT_BITS = 36


class Queries(NamedTuple):
    """Distinct texts by key, their terms as places in the vocabulary, and how often each text holds them."""

    keys: list[bytes]
    terms: list[np.ndarray]
    uses: list[np.ndarray]
    vocabulary: pa.BinaryArray

    @classmethod
    def of(cls, rows: list) -> "Queries":
        column = pa.array([row["text"] for row in rows], pa.string())
        codes, vocabulary, bounds = [], pa.array([], pa.binary()), []
        for _, data, offsets in text_chunks(column, PART_BYTES):
            own, terms, first = coded_terms(data, offsets)
            known = pc.index_in(terms, vocabulary)
            vocabulary = pa.concat_arrays([vocabulary, terms.filter(pc.is_null(known))])
            place = pc.index_in(terms, vocabulary).to_numpy(zero_copy_only=False)
            codes += [place[own[a:b]] for a, b in zip(first[:-1], first[1:])]
        found = [np.unique(own, return_counts=True) for own in codes]
        return cls([bytes(row["key"]) for row in rows], [t for t, _ in found], [n for _, n in found], vocabulary)


class Shard:
    """Postings by term, in falling order of impact; texts are numbered in the order of their keys."""

    def __init__(self, n_texts: int, terms: np.ndarray, places: np.ndarray, impacts: np.ndarray, n_terms: int):
        own = impacts > 0
        order = np.argsort((terms[own] << IMPACT_BITS) - impacts[own])
        self.places, self.impacts = places[own][order], impacts[own][order]
        self.first = np.searchsorted(terms[own][order], np.arange(n_terms + 1))
        self.n_texts = n_texts

    def best(self, terms: np.ndarray, uses: np.ndarray, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
        """The k best of those with at least `floor`, ties to the smaller number: numbers, scores, and postings read."""
        lists = [(int(a), int(b), int(c)) for a, b, c in zip(self.first[terms], self.first[terms + 1], uses) if b > a]
        if not lists:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        at = [a for a, _, _ in lists]
        heads = np.array([c * self.impacts[a] for a, _, c in lists], np.int64)
        lower = np.zeros(self.n_texts, np.int64)
        possible: np.ndarray | None = None  # once no other text can be among the best: those that can
        floor, level = max(floor, 1), int(heads.max())
        while True:
            level //= FALL
            for t, (_, b, c) in enumerate(lists):
                if heads[t] <= level:
                    continue
                # Down to the level: impacts fall, so their negatives rise.
                to = at[t] + int(np.searchsorted(-self.impacts[at[t] : b], -(level // c), "left"))
                read, gain = self.places[at[t] : to], c * self.impacts[at[t] : to]
                if possible is None:
                    lower[read] += gain
                else:
                    own = place[read]
                    held = own >= 0
                    low[own[held]] += gain[held]
                    met[own[held], t] = True
                at[t] = to
                heads[t] = c * self.impacts[to] if to < b else 0
            if possible is None:
                if self.n_texts >= k:
                    floor = max(floor, int(np.partition(lower, self.n_texts - k)[self.n_texts - k]))
                if int(heads.sum()) >= floor:
                    continue
                # A text that was not met is out. Of the others, take off the heads of the lists in which they were met.
                high = np.where(lower > 0, lower + heads.sum(), 0)
                for t, (a, _, _) in enumerate(lists):
                    if heads[t]:
                        high[self.places[a : at[t]]] -= heads[t]
                possible = np.flatnonzero(high >= floor)
                place = np.full(self.n_texts, -1, np.int64)
                place[possible] = np.arange(len(possible))
                low, met = lower[possible], np.zeros((len(possible), len(lists)), bool)
                for t, (a, _, _) in enumerate(lists):
                    own = place[self.places[a : at[t]]]
                    met[own[own >= 0], t] = True
            if len(low) > k:
                floor = max(floor, int(np.partition(low, len(low) - k)[len(low) - k]))
            open_sum = ~met @ heads
            keep = low + open_sum >= floor
            if not keep.all():
                place[possible[~keep]] = -1
                possible, low, met, open_sum = possible[keep], low[keep], met[keep], open_sum[keep]
                place[possible] = np.arange(len(possible))
            if not open_sum.any():
                order = np.lexsort((possible, -low))[:k]
                return possible[order], low[order], sum(at) - sum(a for a, _, _ in lists)


def impacts_of(weights: np.ndarray, uses: np.ndarray, lengths: np.ndarray, n_texts: int, n_terms: int) -> np.ndarray:
    """Of each posting, in whole numbers: the weight of its term times the share of its uses, damped by the text's length."""
    if len(lengths) and 75 * int(lengths.max()) * n_texts >= 2**63:
        damp = np.array([25 + 75 * int(n) * n_texts // n_terms for n in lengths], np.int64)
    else:
        damp = 25 + 75 * lengths * n_texts // max(n_terms, 1)
    return weights * (1_000_000_000 * uses // (1000 * uses + 8 * damp))


def _parts(items: DataFrame, part_bytes: int) -> list[DataFrame]:
    """The distinct texts, in parts that are within the bound or hold one text only; each is collected when its turn comes."""
    n = 1
    while True:
        part = F.pmod(F.xxhash64("key"), F.lit(n))
        sizes = items.groupBy(part.alias("part")).agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n"))
        if sizes.filter((F.col("bytes") > part_bytes) & (F.col("n") > 1)).isEmpty():
            return [items.filter(part == k) for k in range(n)]
        n *= 4


def _blocks(docs: DataFrame, key: str, text: str, vocabulary: pa.BinaryArray, block_bytes: int) -> DataFrame:
    """Postings of the vocabulary's terms, a row for some texts: by term the texts that hold it and how often."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = f"keys array<{kind}>, lengths binary, terms array<int>, sizes array<int>, places binary, uses binary, n_texts long, n_terms long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_known = len(shared.value)
        for batch in batches:
            for a, data, offsets in text_chunks(batch.column(1), block_bytes):
                codes, terms, first = coded_terms(data, offsets)
                lengths = np.diff(first)
                known = pc.fill_null(pc.index_in(terms, shared.value), n_known).to_numpy(zero_copy_only=False)
                term = known[codes].astype(np.int64)
                text_of = np.repeat(np.arange(len(lengths)), lengths)[term < n_known]
                pairs, uses = np.unique(term[term < n_known] * len(lengths) + text_of, return_counts=True)
                term, place = np.divmod(pairs, max(len(lengths), 1))
                held = np.unique(place)
                named, sizes = np.unique(term, return_counts=True)
                one = lambda values, t: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, t))
                blob = lambda values: pa.array([values.astype("<i4").tobytes()], pa.binary())
                keys = batch.column(0).slice(a, len(lengths)).take(pa.array(held))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), keys), blob(lengths[held]), one(named, pa.int32()), one(sizes, pa.int32()),
                        blob(np.searchsorted(held, place)), blob(uses), pa.array([int((lengths > 0).sum())], pa.int64()), pa.array([int(lengths.sum())], pa.int64()),
                    ],
                    ["keys", "lengths", "terms", "sizes", "places", "uses", "n_texts", "n_terms"],
                )

    return stored(docs.select(F.col(f"`{key}`"), text_or_empty(text)).mapInArrow(cut, schema))


def _search(
    blocks: DataFrame, queries: Queries, weights: np.ndarray, n_texts: int, n_terms: int, k: int, floors: np.ndarray, shard_postings: int
) -> DataFrame:
    """Of each task's texts, the k best of each query: `query, key, score`."""
    kind = blocks.schema["keys"].dataType.elementType.simpleString()
    shared = blocks.sparkSession.sparkContext.broadcast((queries, weights, floors))

    def answers(rows: list[dict], floors: np.ndarray) -> Iterator[pa.RecordBatch]:
        queries, weights, _ = shared.value
        numbers = lambda name: [np.frombuffer(row[name].as_py(), "<i4").astype(np.int64) for row in rows]
        lengths, places, uses = (numbers(name) for name in ("lengths", "places", "uses"))
        base = np.append(0, np.cumsum([len(n) for n in lengths]))
        flat = lambda name: np.concatenate([row[name].values.to_numpy(zero_copy_only=False) for row in rows])
        terms = np.repeat(flat("terms"), flat("sizes")).astype(np.int64)
        place = np.concatenate([own + first for own, first in zip(places, base)])
        lengths, uses = np.concatenate(lengths), np.concatenate(uses)
        impacts = impacts_of(weights[terms], uses, lengths[place], n_texts, n_terms)
        keys = pa.concat_arrays([row["keys"].values for row in rows])
        order = pc.array_sort_indices(keys)  # nulls last
        rank = np.empty(len(keys), np.int64)
        rank[order.to_numpy()] = np.arange(len(keys))
        shard = Shard(len(keys), terms, rank[place], impacts, len(weights))
        for q, (own, times) in enumerate(zip(queries.terms, queries.uses)):
            found, scores, _ = shard.best(own, times, k, int(floors[q]))
            if len(found):
                if len(found) == k:
                    floors[q] = max(floors[q], scores[-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([queries.keys[q]] * len(found), pa.binary()), keys.take(order.take(pa.array(found))), pa.array(scores)],
                    ["query", "key", "score"],
                )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floors, rows, size = shared.value[2].copy(), [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                if size > shard_postings:
                    yield from answers(rows, floors)
                    rows, size = [], 0
                rows.append({name: batch.column(name)[row] for name in ("keys", "lengths", "terms", "sizes", "places", "uses")})
                size += len(rows[-1]["places"].as_py()) // 4
        if rows:
            yield from answers(rows, floors)

    return blocks.drop("n_texts", "n_terms").mapInArrow(search, f"query binary, key {kind}, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _best_of_part(docs: DataFrame, part: DataFrame, k: int, key: str, text: str, block_bytes: int, shard_postings: int) -> DataFrame | None:
    queries = Queries.of(part.collect())
    if not len(queries.vocabulary):
        return None
    blocks = _blocks(docs, key, text, queries.vocabulary, block_bytes)
    total = blocks.agg(F.sum("n_texts"), F.sum("n_terms")).first()
    n_texts, n_terms = total[0] or 0, total[1] or 0
    if not n_terms:
        return None
    uses = blocks.select(F.inline(F.arrays_zip("terms", "sizes"))).groupBy("terms").agg(F.sum("sizes").alias("texts"))
    weights = np.zeros(len(queries.vocabulary), np.int64)
    for row in uses.collect():  # one row for each term of the queries at most
        weights[row["terms"]] = math.floor(1000 * math.log((2 * n_texts + 2) / (2 * row["texts"] + 1)))
    floors = np.zeros(len(queries.keys), np.int64)
    first = _search(blocks.limit(SEED_BLOCKS), queries, weights, n_texts, n_terms, k, floors, shard_postings)
    number = {own: q for q, own in enumerate(queries.keys)}
    for row in _ranked(first, k).filter(F.col("rank") == k).collect():
        floors[number[bytes(row["query"])]] = row["score"]
    return _ranked(_search(blocks, queries, weights, n_texts, n_terms, k, floors, shard_postings), k)


def top_k(
    docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    part_bytes: int = PART_BYTES, block_bytes: int = BLOCK_BYTES, shard_postings: int = SHARD_POSTINGS,
) -> DataFrame:
    """The k texts of `docs` with the highest scores above 0 for each row of `items`: item key, `rank`, key, `score`.

    The score of a text adds, over the item's terms with repeats, `w * (1000000000 * tf div (1000 * tf + 8 * m))`, where `w`
    falls with the number of texts that hold the term and `m` grows with the text's length (see `impacts_of`). Equal scores
    go by ascending key, null keys last. Null and empty texts have no terms: they are never found, and find nothing. Each
    row of `docs` is a text of its own and each row of `items` gets its own ranks, also where keys or texts repeat. Items that
    find nothing, and empty tables, give no rows. Other columns are not used, whatever their names. The two keys need
    different names.
    """
    if item_key == key:
        raise ValueError("the keys of texts and items need different names")
    asked = items.select(F.col(f"`{item_key}`").alias("item"), text_or_empty(item_text).alias("text"))
    asked = asked.withColumn("key", text_key(F.col("text")))
    parts = _parts(asked.select("key", "text").dropDuplicates(["key"]), part_bytes)
    found = [best for part in parts if (best := _best_of_part(docs, part, k, key, text, block_bytes, shard_postings)) is not None]
    if not found:
        kinds = asked.schema["item"].dataType.simpleString(), docs.schema[key].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"`{item_key}` {kinds[0]}, rank int, `{key}` {kinds[1]}, score long")
    best = reduce(DataFrame.unionAll, found).select("query", "rank", F.col("key").alias("doc"), "score")
    rows = asked.select("item", "key").join(best, F.col("key") == F.col("query"))
    return rows.select(F.col("item").alias(item_key), "rank", F.col("doc").alias(key), "score")
