"""Removal of passages that repeat across documents, by matching statistics against full-text indexes of shards.

Equal windows have the same smallest gram hash, so a window needs to be looked up in one shard only: each text is cut
into runs of windows that share their smallest gram, and a run goes to the shard of that gram. Grams that occur once in
the corpus lead nowhere and are dropped before any text moves. Runs of a gram that is too frequent for one shard are cut
again, by the next smallest gram of their windows, and equal ones become one with the weight of all. Each shard builds a
compressed index of its distinct runs and streams them against it.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from chirrup.llm.common import stored, tasks, text_key, text_or_empty
from chirrup.llm.fm_index import FmIndex, repeated_windows
from chirrup.llm.pretokens import chunks, text_buffers
from chirrup.llm.words import coded_words, grams, hashed_words, mixed, within, word_spans

WINDOW = 35
GRAM = 8

# A gram with more runs than this is cut by the next smallest gram; a pair of grams that still has more different runs has
# their windows dealt out by their own hashes, and counted.
HOT_RUNS = 4096

# A shard's index takes runs up to about this many words.
SHARD_WORDS = 1 << 18

_RUNS = "gram long, key binary, start int, n int, uses long"
_SEGMENTS = "gram long, hash binary, key binary, start int, n int, copies long, words binary"
_WINDOWS = "a long, b long, key binary, start int, uses long"
_FOUND = "key binary, start int, n int"


def _batch(schema: str, *columns) -> pa.RecordBatch:
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [field.split() for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, types[kind]) for x, (_, kind) in zip(columns, fields)], [name for name, _ in fields])


def smallest(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each `size` neighbours, by doubling."""
    done = 1
    while done < size:
        step = min(done, size - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def runs_of(data: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Of the runs of windows that share their smallest gram: the gram, the text, the first window, their number, the gram's uses.

    Two equal windows hold their gram at two places, be it in one run, so grams of one use lead to no repeated window.
    """
    begins, ends, first = word_spans(data, offsets)
    places = within(first, window)
    if not len(places):
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(4))
    gram = min(GRAM, window)
    values = mixed(grams(hashed_words(data, begins, ends), gram))
    least = smallest(values, window - gram + 1)[places]
    text = np.searchsorted(first, places, "right") - 1
    opens = np.flatnonzero(np.append(True, (least[1:] != least[:-1]) | (text[1:] != text[:-1])))
    n = np.diff(np.append(opens, len(places)))
    sizes = n + window - gram
    ends = np.cumsum(sizes)
    held = np.arange(ends[-1]) + np.repeat(places[opens] - ends + sizes, sizes)
    uses = np.add.reduceat(values[held] == np.repeat(least[opens], sizes), ends - sizes, dtype=np.int64)
    return least[opens], text[opens], places[opens] - first[text[opens]], n, uses


def cut_again(values: np.ndarray, least: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the grams of a run, whose windows hold `size` grams each: where the next smallest gram changes, and a hash of the pair."""
    least = np.uint64(least & (1 << 64) - 1)
    following = smallest(np.where(values == least, np.uint64(2**64 - 1), values), size)
    opens = np.flatnonzero(np.append(True, following[1:] != following[:-1]))
    return opens, mixed(following[opens] ^ mixed(np.array([least]))).view(np.int64)


def _search(gram_rows: list[tuple], window: int) -> Iterator[pa.RecordBatch]:
    """One shard: its distinct runs, each with the weight of all its copies, against their own index."""
    distinct: dict[bytes, list[int]] = {}
    for k, row in enumerate(gram_rows):
        distinct.setdefault(row[4], []).append(k)
    offsets = np.append(0, np.cumsum(np.fromiter(map(len, distinct), np.int64, len(distinct))))
    data = np.frombuffer(b"".join(distinct), np.uint8)
    begins, ends, first = word_spans(data, offsets)
    flat = coded_words(data, begins, ends)[0] + 1
    sizes = np.diff(first)
    weights = np.fromiter((sum(gram_rows[k][3] for k in owners) for owners in distinct.values()), np.int64, len(distinct))
    joined = np.insert(flat, first[1:], 0)
    index = FmIndex(joined, np.insert(np.repeat(weights, sizes), first[1:], 0), window)
    repeated = repeated_windows(index, flat, first, window)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], repeated, [False]]).astype(np.int8)))
    out = []
    sequence = np.searchsorted(first, edges[::2], "right") - 1
    owners = list(distinct.values())
    # A run of places cannot pass the end of its sequence: the last window - 1 places of each are no windows.
    for s, a, b in zip(sequence.tolist(), edges[::2].tolist(), edges[1::2].tolist()):
        for k in owners[s]:
            out.append((gram_rows[k][1], gram_rows[k][2] + a - int(first[s]), b - a))
    if out:
        yield _batch(_FOUND, *zip(*out))


def repeated_runs(docs: DataFrame, text: str = "text", window: int = WINDOW, hot_runs: int = HOT_RUNS) -> DataFrame:
    """`key, marks`: by the key of a text its repeated windows as `(start, n)`; a negative `n` stands for all windows."""
    n_parts = tasks(docs)
    texts = docs.select(text_or_empty(text).alias("text")).select(text_key(F.col("text")).alias("key"), "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = text_buffers(batch.column(1))
            for a, b in chunks(offsets):
                gram, text, start, n, uses = runs_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], window)
                yield _batch(_RUNS, gram.view(np.int64), batch.column(0).slice(a, b - a).take(pa.array(text)), start.astype(np.int32), n.astype(np.int32), uses)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words of the runs; those of hot grams are cut again and have a hash of their words."""
        gram = min(GRAM, window)
        for batch in batches:
            offsets, data = text_buffers(batch.column("text"))
            data = data[offsets[0] : offsets[-1]]
            begins, ends, first = word_spans(data, offsets - offsets[0])
            out: list[tuple] = []
            for k, (key, copies, runs) in enumerate(zip(batch.column("key").to_pylist(), batch.column("copies").to_pylist(), batch.column("runs").to_pylist())):
                place, values = int(first[k]), None

                def words(start: int, n: int) -> bytes:
                    own = slice(place + start, place + start + n + window - 1)
                    return b" ".join([data[i:j].tobytes() for i, j in zip(begins[own].tolist(), ends[own].tolist())])

                for run in runs:
                    start, n = run["start"], run["n"]
                    if not run["hot"]:
                        out.append((run["gram"], None, key, start, n, copies, words(start, n)))
                        continue
                    if values is None:
                        values = mixed(grams(hashed_words(data, begins[place : first[k + 1]], ends[place : first[k + 1]]), gram))
                    opens, pairs = cut_again(values[start : start + n + window - gram], run["gram"], window - gram + 1)
                    for a, b, pair in zip(opens.tolist(), [*opens[1:].tolist(), n], pairs.tolist()):
                        held = words(start + a, b - a)
                        out.append((pair, hashlib.blake2b(held, digest_size=16).digest(), key, start + a, b - a, copies, held))
                if len(out) > 5_000:
                    yield _batch(_SEGMENTS, *zip(*out))
                    out = []
            if out:
                yield _batch(_SEGMENTS, *zip(*out))

    def windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Two hashes of each window of the runs."""
        for batch in batches:
            offsets, data = text_buffers(batch.column("words"))
            data = data[offsets[0] : offsets[-1]]
            begins, ends, first = word_spans(data, offsets - offsets[0])
            places = within(first, window)
            if not len(places):
                continue
            hashes = hashed_words(data, begins, ends)
            run = np.searchsorted(first, places, "right") - 1
            start = batch.column("start").to_numpy()[run] + places - first[run]
            owner = pa.array(run)
            yield _batch(
                _WINDOWS, grams(hashes, window).view(np.int64)[places], grams(mixed(hashes), window).view(np.int64)[places],
                batch.column("key").take(owner), start.astype(np.int32), batch.column("copies").take(owner),
            )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by gram; a shard ends between two grams."""
        rows, size = [], 0
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if size > SHARD_WORDS and row[0] != rows[-1][0]:
                    yield from _search(rows, window)
                    rows, size = [], 0
                rows.append(row)
                size += row[4].count(b" ") + 1
        if rows:
            yield from _search(rows, window)

    runs = texts.mapInArrow(cut, _RUNS)
    counts = runs.groupBy("gram").agg(F.sum("uses").alias("total")).filter("total > 1")
    run = F.struct("start", "n", "gram", (F.col("total") > hot_runs).alias("hot"))
    wanted = runs.join(counts, "gram").groupBy("key").agg(F.collect_set(run).alias("runs"))
    distinct = texts.groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    pieces = stored(distinct.join(wanted, "key").mapInArrow(segments, _SEGMENTS))
    # Equal runs of hot grams meet first: those that come twice are repeated as a whole, and only one of them goes on, with
    # the weight of all.
    hot = pieces.filter(F.col("hash").isNotNull())
    alike = hot.groupBy("gram", "hash").agg(F.sum("copies").alias("copies"), F.first(F.struct("key", "start", "words")).alias("run"))
    alike = stored(alike.select("gram", "hash", "run.key", "run.start", "copies", "run.words"))
    often = alike.filter("copies > 1").select("gram", "hash")
    found = hot.join(often, ["gram", "hash"], "left_semi").select("key", "start", "n")
    large = alike.groupBy("gram").agg(F.count("*").alias("runs")).filter(F.col("runs") > hot_runs).select("gram")
    held = ["gram", "key", "start", "copies", "words"]
    small = pieces.filter(F.col("hash").isNull()).select(held).unionByName(alike.join(large, "gram", "left_anti").select(held))
    found = found.unionByName(small.repartition(n_parts, "gram").sortWithinPartitions("gram").mapInArrow(search, _FOUND))
    windows = alike.join(large, "gram", "left_semi").select("key", "start", "copies", "words").mapInArrow(windows_of, _WINDOWS)
    twice = windows.groupBy("a", "b").agg(F.sum("uses").alias("total")).filter("total > 1")
    single = windows.filter("uses = 1").join(twice, ["a", "b"], "left_semi")
    found = found.unionByName(single.select("key", "start", F.lit(1).alias("n")))
    copies = texts.groupBy("key").agg(F.count("*").alias("copies")).filter("copies > 1")
    found = found.unionByName(copies.select("key", F.lit(0).alias("start"), F.lit(-1).alias("n")))
    return found.groupBy("key").agg(F.collect_list(F.struct("start", "n")).alias("marks"))


def remove_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW, hot_runs: int = HOT_RUNS) -> DataFrame:
    """Replace the text by what is left of it; add `n_words` (of the whole text) and `n_removed`.

    A word goes if it lies in a window of `window` words whose sequence also starts at another place, in any row or the
    same; windows are judged on the texts as they come. What is left keeps its own white space. A null or empty text
    becomes an empty one; of texts that come twice, each loses all windows; texts below `window` words stay; an empty
    table stays empty; columns `n_words` and `n_removed` are replaced.
    """
    marks = repeated_runs(docs, text, window, hot_runs).select(F.col("key").alias("_key"), F.col("marks").alias("_marks"))
    names = [name for name in docs.columns if name not in ("n_words", "n_removed")]
    own = {name: f"_own_{k}" for k, name in enumerate(names) if name != text}
    rows = docs.select(*(F.col(f"`{name}`").alias(place) for name, place in own.items()), text_or_empty(text).alias("_text"))
    rows = rows.withColumn("_text_key", text_key(F.col("_text")))
    joined = rows.join(marks, F.col("_text_key") == F.col("_key"), "left")
    kind = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])

    @arrow_udf(kind)
    def keep(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for column, marked in columns:
            offsets, data = text_buffers(column)
            data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
            counts, gone = [np.zeros(0, np.int64)], np.zeros(len(column), np.int64)
            texts = column.to_pylist()
            marked = marked.to_pylist()
            for a, b in chunks(offsets):
                part = data[offsets[a] : offsets[b]]
                begins, _, first = word_spans(part, offsets[a : b + 1] - offsets[a])
                counts.append(np.diff(first))
                for k in range(a, b):
                    own = begins[first[k - a] : first[k - a + 1]]
                    if marked[k] is None or len(own) < window:
                        continue
                    edges = np.zeros(len(own) + 1, np.int64)
                    for mark in marked[k]:
                        edges[mark["start"]] += 1
                        edges[len(own) if mark["n"] < 0 else mark["start"] + mark["n"] + window - 1] -= 1
                    out = np.cumsum(edges[:-1]) > 0
                    gone[k] = int(out.sum())
                    cuts = np.append(own, offsets[k + 1] - offsets[a])
                    keep = ~out
                    pieces = [part[offsets[k] - offsets[a] : cuts[0]].tobytes()]
                    switches = np.flatnonzero(np.diff(np.concatenate([[False], keep, [False]]).astype(np.int8)))
                    pieces += [part[cuts[i] : cuts[j]].tobytes() for i, j in zip(switches[::2], switches[1::2])]
                    texts[k] = b"".join(pieces).decode()
            yield pa.StructArray.from_arrays(
                [pa.array(texts, pa.string()), pa.array(np.concatenate(counts)), pa.array(gone)], ["text", "n_words", "n_removed"]
            )

    done = joined.withColumn("_kept", keep(F.col("_text"), F.col("_marks")))
    columns = [F.col(own.get(name, "_kept.text")).alias(name) for name in names]
    return done.select(*columns, F.col("_kept.n_words").alias("n_words"), F.col("_kept.n_removed").alias("n_removed"))
