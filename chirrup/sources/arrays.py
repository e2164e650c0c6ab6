"""JSON arrays of records of any size, read and written by many tasks.

An array, on one line or on many, has no place where a reader may begin: whether a brace ends a record depends on all quotes
before it. So the text reader cuts a file at its closing braces, which it can from any byte range on. A first pass says of
each range how its quotes and braces come out, both if it begins outside and if it begins inside a string. From that
follows, range after range, in which state each begins; a second pass then knows where records end, that is, where the
depth comes back to nothing. Pieces of a record that ranges share are put together at the end.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The driver holds a few numbers for each byte range.
MAX_RANGES = 1 << 17


class State(NamedTuple):
    """How a range begins: inside a string or not, the depth of braces, the records that ended before, and the number of
    its pieces if the file ends with it."""

    inside: int
    depth: int
    records: int
    last: int | None


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """`file, start, text`: what lies between closing braces, in the order of each range; a file goes by the hash of its path."""
    place, read = F.col("_metadata"), spark.read.option("lineSep", "}").text(path)
    return read.select(F.xxhash64(place["file_path"]).alias("file"), place["file_block_start"].alias("start"), F.col("value").alias("text"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.Array]]:
    """The texts of a batch by range; a range's rows follow each other."""
    if not batch.num_rows:
        return
    files, starts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    opens = np.flatnonzero(np.append(True, (np.diff(files) != 0) | (np.diff(starts) != 0)))
    for a, b in zip(opens, np.append(opens[1:], batch.num_rows)):
        yield (int(files[a]), int(starts[a])), batch.column(2).slice(a, b - a)


def _escaped(data: np.ndarray) -> np.ndarray:
    """The places of quotes that a backslash takes: those after an odd run of backslashes."""
    slashes = np.flatnonzero(data == 0x5C)
    if not len(slashes):
        return slashes
    opens = np.flatnonzero(np.append(True, np.diff(slashes) != 1))
    sizes = np.diff(np.append(opens, len(slashes)))
    after = slashes[opens] + sizes
    return after[(sizes % 2 == 1) & (after < len(data)) & (data[np.minimum(after, len(data) - 1)] == 0x22)]


def _counted(texts: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """The quotes of each piece, and the braces it opens if it begins outside and if it begins inside a string."""
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    # An escape is within a piece: a closing brace needs none.
    quotes = np.setdiff1d(np.flatnonzero(data == 0x22), _escaped(data), assume_unique=True)
    braces = np.flatnonzero(data == 0x7B)
    before = np.searchsorted(quotes, offsets)
    piece = np.searchsorted(offsets, braces, "right") - 1
    odd = (np.searchsorted(quotes, braces) - before[piece]) & 1
    opened = [np.bincount(piece[odd == inside], minlength=len(texts)) for inside in (0, 1)]
    return np.diff(before), opened


def _scan(counted: tuple[np.ndarray, list[np.ndarray]], inside: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each piece, if the first begins `inside` a string: the depth it adds, whether its brace counts, the state after it."""
    quotes, opened = counted
    after = (inside + np.cumsum(quotes)) & 1
    closes = after == 0
    return np.where((after - quotes) & 1, opened[1], opened[0]) - closes, closes, after


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each range the number of its pieces and, for both ways to begin, the state and depth after it, the smallest depth
    at a counted brace, and how many braces have it."""
    found: dict[tuple[int, int], list] = {}
    for batch in batches:
        for key, texts in _runs(batch):
            row = found.setdefault(key, [0, [[h, 0, 0, 0] for h in (0, 1)]])
            row[0] += len(texts)
            counted = _counted(texts)
            for own in row[1]:
                change, closes, after = _scan(counted, own[0])
                depths = (own[1] + np.cumsum(change))[closes]
                if len(depths):
                    least = int(depths.min())
                    if not own[3] or least < own[2]:
                        own[2:] = [least, 0]
                    own[3] += int((depths == least).sum()) if least == own[2] else 0
                own[0], own[1] = int(after[-1]), own[1] + int(change.sum())
    keys = list(found)
    names = ("state", "depth", "least", "ends")
    columns = {"file": pa.array([f for f, _ in keys], pa.int64()), "start": pa.array([s for _, s in keys], pa.int64()), "n": pa.array([found[k][0] for k in keys], pa.int64())}
    for at, name in enumerate(names):
        columns[name] = pa.array([[own[at] for own in found[k][1]] for k in keys], pa.list_(pa.int64()))
    yield pa.RecordBatch.from_pydict(columns)


def _states(pieces: DataFrame) -> dict[tuple[int, int], State]:
    """How each range begins, from the ranges of its file before it."""
    schema = "file long, start long, n long, state array<long>, depth array<long>, least array<long>, ends array<long>"
    rows = pieces.mapInArrow(_summaries, schema).limit(MAX_RANGES + 1).collect()
    if len(rows) > MAX_RANGES:
        raise ValueError(f"more than {MAX_RANGES} byte ranges; raise spark.sql.files.maxPartitionBytes")
    states, file = {}, None
    for row in sorted(rows, key=lambda row: (row["file"], row["start"])):
        if row["file"] != file:
            file, inside, depth, records, before = row["file"], 0, 0, 0, None
        if before is not None:
            states[before] = states[before]._replace(last=None)
        before = (file, row["start"])
        states[before] = State(inside, depth, records, row["n"])
        # The depth is never below nothing, so records end where the range is lowest, if it gets down to there.
        records += row["ends"][inside] if row["least"][inside] + depth == 0 else 0
        inside, depth = row["state"][inside], depth + row["depth"][inside]
    return states


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of a file, or of all files of a folder, that hold an array of records, each as its JSON text: `value`.

    Records may have records, arrays and strings with any characters in them; what lies between records is not read. A
    file may have several arrays, or none. Of a file that is cut off, what comes after its last record but one may be left
    out; one that is otherwise no JSON gives undefined records, and does not disturb other files. The file is read twice, in byte ranges of
    `spark.sql.files.maxPartitionBytes`, and only parts of records that lie in several ranges are shuffled.
    """
    pieces = _pieces(spark, path)
    shared = spark.sparkContext.broadcast(_states(pieces))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole records; of those that begin or end in another range, the part in this one, by file and number."""
        key, state, first, part, done = None, None, True, [], 0
        for batch in batches:
            for own, texts in _runs(batch):
                if own != key:
                    if part:
                        yield _rows(["".join(part)], key, state.records, False)
                    key, state, part, done = own, shared.value[own], [], 0
                    first = state.depth > 0 or state.inside == 1  # the first record to end began in another range
                change, closes, after = _scan(_counted(texts), state.inside)
                depth = state.depth + np.cumsum(change)
                ends = closes & (depth == 0)
                done += len(texts)
                if done == state.last:
                    ends[-1] = False  # what comes after the last brace of the file
                closed = pc.binary_join_element_wise(texts, "}", "")
                at = np.flatnonzero(ends)
                whole: list = []
                if len(at):
                    text = "".join([*part, *closed.slice(0, at[0] + 1).to_pylist()])
                    if first:
                        yield _rows([text], key, state.records, True)
                    else:
                        whole.append(text)
                    first = False
                    alone = at[1:][np.diff(at) == 1]
                    for a, b in zip(at[:-1][np.diff(at) > 1], at[1:][np.diff(at) > 1]):
                        whole.append("".join(closed.slice(a + 1, b - a).to_pylist()))
                    yield _rows(whole, None, None, True)
                    yield _rows(closed.take(pa.array(alone)), None, None, True)
                    part = []
                rest = int(at[-1]) + 1 if len(at) else 0
                part += closed.slice(rest).to_pylist()
                state = state._replace(inside=int(after[-1]), depth=int(depth[-1]), records=state.records + len(at))
        if part:
            yield _rows(["".join(part)], key, state.records, False)

    found = pieces.mapInArrow(records, "value string, file long, number long, start long, ends boolean")
    parts = found.filter("file IS NOT NULL").groupBy("file", "number")
    joined = parts.agg(F.array_join(F.sort_array(F.collect_list(F.struct("start", "value")))["value"], "").alias("value"), F.max("ends").alias("ends"))
    text = found.filter("file IS NULL").select("value").unionAll(joined.filter("ends").select("value"))
    return text.select(F.substr("value", F.instr("value", F.lit("{"))).alias("value"))


def _rows(texts: list | pa.Array, key: tuple | None, number: int | None, ends: bool) -> pa.RecordBatch:
    n = len(texts)
    same = lambda value, kind: pa.nulls(n, kind) if value is None else pa.repeat(pa.scalar(value, kind), n)
    file, start = key or (None, None)
    columns = [same(value, pa.int64()) for value in (file, number, start)]
    texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
    return pa.RecordBatch.from_arrays([texts, *columns, same(ends, pa.bool_())], ["value", "file", "number", "start", "ends"])


def as_arrays(records: DataFrame) -> DataFrame:
    """Records as JSON texts, `value`, to lines that make an array of each task's records when written as text."""

    def bracketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opening = "["
        for batch in batches:
            if batch.num_rows:
                separators = pa.array([opening, *[","] * (batch.num_rows - 1)], pa.string())
                yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(separators, batch.column(0), "")], ["value"])
                opening = ","
        yield pa.RecordBatch.from_pydict({"value": ["]"] if opening == "," else ["[", "]"]})

    return records.select("value").mapInArrow(bracketed, "value string")
