"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

A block is one Arrow batch of texts. Its texts become codes into the block's list of distinct pre-tokens, whose order is
their position: that is the exploded form of the texts, kept narrow. The distinct pre-tokens are shuffled by a hash of
the word, so that all blocks' copies of a word meet in one task, which encodes it once; the ids go back to the blocks,
where the texts are put together again by position.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_schema

from chirrup.llm.common import tasks, text_or_empty
from chirrup.llm.pretokens import as_lists, bpe, cut_column, read_blob, text_buffers

# A task that encodes words forgets them beyond this number; a word that comes again is then encoded again.
REMEMBERED_WORDS = 1 << 19

# Texts are cut in pieces of about this size: cutting takes some twenty times as much memory.
CUT_BYTES = 1 << 20

# Rows that are decoded together.
DECODED_ROWS = 256


def _packed(values: np.ndarray) -> bytes:
    """Numbers below 2**32, as their bytes in planes, compressed."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(len(values).to_bytes(8, "little") + planes.tobytes())


def _unpacked(blob: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int.from_bytes(raw[:8], "little")
    planes = np.frombuffer(raw, np.uint8, offset=8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def _joined(words: list[bytes]) -> tuple[bytes, bytes]:
    return _packed(np.fromiter(map(len, words), np.int64, len(words))), zstandard.ZstdCompressor(level=1).compress(b"".join(words))


def _split(sizes: bytes, blob: bytes) -> list[bytes]:
    raw, ends = zstandard.ZstdDecompressor().decompress(blob), np.cumsum(_unpacked(sizes)).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def _mark(words: pa.BinaryArray) -> int:
    """The number of a block's words and a checksum of them."""
    offsets, data = text_buffers(words)
    check = zlib.crc32(data[offsets[0] : offsets[-1]], zlib.crc32(np.diff(offsets)))
    return (check << 31) + len(words)


def _buckets(words: pa.BinaryArray, n: int) -> np.ndarray:
    """The bucket of each word, by its checksum; few words at a time become objects."""
    parts = [[zlib.crc32(w) % n for w in words.slice(k, 4096).to_pylist()] for k in range(0, len(words), 4096)]
    return np.concatenate([np.zeros(0, np.int32), *(np.array(x, np.int32) for x in parts)])


def _released() -> None:
    """Give back what Arrow keeps for later: the worker waits for its next task, and others share the executor with it."""
    pa.default_memory_pool().release_unused()


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids", carry: list[str] | None = None) -> DataFrame:
    """Add `out`: the ids of the text by the rank file at `path`, little-endian, 32 bits each.

    `carry` names the columns to keep (all by default); they travel to the block with the codes.

    `docs` must give the same rows in the same order each time it is read, as files do; a block whose two readings
    differ stops the job. A null text is empty and has no ids; repeated rows are encoded each; an empty table stays
    empty; an existing column `out` is replaced.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_blob(path))
    n_buckets = tasks(docs)
    names = [name for name in (docs.columns if carry is None else carry) if name != out]
    rows = docs.select(F.struct(*(F.col(f"`{name}`") for name in names)).alias("doc"), text_or_empty(text).alias("text"), F.spark_partition_id().alias("part"))
    text_schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("bucket", T.IntegerType()), T.StructField("n_words", T.LongType()),
        T.StructField("codes", T.BinaryType()), T.StructField("words", T.BinaryType()), rows.schema["doc"],
    ])
    doc_type = to_arrow_schema(T.StructType([rows.schema["doc"]])).field("doc").type

    def block_of(part: pa.Array, number: int) -> int:
        return (part[0].as_py() << 32) + number if len(part) else 0

    def distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The block's distinct words, dealt into buckets, with their codes."""
        tokenizer = bpe(shared.value)
        for number, batch in enumerate(batches):
            words = cut_column(batch.column(0), tokenizer, size=CUT_BYTES).words
            mark = _mark(words)
            bucket = _buckets(words, n_buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            for k in np.unique(bucket).tolist():
                codes = order[cuts[k] : cuts[k + 1]]
                sizes, blob = _joined(words.take(pa.array(codes)).to_pylist())
                deltas = _packed(np.diff(codes, prepend=0))
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block_of(batch.column(1), number)], pa.int64()), "bucket": pa.array([k], pa.int32()), "n_words": pa.array([mark], pa.int64()),
                    "codes": pa.array([deltas], pa.binary()), "sizes": pa.array([sizes], pa.binary()), "words": pa.array([blob], pa.binary()),
                })
            del words
            _released()

    def ids_of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each distinct word of the bucket once."""
        tokenizer, cache = bpe(shared.value), {}
        piece = tokenizer.encoding._core_bpe.encode_single_piece
        for batch in batches:
            for block, bucket, mark, codes, sizes, blob in zip(*(column.to_pylist() for column in batch.columns)):
                words = _split(sizes, blob)
                if len(cache) > REMEMBERED_WORDS:
                    cache.clear()
                for word in words:
                    if word not in cache:
                        cache[word] = np.array(piece(word), "<u4").tobytes()
                found = [cache[word] for word in words]
                counts = np.fromiter(map(len, found), np.int64, len(found)) // 4
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block], pa.int64()), "bucket": pa.array([bucket], pa.int32()), "n_words": pa.array([mark], pa.int64()), "codes": pa.array([codes], pa.binary()),
                    "sizes": pa.array([_packed(counts)], pa.binary()), "words": pa.array([_packed(np.frombuffer(b"".join(found), "<u4"))], pa.binary()),
                })

    def coded_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each text as codes; a text that only the library can cut as its bytes, with bucket -2."""
        tokenizer = bpe(shared.value)
        for number, batch in enumerate(batches):
            found = cut_column(batch.column(1), tokenizer, size=CUT_BYTES)
            n, block = len(batch), block_of(batch.column(2), number)
            codes = [_packed(found.codes[a:b]) for a, b in zip(found.first[:-1], found.first[1:])]
            whole = {k: found.text(k).encode() for k in np.flatnonzero(found.unknown).tolist()}
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * n, pa.int64()), pa.array([n_buckets] * n, pa.int32()), pa.array([_mark(found.words)] * n, pa.int64()),
                 pa.array(codes, pa.binary()), pa.array([whole.get(k) for k in range(n)], pa.binary()), batch.column(0)],
                ["block", "bucket", "n_words", "codes", "words", "doc"],
            )
            del found, codes, whole
            _released()

    def reassembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by block, with the ids of its words before its texts."""
        block, lists, parts = None, None, []
        for batch in batches:
            blocks, buckets = batch.column("block").to_numpy(), batch.column("bucket").to_numpy()
            n_words, codes, words, sizes = (batch.column(c) for c in ("n_words", "codes", "words", "sizes"))
            out, kept = [], []
            for k in range(len(batch)):
                if blocks[k] != block:
                    block, lists, parts = blocks[k], None, []
                if buckets[k] < n_buckets:
                    parts.append((np.cumsum(_unpacked(codes[k].as_py())), _unpacked(sizes[k].as_py()), _unpacked(words[k].as_py()), n_words[k].as_py()))
                    continue
                if lists is None:
                    order = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
                    mark = n_words[k].as_py()
                    if len(order) != mark & (1 << 31) - 1 or any(p[3] != mark for p in parts) or (np.sort(order) != np.arange(len(order))).any():
                        raise RuntimeError("the texts changed between two readings; store them first")
                    ids = as_lists(np.concatenate([np.zeros(0, np.int64), *(p[1] for p in parts)]), np.concatenate([np.zeros(0, "<u4"), *(p[2] for p in parts)]))
                    lists, parts = ids.take(pa.array(np.argsort(order))), []
                raw = words[k].as_py()
                ids = lists.take(pa.array(_unpacked(codes[k].as_py()))).flatten().to_numpy() if raw is None else np.array(bpe(shared.value).whole(raw.decode()), "<u4")
                out.append(ids.astype("<u4").tobytes())
                kept.append(k)
                if len(out) >= 256:
                    yield pa.RecordBatch.from_arrays([batch.column("doc").take(pa.array(kept)).cast(doc_type), pa.array(out, pa.binary())], ["doc", out_name])
                    out, kept = [], []
            if out:
                yield pa.RecordBatch.from_arrays([batch.column("doc").take(pa.array(kept)).cast(doc_type), pa.array(out, pa.binary())], ["doc", out_name])

    out_name = "ids"
    word_schema = "block long, bucket int, n_words long, codes binary, sizes binary, words binary"
    found = rows.select("text", "part").mapInArrow(distinct_words, word_schema)
    ids = found.repartition(n_buckets, "bucket").mapInArrow(ids_of_words, word_schema)
    texts = rows.mapInArrow(coded_texts, text_schema)
    met = ids.unionByName(texts, allowMissingColumns=True).repartition(n_buckets, "block").sortWithinPartitions("block", "bucket")
    whole = met.mapInArrow(reassembled, T.StructType([rows.schema["doc"], T.StructField(out_name, T.BinaryType())]))
    return whole.select(*(F.col("doc").getField(name).alias(name) for name in names), F.col(out_name).alias(out))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add `out`: the bytes of the ids, joined on the map side to the table of token bytes, whose size the vocabulary bounds.

    Null ids give null; no ids give no bytes; an id outside the table stops the job.
    """
    shared = df.sparkSession.sparkContext.broadcast(bpe(read_blob(path)).token_bytes())

    @arrow_udf("binary")
    def join(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        offsets, data = shared.value
        tokens = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])
        for column in columns:
            parts = [_texts_of(column.slice(k, DECODED_ROWS), tokens) for k in range(0, len(column), DECODED_ROWS)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.binary())
            del parts
            _released()

    return df.withColumn(out, join(F.col(ids)))


def _texts_of(column: pa.Array, tokens: pa.BinaryArray) -> pa.BinaryArray:
    """The bytes of the ids of each row; nulls stay null."""
    missing = column.is_null().to_numpy(zero_copy_only=False)
    offsets, data = text_buffers(column.fill_null(b""))
    ids = np.frombuffer(data[offsets[0] : offsets[-1]].tobytes(), "<u4")
    found = tokens.take(pa.array(ids))
    ends, raw = text_buffers(found)
    ends = ends[(offsets - offsets[0]) // 4]
    held = None if not missing.any() else pa.py_buffer(np.packbits(~missing, bitorder="little"))
    return pa.Array.from_buffers(pa.binary(), len(column), [held, pa.py_buffer((ends - ends[0]).astype(np.int32)), pa.py_buffer(raw[ends[0] : ends[-1]])])
