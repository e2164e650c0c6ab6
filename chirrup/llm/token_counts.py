"""Token counts of texts by a two-tier lookup on the map side; no pre-token is shuffled with its texts."""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from chirrup.llm.common import text_or_empty
from chirrup.llm.pretokens import bpe, cut_column, read_blob

# The broadcast table holds at most so many pre-tokens of at most so many bytes: 4 MB.
FREQUENT_WORDS = 1 << 16
MAX_WORD_BYTES = 64

# Each task reports at most so many pre-tokens.
REPORTED_WORDS = 1 << 12

# A worker's cache of other pre-tokens is emptied beyond this size.
CACHED_WORDS = 1 << 18

_cache: dict[bytes, dict[bytes, int]] = {}


def frequent_words(docs: DataFrame, path: str, text: str = "text", size: int = FREQUENT_WORDS) -> list[tuple[bytes, int]]:
    """The most frequent pre-tokens of several tokens, over all texts, with their numbers of tokens.

    Each task counts its pre-tokens in a summary of bounded size (a Misra-Gries sketch), and only the heads of these
    summaries are merged. The choice decides the speed of a count, never its result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_blob(path))

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, counts = bpe(shared.value), Counter()
        for batch in batches:
            found = cut_column(batch.column(0), tokenizer, tokenizer.vocabulary)
            uses = np.bincount(found.codes, minlength=len(tokenizer.vocabulary))[len(tokenizer.vocabulary) :]
            often = np.flatnonzero(uses > 1)
            for word, n in zip(found.words.take(pa.array(often)).to_pylist(), uses[often].tolist()):
                if len(word) <= MAX_WORD_BYTES:
                    counts[word] += n
            if len(counts) > 8 * REPORTED_WORDS:
                floor = sorted(counts.values())[-4 * REPORTED_WORDS]
                counts = Counter({word: n - floor for word, n in counts.items() if n > floor})
        top = counts.most_common(REPORTED_WORDS)
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array([w for w, _ in top], pa.binary()), "uses": pa.array([n for _, n in top], pa.int64())}
        )

    merged = docs.select(text_or_empty(text)).mapInArrow(summaries, "word binary, uses long").groupBy("word").agg(F.sum("uses").alias("uses"))
    words = [bytes(row.word) for row in merged.orderBy(F.desc("uses"), "word").limit(size).collect()]
    lists = bpe(shared.value).ids_of_words(pa.array(words, pa.binary()))
    return list(zip(words, np.diff(lists.offsets.to_numpy()).tolist()))


def token_counts(
    docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens", frequent: int = FREQUENT_WORDS
) -> DataFrame:
    """Add `out`, the number of tokens of each whole text by the tokenizer file at `path`.

    First tier: a broadcast table of the lengths of the tokenizer's own words and of up to `frequent` pre-tokens of
    the corpus. Second tier: a cache in each worker, filled by the tokenizer. A null text counts as empty, with no
    tokens; repeated rows are counted each; an existing column `out` is replaced, other columns stay; an empty table
    stays empty.
    """
    blob = read_blob(path)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((blob, frequent_words(docs, path, text, frequent) if frequent else []))

    @arrow_udf("long")
    def count(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        blob, table = shared.value
        tokenizer = bpe(blob)
        known = pa.concat_arrays([tokenizer.vocabulary, pa.array([word for word, _ in table], pa.binary())])
        sizes = np.append(np.ones(len(tokenizer.vocabulary), np.int32), np.array([n for _, n in table], np.int32))
        cache = _cache.setdefault(blob, {})
        for column in columns:
            found = cut_column(column, tokenizer, known)
            words = found.words.to_pylist()
            missing = [word for word in words if word not in cache]
            lengths = np.diff(tokenizer.ids_of_words(pa.array(missing, pa.binary())).offsets.to_numpy())
            cache.update(zip(missing, lengths.tolist()))
            rest = np.fromiter(map(cache.__getitem__, words), np.int32, len(words))
            if len(cache) > CACHED_WORDS:
                cache.clear()
            before = np.append(0, np.cumsum(np.append(sizes, rest)[found.codes], dtype=np.int64))
            counts = np.diff(before[found.first])
            for k in np.flatnonzero(found.unknown):
                counts[k] = len(tokenizer.whole(found.text(k)))
            yield pa.array(counts)

    return docs.withColumn(out, count(text_or_empty(text)))
