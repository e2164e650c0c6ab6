"""Polarity of a text: the mean polarity of its words that a lexicon knows, after the words that change it.

Polarities count in whole millionths, whose sums are exact in any order, and each score is one division of such a sum.
So the ways to score, picked by the size and the columns of the lexicon, give the same numbers.
"""

from collections import defaultdict
from collections.abc import Callable
from typing import NamedTuple

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from chirrup.functions.constants import constant
from chirrup.functions.text import letter_tokens, word_counts

# Above this size (a few MB) the lexicon is joined instead of being sent to every executor.
MAX_BROADCAST_WORDS = 50_000

# The sieve of a joined lexicon has about this many bits for each word, and 1 MB at most.
BITS_PER_WORD = 8
MAX_BITS = 1 << 23

# A negation or a degree word reaches the next known word up to this many words further on.
REACH = 3

SCORE_DIGITS = 6
MILLION = 1_000_000


def score(
    df: DataFrame,
    text_col: str,
    lexicon: DataFrame,
    score_col: str = "sentiment_score",
    max_broadcast_words: int = MAX_BROADCAST_WORDS,
    reach: int = REACH,
) -> DataFrame:
    """Add `score_col`; a null or empty text, or one without a known word, scores 0.0.

    The lexicon has `word, polarity` and, if words are to change others, `degree`. A word with a degree changes the next
    known word up to `reach` words further on: a degree above 0 multiplies its polarity; one below 0 negates, that is,
    multiplies it too, and the degrees around then divide, so that "not very good" is milder than "not good". Several
    degrees multiply, as long as each is within reach of the next. Changed polarities stay within -1 and 1. A word
    without polarity does not count in the mean. Null degrees and 0 change nothing, as does a `reach` of 0.

    A lexicon within the bound is looked up in the stage of the scan, with one hash lookup per token, without a shuffle
    and without a Python worker, whatever the number or repetition of texts. A larger lexicon is joined on the word.
    Several polarities, or degrees, of one word are averaged, to the millionth. The size of the lexicon is looked up here,
    by a bounded job.
    """
    polarity = F.round(F.col("polarity") * MILLION).cast("long").alias("polarity")
    modified = reach > 0 and "degree" in lexicon.columns
    degree = F.nullif(F.round(F.col("degree") * MILLION).cast("long"), F.lit(0)) if modified else F.lit(None).cast("long")
    entries = lexicon.select(F.lower(F.trim("word")).alias("word"), polarity, degree.alias("degree"))
    entries = entries.filter("word IS NOT NULL AND (polarity IS NOT NULL OR degree IS NOT NULL)")
    known = entries.withColumn("hash", F.xxhash64("word")).limit(max_broadcast_words + 1).collect()
    if len(known) > max_broadcast_words:
        modified = modified and not entries.filter("degree IS NOT NULL").isEmpty()
        return _score_by_join(df, text_col, entries, score_col, reach if modified else 0)
    if not known:
        return df.withColumn(score_col, F.lit(0.0))
    words = _averaged(known)
    if any(word.degree is not None for word in words.values()):
        return df.withColumn(score_col, _scanned(_looked_up(letter_tokens(F.col(text_col)), words), reach))
    return _score_by_vocabulary(df, text_col, sorted(words), [words[word].polarity for word in sorted(words)], score_col)


class Word(NamedTuple):
    """Polarity and degree in millionths, and Spark's hash of the word."""

    polarity: int | None
    degree: int | None
    hash: int


def _averaged(rows: list) -> dict[str, Word]:
    found, hashes = defaultdict(lambda: ([], [])), {}
    for row in rows:
        hashes[row["word"]] = row["hash"]
        for name, values in zip(("polarity", "degree"), found[row["word"]]):
            if row[name] is not None:
                values.append(row[name])
    mean = lambda own: (2 * sum(own) + len(own)) // (2 * len(own)) if own else None
    return {word: Word(*map(mean, values), hashes[word]) for word, values in found.items()}


def _average(name: str) -> Column:
    n = F.count(name)
    return F.floor((2 * F.sum(name) + n) / F.nullif(2 * n, F.lit(0))).alias(name)


def _mean(total: Column, hits: Column) -> Column:
    """Both whole numbers."""
    return F.when(hits > 0, F.round(total.cast("double") / hits.cast("double") / MILLION, SCORE_DIGITS)).otherwise(0.0)


def _score_by_vocabulary(
    df: DataFrame, text_col: str, words: list[str], polarities: list[int], score_col: str
) -> DataFrame:
    """Word counts times polarities, over the number of known words.

    The score is one expression over the text that names each step once, so a filter that Spark moves below a
    projection still tokenises a text once.
    """
    counter = CountVectorizerModel.from_vocabulary(words, inputCol="_tokens", outputCol="_hits")
    counted = counter.transform(df.withColumn("_tokens", letter_tokens(F.col(text_col))))
    table = constant(polarities, "array<double>")

    def mean(vector: Column) -> Column:
        parts = F.zip_with(
            vector["indices"], vector["values"], lambda i, n: F.struct((n * F.get(table, i)).alias("total"), n.alias("hits"))
        )
        zero = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("hits"))
        return F.aggregate(
            parts,
            zero,
            lambda a, b: F.struct((a["total"] + b["total"]).alias("total"), (a["hits"] + b["hits"]).alias("hits")),
            lambda a: _mean(a["total"], a["hits"]),
        )

    score = F.get(F.transform(F.array(F.unwrap_udt("_hits")), mean), F.lit(0))
    return counted.withColumn(score_col, score).drop("_tokens", "_hits")


def _looked_up(tokens: Column, words: dict[str, Word]) -> Column:
    """The known tokens in order, as `(pos, polarity, degree)`.

    A map literal is searched one key after the other, so the lexicon is dealt over many small maps by the hash of the word.
    """
    n = 1 << len(words).bit_length()
    buckets: list[dict] = [{} for _ in range(n)]
    for word, known in words.items():
        buckets[known.hash % n][word] = {"polarity": known.polarity, "degree": known.degree}
    table = constant(buckets, "array<map<string, struct<polarity: bigint, degree: bigint>>>")
    place = lambda word: F.pmod(F.xxhash64(word), F.lit(n)).cast("int")
    found = F.transform(
        tokens, lambda word, i: F.struct(i.alias("pos"), F.try_element_at(F.get(table, place(word)), word).alias("known"))
    )
    known = F.filter(found, lambda token: token["known"].isNotNull())
    return F.transform(known, lambda token: F.struct(token["pos"], token["known"]["polarity"], token["known"]["degree"]))


def _scanned(entries: Column, reach: int) -> Column:
    """The score from the known words in order, by a scan whose state is what still waits for a word to change."""
    zero = F.struct(
        F.lit(0).cast("long").alias("total"),
        F.lit(0).cast("long").alias("hits"),
        F.lit(1.0).alias("degree"),
        F.lit(None).cast("double").alias("negation"),
        F.lit(None).cast("long").alias("last"),  # the place of the last word that waits
    )

    def step(state: Column, word: Column) -> Column:
        waits = F.coalesce(word["pos"] - state["last"] <= reach, F.lit(False))
        degree = F.when(waits, state["degree"]).otherwise(1.0)
        negation = F.when(waits, state["negation"])
        changed = word["polarity"] * F.coalesce(negation / degree, degree)
        free = word["polarity"].isNotNull()  # a known word uses up what waited for it
        gain = F.when(free, F.least(F.greatest(F.floor(changed + 0.5), F.lit(-MILLION)), F.lit(MILLION)))
        own = word["degree"] / MILLION
        before = F.when(free, F.lit(None).cast("double")).otherwise(negation)
        return F.struct(
            (state["total"] + F.coalesce(gain, F.lit(0))).alias("total"),
            (state["hits"] + free.cast("long")).alias("hits"),
            (F.when(free, 1.0).otherwise(degree) * F.when(own > 0, own).otherwise(1.0)).alias("degree"),
            F.when(own < 0, F.coalesce(before, F.lit(1.0)) * own).otherwise(before).alias("negation"),
            F.when(own.isNotNull(), word["pos"].cast("long")).alias("last"),
        )

    return F.aggregate(entries, zero, step, lambda state: _mean(state["total"], state["hits"]))


def _sieve(entries: DataFrame) -> Callable[[Column], Column]:
    """A test that all words of the lexicon pass, and few others: one bit for the hash of each word, in 1 MB at most.

    A lexicon of more words than bits passes more of the others; the join then leaves them out.
    """
    n = max(64, min(MAX_BITS, 1 << (BITS_PER_WORD * entries.count()).bit_length()))
    place = F.pmod(F.xxhash64("word"), F.lit(n)).alias("place")
    bits = entries.select(place).groupBy(F.expr("place div 64").alias("at")).agg(F.expr("bit_or(shiftleft(1L, int(place % 64)))").alias("bits"))
    table = [0] * (n // 64)
    for row in bits.collect():
        table[row["at"]] = row["bits"]
    literal = constant(table, "array<bigint>")

    def passes(word: Column) -> Column:
        place = F.pmod(F.xxhash64(word), F.lit(n))
        return F.getbit(F.get(literal, F.floor(place / 64).cast("int")), (place % 64).cast("int")) == 1

    return passes


def _score_by_join(df: DataFrame, text_col: str, entries: DataFrame, score_col: str, reach: int) -> DataFrame:
    """Score by the digest of the text, and join the scores back.

    Tokens go through a sieve of the lexicon in the row that holds them, and what is left is counted there (or keeps
    its places, where words change others) before it is exploded. Copies of a text are one after the first shuffle,
    whose map side combines them; a word common to all texts is split by the adaptive skew join.
    """
    text = F.col(text_col)
    digest = F.substring(F.unhex(F.sha2(text, 256)), 1, 16)
    passes = _sieve(entries)
    lexicon = entries.groupBy("word").agg(_average("polarity"), _average("degree"))
    tokens = letter_tokens(text)
    if reach:
        placed = F.filter(F.transform(tokens, lambda word, i: F.struct(word.alias("word"), i.alias("pos"))), lambda token: passes(token["word"]))
        uses = df.select(digest.alias("_digest"), F.inline(placed)).distinct()
        entry = F.struct("pos", "polarity", "degree")
        result = _scanned(F.sort_array(F.collect_list(entry)), reach)
    else:
        lexicon = lexicon.filter("polarity IS NOT NULL")
        uses = df.select(digest.alias("_digest"), F.inline(word_counts(F.filter(tokens, passes))))
        uses = uses.groupBy("_digest", "word").agg(F.sum("uses").alias("uses"))
        result = _mean(F.sum(F.col("uses") * F.col("polarity")), F.sum("uses"))
    scores = uses.join(lexicon, on="word").groupBy("_digest").agg(result.alias(score_col))
    joined = df.withColumn("_digest", _spread(df, text, digest)).join(scores, on="_digest", how="left").drop("_digest")
    return joined.withColumn(score_col, F.coalesce(score_col, F.lit(0.0)))


def _spread(df: DataFrame, text: Column, digest: Column) -> Column:
    """The digest, or, for a text without letters, a shorter key that meets nothing: such rows need not meet in one task."""
    plain = [F.col(f"`{field.name}`") for field in df.schema if isinstance(field.dataType, AtomicType)]
    return F.when(text.rlike(r"\p{L}"), digest).otherwise(F.unhex(F.lpad(F.hex(F.xxhash64(*plain)), 16, "0")))
