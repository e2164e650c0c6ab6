"""Gold tables of word and hashtag counts, and their ranking on read.

Every count is a partial aggregation before its shuffle, so a word that makes up a third of the text reaches the
shuffle as one row per task.

Each table is a job on silver. All four also follow from one table of counted words (`counted_words`,
`word_tables`), which reads and splits the texts once instead of four times.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirrup.functions.text import space_words
from chirrup.schemas import NEGATIVE_WORDS, POSITIVE_WORDS

HASHTAG = "#"


def negative_word_frequency(silver: DataFrame, words: list[str] = NEGATIVE_WORDS) -> DataFrame:
    return _listed_frequency(_lower_uses(silver), "negative", words)


def positive_word_frequency(silver: DataFrame, words: list[str] = POSITIVE_WORDS) -> DataFrame:
    return _listed_frequency(_lower_uses(silver), "positive", words)


def neutral_word_frequency(silver: DataFrame) -> DataFrame:
    """All words of the tweets whose polarity is neutral, the empty word included."""
    return _neutral_frequency(_lower_uses(silver))


def top_hashtags_by_sentiment(silver: DataFrame, prefix: str = HASHTAG) -> DataFrame:
    """Words that start with the prefix, case kept, per sentiment category."""
    return _prefixed_counts(word_uses(silver), prefix)


def word_uses(silver: DataFrame) -> DataFrame:
    """One row per word of each tweet, with its case: `word, sentiment_label, sentiment_category, uses`."""
    words = F.explode(space_words(F.col("tweet"))).alias("word")
    return silver.select(words, "sentiment_label", "sentiment_category", F.lit(1).cast("long").alias("uses"))


def counted_words(silver: DataFrame) -> DataFrame:
    """The uses that at least one of the four tables counts, added up before and after one shuffle."""
    word = F.col("word")
    counted = (
        (F.col("sentiment_category") == "neutral")
        | word.startswith(HASHTAG)
        | F.lower(word).isin(NEGATIVE_WORDS + POSITIVE_WORDS)
    )
    keys = ["word", "sentiment_label", "sentiment_category"]
    return word_uses(silver).filter(counted).groupBy(*keys).agg(F.sum("uses").alias("uses"))


def word_tables(uses: DataFrame) -> dict[str, DataFrame]:
    """The four tables from counted words."""
    lower_uses = uses.withColumn("word", F.lower("word"))
    return {
        "negative_word_frequency": _listed_frequency(lower_uses, "negative", NEGATIVE_WORDS),
        "positive_word_frequency": _listed_frequency(lower_uses, "positive", POSITIVE_WORDS),
        "neutral_word_frequency": _neutral_frequency(lower_uses),
        "top_hashtags_by_sentiment": _prefixed_counts(uses, HASHTAG),
    }


def ranked(counts: DataFrame, count_col: str, *keys: str, k: int | None = None) -> DataFrame:
    """Largest counts first, equal counts in key order; with `k`, only the first `k` rows."""
    ordered = counts.orderBy(F.desc(count_col), *keys)
    return ordered if k is None else ordered.limit(k)


def _lower_uses(silver: DataFrame) -> DataFrame:
    return word_uses(silver.withColumn("tweet", F.lower("tweet")))


def _listed_frequency(lower_uses: DataFrame, label: str, words: list[str]) -> DataFrame:
    return _frequency(lower_uses.filter((F.col("sentiment_label") == label) & F.col("word").isin(words)))


def _neutral_frequency(lower_uses: DataFrame) -> DataFrame:
    return _frequency(lower_uses.filter(F.col("sentiment_category") == "neutral"))


def _frequency(uses: DataFrame) -> DataFrame:
    return uses.groupBy("word").agg(F.sum("uses").alias("freq"))


def _prefixed_counts(uses: DataFrame, prefix: str) -> DataFrame:
    tags = uses.filter(F.col("word").startswith(prefix))
    return tags.groupBy("word", "sentiment_category").agg(F.sum("uses").alias("count"))
