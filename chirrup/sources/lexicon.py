"""Lexicon tables `(word, polarity)`, or `(word, polarity, degree)` with the words that change others."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirrup.schemas import LEXICON, LEXICON_WITH_DEGREES, STARTER_DEGREES, STARTER_LEXICON


def starter_lexicon(spark: SparkSession, degrees: bool = False) -> DataFrame:
    """The small lexicon that comes with the package, if asked with its negations and degree words."""
    rows = ", ".join(f"('{word}', {polarity}D)" for word, polarity in STARTER_LEXICON.items())
    words = spark.sql(f"SELECT * FROM VALUES {rows} AS lexicon(word, polarity)")
    if not degrees:
        return words
    rows = ", ".join(f"('{word}', {degree}D)" for word, degree in STARTER_DEGREES.items())
    return words.unionByName(spark.sql(f"SELECT * FROM VALUES {rows} AS lexicon(word, degree)"), allowMissingColumns=True)


def read_lexicon(spark: SparkSession, path: str, degrees: bool = False) -> DataFrame:
    """A CSV file with a header and the columns `word, polarity`, or `word, polarity, degree`; empty fields are null."""
    return spark.read.schema(LEXICON_WITH_DEGREES if degrees else LEXICON).option("header", True).csv(path)


def read_xml_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """An XML lexicon of `<word form= pos= polarity=>` entries, one per sense.

    The polarity of a word is the mean over its parts of speech, each the mean over its senses.
    """
    schema = "_form string, _pos string, _polarity double"
    senses = spark.read.format("xml").schema(schema).option("rowTag", "word").load(path)
    by_part = senses.groupBy(F.col("_form").alias("word"), "_pos").agg(F.avg("_polarity").alias("polarity"))
    return by_part.groupBy("word").agg(F.avg("polarity").alias("polarity"))
