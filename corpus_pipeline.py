"""From raw documents to packed training sequences, in five stages, each one operator over all that the last one kept."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirrup.llm import near_duplicates, packing, pii, quality_crf, repeats
from chirrup.llm.common import stored
from chirrup.llm.queries import MIN_QUALITY, piece_columns, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _with_text(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier calls good; it learns from the labels of these documents."""
    model = quality_crf.fit(docs, table(spark, sf_dir, "labels"))
    return quality_crf.score(docs, model, out="_score").filter(F.col("_score") >= MIN_QUALITY).select(COLUMNS)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id.

    A row that repeats with its id and text stays once; rows without an id stay, as nothing tells which of them to keep.
    """
    classes = near_duplicates.components(docs)
    first = classes.filter("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(first, "doc_id", "left_semi")
    repeated = docs.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").count().filter("count > 1")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates(["doc_id", "text"])
    return kept.unionByName(docs.filter(F.col("doc_id").isNull())).select(COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that documents share."""
    return _with_text(repeats.remove_repeats(docs))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the kind of each personal datum in its place."""
    found = pii.find(docs.select(COLUMNS)).withColumn("text", pii.redacted(F.col("text"), F.col("spans")))
    return _with_text(found)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    return piece_columns(packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", one_of_each_class),
    ("substring dedup", without_repeats),
    ("PII", without_personal_data),
    ("packing", packed),
]

# The line classifier is fitted, which SQL cannot say; the tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each but the last is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
