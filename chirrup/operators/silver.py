"""Silver: complete tweets with their sentiment columns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirrup.functions.sentiment import differs, label_text, polarity_category
from chirrup.operators.polarity import score


def silver(bronze: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Drop tweets without text or user, add four sentiment columns, then trim the text.

    The score is taken from the text as it came, before the trim.
    """
    complete = bronze.filter(F.col("tweet").isNotNull() & F.col("user_id").isNotNull())
    labelled = complete.withColumn("sentiment_label", label_text(F.col("label")))
    return (
        score(labelled, "tweet", lexicon)
        .withColumn("sentiment_category", polarity_category(F.col("sentiment_score")))
        .withColumn("discrepancy", differs(F.col("sentiment_label"), F.col("sentiment_category")))
        .withColumn("tweet", F.trim("tweet"))
    )
