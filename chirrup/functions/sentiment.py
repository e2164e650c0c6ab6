"""Sentiment expressions: label text, polarity bins, discrepancy and prediction texts."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_text(label: Column) -> Column:
    """1 is positive, 0 is negative, anything else (null included) is neutral."""
    return F.when(label == 1, "positive").when(label == 0, "negative").otherwise("neutral")


def polarity_category(score: Column) -> Column:
    """Five bins over a polarity in [-1, 1].

    The score is bound once for all comparisons: repeated in each, it would be computed for each wherever Spark
    puts a filter on the category next to the text.
    """

    def bins(value: Column) -> Column:
        return (
            F.when(value >= 0.6, "strong positive")
            .when(value > 0.1, "positive")
            .when(value > -0.1, "neutral")
            .when(value > -0.6, "negative")
            .otherwise("strong negative")
        )

    return F.transform(F.array(score), bins)[0]


def differs(left: Column, right: Column) -> Column:
    """True where the two texts differ, never null."""
    return F.coalesce(left != right, F.lit(False))


def prediction_text(prediction: Column) -> Column:
    return F.when(prediction == 1, "positive").otherwise("negative")


def predicted_label(ml_sentiment: Column) -> Column:
    """The 0/1 label a stored prediction stands for: the two texts, or a label kept as text."""
    return (
        F.when(ml_sentiment == "positive", F.lit(1).cast("long"))
        .when(ml_sentiment == "negative", F.lit(0).cast("long"))
        .otherwise(ml_sentiment.try_cast("long"))
    )
