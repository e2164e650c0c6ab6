"""Gold tables over time and over label against prediction."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chirrup.functions.sentiment import predicted_label
from chirrup.functions.times import time_bucket


def hourly_sentiment_trend(silver: DataFrame) -> DataFrame:
    """Tweets per hour and label text, and the share of the hour in percent.

    The window runs over the counts (a few rows per hour), not over the tweets.
    """
    counts = silver.groupBy(time_bucket(F.col("timestamp"), "hour").alias("hour"), "sentiment_label").agg(
        F.count("*").alias("tweet_count")
    )
    hour_total = F.sum("tweet_count").over(Window.partitionBy("hour"))
    return counts.withColumn("percentage", F.col("tweet_count") / hour_total * 100)


def by_time(trend: DataFrame) -> DataFrame:
    """The stored trend in the order of hours, and of label texts within an hour."""
    return trend.orderBy("hour", "sentiment_label")


def ml_sentiment_accuracy(silver: DataFrame) -> DataFrame:
    """Correct predictions per day; unlabelled tweets count in the total only."""
    correct = (predicted_label(F.col("ml_sentiment")) == F.col("label")).cast("int")
    return (
        silver.groupBy(time_bucket(F.col("timestamp"), "day").alias("day"))
        .agg(F.count("*").alias("total_tweets"), F.sum(correct).alias("correct_predictions"))
        .withColumn("accuracy_percentage", F.col("correct_predictions") / F.col("total_tweets") * 100)
    )


def ml_vs_label_comparison(silver: DataFrame) -> DataFrame:
    """Confusion table of label and prediction; missing values form their own groups."""
    return silver.groupBy("label", "ml_sentiment").agg(F.count("*").alias("total_tweets"))
