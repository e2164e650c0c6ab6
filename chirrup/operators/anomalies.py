"""Discrepant tweets, their log and its alert."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirrup.schemas import ALERT_MESSAGE, ANOMALY_DESCRIPTION


def discrepant_tweets(silver: DataFrame) -> DataFrame:
    return silver.filter("discrepancy").select(
        "id", "label", "sentiment_label", "sentiment_score", "ml_sentiment", "sentiment_category"
    )


def anomaly_log(silver: DataFrame, log_time: datetime | None = None) -> DataFrame:
    """Discrepant tweets, stamped with the given time or the time of the run."""
    stamp = F.current_timestamp() if log_time is None else F.lit(log_time)
    return silver.filter("discrepancy").select(
        "id",
        "tweet",
        "label",
        "ml_sentiment",
        "sentiment_label",
        "sentiment_score",
        "sentiment_category",
        stamp.alias("log_time"),
        F.lit(ANOMALY_DESCRIPTION).alias("description"),
    )


def anomaly_alert(anomalies: DataFrame) -> DataFrame:
    """One row with the number of anomalies and the message, no row if there are none."""
    return (
        anomalies.agg(F.count("*").alias("anomaly_count"))
        .filter(F.col("anomaly_count") > 0)
        .withColumn("message", F.format_string(ALERT_MESSAGE, "anomaly_count"))
    )
