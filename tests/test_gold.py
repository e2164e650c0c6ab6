import random
from collections import Counter
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from chirrup.operators.anomalies import anomaly_alert, anomaly_log, discrepant_tweets
from chirrup.operators.trends import hourly_sentiment_trend, ml_sentiment_accuracy, ml_vs_label_comparison
from chirrup.operators.words import (
    counted_words,
    negative_word_frequency,
    neutral_word_frequency,
    positive_word_frequency,
    ranked,
    top_hashtags_by_sentiment,
    word_tables,
)
from chirrup.schemas import NEGATIVE_WORDS, POSITIVE_WORDS
from tests.fixture import rows, silver_df


def utc(text):
    return datetime.fromisoformat(text)


def test_hourly_sentiment_trend(spark):
    df = hourly_sentiment_trend(silver_df(spark))
    assert dict(df.dtypes) == {
        "hour": "timestamp", "sentiment_label": "string", "tweet_count": "bigint", "percentage": "double"
    }
    assert rows(df) == sorted([
        (utc("2023-01-01T00:00"), "negative", 2, 100.0),
        (utc("2023-01-01T01:00"), "negative", 1, 50.0),
        (utc("2023-01-01T01:00"), "positive", 1, 50.0),
        (utc("2023-01-01T02:00"), "neutral", 1, 50.0),
        (utc("2023-01-01T02:00"), "positive", 1, 50.0),
        (utc("2023-01-02T00:00"), "negative", 2, 100.0),
        (utc("2023-01-03T00:00"), "neutral", 1, 100.0),
    ], key=repr)


def test_shares_of_an_hour_sum_to_100(spark):
    sums = hourly_sentiment_trend(silver_df(spark)).groupBy("hour").agg(F.sum("percentage").alias("s")).collect()
    assert [row.s for row in sums] == pytest.approx([100.0] * len(sums))


def test_missing_timestamps_form_their_own_bucket(spark):
    silver = silver_df(spark).withColumn("timestamp", F.when(F.col("id") > 3, F.col("timestamp")))
    assert hourly_sentiment_trend(silver).filter("hour IS NULL").agg(F.sum("tweet_count")).head()[0] == 3
    assert ml_sentiment_accuracy(silver).filter("day IS NULL").head().total_tweets == 3


def test_discrepant_tweets(spark):
    df = discrepant_tweets(silver_df(spark))
    assert df.columns == ["id", "label", "sentiment_label", "sentiment_score", "ml_sentiment", "sentiment_category"]
    got = df.collect()
    assert sorted(row.id for row in got) == [1, 2, 3, 4, 6]
    assert all(row.sentiment_label != row.sentiment_category for row in got)


def test_word_frequencies(spark):
    silver = silver_df(spark)
    negative, positive = negative_word_frequency(silver), positive_word_frequency(silver)
    assert negative.columns == positive.columns == ["word", "freq"]
    assert rows(negative) == [("#sad", 1), ("bad", 2), ("hate", 1), ("lost", 2)]
    assert rows(positive) == [("#love", 1), ("#win", 1), ("good", 2), ("love", 1)]
    assert rows(neutral_word_frequency(silver)) == [
        ("", 1), ("@user", 1), ("a", 1), ("dysfunctional...", 1), ("father", 1), ("is", 1), ("meh", 1), ("when", 1)
    ]


def test_word_lists():
    assert len(NEGATIVE_WORDS) == len(set(NEGATIVE_WORDS)) == 14
    assert len(POSITIVE_WORDS) == len(set(POSITIVE_WORDS)) == 13


def test_neutral_frequencies_add_up_to_the_words(spark):
    silver = silver_df(spark)
    neutral = silver.filter("sentiment_category = 'neutral'")
    words = neutral.select(F.sum(F.size(F.split("tweet", " ")))).head()[0]
    assert neutral_word_frequency(silver).agg(F.sum("freq")).head()[0] == words


def test_top_hashtags_by_sentiment(spark):
    df = top_hashtags_by_sentiment(silver_df(spark))
    assert df.columns == ["word", "sentiment_category", "count"]
    assert rows(df) == [
        ("#", "strong positive", 1), ("#SAD", "strong negative", 1), ("#Win", "strong positive", 1),
        ("#love", "strong positive", 1), ("#lyft", "positive", 1),
    ]
    assert rows(top_hashtags_by_sentiment(silver_df(spark), prefix="@")) == [
        ("@user", "neutral", 1), ("@user", "positive", 2)
    ]


def test_tables_from_counted_words_equal_the_jobs(spark):
    rng = random.Random(3)
    vocabulary = [*NEGATIVE_WORDS, *POSITIVE_WORDS, "Bad", "#SAD", "GOOD", "#", "", "x", "ΟΔΟΣ", "#Σ", "İx", "a\nb", "\t"]
    categories = ["strong positive", "positive", "neutral", "negative", "strong negative"]
    data = [
        (" ".join(rng.choices(vocabulary, k=rng.randint(1, 9))), rng.choice(categories[1:4]), rng.choice(categories))
        for _ in range(500)
    ]
    silver = spark.createDataFrame(data, "tweet string, sentiment_label string, sentiment_category string")
    tables = word_tables(counted_words(silver))
    for job in (negative_word_frequency, positive_word_frequency, neutral_word_frequency, top_hashtags_by_sentiment):
        assert rows(tables[job.__name__]) == rows(job(silver)), job.__name__

    neutral = Counter(word for tweet, _, category in data if category == "neutral" for word in tweet.lower().split(" "))
    assert rows(tables["neutral_word_frequency"]) == rows(spark.createDataFrame(list(neutral.items())))


def test_ranked(spark):
    counts = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5)], "word string, freq long")
    assert [row.word for row in ranked(counts, "freq", "word").collect()] == ["c", "a", "b"]
    assert [row.word for row in ranked(counts, "freq", "word", k=2).collect()] == ["c", "a"]


def test_ml_sentiment_accuracy(spark):
    got = ml_sentiment_accuracy(silver_df(spark)).orderBy("day").collect()
    assert [tuple(row) for row in got] == [
        (utc("2023-01-01"), 6, 4, 66.66666666666666),
        (utc("2023-01-02"), 2, 2, 100.0),
        (utc("2023-01-03"), 1, None, None),
    ]
    for row in got[:2]:
        assert row.accuracy_percentage == row.correct_predictions / row.total_tweets * 100


def test_ml_sentiment_accuracy_compat(spark):
    got = ml_sentiment_accuracy(silver_df(spark, compat=True)).orderBy("day").collect()
    assert [tuple(row) for row in got] == [
        (utc("2023-01-01"), 6, 5, 83.33333333333334),
        (utc("2023-01-02"), 2, 2, 100.0),
        (utc("2023-01-03"), 1, None, None),
    ]


def test_ml_vs_label_comparison(spark):
    assert rows(ml_vs_label_comparison(silver_df(spark))) == sorted([
        (0, "negative", 4), (0, "positive", 1), (1, "positive", 2), (None, None, 2)
    ], key=repr)
    assert rows(ml_vs_label_comparison(silver_df(spark, compat=True))) == sorted([
        (0, "0", 5), (1, "1", 2), (None, None, 2)
    ], key=repr)


def test_anomaly_log(spark):
    stamp = datetime(2023, 2, 1, tzinfo=timezone.utc)
    df = anomaly_log(silver_df(spark), stamp)
    assert df.columns == [
        "id", "tweet", "label", "ml_sentiment", "sentiment_label", "sentiment_score", "sentiment_category", "log_time",
        "description",
    ]
    assert dict(df.dtypes)["log_time"] == "timestamp"
    got = df.collect()
    assert sorted(row.id for row in got) == [1, 2, 3, 4, 6]
    assert {row.description for row in got} == {"Discrepancy between label and sentiment"}
    assert df.select(F.unix_seconds("log_time")).distinct().head()[0] == int(stamp.timestamp())


def test_anomaly_log_is_stamped_with_the_time_of_the_run(spark):
    seconds = anomaly_log(silver_df(spark)).select(F.unix_seconds("log_time")).distinct().collect()
    assert len(seconds) == 1 and abs(seconds[0][0] - datetime.now().timestamp()) < 600


def test_anomaly_alert(spark):
    log = anomaly_log(silver_df(spark))
    assert [tuple(row) for row in anomaly_alert(log).collect()] == [
        (5, "Anomaly Detected! 5 discrepancies found in sentiment pipeline.")
    ]
    assert anomaly_alert(log.limit(0)).collect() == []
