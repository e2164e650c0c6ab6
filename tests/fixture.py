"""The small fixture of FIXTURES.md."""

from chirrup.operators.bronze import bronze
from chirrup.operators.silver import silver
from chirrup.schemas import LEXICON, PREDICTION, TWEET

TWEETS = [
    (1, 0, 1672531200000, " @user when a father is dysfunctional...", 1),
    (2, 0, 1672531260000, "@user @user thanks for #lyft credit...", 2),
    (3, 1, 1672534800000, "I love this #love #Win", 3),
    (4, 0, 1672534860000, "I hate this  bad #SAD bad", 4),
    (5, None, 1672538400000, "", 5),
    (6, 1, 1672538460000, "good good day # ", 6),
    (7, 0, 1672617600000, "lost", 7),
    (8, 1, 1672617600000, None, 8),
    (9, 1, 1672617600000, "great", None),
    (10, None, 1672704000000, "meh", 10),
]

PREDICTIONS = [
    (1, "negative"), (2, "negative"), (3, "positive"), (4, "positive"),
    (6, "positive"), (7, "negative"), (7, "negative"), (99, "positive"),
]

WORDS = [
    ("love", 0.5), ("hate", -0.8), ("bad", -0.7), ("good", 0.7), ("lost", -0.1),
    ("win", 0.8), ("sad", -0.5), ("thanks", 0.2), ("great", 0.8),
]


def tweets_df(spark):
    return spark.createDataFrame(TWEETS, TWEET)


def predictions_df(spark):
    return spark.createDataFrame(PREDICTIONS, PREDICTION)


def lexicon_df(spark):
    return spark.createDataFrame(WORDS, LEXICON)


def bronze_df(spark, compat=False):
    return bronze(tweets_df(spark), predictions_df(spark), compat)


def silver_df(spark, compat=False):
    return silver(bronze_df(spark, compat), lexicon_df(spark))


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
