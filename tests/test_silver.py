from pyspark.sql import functions as F

from chirrup.functions.sentiment import label_text, polarity_category, predicted_label
from tests.fixture import rows, silver_df


def test_expected_rows(spark):
    df = silver_df(spark)
    got = rows(df.select("id", "ml_sentiment", "sentiment_label", "sentiment_score", "sentiment_category", "discrepancy"))
    assert got == sorted([
        (1, "negative", "negative", 0.0, "neutral", True),
        (2, "negative", "negative", 0.2, "positive", True),
        (3, "positive", "positive", 0.6, "strong positive", True),
        (4, "positive", "negative", -0.675, "strong negative", True),
        (5, None, "neutral", 0.0, "neutral", False),
        (6, "positive", "positive", 0.7, "strong positive", True),
        (7, "negative", "negative", -0.1, "negative", False),
        (7, "negative", "negative", -0.1, "negative", False),
        (10, None, "neutral", 0.0, "neutral", False),
    ], key=repr)


def test_schema_and_logic_of_every_row(spark):
    df = silver_df(spark)
    assert dict(df.dtypes) == {
        "id": "bigint", "label": "bigint", "timestamp": "bigint", "tweet": "string", "user_id": "bigint",
        "ml_sentiment": "string", "sentiment_label": "string", "sentiment_score": "double",
        "sentiment_category": "string", "discrepancy": "boolean",
    }
    for row in df.collect():
        assert row.tweet is not None and row.user_id is not None
        assert row.discrepancy == (row.sentiment_label != row.sentiment_category)


def test_only_spaces_are_trimmed(spark):
    from chirrup.operators.silver import silver
    from chirrup.schemas import TWEET
    from tests.fixture import lexicon_df

    tweets = spark.createDataFrame([(1, 0, 0, "  \tgood \n ", 1)], TWEET).withColumn("ml_sentiment", F.lit("x"))
    assert silver(tweets, lexicon_df(spark)).head().tweet == "\tgood \n"


def test_bin_edges(spark):
    edges = [1.0, 0.6, 0.599999, 0.100001, 0.1, 0.0, -0.099999, -0.1, -0.599999, -0.6, -1.0]
    df = spark.createDataFrame([(i, score) for i, score in enumerate(edges)], "i int, score double")
    got = [row.c for row in df.select("i", polarity_category(F.col("score")).alias("c")).orderBy("i").collect()]
    assert got == [
        "strong positive", "strong positive", "positive", "positive", "neutral", "neutral", "neutral", "negative",
        "negative", "strong negative", "strong negative",
    ]


def test_label_texts(spark):
    df = spark.createDataFrame([(1,), (0,), (2,), (None,)], "label long")
    assert [row.t for row in df.select(label_text(F.col("label")).alias("t")).collect()] == [
        "positive", "negative", "neutral", "neutral"
    ]


def test_predicted_labels(spark):
    df = spark.createDataFrame([("positive",), ("negative",), ("1",), ("0",), ("?",), (None,)], "s string")
    assert [row.p for row in df.select(predicted_label(F.col("s")).alias("p")).collect()] == [1, 0, 1, 0, None, None]
