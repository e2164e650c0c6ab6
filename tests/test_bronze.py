import pytest
from pyspark.sql import functions as F

from chirrup.operators.bronze import COPIES_PER_RUN, bronze
from chirrup.schemas import PREDICTION, TWEET
from tests.fixture import bronze_df, predictions_df, rows, tweets_df


def test_every_tweet_stays_and_duplicate_predictions_fan_out(spark):
    df = bronze_df(spark)
    assert df.columns == ["id", "label", "timestamp", "tweet", "user_id", "ml_sentiment"]
    assert dict(df.dtypes) == {
        "id": "bigint", "label": "bigint", "timestamp": "bigint", "tweet": "string", "user_id": "bigint",
        "ml_sentiment": "string",
    }
    got = [(row.id, row.ml_sentiment) for row in df.orderBy("id").collect()]
    assert got == [
        (1, "negative"), (2, "negative"), (3, "positive"), (4, "positive"), (5, None), (6, "positive"),
        (7, "negative"), (7, "negative"), (8, None), (9, None), (10, None),
    ]


def test_compat_puts_the_label_in_place_of_the_prediction(spark):
    got = {(row.id, row.label, row.ml_sentiment) for row in bronze_df(spark, compat=True).collect()}
    assert all(sentiment == (None if label is None else str(label)) for _, label, sentiment in got)
    assert bronze_df(spark, compat=True).count() == 11


def test_equals_a_plain_left_join(spark):
    tweets = spark.createDataFrame([(i % 5 if i % 4 else None, 1, i, "t", i) for i in range(40)], TWEET)
    predictions = spark.createDataFrame(
        [(i % 7 if i % 3 else None, ["positive", "negative", None][i % 3]) for i in range(60)], PREDICTION
    )
    want = rows(tweets.join(predictions, on="id", how="left"))
    assert rows(bronze(tweets, predictions)) == rows(bronze(tweets, predictions, hot_predictions=False)) == want


def test_a_hot_prediction_id_keeps_all_its_copies(spark):
    copies = 3 * COPIES_PER_RUN + 17
    hot = spark.range(copies).selectExpr("1L AS id", "'positive' AS ml_sentiment")
    df = bronze(tweets_df(spark), hot.unionAll(predictions_df(spark)))
    counts = {row.id: row["count"] for row in df.groupBy("id").count().collect()}
    assert counts[1] == copies + 1
    assert counts[7] == 2
    assert counts[10] == 1


def test_hot_ids_equal_a_plain_left_join(spark, monkeypatch):
    monkeypatch.setattr("chirrup.operators.bronze.COPIES_PER_RUN", 3)
    tweets = spark.createDataFrame([(i % 5 if i % 4 else None, 1, i, "t", i) for i in range(40)], TWEET)
    predictions = spark.createDataFrame(
        [(1, "positive")] * 10 + [(2, "negative")] * 3 + [(2, "positive")] * 7 + [(3, None)] * 9 + [(None, "positive")] * 9,
        PREDICTION,
    )
    want = rows(tweets.join(predictions, on="id", how="left"))
    assert rows(bronze(tweets, predictions)) == want


def test_a_hot_prediction_id_is_expanded_by_many_tasks(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        hot = spark.range(8_000_000).selectExpr("1L AS id", "'positive' AS ml_sentiment")
        df = bronze(tweets_df(spark), hot)
        sizes = [row["count"] for row in df.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sum(sizes) == 8_000_000 + tweets_df(spark).count() - 1
    assert max(sizes) <= 0.1 * sum(sizes)


def spread(spark, tweets, predictions, n_tasks=16):
    """The numbers of rows by task."""
    spark.conf.set("spark.sql.shuffle.partitions", str(n_tasks))
    try:
        df = bronze(tweets, predictions)
        return [row["count"] for row in df.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_many_different_predictions_of_one_id_are_joined_by_many_tasks(spark):
    hot = spark.range(8_000_000).selectExpr("1L AS id", "string(id) AS ml_sentiment")
    sizes = spread(spark, tweets_df(spark), hot)
    assert sum(sizes) == 8_000_000 + tweets_df(spark).count() - 1
    assert max(sizes) <= 0.1 * sum(sizes)


def test_an_id_that_is_hot_on_both_sides_is_joined_by_many_tasks(spark):
    tweets = spark.range(3000).selectExpr("if(id % 3 = 0, 4, id) AS id", "1L AS label", "id AS timestamp", "'t' AS tweet", "id AS user_id")
    hot = spark.range(18_000).selectExpr("if(id % 3 = 0, 4, id) AS id", "string(id % 4500) AS ml_sentiment")
    sizes = spread(spark, tweets, hot)
    want = tweets.join(hot, "id", "left").count()
    assert sum(sizes) == want > 6_000_000
    assert max(sizes) <= 0.1 * sum(sizes)


def test_a_mixture_of_hot_ids_equals_a_plain_left_join(spark, monkeypatch):
    """Copies, different predictions, null predictions, null ids and ids without a tweet; every limit is small."""
    monkeypatch.setattr("chirrup.operators.bronze.COPIES_PER_RUN", 5)
    rows_of = lambda k: [(k, ["positive", "negative", None, str(j)][j % 4]) for j in range(40)]
    predictions = [*rows_of(1), *rows_of(2), *rows_of(77), *[(None, "x")] * 50, *[(3, "positive")] * 60, (5, "a"), (6, None)]
    values = [(k % 8 or None, 1, k, "t", k) for k in range(64)] + [(1, 1, 0, "same", 0)] * 9
    tweets, predictions = spark.createDataFrame(values, TWEET), spark.createDataFrame(predictions, PREDICTION)
    assert rows(bronze(tweets, predictions)) == rows(tweets.join(predictions, on="id", how="left"))
    compat = rows(bronze(tweets, predictions, compat=True))
    assert compat == rows(tweets.join(predictions, on="id", how="left").withColumn("ml_sentiment", F.col("label").cast("string")))


def test_hot_ids_are_found_among_many_others(spark):
    """The sketch of many tasks holds each id above the limit, whatever else there is."""
    from chirrup.operators.bronze import _grid

    predictions = spark.range(0, 2_000_000, 1, 40).selectExpr("if(id % 20 < 5, id % 20 - 2, id) AS id", "'p' AS ml_sentiment")
    ids, cells = _grid(tweets_df(spark), predictions)
    assert sorted(ids) == [-2, -1, 0, 1, 2]
    assert {row["id"] for row in cells.collect()} == set(ids)
    assert _grid(tweets_df(spark), predictions.filter("id > 100")) is None


@pytest.fixture
def small_skew_limits(spark):
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    for key, value in limits.items():
        spark.conf.set(key, value)
    yield
    for key in limits:
        spark.conf.unset(key)


def test_hot_and_missing_tweet_ids_are_split_by_the_adaptive_join(spark, small_skew_limits, tmp_path):
    """A third of all tweets shares one id and a third has none: the join is split and nothing is lost."""
    tweets = spark.range(0, 60_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 5 WHEN id % 3 = 1 THEN NULL ELSE id END AS id",
        "1L AS label", "id AS timestamp", "sha2(string(id), 512) AS tweet", "id AS user_id",
    )
    predictions = spark.range(60_000).selectExpr("id", "'positive' AS ml_sentiment")
    df = bronze(tweets, predictions)
    df.write.parquet(str(tmp_path / "bronze"))
    stored = spark.read.parquet(str(tmp_path / "bronze"))
    assert stored.count() == stored.select("timestamp").distinct().count() == 60_000
    assert stored.filter("ml_sentiment IS NULL").count() == 20_000
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
