import json
import random

import pytest
from pyspark.sql import functions as F

from chirrup.operators.silver import silver
from chirrup.schemas import PREDICTION, TWEET
from chirrup.sources import arrays
from chirrup.sources.arrays import read_records
from chirrup.sources.records import export_csv, read_csv, read_predictions, read_tweets, rejected_tweets, write_predictions
from tests.fixture import PREDICTIONS, TWEETS, lexicon_df, predictions_df, rows, tweets_df

KEYS = ["id", "label", "timestamp", "tweet", "user_id"]


def lines(records):
    return "".join(json.dumps(record) + "\n" for record in records)


def test_tweet_directory(spark, tmp_path):
    records = [dict(zip(KEYS, tweet)) for tweet in TWEETS]
    (tmp_path / "a.json").write_text(lines(records[:5]) + "\n\n")
    (tmp_path / "b.json").write_text(lines(records[5:]))
    df = read_tweets(spark, str(tmp_path))
    assert df.schema == TWEET
    assert rows(df) == rows(tweets_df(spark))


def test_numbers_as_other_tools_write_them(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"id": 3.0, "label": 1.0, "timestamp": 1672531200000.0, "tweet": "a", "user_id": "7"}\n'
        '{"id": "4", "label": null, "timestamp": 1.6725312e12, "tweet": "b", "user_id": 1.5}\n'
        '{"id": 5, "label": true, "timestamp": 0, "tweet": "c", "user_id": 9}\n'
    )
    assert rows(read_tweets(spark, str(tmp_path))) == [
        (3, 1, 1672531200000, "a", 7), (4, None, 1672531200000, "b", None), (5, None, 0, "c", 9)
    ]
    assert [row.id for row in rejected_tweets(spark, str(tmp_path)).orderBy("id").collect()] == ["4", "5"]


def test_a_malformed_line_is_dropped_by_silver(spark, tmp_path):
    (tmp_path / "a.json").write_text(lines([dict(zip(KEYS, TWEETS[2]))]) + '{"id": 5, "tweet": \n')
    tweets = read_tweets(spark, str(tmp_path))
    assert tweets.count() == 2
    clean = silver(tweets.selectExpr("*", "'positive' AS ml_sentiment"), lexicon_df(spark))
    assert [row.id for row in clean.collect()] == [3]


def test_prediction_files_as_array_and_as_lines(spark, tmp_path):
    records = [{"id": i, "ml_sentiment": sentiment, "label": 1} for i, sentiment in PREDICTIONS]
    (tmp_path / "array.json").write_text(json.dumps(records))
    (tmp_path / "pretty.json").write_text(json.dumps(records, indent=2))
    (tmp_path / "lines.json").write_text(lines(records))
    want = rows(predictions_df(spark))
    for name, multi_line in (("array", False), ("lines", False), ("pretty", True)):
        df = read_predictions(spark, str(tmp_path / f"{name}.json"), multi_line)
        assert df.schema == PREDICTION
        assert rows(df) == want


@pytest.fixture
def ranges(spark):
    """Sets the size of the byte ranges."""

    def set_size(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")

    yield set_size
    for key in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{key}")


NASTY = ["}", "{", '"', "\\", '\\"', '"}', "},{", '{"id": 1}', "]", "[", ",", "\n", "\\\\", "\u00e9\u6f22", "a b", "", " ", ":", '","', '":{"']


def nasty_value(rnd, depth=0):
    kind = rnd.randrange(7)
    if kind < 4 or depth > 3:
        return "".join(rnd.choices(NASTY, k=rnd.randrange(6)))
    if kind == 4:
        return rnd.choice([None, True, 1.5, -3, 10**12])
    if kind == 5:
        return [nasty_value(rnd, depth + 1) for _ in range(rnd.randrange(3))]
    return {rnd.choice(NASTY) + str(k): nasty_value(rnd, depth + 1) for k in range(rnd.randrange(3))}


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("size", [1, 7, 64, 1000, 1 << 27])
def test_records_of_arrays_whatever_the_byte_ranges(spark, tmp_path, ranges, indent, size):
    """Strings with braces, quotes and escapes, records in records, several files, and ranges within a record or a string."""
    rnd = random.Random(size + bool(indent))
    few = {1: 3, 7: 10}.get(size, 40)
    files = [[{"id": i, "v": nasty_value(rnd), "w": nasty_value(rnd)} for i in range(rnd.randrange(few))] for _ in range(3)]
    for k, records in enumerate(files):
        (tmp_path / f"{k}.json").write_text(json.dumps(records, indent=indent, ensure_ascii=bool(k % 2)), encoding="utf-8")
    (tmp_path / "empty.json").write_text("[]")
    (tmp_path / "nothing.json").write_text("")
    (tmp_path / "two.json").write_text('[{"id": -1}]\n [{"id": -2}, {}]\n')
    ranges(size)
    got = sorted(json.dumps(json.loads(row.value)) for row in read_records(spark, str(tmp_path)).collect())
    want = [record for records in files for record in records] + [{"id": -1}, {"id": -2}, {}]
    assert got == sorted(map(json.dumps, want))


def test_an_array_is_read_as_its_lines_are_and_by_many_tasks(spark, tmp_path, ranges):
    records = [{"id": i, "ml_sentiment": ["positive", "negative", "a } b", 'say "{"', None][i % 5], "other": {"x": [i, {"y": "}"}]}} for i in range(20_000)]
    records += [{"id": 2.0, "ml_sentiment": "positive"}, {"id": "3", "ml_sentiment": ""}, {"id": 1.5}, {"ml_sentiment": "x"}, {}]
    (tmp_path / "array.json").write_text(json.dumps(records, separators=(",", ":")))
    (tmp_path / "lines.json").write_text(lines(records))
    ranges(50_000)
    df = read_predictions(spark, str(tmp_path / "array.json"), array=True)
    assert df.schema == PREDICTION
    assert rows(df) == rows(read_predictions(spark, str(tmp_path / "lines.json")))
    sizes = [row["count"] for row in df.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 20 and max(sizes) < 0.1 * len(records)


def test_a_file_that_is_cut_off_loses_its_end_only(spark, tmp_path, ranges):
    (tmp_path / "a.json").write_text('[{"id": 1}, {"id": 2, "ml_sentiment": "x')
    (tmp_path / "b.json").write_text('[{"id": 3}, {"id": 4')
    (tmp_path / "c.json").write_text('[{"id": 5}, {"id": 6}')
    for size in (5, 1000):
        ranges(size)
        assert sorted(row.id for row in read_predictions(spark, str(tmp_path), array=True).collect()) == [1, 3, 5]


def test_too_many_ranges_are_refused(spark, tmp_path, ranges, monkeypatch):
    (tmp_path / "a.json").write_text(json.dumps([{"id": i} for i in range(100)]))
    monkeypatch.setattr(arrays, "MAX_RANGES", 5)
    ranges(20)
    with pytest.raises(ValueError, match="maxPartitionBytes"):
        read_records(spark, str(tmp_path))


def test_predictions_round_trip_as_arrays(spark, tmp_path):
    path = str(tmp_path / "predictions")
    predictions = predictions_df(spark).repartition(3).unionAll(spark.createDataFrame([(None, '"}'), (5, None)], PREDICTION))
    write_predictions(predictions, path, array=True)
    assert rows(read_predictions(spark, path, array=True)) == rows(predictions)
    for file in (tmp_path / "predictions").glob("*.txt"):
        assert isinstance(json.loads(file.read_text()), list)
    write_predictions(predictions.limit(0), path, array=True)
    assert read_predictions(spark, path, array=True).count() == 0


def test_predictions_round_trip(spark, tmp_path):
    path = str(tmp_path / "predictions")
    write_predictions(predictions_df(spark), path)
    assert rows(read_predictions(spark, path)) == rows(predictions_df(spark))


def test_csv_export(spark, tmp_path):
    words = [("", 3), ("a,b", 1), ('say "hi"', 2), ("two\nlines", 4), ("tab\t", 5), (None, 6), ("\\", 7),
             ("\\\"", 8), (" b ", 9), ("x\r\ny", 10), ("\r", 11), ("\n", 12), ('"', 13), ("#a", None)]
    df = spark.createDataFrame(words, "word string, freq long")
    path = str(tmp_path / "words")
    export_csv(df, path)
    assert rows(read_csv(spark, path, "word string, freq long")) == rows(df)


def test_csv_has_the_header_and_plain_rows(spark, tmp_path):
    path = tmp_path / "words"
    export_csv(spark.createDataFrame([("hate", 123), ("#sad", 66)], "word string, freq long").coalesce(1), str(path))
    [part] = path.glob("*.csv")
    assert part.read_text().splitlines() == ["word,freq", "hate,123", "#sad,66"]
