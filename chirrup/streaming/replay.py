"""Replay of JSON-lines files as a keyed stream."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from chirrup.streaming.paced import paced_lines

# Fixed value: the key of a record that lacks the key field.
DEFAULT_KEY = "default"


def keyed_records(lines: DataFrame, key: str = "Date", *others: str) -> DataFrame:
    """From text lines to `key, value`: the record's key field as text, and the whole record; `others` are kept.

    Blank lines are skipped; a line that is not exactly one JSON record fails the query (read as an array, it must have
    one element, so that text after the record is noticed). The first two columns are what a message-queue sink expects as
    well.
    """
    parsed = _parsed(lines, key)
    checked = F.when(F.col("reason").isNull(), F.col("key")).otherwise(F.raise_error(F.concat(F.lit("a line is not one record: "), "reason")))
    return parsed.select(checked.alias("key"), "value", *others)


def _parsed(lines: DataFrame, key: str) -> DataFrame:
    """Lines that are not blank, with the record's key and, if a line is not exactly one record, the reason."""
    records = lines.filter(F.col("value").rlike(r"\S")).withColumn("value", F.trim("value"))
    lenient = {"mode": "PERMISSIVE", "allowSingleQuotes": "false", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = F.from_json(F.concat(F.lit("["), "value", F.lit("]")), f"array<struct<`{key}`: string, _corrupt: string>>", lenient)
    braces = F.col("value").rlike(r"(?s)^\s*\{.*\}\s*$")
    reason = F.when(F.col("_parsed").isNull(), "no JSON").when((F.size("_parsed") != 1) | F.get("_parsed", F.lit(0)).isNull() | ~braces, "not one record")
    keyed = records.withColumn("_parsed", parsed).withColumn("reason", reason)
    return keyed.withColumn("key", F.coalesce(F.get("_parsed", F.lit(0))[key], F.lit(DEFAULT_KEY))).drop("_parsed")


def _with(*fields: str) -> Column:
    """The record with these columns as its last fields."""
    opened = F.regexp_replace("value", r"\s*\}\s*$", "")
    comma = F.when(opened.rlike(r"^\s*\{$"), "").otherwise(",")
    return F.concat(opened, comma, F.substr(F.to_json(F.struct(*fields)), F.lit(2))).alias("value")


def _source(spark: SparkSession, src: str, max_files: int, records: int | None) -> DataFrame:
    if records is not None:
        return paced_lines(spark, src, records)
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(src)


def replay(
    spark: SparkSession,
    src: str,
    dst: str,
    checkpoint: str,
    key: str = "Date",
    max_files_per_trigger: int = 1000,
    interval: str | None = None,
    records_per_trigger: int | None = None,
    rejects: str | None = None,
) -> StreamingQuery:
    """Stream the files of `src` into JSON-lines files in `dst`, a directory the tweet reader takes.

    Each record gets its key as a last field, `key`, which stands for any field of that name. Without `interval` the
    stream takes what is there and stops; with it, at most `max_files_per_trigger` files are sent per interval. With
    `records_per_trigger` the stream is paced by records instead, however the files are cut, and runs until it is stopped
    (see `paced.PacedLines`). Each task writes the records that it read to one file: the number of files does not depend on
    the number of keys, and a key that all records share is spread over the tasks.

    A line that is not one JSON record stops the stream, unless there is a folder for `rejects`. Then each batch has a
    folder `batch=...` below `dst` and one below `rejects`, with `value`, its `file` and the `reason`; a batch that is
    done again replaces both.
    """
    lines = _source(spark, src, max_files_per_trigger, records_per_trigger)
    trigger = {"availableNow": True} if interval is None and records_per_trigger is None else {"processingTime": interval or "0 seconds"}
    if rejects is None:
        writer = keyed_records(lines, key).select(_with("key")).writeStream.format("text").outputMode("append")
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start(dst)
    if records_per_trigger is None:
        lines = lines.select("value", F.col("_metadata.file_path").alias("file"))

    def send(batch: DataFrame, number: int) -> None:
        good, bad = batch.filter("reason IS NULL"), batch.filter("reason IS NOT NULL")
        good.select(_with("key")).write.mode("overwrite").text(f"{dst}/batch={number}")
        bad.select("value", "file", "reason").write.mode("overwrite").json(f"{rejects}/batch={number}")

    writer = _parsed(lines, key).writeStream.foreachBatch(send)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


# Keys are numbered in so many groups.
BUCKETS = 1024


def numbered(records: DataFrame, lanes: int = 8, hot_keys: tuple[str, ...] = (DEFAULT_KEY,), buckets: int = BUCKETS) -> DataFrame:
    """From a stream `key, value, time, file, record` to the same with `lane, sequence`.

    The records of a key are numbered from 0, without a gap, in the order of the files and their lines, over all batches
    and restarts. The records of a hot key are dealt over `lanes`, each with numbers of its own, so that they are not all
    numbered by one task; the others have lane 0. The order of a hot key is that of `time, file, record`.

    Keys and lanes are dealt over `buckets`, which are numbered as a whole, since a call of Python for each key would take
    most of the time. The state of a bucket is one number for each of its keys and lanes, and is written anew by a batch
    that has records of it: give more buckets for small batches of very many keys. Their number must stay the same as long
    as a checkpoint is used. A task holds the records of a bucket in one batch.
    """
    lane = F.when(F.col("key").isin(*hot_keys), F.pmod(F.xxhash64("record"), F.lit(lanes))).otherwise(0).cast("int")
    bucket = F.pmod(F.xxhash64("key", "lane"), F.lit(buckets)).cast("int")
    schema = "key string, value string, time long, file string, record long, lane int, sequence long"

    def number(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        done = {(key, lane): n for key, lane, n in zip(*state.get)} if state.exists else {}
        rows = pd.concat(list(parts)).sort_values(["time", "file", "record"])
        owners = rows.groupby(["key", "lane"], sort=False, dropna=False)
        counts = owners.size()
        # A null key comes as NaN, which equals nothing.
        names = [(None if pd.isna(key) else key, lane) for key, lane in counts.index]
        before = np.array([done.get(name, 0) for name in names], np.int64)
        rows["sequence"] = before[owners.ngroup().to_numpy()] + owners.cumcount().to_numpy()
        done.update(zip(names, (before + counts.to_numpy()).tolist()))
        state.update(([key for key, _ in done], [lane for _, lane in done], list(done.values())))
        yield rows[["key", "value", "time", "file", "record", "lane", "sequence"]]

    laned = records.select("key", "value", "time", "file", "record", lane.alias("lane"))
    grouped = laned.withColumn("bucket", bucket).groupBy("bucket")
    return grouped.applyInPandasWithState(number, schema, "keys array<string>, lanes array<int>, done array<long>", "append", GroupStateTimeout.NoTimeout)


def replay_in_order(
    spark: SparkSession,
    src: str,
    dst: str,
    checkpoint: str,
    records_per_trigger: int,
    key: str = "Date",
    interval: str | None = None,
    lanes: int = 8,
    hot_keys: tuple[str, ...] = (DEFAULT_KEY,),
) -> StreamingQuery:
    """As `replay`, paced by records, with `lane` and `sequence` as last fields besides `key`: a reader gets the records of
    a key in their order back, whatever files they are in (see `numbered`). Runs until it is stopped."""
    lines = paced_lines(spark, src, records_per_trigger)
    keyed = keyed_records(lines, key, "time", "file", "record")
    writer = numbered(keyed, lanes, hot_keys).select(_with("key", "lane", "sequence")).writeStream.format("text").outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=interval or "0 seconds").start(dst)
