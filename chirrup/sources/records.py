"""JSON readers with explicit schemas, and the prediction and CSV writers."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chirrup.schemas import PREDICTION, TWEET
from chirrup.sources.arrays import as_arrays, read_records


def _whole(text: Column) -> Column:
    """A whole number however it is written (`1`, `1.0`, `"1"`, `1e0`); null for anything else."""
    number = F.trim(text).try_cast("decimal(38, 10)")
    return F.when(number == F.floor(number), number).try_cast("long")


def _read(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """The raw fields, as text."""
    return spark.read.schema(T.StructType([T.StructField(name, T.StringType()) for name in schema.names])).options(**options).json(path)


def _typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of the schema, whatever partition columns a folder adds."""
    return raw.select(*(_whole(F.col(f.name)).alias(f.name) if f.dataType == T.LongType() else F.col(f.name) for f in schema))


def _rejected(raw: DataFrame, schema: T.StructType) -> DataFrame:
    wrong = [F.col(f.name).isNotNull() & _whole(F.col(f.name)).isNull() for f in schema if f.dataType == T.LongType()]
    return raw.select(schema.names).filter(reduce(Column.__or__, wrong))


def read_tweets(spark: SparkSession, path: str) -> DataFrame:
    """A directory or file of JSON lines; a malformed line gives a row of nulls, which silver drops.

    Numbers are read however they are written; one that is no whole number becomes null, and `rejected_tweets` has it.
    """
    return _typed(_read(spark, path, TWEET, mode="PERMISSIVE"), TWEET)


def rejected_tweets(spark: SparkSession, path: str) -> DataFrame:
    """The records, all fields as text, that hold something else than a whole number where one belongs."""
    return _rejected(_read(spark, path, TWEET, mode="PERMISSIVE"), TWEET)


def read_predictions(spark: SparkSession, path: str, multi_line: bool = False, array: bool = False) -> DataFrame:
    """JSON lines or a JSON array on one line; `multi_line=True` for an array spread over several lines.

    Only `id` and `ml_sentiment` are read, whatever else the records carry; ids as in `read_tweets`. An array is one row
    of text, and a file with `multi_line` one task. `array=True` is for large files of arrays, on one line or on many:
    byte ranges of a file are read by different tasks, see `arrays.read_records`.
    """
    if not array:
        return _typed(_read(spark, path, PREDICTION, multiLine=multi_line), PREDICTION)
    fields = T.StructType([T.StructField(name, T.StringType()) for name in PREDICTION.names])
    return _typed(read_records(spark, path).select(F.from_json("value", fields).alias("record")).select("record.*"), PREDICTION)


def write_predictions(predictions: DataFrame, path: str, array: bool = False) -> None:
    """JSON lines, or with `array=True` one JSON array for each task, which `read_predictions` reads back."""
    named = predictions.select("id", "ml_sentiment")
    if array:
        as_arrays(named.select(F.to_json(F.struct("id", "ml_sentiment")).alias("value"))).write.mode("overwrite").text(path)
    else:
        named.write.mode("overwrite").json(path)


# A quote inside a quoted field is doubled, as other CSV readers expect.
_CSV = {"header": True, "quote": '"', "escape": '"'}

# Spaces around a word belong to it, and a leading '#' starts no comment and so needs no quotes.
_CSV_WRITE = _CSV | {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "comment": "\x01"}

# Words may hold line breaks. A quoted empty field is an empty word, an unquoted one (read as the marker) is null.
_CSV_READ = _CSV | {"multiLine": True, "emptyValue": "", "nullValue": "\x00"}


def export_csv(df: DataFrame, path: str) -> None:
    """Comma-separated files with a header row."""
    df.write.mode("overwrite").options(**_CSV_WRITE).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What `export_csv` wrote."""
    return spark.read.schema(schema).options(**_CSV_READ).csv(path)
