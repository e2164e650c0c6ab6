"""Helpers of this subpackage."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chirrup.sources.tables import shared_folder

# The character class of a word; white space is the space and the five ASCII controls from tab on.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame) -> DataFrame:
    """The frame, written to and read from the shared folder: it is computed once, and lost executors cost no more."""
    path = f"{shared_folder(df.sparkSession)}/table"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_alone(df: DataFrame) -> DataFrame:
    """As `stored`; the shuffle files that the write needed are deleted when it is done.

    Spark otherwise keeps them until the driver's JVM collects the plan, which may be long after their last use, and a job
    of many steps would fill the disks meanwhile.
    """
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name)
    conf.set(name, "true")
    try:
        return stored(df)
    finally:
        conf.set(name, before)


def tasks(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def text_key(text: Column) -> Column:
    """Sixteen bytes by which equal texts meet."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)
