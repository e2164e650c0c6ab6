"""Named tables and the folder for intermediate data."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder() -> tempfile.TemporaryDirectory:
    """Removed when the process ends."""
    return tempfile.TemporaryDirectory(prefix="chirrup-")


def write_once(df: DataFrame, path: str) -> DataFrame:
    """Store as parquet, unless the folder holds a complete write already, and return what is stored.

    A write that was stopped has no mark of success; what it left is replaced.
    """
    spark = df.sparkSession
    if not exists(spark, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    system, path = _file_system(spark, path)
    return system.exists(path)


def publish(spark: SparkSession, name: str, path: str, comment: str) -> DataFrame:
    """Make the name of a table stand for the files of a folder; neither these nor the ones it stood for are touched.

    A table that has the columns and the comment already is only pointed elsewhere, so it can be read at any time.
    """
    stored = spark.read.parquet(path)
    if spark.catalog.tableExists(name) and _described(spark, name) == (stored.dtypes, comment):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        columns = ", ".join(f"`{column}` {kind}" for column, kind in stored.dtypes)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}'")
        spark.sql(f"COMMENT ON TABLE {name} IS :comment", args={"comment": comment})
    return spark.table(name)


def _described(spark: SparkSession, name: str) -> tuple[list[tuple[str, str]], str]:
    return spark.table(name).dtypes, spark.catalog.getTable(name).description


def delete_others(spark: SparkSession, folder: str, keep: set[str]) -> None:
    """Delete the folders in a folder, but for those with these names."""
    system, path = _file_system(spark, folder)
    for status in system.listStatus(path):
        if status.isDirectory() and status.getPath().getName() not in keep:
            system.delete(status.getPath(), True)


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors see, below the session's `spark.checkpoint.dir` or, if unset, the context's folder.

    Only a local session, whose executors share one machine, may do without both.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        base = _local_folder().name
    return f"{base.rstrip('/')}/chirrup-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def stored_bytes(spark: SparkSession, folder: str) -> int:
    """The size of all files below a folder, as its file system tells it."""
    system, path = _file_system(spark, folder)
    return system.getContentSummary(path).getLength()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A `shared_folder` that is deleted, by the file system of its path, when the block ends."""
    folder = shared_folder(spark)
    try:
        yield folder
    finally:
        system, path = _file_system(spark, folder)
        system.delete(path, True)
