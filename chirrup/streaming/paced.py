"""A stream of text lines that is paced by records, whatever the size of the files."""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# A task of a batch reads at most so many records.
RECORDS_PER_TASK = 10_000

# The driver looks for the ends of lines in blocks of so many bytes.
BLOCK = 1 << 20

# The white space of a blank line.
BLANK = np.zeros(256, bool)
BLANK[list(b" \t\n\r\x0b\x0c")] = True


class Place(NamedTuple):
    """What was read: files up to this one, by time and name, and of this one so many bytes and records."""

    time: int
    file: str
    byte: int
    record: int


class Part(InputPartition):
    """Bytes of a file that hold whole lines, and the number of the first record."""

    def __init__(self, place: Place, end: int):
        self.place, self.end = place, end


def _lines(handle: pa.NativeFile, limit: int | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Block by block, where lines end, in bytes from the place of the file on, and whether they are not blank."""
    done, open_since, solid_before = 0, 0, False
    while data := handle.read(BLOCK if limit is None else min(BLOCK, limit - done)):
        block = np.frombuffer(data, np.uint8)
        solid = ~BLANK[block]
        ends = np.flatnonzero(block == ord("\n")) + 1
        if len(ends):
            held = np.logical_or.reduceat(solid[: ends[-1]], np.append(0, ends[:-1]))
            held[0] |= solid_before
            yield done + ends, held
            open_since, solid_before = done + int(ends[-1]), False
            solid = solid[ends[-1] :]
        solid_before |= bool(solid.any())
        done += len(data)
    if done > open_since:
        yield np.array([done]), np.array([solid_before])


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


class PacedLines(DataSource):
    """`paced_lines`: the non-blank lines of the files of a folder, at most `recordsPerTrigger` in a batch.

    Files are read by time of change, then by name, and are complete when they appear, as for Spark's own file streams. A
    batch ends within a file where its records do, so the offset is a place in a file, and a restart goes on from there.
    The driver looks for the line that ends a batch; the lines are read by tasks of `recordsPerTask` records. Names that
    begin with `_` or `.` are left out.
    """

    @classmethod
    def name(cls) -> str:
        return "paced_lines"

    def schema(self) -> str:
        return "value string, time long, file string, record long"

    def streamReader(self, schema) -> "PacedReader":
        return PacedReader(self.options["path"], int(self.options["recordsPerTrigger"]), int(self.options.get("recordsPerTask", RECORDS_PER_TASK)))


class PacedReader(DataSourceStreamReader):
    def __init__(self, path: str, records: int, per_task: int):
        self.path, self.records, self.per_task = path, records, per_task
        self.at: Place | None = None

    def initialOffset(self) -> dict:
        return Place(0, "", 0, 0)._asdict()

    def latestOffset(self) -> dict:
        self.at = self.at or Place(**self.initialOffset())
        for _, end in self._parts(self.at, self.records, None):
            self.at = end
        return self.at._asdict()

    def partitions(self, start: dict, end: dict) -> list[Part]:
        """With equal offsets, the engine says where a restarted query goes on."""
        start, end = Place(**start), Place(**end)
        if self.at is None:
            self.at = end
        return [Part(first, last.byte) for first, last in self._parts(start, None, end)]

    def _files(self, at: Place) -> list[tuple[int, str]]:
        """The file of the place and those after it, by time and name."""
        system, folder = _file_system(self.path)
        infos = system.get_file_info(fs.FileSelector(folder)) if system.get_file_info(folder).type == fs.FileType.Directory else [system.get_file_info(folder)]
        found = [(info.mtime_ns // 1_000_000, info.path) for info in infos if info.type == fs.FileType.File and info.base_name[0] not in "_."]
        return sorted(file for file in found if file >= (at.time, at.file))

    def _parts(self, at: Place, records: int | None, end: Place | None) -> Iterator[tuple[Place, Place]]:
        """Begin and end of parts for one task each, from a place on, up to a number of records or to another place."""
        system, _ = _file_system(self.path)
        for time, file in self._files(at):
            if records is not None and records <= 0:
                return
            if end is not None and (time, file) > (end.time, end.file):
                return
            if (time, file) != (at.time, at.file):
                at = Place(time, file, 0, 0)
            with system.open_input_file(file) as handle:
                handle.seek(at.byte)
                first, origin = at, at.byte
                limit = end.byte - origin if end is not None and (time, file) == (end.time, end.file) else None
                for ends, held in _lines(handle, limit):
                    counts = np.cumsum(held)
                    if records is not None:
                        lines = int(np.searchsorted(counts, records)) + 1
                        ends, counts = ends[:lines], counts[:lines]
                        records -= int(counts[-1])
                    # Parts end at the line with which they are full.
                    before, last = at.record, at.record + int(counts[-1])
                    for record in range(first.record + self.per_task, last + 1, self.per_task):
                        at = Place(time, file, origin + int(ends[np.searchsorted(counts, record - before)]), record)
                        yield first, at
                        first = at
                    at = Place(time, file, origin + int(ends[-1]), last)
                    if records == 0:
                        break
                if at != first:
                    yield first, at

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        system, _ = _file_system(self.path)
        place = partition.place
        with system.open_input_file(place.file) as handle:
            handle.seek(place.byte)
            data = handle.read(partition.end - place.byte)
        values = [line.rstrip(b"\r").decode("utf-8", "replace") for line in data.split(b"\n") if line.strip()]
        n = len(values)
        columns = [pa.array(values, pa.string()), pa.repeat(place.time, n), pa.repeat(place.file, n), pa.array(range(place.record, place.record + n), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["value", "time", "file", "record"])


def paced_lines(spark: SparkSession, path: str, records_per_trigger: int, records_per_task: int = RECORDS_PER_TASK) -> DataFrame:
    """A stream `value, time, file, record` of the lines of a folder's files, on any file system that Arrow opens."""
    spark.dataSource.register(PacedLines)
    options = {"recordsPerTrigger": str(records_per_trigger), "recordsPerTask": str(records_per_task)}
    return spark.readStream.format("paced_lines").options(**options).load(path)
