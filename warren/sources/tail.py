"""Logs that are still being written, as a stream of their lines."""

from __future__ import annotations

from collections.abc import Iterator
from posixpath import basename, dirname

import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from warren.sources.logs import parse_log

SCHEMA = "session_id string, line_no bigint, value string"
#: Bytes of a partition, and of a read.
PART, CHUNK = 64 << 20, 1 << 20


class LogPart(InputPartition):
    """The lines of a file that begin in [start, stop); the first byte of the batch is `begin`."""

    def __init__(self, path: str, begin: int, start: int, stop: int):
        super().__init__(None)
        self.path, self.begin, self.start, self.stop = path, begin, start, stop


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _session(path: str) -> str:
    """The folder that holds the file."""
    return basename(dirname(path))


class _Logs:
    """The logs of a folder, and the lines of their parts."""

    def __init__(self, options: dict):
        self.path, self.suffix = options["path"], options.get("suffix", ".log")

    def _files(self) -> list[tuple[str, int]]:
        store, at = _opened(self.path)
        info = store.get_file_info(at)
        found = [info] if info.type == fs.FileType.File else [f for f in store.get_file_info(fs.FileSelector(at, allow_not_found=True)) if f.is_file and f.path.endswith(self.suffix)]
        return sorted((f.path, f.size) for f in found)

    def _parts(self, start: dict, end: dict) -> list[LogPart]:
        parts = [LogPart(path, start.get(path, 0), at, min(at + PART, stop)) for path, stop in sorted(end.items()) for at in range(start.get(path, 0), stop, PART)]
        return parts or [LogPart("", 0, 0, 0)]

    def read(self, partition: LogPart) -> Iterator[pa.RecordBatch]:
        """Lines without their ends, numbered by the byte they begin at; bytes that are no UTF-8 are replaced."""
        if partition.start >= partition.stop:
            return
        session = _session(partition.path)
        store, _ = _opened(self.path)
        with store.open_input_file(partition.path) as f:
            # a line that began before this part belongs to the part before it
            at = partition.start if partition.start == partition.begin else partition.start - 1
            held, skip = b"", at < partition.start
            f.seek(at)
            while True:
                data = f.read(CHUNK)
                held += data
                lines = held.split(b"\n")
                held = lines.pop()
                numbers, values = [], []
                for line in [*lines, *([held] if not data and held else [])]:
                    if not skip and at < partition.stop:
                        numbers.append(at)
                        values.append(line.decode("utf-8", "replace").rstrip("\r"))
                    skip = False
                    at += len(line) + 1
                if numbers:
                    yield pa.RecordBatch.from_arrays([pa.array([session] * len(numbers)), pa.array(numbers, pa.int64()), pa.array(values, pa.string())], names=["session_id", "line_no", "value"])
                if not data or at >= partition.stop:
                    return


class LogStreamReader(_Logs, DataSourceStreamReader):
    """Offsets are {file: bytes read}. They end at line ends, so a line half written waits for the rest of it."""

    def _line_end(self, path: str, size: int) -> int:
        """Where the last whole line ends, looked for from the file's end."""
        store, _ = _opened(self.path)
        with store.open_input_file(path) as f:
            stop = size
            while stop > 0:
                start = max(0, stop - CHUNK)
                at = f.read_at(stop - start, start).rfind(b"\n")
                if at >= 0:
                    return start + at + 1
                stop = start
        return 0

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {path: self._line_end(path, size) for path, size in self._files()}

    def partitions(self, start: dict, end: dict) -> list[LogPart]:
        return self._parts(start, end)

    def commit(self, end: dict) -> None:
        pass


class LogBatchReader(_Logs, DataSourceReader):
    """All lines that there are, the last one whole or not."""

    def partitions(self) -> list[LogPart]:
        return self._parts({}, dict(self._files()))


class TrackerLog(DataSource):
    """The lines of the logs in a folder (`path`; `suffix` .log), in batch or as they are written."""

    @classmethod
    def name(cls) -> str:
        return "tracker_log"

    def schema(self) -> str | StructType:
        return SCHEMA

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return LogStreamReader(self.options)

    def reader(self, schema: StructType) -> DataSourceReader:
        return LogBatchReader(self.options)


def tail_log(spark: SparkSession, path: str) -> DataFrame:
    """S4 as a stream: the parsed lines of all logs below `path`, each once, also after a restart from a checkpoint.

    `line_no` is the byte that a line begins at, so it rises along a file. A file that shrinks gives nothing until it
    is longer than what was read of it.
    """
    spark.dataSource.register(TrackerLog)
    return parse_log(spark.readStream.format(TrackerLog.name()).option("path", path).load())
