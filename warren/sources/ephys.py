"""Recordings of packed little-endian records behind an ASCII header, as a Python data source."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

HEADER_END = b"<End settings>\n"
#: Records in one partition of a file.
RECORDS = 1_000_000


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or an address (hdfs, s3, gs, file), and the path within it."""
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def parse_header(data: bytes) -> tuple[dict[str, str], np.dtype, int]:
    """Settings, the layout of a record and the header's length."""
    end = data.index(HEADER_END) + len(HEADER_END)
    settings = dict(x.split(": ", 1) for x in data[:end].decode("latin-1").split("\n") if ": " in x)
    kinds = []
    for name, count, kind in re.findall(r"<(\w+) (?:(\d+)\*)?(\w+)>", settings["Fields"]):
        kinds.append((name, np.dtype(kind).newbyteorder("<")) if not count else (name, np.dtype(kind).newbyteorder("<"), int(count)))
    return settings, np.dtype(kinds), end


class Range(InputPartition):
    def __init__(self, path: str, start: int, records: int, index: int):
        self.path, self.start, self.records, self.index = path, start, records, index


class EphysDatSource(DataSource):
    """`spark.read.format("ephys_dat").option("path", ...)`: the fields of every record, with its index.

    A field of several numbers is an array. Paths are addresses in a shared store, or on a mount of the executors.
    """

    @classmethod
    def name(cls) -> str:
        return "ephys_dat"

    def _first(self) -> str:
        return self.options["path"].split(",")[0]

    def _layout(self, path: str) -> tuple[np.dtype, int]:
        store, inside = opened(path)
        with store.open_input_file(inside) as f:
            head = f.read(1 << 16)
        _, dtype, end = parse_header(head)
        return dtype, end

    def schema(self) -> str:
        dtype, _ = self._layout(self._first())
        kind = lambda d: "double" if d.base.kind == "f" else "bigint"
        return "path string, record bigint, " + ", ".join(f"{n} array<{kind(dtype[n])}>" if dtype[n].shape else f"{n} {kind(dtype[n])}" for n in dtype.names)

    def reader(self, schema) -> DataSourceReader:
        return EphysDatReader(self)


class EphysDatReader(DataSourceReader):
    def __init__(self, source: EphysDatSource):
        self.source = source

    def partitions(self) -> list[Range]:
        out = []
        for path in self.source.options["path"].split(","):
            dtype, end = self.source._layout(path)
            store, inside = opened(path)
            whole = (store.get_file_info(inside).size - end) // dtype.itemsize  # a record that breaks off is dropped
            out += [Range(path, end + a * dtype.itemsize, min(RECORDS, whole - a), a) for a in range(0, whole, RECORDS)]
        return out or [Range(self.source._first(), 0, 0, 0)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        dtype, _ = self.source._layout(part.path)
        store, inside = opened(part.path)
        with store.open_input_file(inside) as f:
            rows = np.frombuffer(f.read_at(part.records * dtype.itemsize, part.start), dtype)
        columns = {"path": pa.array([part.path] * len(rows), pa.string()), "record": pa.array(np.arange(part.index, part.index + len(rows)))}
        for n in dtype.names:
            values = rows[n].astype("f8" if dtype[n].base.kind == "f" else "i8")
            flat = pa.array(values.reshape(-1))
            columns[n] = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype="i4") * dtype[n].shape[0], flat) if dtype[n].shape else flat
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
