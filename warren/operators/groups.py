"""Many small groups in one call: whole groups stream through tasks in batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches in which a group's rows stand together; held are a batch and the last group."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        ends = [(kept[0].column(k)[0], batch.column(k)[batch.num_rows - 1]) for k in keys]
        if all(a == b or not (a.is_valid or b.is_valid) for a, b in ends):
            continue  # one group as yet
        table, last = pa.Table.from_batches(kept), pa.scalar(True)
        for k, (_, b) in zip(keys, ends):
            last = pc.and_(last, pc.fill_null(pc.equal(table.column(k), b), False) if b.is_valid else pc.is_null(table.column(k)))
        start = table.num_rows - pc.sum(last).as_py()
        yield table.slice(0, start)
        kept = table.slice(start).to_batches()
    if kept:
        yield pa.Table.from_batches(kept)


def starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """The first row of each group, and the number of rows."""
    turn = np.zeros(table.num_rows, bool)
    turn[:1] = True
    for k in keys:
        codes = table.column(k).combine_chunks().dictionary_encode().indices
        codes = pc.fill_null(codes, -1).to_numpy(zero_copy_only=False)
        turn[1:] |= codes[1:] != codes[:-1]
    return np.append(np.flatnonzero(turn), table.num_rows)


def map_groups(df: DataFrame, keys: list[str], order: list[str], work: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """Rows that `work` makes of tables of whole groups (`keys`), each group in `order`. One shuffle, by the keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys):
            yield from work(table.combine_chunks()).to_batches()

    return dealt(df, keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def dealt(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows dealt by keys to the session's number of partitions, named, since few bytes may be much work and would be coalesced."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def doubles(column: pa.ChunkedArray) -> np.ndarray:
    """Numbers as doubles, null as NaN."""
    return column.to_numpy().astype(float)


#: Chunks (by number) of a block that shares its halo.
BLOCK_CHUNKS = 256


def map_lines(chunks: DataFrame, size: int, reach: int, work: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[dict, list[np.ndarray]]], number: str) -> DataFrame:
    """Chunked channels (session_id, channel, chunk, v), each chunk with `reach` neighbours on both sides as one line.

    `work` gets lines (a row for each chunk, zeros where nothing is), chunk numbers and lengths, and gives `number` (a
    new column) and each new v; an empty one gives no row. A block of chunks is sent with its halo to one task.
    """
    block = lambda by: f"cast(floor((chunk + {by}) / {BLOCK_CHUNKS}) as bigint)"
    sent = chunks.selectExpr("session_id", "cast(channel as int) channel", "cast(chunk as bigint) chunk", "cast(v as array<double>) v", f"explode(sequence({block(-reach)}, {block(reach)})) as block").filter("size(v) > 0")

    def run(table: pa.Table) -> pa.Table:
        chunk, block = (table.column(c).to_numpy() for c in ("chunk", "block"))
        lists = table.column("v").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
        values = np.zeros((len(lengths) + 1, size))  # the last row stands for what is not there
        row = np.repeat(np.arange(len(lengths)), lengths)
        values[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
        ends = starts(table, ["session_id", "channel", "block"])
        group = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        low, span = chunk.min() - reach, chunk.max() - chunk.min() + 2 * reach + 1
        place = group * span + chunk - low
        own = np.flatnonzero(chunk // BLOCK_CHUNKS == block)
        out, rows, found = {number: []}, [], []
        for a in range(0, len(own), 1024):
            some = own[a : a + 1024]
            line = np.empty((len(some), 2 * reach + 1, size))
            for k in range(-reach, reach + 1):
                at = np.searchsorted(place, place[some] + k)
                there = (at < len(place)) & (place[np.minimum(at, len(place) - 1)] == place[some] + k)
                line[:, k + reach] = values[np.where(there, at, len(lengths))]
            new, v = work(line.reshape(len(some), -1), chunk[some], lengths[some])
            keep = [i for i, x in enumerate(v) if len(x)]
            rows.append(some[keep])
            out[number].append(new[keep])
            found += [v[i] for i in keep]
        taken = table.take(pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64)))
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
        v = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found) if found else np.zeros(0)))
        numbers = pa.array(np.concatenate(out[number]) if rows else np.zeros(0, np.int64), pa.int64())
        return pa.table({"session_id": taken.column("session_id"), "channel": taken.column("channel"), number: numbers, "v": v})

    return map_groups(sent, ["session_id", "channel", "block"], ["chunk"], run, f"session_id string, channel int, {number} bigint, v array<double>")
