"""Recursive filters over chunked channels: a chunk's end state is affine in its first one, so states are scanned."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warren.operators.base import checkpointed
from warren.operators.signals import emg_corr_chunks

#: Samples of a product inside a chunk.
BLOCK = 128
CHANNEL = ["session_id", "channel"]


def passband(fs: float, low: float = 300.0, high: float = 600.0, margin: float = 25.0) -> tuple[float, float]:
    """E5: the band in Hz, its upper edge kept below half of the sampling rate; raises where nothing is left of it."""
    top = min(high, np.floor(fs / 2) - margin)
    if top <= low:
        raise ValueError(f"no band above {low} Hz at {fs} Hz")
    return low, float(top)


def butterworth(order: int, low: float, high: float, fs: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """A band-pass as sections (b, a) of second order, by the poles of the analogue prototype and the bilinear transform."""
    edge = np.tan(np.pi * np.array([low, high]) / fs)
    width, centre = edge[1] - edge[0], np.sqrt(edge[0] * edge[1])
    angle = np.pi * (np.arange(order) + 0.5) / order
    half = (-np.sin(angle) + 1j * np.cos(angle)) * width / 2
    root = np.sqrt(half**2 - centre**2)
    analogue = np.concatenate((half + root, half - root))
    poles = (1 + analogue) / (1 - analogue)
    upper, real = [p for p in poles if p.imag > 1e-12], sorted(p.real for p in poles if abs(p.imag) <= 1e-12)
    denominators = [np.array([1.0, -2 * p.real, abs(p) ** 2]) for p in upper] + [np.array([1.0, -p - q, p * q]) for p, q in zip(real[::2], real[1::2])]
    z = np.exp(2j * np.arctan(centre))
    out = []
    for a in denominators:
        b = np.array([1.0, 0.0, -1.0])  # zeros at both ends of the spectrum
        out.append((b / abs(np.polyval(b, z) / np.polyval(a, z)), a))
    return out


class Cascade:
    """Sections in a row as s' = As + Bx, y = Cs + Dx, and the same over blocks of samples."""

    def __init__(self, sections: list[tuple[np.ndarray, np.ndarray]], block: int = BLOCK):
        n = 2 * len(sections)
        a, b, c, d = np.zeros((n, n)), np.zeros(n), np.zeros(n), 1.0
        for i, (num, den) in enumerate(sections):
            # what enters a section is c s + d x of those before it
            own = slice(2 * i, 2 * i + 2)
            feed = np.array([num[1] - den[1] * num[0], num[2] - den[2] * num[0]])
            a[own] = np.outer(feed, c)
            a[own, own] += [[-den[1], 1.0], [-den[2], 0.0]]
            b[own] = feed * d
            c, d = num[0] * c, num[0] * d
            c[2 * i] += 1.0
        self.a, self.b, self.c, self.d, self.block = a, b, c, d, block
        self.steady = np.linalg.solve(np.eye(n) - a, b)  # the state that a constant 1 ends in
        powers = [np.eye(n)]
        for _ in range(block):
            powers.append(powers[-1] @ a)
        self.powers = np.array(powers)
        impulse = np.concatenate(([d], [c @ p @ b for p in powers[: block - 1]]))
        self.inside = np.array([[impulse[i - j] if i >= j else 0.0 for i in range(block)] for j in range(block)])  # x to y
        self.seen = np.array([c @ p for p in powers[:block]]).T  # s to y
        self.left = np.array([p @ b for p in powers[block - 1 :: -1]])  # x to the block's end state

    def run(self, x: np.ndarray, s: np.ndarray, out: bool = True) -> tuple[np.ndarray | None, np.ndarray]:
        """Outputs (if asked for) and end states of rows of equal length from their first states."""
        y = np.empty_like(x) if out else None
        for at in range(0, x.shape[1], self.block):
            part = x[:, at : at + self.block]
            k = part.shape[1]
            if out:
                y[:, at : at + k] = part @ self.inside[:k, :k] + s @ self.seen[:, :k]
            s = s @ self.powers[k].T + part @ self.left[self.block - k :]
        return y, s


def _in_rows(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the rows of each length, and their values as a matrix."""
    lists = batch.column(column)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        at = np.nonzero(sizes == size)[0]
        yield at, lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(at), size)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(r) for r in rows]))), pa.int32()), pa.array(np.concatenate(rows) if rows else np.empty(0)))


def recursed(chunks: DataFrame, sections: list[tuple[np.ndarray, np.ndarray]], back: bool = False) -> DataFrame:
    """Every channel's chunks (session_id, channel, chunk, v) through the filter, as one line; `back` from its end.

    A first pass finds each chunk's end state from a state of rest; these are a few numbers a chunk, which stream in
    order through a task and become first states; a second pass takes them. The line begins in the state that its first
    value, if held for ever, would end in. Equal to one recursion over the whole channel, whatever the chunks.
    """
    flt = Cascade(sections)
    n = len(flt.b)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, first = [None] * b.num_rows, np.zeros(b.num_rows)
            for at, x in _in_rows(b, "v"):
                x = x[:, ::-1] if back else x
                _, s = flt.run(x, np.zeros((len(at), n)), out=False)
                for i, k in enumerate(at):
                    out[k], first[k] = s[i], x[i, 0] if x.shape[1] else 0.0
            sizes = b.column("v").value_lengths().cast(pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in (*CHANNEL, "chunk")), sizes, pa.array(first), _lists(out)], names=[*CHANNEL, "chunk", "size", "first", "state"])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, s = None, None
        for b in batches:
            made = []
            for session, channel, size, first, end in zip(*(b.column(c).to_pylist() for c in (*CHANNEL, "size", "first", "state"))):
                if (session, channel) != now:
                    now, s = (session, channel), flt.steady * first
                made.append(s)
                s = np.linalg.matrix_power(flt.a, size) @ s + np.array(end) if size else s
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in (*CHANNEL, "chunk")), _lists(made)], names=[*CHANNEL, "chunk", "state"])

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            state = np.array(b.column("state").to_pylist(), float).reshape(-1, n)
            out: list = [None] * b.num_rows
            for at, x in _in_rows(b, "v"):
                y, _ = flt.run(x[:, ::-1] if back else x, state[at])
                for i, k in enumerate(at):
                    out[k] = y[i, ::-1] if back else y[i]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in (*CHANNEL, "chunk")), _lists(out)], names=[*CHANNEL, "chunk", "v"])

    kinds = dict(chunks.dtypes)
    key = ", ".join(f"{c} {kinds[c]}" for c in (*CHANNEL, "chunk"))
    lines = chunks.select(*CHANNEL, "chunk", F.col("v").cast("array<double>").alias("v"))
    order = F.desc("chunk") if back else F.asc("chunk")
    states = lines.mapInArrow(ends, key + ", size bigint, first double, state array<double>").repartition(*CHANNEL).sortWithinPartitions(*CHANNEL, order).mapInArrow(scanned, key + ", state array<double>")
    return lines.join(states, [*CHANNEL, "chunk"]).select(*CHANNEL, "chunk", "v", "state").mapInArrow(filtered, key + ", v array<double>")


def padded(chunks: DataFrame, reach: int) -> DataFrame:
    """Adds a chunk before and one after every channel: its ends, turned about the end points, `reach` samples if there are so many.

    Only chunks at the ends are gathered: those whose samples before (after) them are fewer than reach + 1.
    """
    sizes = chunks.select(*CHANNEL, "chunk", F.size("v").alias("__n"))
    ends = sizes.groupBy(*CHANNEL).agg(F.min("chunk").alias("__a"), F.max("chunk").alias("__b"), F.sum("__n").alias("__all"), F.max("__n").alias("__size"))
    span = F.ceil((F.lit(reach) + 1) / F.col("__size")) + 1  # all chunks but the last are full
    own = chunks.select(*CHANNEL, "chunk", F.col("v").cast("array<double>").alias("v")).join(ends, CHANNEL)
    own = own.withColumn("__k", F.least(F.lit(reach), F.col("__all") - 1).cast("int"))
    line = lambda: F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "v"))), lambda s: s["v"])).alias("v")
    head = own.filter(F.col("chunk") < F.col("__a") + span).groupBy(*CHANNEL, (F.col("__a") - 1).alias("chunk"), "__k").agg(line())
    tail = own.filter(F.col("chunk") > F.col("__b") - span).groupBy(*CHANNEL, (F.col("__b") + 1).alias("chunk"), "__k").agg(line())
    first = F.transform(F.reverse(F.slice("v", 2, F.col("__k"))), lambda x: 2 * F.get("v", F.lit(0)) - x)
    last = F.transform(F.reverse(F.slice("v", F.size("v") - F.col("__k"), F.col("__k"))), lambda x: 2 * F.element_at("v", -1) - x)
    plain = chunks.select(*CHANNEL, "chunk", F.col("v").cast("array<double>").alias("v"))
    ends_ = head.select(*CHANNEL, "chunk", first.alias("v")).unionByName(tail.select(*CHANNEL, "chunk", last.alias("v")))
    return plain.unionByName(ends_.filter(F.size("v") > 0))


def zero_phase(chunks: DataFrame, sections: list[tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """E5: the filter forward and then back over chunks of equal size (the last may be shorter), so that no phase is left.

    Channels are lengthened at both ends by three times the filter's length, turned about their end points, and cut
    again. A channel shorter than that is turned as far as it goes; chunks without samples are left out.
    """
    whole = chunks.filter(F.size("v") > 0)
    once = checkpointed(recursed(padded(whole, 3 * (2 * len(sections) + 1)), sections))
    ends = whole.groupBy(*CHANNEL).agg(F.min("chunk").alias("__a"), F.max("chunk").alias("__b"))
    return recursed(once, sections, back=True).join(ends, CHANNEL).filter("chunk between __a and __b").drop("__a", "__b")


def muscle_from_fields(chunks: DataFrame, size: int, fs: float, half: int, order: int = 4) -> DataFrame:
    """E7 whole: the high band of every channel by E5, then the mean correlation of the channels in windows."""
    return emg_corr_chunks(zero_phase(chunks, butterworth(order, *passband(fs), fs)), size, half)
