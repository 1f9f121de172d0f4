"""Logistic regression on hashed n-grams, fitted on a bounded sample."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from perron.llm.arrow import slices, texts


#: Rows that are dense at a time: 100 MB at 12,288 features.
AT_ONCE = 2048


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 300, rate: float = 0.05, l2: float = 1e-4):
    """Weights (features x outputs) and biases for targets `y` in 0..1, by full-batch Adam from zero; no chance involved.

    `x` is an array or `Sparse`.
    """
    w, b = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    state = [np.zeros_like(v) for v in (w, w, b, b)]
    share = (weight / weight.sum()).astype(np.float32)[:, None]
    for t in range(1, steps + 1):
        gradients = (np.float32(l2) * w, np.zeros_like(b))
        for own, part in blocks(x):
            error = (sigmoid(part @ w + b) - y[own]).astype(np.float32) * share[own]
            gradients[0][...] += part.T @ error
            gradients[1][...] += error.sum(axis=0)
        for k, (value, g) in enumerate(zip((w, b), gradients)):
            first, second = state[2 * k], state[2 * k + 1]
            first += 0.1 * (g - first)
            second += 0.001 * (g * g - second)
            value -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return w, b


def sparse_rows(frame: DataFrame, features, kept: list[str]) -> DataFrame:
    """Features of `text` as (places, values) beside the columns `kept` (bigint or string), made by the executors.

    `features` takes a list of texts as bytes and gives a float32 row for each. Both are packed without loss, as steps
    between places and values repeat a lot: the sample is copied several times on its way through the driver.
    """
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    types = dict(frame.dtypes)
    schema = pa.schema([(c, kinds[types[c]]) for c in kept] + [("places", pa.binary()), ("values", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=1 << 20):
            rows = features(texts(batch))
            set_ = [np.flatnonzero(r) for r in rows]
            places = pa.array([zlib.compress(np.diff(p, prepend=0).astype("<u4").tobytes()) for p in set_], pa.binary())
            values = pa.array([zlib.compress(r[p].astype("<f4").tobytes()) for r, p in zip(rows, set_)], pa.binary())
            yield pa.record_batch([*[batch.column(c).cast(kinds[types[c]]) for c in kept], places, values], schema)

    ddl = ", ".join([f"{c} {types[c]}" for c in kept] + ["places binary", "values binary"])
    return frame.select("text", *kept).mapInArrow(run, ddl)


def dense(rows: list, width: int) -> np.ndarray:
    x = np.zeros((len(rows), width), np.float32)
    for i, row in enumerate(rows):
        places = np.cumsum(np.frombuffer(zlib.decompress(row["places"]), "<u4"), dtype=np.int64)
        x[i, places] = np.frombuffer(zlib.decompress(row["values"]), "<f4")
    return x


class Sparse:
    """Rows of `sparse_rows` as places and values; only `at_once` of them are dense at a time."""

    def __init__(self, rows: list, width: int, at_once: int = AT_ONCE):
        self.shape, self.at_once = (len(rows), width), at_once
        values = [np.frombuffer(zlib.decompress(r["values"]), "<f4") for r in rows]
        self.ends = np.cumsum([0, *map(len, values)])
        self.values = np.concatenate([np.zeros(0, np.float32), *values])
        self.places = np.empty(len(self.values), np.uint16 if width <= 1 << 16 else np.uint32)
        for row, start, stop in zip(rows, self.ends, self.ends[1:]):
            self.places[start:stop] = np.cumsum(np.frombuffer(zlib.decompress(row["places"]), "<u4"), dtype=np.int64)
        self.shown, self.block = None, np.zeros((min(at_once, len(rows)), width), np.float32)

    def blocks(self) -> Iterator[tuple[slice, np.ndarray]]:
        """Which rows, and those rows dense, in the same memory for every block."""
        for start in range(0, self.shape[0], self.at_once):
            stop = min(start + self.at_once, self.shape[0])
            if self.shown != start:
                self.shown, own = start, slice(self.ends[start], self.ends[stop])
                self.block[:] = 0
                self.block[np.repeat(np.arange(stop - start), np.diff(self.ends[start : stop + 1])), self.places[own]] = self.values[own]
            yield slice(start, stop), self.block[: stop - start]


def blocks(x: np.ndarray | Sparse) -> Iterable[tuple[slice, np.ndarray]]:
    return x.blocks() if isinstance(x, Sparse) else [(slice(None), x)]


def byte_grams(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    """The hash of the n bytes, or code points, from each place on, in 0..2^bits-1; there are n-1 places less than of these."""
    if len(data) < n:
        return np.zeros(0, np.uint32)
    value = np.zeros(len(data) - n + 1, np.uint32)
    for k in range(n):
        value *= np.uint32(0x01000193)
        value ^= data[k : k + len(value)]
    value *= np.uint32(0x9E3779B1)
    return value >> np.uint32(32 - bits)
