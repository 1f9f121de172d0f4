"""Helpers for work on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

WHITE = b" \t\n\x0b\x0c\r"


def small_batches(spark: SparkSession) -> None:
    """Has Spark hand texts to tasks by the thousand, unless the session says otherwise: memory for long texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "1000")


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `limit` bytes of text; one longer text makes a batch of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start, done = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start, done = stop, int(ends[stop - 1])


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """A column's texts as UTF-8; null counts as empty."""
    return [t or b"" for t in batch.column(column).cast(pa.large_binary()).to_pylist()]


def joined(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes behind one another, and where each value starts, with the end as last."""
    bounds = np.zeros(len(values) + 1, np.int64)
    np.cumsum([len(v) for v in values], out=bounds[1:])
    return np.frombuffer(b"".join(values), np.uint8), bounds


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum of each segment; empty segments have 0."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
