"""Bounded samples for classifiers: the rows whose hashes are least, repeated rows once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def least_turns(rows: DataFrame, group: str, turn: str, k: int) -> DataFrame:
    """The `k` least distinct values of `turn` (bigint) for each `group` (text), one row each; nulls take no part.

    A task keeps no more than `k` for each group it meets and hands only those on, however often rows are repeated.
    An empty table gives no rows.
    """
    schema = pa.schema([(group, pa.string()), (turn, pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            coded = batch.column(0).dictionary_encode()
            codes, turns = coded.indices.to_numpy(zero_copy_only=False), batch.column(1).to_numpy()
            for code, name in enumerate(coded.dictionary.to_pylist()):
                own = turns[codes == code]
                held[name] = np.unique(np.concatenate([held[name], own]) if name in held else own)[:k]
        for name, own in held.items():
            yield pa.record_batch([pa.array([name] * len(own), pa.string()), pa.array(own)], schema)

    keys = rows.select(group, turn).where(F.col(group).isNotNull() & F.col(turn).isNotNull())
    parts = keys.mapInArrow(run, f"{group} string, {turn} bigint").distinct()
    place = F.row_number().over(Window.partitionBy(group).orderBy(turn))
    return parts.withColumn("__place", place).where(F.col("__place") <= k).drop("__place")
