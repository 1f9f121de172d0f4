"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perron.session import scratch

_ROW_BITS = 33
_LAST = 1 << 62


def with_row_id(frame: DataFrame, name: str, start: int = 1) -> DataFrame:
    """Unique ids from `start` up, with gaps, without a shuffle.

    For rows as they are read from files or tables: a repeated task then gives the same ids.
    """
    return frame.select((F.monotonically_increasing_id() + F.lit(start)).alias(name), *frame.columns)


def with_dense_id(frame: DataFrame, name: str, order: list[str], start: int = 1) -> DataFrame:
    """Ids `start`, `start+1`, ... in the order of some columns.

    Rows are put in order by ranges and written to the shared folder, which fixes what each partition
    holds even when executors are lost: ranges are sampled anew each time they are computed. Adding
    up the partition sizes gives each partition its first id. Only those sizes are in one place.
    """
    spark = frame.sparkSession
    # The source partition splits rows that are equal in `order`, which ranges alone cannot.
    source = frame.withColumn("__source", F.spark_partition_id())
    ranged = source.repartitionByRange(*order, "__source").sortWithinPartitions(*order).drop("__source")
    folder = scratch(spark, "dense-id")
    ranged.withColumn("__position", F.monotonically_increasing_id()).write.parquet(folder)
    fixed = spark.read.parquet(folder)

    partition = F.shiftright("__position", _ROW_BITS)
    sizes = fixed.groupBy(partition.alias("part")).count().collect()
    first, offsets = start, []
    for part, count in sorted(tuple(row) for row in sizes):
        offsets.append((part, first))
        first += count
    table = F.broadcast(spark.createDataFrame(offsets, "__part bigint, __first bigint"))
    row = F.col("__position").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return fixed.join(table, partition == F.col("__part")).select(
        (F.col("__first") + row).alias(name), *frame.columns
    )


def next_id(frame: DataFrame | None, name: str) -> int:
    """One more than the largest id of an earlier load: ids go on growing over reloads.

    Past half of the BIGINT range they begin anew, which a reload that replaces all rows allows.
    """
    largest = frame.agg(F.max(name)).first()[0] if frame is not None else None
    return 1 if largest is None or largest >= _LAST else largest + 1
