"""Aggregates per key. All combine on the map side first, so a hot key costs one row per task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perron.operators.joins import HOT_ROWS, sized_join
from perron.operators.tallies import Tally


def count_per_key(frame: DataFrame, key: str, name: str) -> DataFrame:
    """Rows per key. NULL is a key of its own."""
    return frame.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def rounded_mean(frame: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Mean per key, rounded half up to a whole number."""
    return frame.groupBy(key).agg(F.round(F.avg(value), 0).cast("bigint").alias(name))


def distinct_rows(frame: DataFrame, *columns: str | Column) -> DataFrame:
    return frame.select(*columns).distinct()


def first_per_key(frame: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key: the least by `order`, then by the remaining columns, NULLs first.

    A minimum over whole rows, so unlike a ranking window it never holds a key's rows together.
    """
    rest = [name for name in frame.columns if name not in (key, *order)]
    row = F.struct(*order, *rest)
    return frame.groupBy(key).agg(F.min(row).alias("row")).select(key, "row.*").select(*frame.columns)


def dim_with_count(
    dimension: DataFrame,
    key: str,
    facts: DataFrame,
    fact_key: str,
    name: str,
    hot_rows: int = HOT_ROWS,
    tally: Tally | None = None,
) -> DataFrame:
    """The dimension with its number of facts; a key without facts keeps NULL, not 0.

    With a tally of the facts that has counted their key, the facts themselves are not read.
    """
    if tally and fact_key in tally.counted:
        counts = tally.per_value(fact_key, facts.schema[fact_key].dataType, "__fact_key", name)
    else:
        counts = count_per_key(facts.select(F.col(fact_key).alias("__fact_key")), "__fact_key", name)
    # The counts are one row per key. Measuring them would read the facts twice; the adaptive
    # planner sees their size after the aggregation and broadcasts them if it can.
    joined = sized_join(
        dimension, counts, key, "__fact_key", "left",
        unique_right=True, measure=False, hot_rows=hot_rows,
    )
    return joined.drop("__fact_key")
