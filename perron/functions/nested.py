"""Reading arrays and JSON documents held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_path(documents: DataFrame, column: str, path: str, value: str = "value") -> DataFrame:
    """One row per element below `path`; a document without elements gives no row."""
    elements = documents.sparkSession.tvf.variant_explode(
        F.try_variant_get(F.col(column).outer(), path, "variant")
    ).select(F.col("value").alias(value))
    return documents.lateralJoin(elements).select(value)


def explode_array(frame: DataFrame, column: str, position: str, value: str) -> DataFrame:
    """One row per element of a typed array, with its 0-based position; an empty one gives no row."""
    rest = [name for name in frame.columns if name != column]
    return frame.select(*rest, F.posexplode(column).alias(position, value))


def whole_at(document: Column | str, path: str) -> Column:
    """Whole number at a path, rounded half up; NULL when absent or no number."""
    return F.try_variant_get(document, path, "decimal(38,0)").try_cast("bigint")


def unreadable_at(document: Column | str, path: str, number: Column) -> Column:
    """Whether there is a value at a path, not the JSON null, though no `number` was read there."""
    value = F.try_variant_get(document, path, "variant")
    return number.isNull() & value.isNotNull() & ~F.is_variant_null(value)


def size_at(document: Column | str, path: str) -> Column:
    """Length of the array at a path; NULL when there is no array."""
    return F.array_size(F.try_variant_get(document, path, "array<variant>")).cast("bigint")


def element(array: Column | str, index: int) -> Column:
    """Array element by 0-based index; NULL beyond the end."""
    return F.get(array, F.lit(index))
