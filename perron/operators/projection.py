"""Choosing, naming and typing columns; row filters on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def layout(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def conform(frame: DataFrame, schema: str | T.StructType) -> DataFrame:
    """The columns of `schema` in its order and types, matched by name and never by position."""
    wanted = layout(schema)
    have = {name.lower() for name in frame.columns}
    missing = [field.name for field in wanted if field.name.lower() not in have]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    return frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted])


def project(frame: DataFrame, columns: list[str], renamed: dict[str, str] | None = None) -> DataFrame:
    """Some columns; `renamed` maps an old name to its new one."""
    renamed = renamed or {}
    return frame.select(*[F.col(name).alias(renamed.get(name, name)) for name in columns])


def drop_null_keys(frame: DataFrame, *keys: str) -> DataFrame:
    """Only rows in which every key has a value."""
    return frame.na.drop(subset=list(keys))


def without_token(frame: DataFrame, column: str, token: str) -> DataFrame:
    """Rows whose text lacks a token. A NULL text does not pass."""
    return frame.where(~F.col(column).contains(token))


def default_flags(frame: DataFrame, *columns: str) -> DataFrame:
    """NULL flags become false."""
    return frame.withColumns({name: F.coalesce(name, F.lit(False)) for name in columns})
