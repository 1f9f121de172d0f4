"""Equi-joins that hold when one key has a large part of the rows.

A side is broadcast only after its size has been measured. Beyond that limit both sides are shuffled;
keys with more rows than a fair share of a shuffle partition are found first, and their rows are cut
into pieces that join independently:

* the rows of a hot key get a piece number from the input partition they come from, so a piece holds
  the rows of a few input partitions however many equal rows there are, and a repeated task gives the
  same pieces;
* the rows of that key on the other side are repeated once per piece.

Every pair of matching rows meets exactly once. A row that was repeated, though its key has a partner,
can miss it in some pieces; those unmatched copies are known by their piece number and are dropped.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perron.operators.summaries import HOT_ROWS, KEPT, LOOKED_AT, Summary

# Pieces per fair share of rows: small ones, of which several may meet in a partition by chance.
PIECES = 4

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def size_in_bytes(setting: str) -> int:
    """A size as Spark's settings write it, `10m` or `128MB`."""
    number, unit = re.fullmatch(r"(-?\d+)\s*([bkmgt]?)b?", setting.strip().lower()).groups()
    return int(number) * _UNITS[unit]


def broadcast_limit(spark: SparkSession) -> int:
    """`spark.sql.autoBroadcastJoinThreshold` in bytes; 0 or less means: do not broadcast."""
    return size_in_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))


def fits_broadcast(frame: DataFrame, limit: int | None = None, known: Summary | None = None) -> bool:
    """Whether the rows stay below `limit` bytes as a hash table: by their summary, else measured in one pass over them."""
    limit = broadcast_limit(frame.sparkSession) if limit is None else limit
    if limit <= 0:
        return False
    size = known.size(frame.columns) if known else None
    if size is not None:
        return size <= limit
    fixed = 24 + 8 * len(frame.columns)
    widths = [_width(field) for field in frame.schema if not _is_fixed(field.dataType)]
    if not widths:
        # Of a plain scan this reads no more than the file footers.
        return frame.count() * fixed <= limit
    width = sum(widths, F.lit(fixed)).cast("bigint")
    return (frame.agg(F.sum(width).alias("bytes")).first()["bytes"] or 0) <= limit


def _is_fixed(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.BooleanType, T.DatetimeType, T.NullType))


def _width(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if not isinstance(field.dataType, T.StringType):
        column = F.to_json(F.struct(column))
    return F.coalesce(F.octet_length(column) + F.lit(8), F.lit(0))


def hot_keys(frame: DataFrame, key: str, hot_rows: int = HOT_ROWS, known: Summary | None = None) -> dict:
    """Keys with more rows than a fair share of a shuffle partition, and how often to cut each.

    At most as many keys as there are shuffle partitions can exceed that share, which bounds the
    answer. NULL is listed like any key. Counts are estimates: the answer says how to lay a join out
    and never what is in it, so some of the keys are enough to tell, about ten thousand for a key
    that just counts as hot. With a summary that can tell, nothing is read.
    """
    partitions = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if known:
        if known.rows <= hot_rows:
            return {}
        fair = max(hot_rows, known.rows / partitions)
        if key in known.keys and fair >= known.rows / KEPT:
            return {value: math.ceil(rows / fair * PIECES) for value, rows in known.keys[key].items() if rows > fair}
    part = min(1.0, LOOKED_AT / hot_rows)
    keys = frame.select(F.col(key).alias("key"))
    looked_at = keys.sample(part, seed=17) if part < 1 else keys
    sizes = looked_at.groupBy("key").agg((F.count(F.lit(1)) / F.lit(part)).alias("rows"))
    share = F.greatest(
        F.lit(float(hot_rows)), sizes.select(F.sum("rows") / F.lit(partitions)).scalar()
    )
    hot = sizes.where(F.col("rows") > share).select(
        "key", F.ceil(F.col("rows") / share * PIECES).cast("int").alias("cuts")
    )
    return {row["key"]: row["cuts"] for row in hot.collect()}


def _cuts_frame(spark: SparkSession, cuts: dict, kind: T.DataType) -> DataFrame:
    schema = T.StructType([T.StructField("__hot_key", kind), T.StructField("__cuts", T.IntegerType())])
    return spark.createDataFrame(list(cuts.items()), schema)


def _cut(frame: DataFrame, key: str, cuts: dict, piece: str) -> DataFrame:
    """Numbers the piece each row belongs to; rows of a key that is not hot are piece 0.

    NULL keys join nothing and may stand anywhere, so they are spread over all partitions.
    """
    columns, number = frame.columns, F.lit(0)
    if cuts:
        table = _cuts_frame(frame.sparkSession, cuts, frame.schema[key].dataType)
        frame = frame.join(F.broadcast(table), F.col(key) == F.col("__hot_key"), "left")
        number = F.coalesce(F.pmod(F.spark_partition_id(), F.col("__cuts")), F.lit(0))
    number = F.when(F.col(key).isNull(), F.spark_partition_id()).otherwise(number)
    return frame.select(*columns, number.alias(piece))


def _repeat(frame: DataFrame, key: str, cuts: dict, piece: str, repeated: str) -> DataFrame:
    """Repeats each row for every piece into which the other side cuts its key."""
    columns = frame.columns
    if not cuts:
        # 0, but not a constant: the optimizer would take a constant out of the join keys.
        zero = F.pmod(F.spark_partition_id(), F.lit(1))
        return frame.select(*columns, zero.alias(piece), F.lit(False).alias(repeated))
    table = _cuts_frame(frame.sparkSession, cuts, frame.schema[key].dataType).select(
        "__hot_key", F.explode(F.sequence(F.lit(0), F.col("__cuts") - 1)).alias("__copy")
    )
    joined = frame.join(F.broadcast(table), F.col(key) == F.col("__hot_key"), "left")
    copy = F.coalesce("__copy", F.lit(0))
    return joined.select(*columns, copy.alias(piece), F.col("__copy").isNotNull().alias(repeated))


def sized_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str,
    *,
    unique_left: bool = False,
    unique_right: bool = False,
    measure: bool = True,
    left_like: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    left_known: Summary | None = None,
    right_known: Summary | None = None,
) -> DataFrame:
    """Join on one key; `how` is inner, left, full or left_anti. Gives all columns of both sides.

    `unique_left` and `unique_right` say that a side has one row per key and needs no look for hot
    keys. `measure=False` skips the look at the size of the right side, for one that is costly to
    compute twice. `left_like` is a cheaper frame in which the left key is spread alike, to look for
    hot keys in. The summaries are those of the left side, or of what is like it, and of the right side as they were written;
    a side that has one is not read to be measured. None of them changes the result. Column names must differ between the sides.
    """
    if how not in ("inner", "left", "full", "left_anti"):
        raise ValueError(f"unknown join: {how}")
    if left_like is not None and how == "full":
        raise ValueError("in a full join hot keys must come from the sides themselves")
    shared = {name.lower() for name in left.columns} & {name.lower() for name in right.columns}
    if shared:
        raise ValueError(f"columns on both sides: {', '.join(sorted(shared))}")
    if how in ("inner", "left_anti"):
        # NULL keys join nothing, so here they need no place at all on the right.
        right = right.where(F.col(right_key).isNotNull())
    if how == "left_anti":
        right = right.select(right_key)

    on = F.col(left_key) == F.col(right_key)
    if how != "full" and measure:
        if fits_broadcast(right, known=right_known):
            return left.join(F.broadcast(right), on, how)
        # Else the planner may broadcast it after all, by the size of its compressed files.
        right = right.hint("merge")

    if how == "left_anti":
        right, unique_right = right.distinct(), True
        right = right.hint("merge") if measure else right
    looked_at = left if left_like is None else left_like
    hot_left = {} if unique_left else hot_keys(looked_at, left_key, hot_rows, left_known)
    hot_right = {} if unique_right else hot_keys(right, right_key, hot_rows, right_known)
    # NULL keys that stay in the result need a place. What stands for the left side may have fewer.
    cut_left = bool(hot_left) or how == "full" or (how == "left" and left_like is not None)
    cut_right = bool(hot_right) or how == "full"
    if not cut_left and not cut_right:
        return left.join(right, on, how)

    hot_left.pop(None, None)
    hot_right.pop(None, None)
    lefts = left.withColumn("__in_left", F.lit(True))
    rights = right.withColumn("__in_right", F.lit(True))
    stray = F.lit(False)
    if cut_left:
        lefts = _cut(lefts, left_key, hot_left, "__left_piece")
        rights = _repeat(rights, right_key, hot_left, "__right_copy", "__right_repeated")
        on &= F.col("__left_piece") == F.col("__right_copy")
        stray |= F.col("__right_repeated") & F.col("__in_left").isNull()
    if cut_right:
        rights = _cut(rights, right_key, hot_right, "__right_piece")
        lefts = _repeat(lefts, left_key, hot_right, "__left_copy", "__left_repeated")
        on &= F.col("__left_copy") == F.col("__right_piece")
        stray |= F.col("__left_repeated") & F.col("__in_right").isNull()
    joined = lefts.join(rights.hint("merge") if measure and how != "full" else rights, on, how)
    if how == "left_anti":
        return joined.select(*left.columns)
    # `stray` is NULL where that side is absent altogether, and such rows stay.
    return joined.where(~F.coalesce(stray, F.lit(False))).select(*left.columns, *right.columns)


def star_join(
    fact: DataFrame,
    edges: list[tuple[str, DataFrame, str] | tuple[str, DataFrame, str, Summary | None]],
    hot_rows: int = HOT_ROWS,
    known: Summary | None = None,
) -> DataFrame:
    """The fact left-joined to each dimension; an edge is (fact column, dimension, dimension key[, dimension summary]).

    A column that a dimension has brought in can lead on to the next. Hot keys of the fact's own
    columns are looked for in the fact as it came, not behind the joins before. `known` is the summary of the fact.
    """
    joined = fact
    for column, dimension, key, *summary in edges:
        own = column in fact.columns
        joined = sized_join(
            joined, dimension, column, key, "left", left_like=fact if own and joined is not fact else None,
            hot_rows=hot_rows, left_known=known if own else None, right_known=summary[0] if summary else None,
        )
    return joined
