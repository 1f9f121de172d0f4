"""How many rows have each value of a table's key columns, counted once when the rows are written.

Tallies of parts of a table add up to that of the table, so an addition is counted by itself, and counts per key and
reports on declared keys need the tallies alone. A tally has a row per value and not per row, whatever its rows share.

Of a column that no other refers to, such as the id of a fact, only what its own key forbids is kept: values of several rows,
and NULL, with the least and the largest value of the part. Parts whose ranges do not overlap share no value. Where they do,
the tally does not tell of the column, and the table is read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A row of a tally: so many rows have this value, as text, in this column.
TALLY = "column string, value string, rows bigint"


@dataclass(frozen=True)
class Tally:
    """The counts of some rows. `counted` are columns of which every value is there, `faults` has for each column of which
    only repeated values and NULL are the ranges of its parts."""

    counts: DataFrame
    counted: frozenset[str]
    faults: dict[str, list[tuple[int, int]]]

    def tells(self, column: str, alone: bool) -> bool:
        """Whether a report can take the column from here; `alone` if it is compared with no other column."""
        if column in self.counted:
            return True
        ranges = sorted(self.faults.get(column, []))
        return alone and column in self.faults and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))

    def per_value(self, column: str, kind: T.DataType, key: str, rows: str) -> DataFrame:
        """Rows per value of a counted column, NULL among them, with the value in its own type."""
        if column not in self.counted:
            raise KeyError(column)
        found = self.counts.where(F.col("column") == column).groupBy("value").agg(F.sum("rows").alias(rows))
        return found.select(F.col("value").cast(kind).alias(key), rows)

    def shared(self, kinds: dict[str, T.DataType], least: float) -> dict[str, dict]:
        """Of counted columns, given with their types, the values that more than `least` rows have, with their rows."""
        found: dict[str, dict] = {name: {} for name in kinds}
        counts = self.counts.where(F.col("column").isin(list(kinds)))
        counts = counts.groupBy("column", "value").agg(F.sum("rows").alias("rows"))
        for name, value, rows in counts.where(F.col("rows") > least).collect():
            whole = value is not None and isinstance(kinds[name], T.IntegralType)
            found[name][int(value) if whole else value] = rows
        return found


def write_tally(
    frame: DataFrame, write: Callable[[DataFrame], DataFrame], counted: Iterable[str], alone: Iterable[str] = ()
) -> str:
    """Counts rows that are stored already, reading the columns wanted; the text that `read_tally` needs beside them.

    `write` is given the tally and writes it. Columns are texts, or whole numbers; `alone`, those of which only faults are kept,
    must be whole numbers. Each column is read and counted by itself, in its own type, so a task holds values of one.
    """
    counted, alone = list(dict.fromkeys(counted)), list(dict.fromkeys(alone))
    alone = [name for name in alone if name not in counted]
    kinds = {f.name: f.dataType for f in frame.schema}
    for name in counted + alone:
        if not isinstance(kinds[name], T.IntegralType) and (name in alone or not isinstance(kinds[name], T.StringType)):
            raise TypeError(f"{name} is {kinds[name].simpleString()}")
    parts, ranges = [_counts(frame, name) for name in counted], {}
    for name in alone:
        ranges[name], faulty = _range(frame, name)
        if faulty:
            parts.append(_counts(frame, name).where((F.col("rows") > 1) | F.col("value").isNull()))
    write(reduce(DataFrame.unionByName, parts or [frame.sparkSession.createDataFrame([], TALLY)]))
    return json.dumps({"counted": counted, "faults": ranges})


def _counts(frame: DataFrame, name: str) -> DataFrame:
    """The rows of a tally for one column."""
    counts = frame.select(F.col(f"`{name}`").alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("rows"))
    return counts.select(F.lit(name).alias("column"), F.col("value").cast("string").alias("value"), "rows")


def _range(frame: DataFrame, name: str) -> tuple[list[tuple[int, int]], bool]:
    """The least and the largest of whole numbers, if there are any, and whether one is repeated or NULL.

    Numbers meet in blocks of 64, each a count and a bit per number: a repeated one leaves fewer bits than rows. Where numbers are
    mostly different, counting each before the shuffle would only fill memory.
    """
    number = F.col(f"`{name}`").cast("bigint")
    numbers = frame.select(number.alias("number"), F.shiftright(number, 6).alias("block")).repartition("block")
    bit = F.expr("shiftleft(1L, cast(number & 63 as int))")
    blocks = numbers.groupBy("block").agg(
        F.min("number").alias("least"), F.max("number").alias("largest"),
        (F.count(F.lit(1)) != F.bit_count(F.bit_or(bit))).alias("repeated"),
    )
    faulty = F.count_if(F.col("block").isNull() | F.col("repeated"))
    least, largest, faults = blocks.agg(F.min("least"), F.max("largest"), faulty).first()
    return [] if least is None else [(least, largest)], faults > 0


def read_tally(counts: DataFrame, text: str) -> Tally:
    found = json.loads(text)
    faults = {name: [tuple(r) for r in ranges] for name, ranges in found["faults"].items()}
    return Tally(counts, frozenset(found["counted"]), faults)


def added(parts: list[Tally | None]) -> Tally | None:
    """The tally of all rows of some parts, of the columns that each tells of; None unless each has one.

    A column that one part has counted whole and another not is left out.
    """
    if not parts or None in parts:
        return None
    faults = {
        name: [r for part in parts for r in part.faults[name]]
        for name in parts[0].faults if all(name in part.faults for part in parts)
    }
    counted = frozenset.intersection(*[part.counted for part in parts])
    return Tally(reduce(DataFrame.unionByName, [part.counts for part in parts]), counted, faults)
