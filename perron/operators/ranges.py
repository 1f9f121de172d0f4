"""Rows laid out so that filters on some columns read little of them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame


def in_ranges(frame: DataFrame, by: list[str], ties: list[str], most: int | None = None) -> DataFrame:
    """The rows in ranges of the columns `by`, each partition sorted, with one shuffle.

    Files written from it span little of these columns, and so do their row groups and pages, whose statistics let scans
    pass over what a filter excludes. `ties` go on where `by` is equal, so that many rows of one value are split like others.
    Partitions are as many as a shuffle has; the adaptive planner puts small neighbours together, which keeps the ranges.
    With `most` rows are counted first, and partitions are as many more as it takes for about so many in each: what a task sorts
    then does not grow with the table. Counting reads the columns that the frame's filters need.
    """
    ranged = frame.repartitionByRange(*by, *ties)
    if most is not None:
        partitions = math.ceil(frame.count() / most)
        if partitions > int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")):
            ranged = frame.repartitionByRange(partitions, *by, *ties)
    return ranged.sortWithinPartitions(*by, *ties)
