"""Rows that could not be loaded travel with the good ones until both are written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A checked read adds these to the columns of its table. All but the first are NULL for a good row.
REJECTED, REASONS, CELLS, SOURCE = "rejected", "reasons", "cells", "source_file"
REJECT_COLUMNS = [SOURCE, REASONS, CELLS]


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(~F.col(REJECTED)).drop(REJECTED, *REJECT_COLUMNS)


def rejects(checked: DataFrame) -> DataFrame:
    """Rows that were not loaded: their file, the columns at fault and their cells as read."""
    return checked.where(F.col(REJECTED)).select(*REJECT_COLUMNS)
