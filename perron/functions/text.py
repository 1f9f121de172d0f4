"""Text expressions over literal delimiters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_token(text: Column, delimiter: str) -> Column:
    """What stands before the first delimiter, or the whole text."""
    return F.substring_index(text, delimiter, 1)


def last_segment(text: Column, delimiter: str, trim: bool = False) -> Column:
    """What stands after the last delimiter, blanks kept unless `trim`."""
    segment = F.substring_index(text, delimiter, -1)
    return F.trim(segment) if trim else segment


def occurrences(text: Column, token: str) -> Column:
    """How often a literal token occurs."""
    return F.regexp_count(text, F.lit(r"\Q" + token + r"\E"))


def without_spaces(text: Column) -> Column:
    """`1 234 567` to `1234567`."""
    return F.replace(text, F.lit(" "), F.lit(""))


def prefixed_key(prefix: str, number: Column, offset: int) -> Column:
    """Prefix followed by a whole number less an offset."""
    return F.concat(F.lit(prefix), (number - F.lit(offset)).cast("bigint").cast("string"))
