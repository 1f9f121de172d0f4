"""Tolerant conversions from text. Each gives NULL for text it cannot read and never raises."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


# More characters than any text has.
_END = 2**31 - 1


def to_flag(text: Column) -> Column:
    """true/t/yes/y/on/1 and false/f/no/n/off/0, in any case."""
    word = F.lower(F.trim(text))
    return F.coalesce(text.try_cast("boolean"), F.when(word == "on", True).when(word == "off", False))


def to_decimal(text: Column, precision: int, scale: int) -> Column:
    """Exact number, rounded half up to `scale` digits; NULL when it needs more than `precision`."""
    return text.try_cast(f"decimal({precision},{scale})")


def to_whole(text: Column) -> Column:
    """Whole number, rounded half up: `2.5` is 3, where a direct cast to BIGINT would give NULL."""
    return to_decimal(text, 38, 0).try_cast("bigint")


def to_year(text: Column) -> Column:
    return to_decimal(text, 4, 0).try_cast("int")


def to_float(text: Column) -> Column:
    return text.try_cast("double")


def _rearranged(text: Column, clock: str) -> Column:
    """`31.12.2024` and a clock time as ISO text; any other text becomes NULL.

    The result is cast straight to a zone-free type. A detour over a timestamp with a zone would shift
    the hour that daylight saving skips, by the zone of the session.
    """
    fits = text.rlike(r"^\d{2}\.\d{2}\.\d{4}" + clock + "$")
    day, month, year, rest = text.substr(1, 2), text.substr(4, 2), text.substr(7, 4), F.substring(text, 11, _END)
    return F.when(fits, F.concat(year, F.lit("-"), month, F.lit("-"), day, rest))


def to_day(text: Column) -> Column:
    """`31.12.2024` to a date."""
    return _rearranged(text, "").try_cast("date")


def to_minute(text: Column) -> Column:
    """`31.12.2024 23:59` to a zone-free timestamp."""
    return _rearranged(text, r" \d{2}:\d{2}").try_cast("timestamp_ntz")


def to_second(text: Column) -> Column:
    """`31.12.2024 23:59:59` to a zone-free timestamp."""
    return _rearranged(text, r" \d{2}:\d{2}:\d{2}").try_cast("timestamp_ntz")


@dataclass(frozen=True)
class Kind:
    """A way to read a text cell. `pattern` writes the value back as such text."""

    type: str
    read: Callable[[Column], Column]
    pattern: str | None = None


KINDS = {
    "text": Kind("string", lambda text: text),
    "flag": Kind("boolean", to_flag),
    "whole": Kind("bigint", to_whole),
    "year": Kind("int", to_year),
    "day": Kind("date", to_day, "dd.MM.yyyy"),
    "minute": Kind("timestamp_ntz", to_minute, "dd.MM.yyyy HH:mm"),
    "second": Kind("timestamp_ntz", to_second, "dd.MM.yyyy HH:mm:ss"),
}


def kind_type(kind: str) -> str:
    """SQL type of a kind; every kind that is not in KINDS is a decimal and names its own type."""
    return KINDS[kind].type if kind in KINDS else kind


def read_kind(text: Column, kind: str) -> Column:
    return KINDS[kind].read(text) if kind in KINDS else text.try_cast(kind)
