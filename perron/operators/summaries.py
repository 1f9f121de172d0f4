"""What is known of rows since they were written: how many they are, how wide, and which keys many of them share.

Rows and bytes are counted by the tasks that write, and reach the driver as a few numbers per task. Keys that many rows
share are looked for afterwards, in the key columns of what was written, and only where there are enough rows for one
to be hot. A join that is given a summary reads nothing to decide how it is laid out. A summary never decides what is
in a result, so estimates do.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perron.session import scratch

# Rows from which on a key can be hot, unless a join is told otherwise.
HOT_ROWS = 1_000_000

# Rows of a just hot key that the look for hot keys comes across.
LOOKED_AT = 10_000

# A key that more than one in so many rows have is in the summary; so at most as many are.
KEPT = 2_000


@dataclass(frozen=True)
class Summary:
    """Of some rows: `widths` has the bytes that each column takes in all of them, `keys` for each key column that was
    looked at the values that many rows share, with an estimate of their rows; None stands for NULL."""

    rows: int
    widths: dict[str, int]
    keys: dict[str, dict] = field(default_factory=dict)

    def size(self, columns: Iterable[str]) -> int | None:
        """Bytes of a hash table of these columns; None if it is not known of all."""
        widths = [self.widths.get(name) for name in columns]
        if None in widths:
            return None
        return self.rows * (24 + 8 * len(widths)) + sum(widths)

    def renamed(self, names: dict[str, str]) -> Summary:
        """That of a projection, given as new names with the old ones."""
        return Summary(
            self.rows,
            {new: self.widths[old] for new, old in names.items() if old in self.widths},
            {new: self.keys[old] for new, old in names.items() if old in self.keys},
        )

    def to_json(self) -> str:
        return json.dumps(asdict(self) | {"keys": {name: list(found.items()) for name, found in self.keys.items()}})

    @staticmethod
    def from_json(text: str) -> Summary:
        found = json.loads(text)
        return Summary(found["rows"], found["widths"], {name: dict(pairs) for name, pairs in found["keys"].items()})


def merged(parts: list[Summary | None]) -> Summary | None:
    """The summary of all rows of some tables; None unless each has one. Keys that one was not looked at for are unknown."""
    if not parts or None in parts:
        return None
    widths, keys = {}, {}
    for name in parts[0].widths:
        if all(name in part.widths for part in parts):
            widths[name] = sum(part.widths[name] for part in parts)
    for name in parts[0].keys:
        if all(name in part.keys for part in parts):
            keys[name] = {}
            for part in parts:
                for value, rows in part.keys[name].items():
                    keys[name][value] = keys[name].get(value, 0) + rows
    return Summary(sum(part.rows for part in parts), widths, keys)


def write_summarised(
    frame: DataFrame,
    write: Callable[[DataFrame], DataFrame],
    keys: Iterable[str] = (),
    hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, Summary]:
    """Writes rows once and tells what is known of them then. `write` is given them and returns what it wrote, to be read.

    `keys` are the columns by which the rows will be joined, texts or whole numbers; others are passed over. They are
    looked at if there are more than `hot_rows` rows. Columns other than texts, numbers, flags and times have no width.
    """
    fields = {f.name: f.dataType for f in frame.schema}
    texts = [name for name, kind in fields.items() if isinstance(kind, T.StringType)]
    counted = Observation()
    stored = write(
        frame.observe(
            counted,
            F.count(F.lit(1)).alias("rows"),
            *[F.sum(F.octet_length(F.col(f"`{name}`")) + F.lit(8)).alias(f"bytes{i}") for i, name in enumerate(texts)],
        )
    )
    found = counted.get
    fixed = (T.NumericType, T.BooleanType, T.DatetimeType, T.NullType)
    widths = {name: 0 for name, kind in fields.items() if isinstance(kind, fixed)}
    widths |= {name: found[f"bytes{i}"] or 0 for i, name in enumerate(texts)}
    rows = found["rows"]
    able = [name for name in dict.fromkeys(keys) if isinstance(fields[name], (T.StringType, T.IntegralType))]
    return stored, Summary(rows, widths, shared_keys(stored, able, rows) if able and rows > hot_rows else {})


def shared_keys(frame: DataFrame, keys: list[str], rows: int) -> dict[str, dict]:
    """For each key column the values that more than one in `KEPT` of the rows have, with an estimate of their rows.

    All columns are looked at in one read, in so many rows that a value that just counts is met about `LOOKED_AT` times.
    """
    part = min(1.0, LOOKED_AT * KEPT / max(rows, 1))
    looked_at = frame.select(*[F.col(f"`{key}`") for key in keys])
    looked_at = looked_at.sample(part, seed=17) if part < 1 else looked_at
    pairs = [
        F.struct(F.lit(i).alias("key"), F.col(f"`{key}`").cast("string").alias("value")) for i, key in enumerate(keys)
    ]
    counts = looked_at.select(F.inline(F.array(*pairs))).groupBy("key", "value").count()
    found: dict[str, dict] = {key: {} for key in keys}
    for number, value, count in counts.where(F.col("count") > rows * part / KEPT).collect():
        key = keys[number]
        whole = value is not None and isinstance(frame.schema[key].dataType, T.IntegralType)
        found[key][int(value) if whole else value] = int(count / part)
    return found


def settled(frame: DataFrame, name: str, *keys: str) -> tuple[DataFrame, Summary]:
    """The rows, computed once: written to the shared folder, to be read from there, and their summary."""
    spark, folder = frame.sparkSession, scratch(frame.sparkSession, name)

    def write(rows: DataFrame) -> DataFrame:
        rows.write.parquet(folder)
        return spark.read.schema(frame.schema).parquet(folder)

    return write_summarised(frame, write, keys)
