"""Document fingerprints by context-triggered piecewise hashing, and how much two texts have in common by them.

1. A rolling hash looks at the last `WINDOW` bytes of a text. A byte is a boundary of block size 2^k if its hash ends in
   k zero bits, so the boundaries of a block size are among those of the size below, and what stands in one place of a
   text does not move the boundaries of another.
2. A text's block size is the smallest that cuts it into at most `PIECES` pieces. Its fingerprint has the block size,
   the signature at it and the signature at twice that size; a signature has one code (two letters) for each piece.
3. Two fingerprints are compared where they have a block size in common. Their likeness is one less the edit distance
   of the two signatures, an insertion or deletion counting 1 and a replacement 2, over the number of their pieces.

Texts meet the next one in the order of ids by one shuffle, by ranges. A task reads its range in order and holds a
batch and one text; the two texts at the ends of a range, and nothing else of it, go to a second step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perron.llm.arrow import slices, small_batches, texts
from perron.session import scratch

WINDOW = 7
PIECES = 64
LEAST = 2

# Odd multipliers that spread bits (the last two are those of the 32-bit murmur finalizer).
_ROLL, _MIX, _FINAL = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35)
_LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint32(16))) * _MIX
    x = (x ^ (x >> np.uint32(13))) * _FINAL
    return x ^ (x >> np.uint32(16))


def _rolled(data: np.ndarray) -> np.ndarray:
    """The hash of the `WINDOW` bytes that end at each place; there is nothing but zeros before the first."""
    out = np.zeros(len(data), np.uint32)
    factor = np.uint32(1)
    for back in range(WINDOW):
        out[back:] += data[: len(data) - back].astype(np.uint32) * factor
        factor = np.uint32(int(factor) * int(_ROLL) & 0xFFFFFFFF)
    return _spread(out)


def signatures(values: list[bytes]) -> list[str]:
    """The fingerprint `size:signature:signature at twice the size` of each text; an empty one has `4::`."""
    # Zeros before each text keep the window within it.
    bounds = np.cumsum([0] + [len(v) + WINDOW - 1 for v in values])
    gap = bytes(WINDOW - 1)
    data = np.frombuffer(b"".join([part for v in values for part in (gap, v)]), np.uint8)
    hashes = _rolled(data)
    # The sum of the hashes of all windows that end in a piece tells the pieces apart.
    total = np.zeros(len(data) + 1, np.uint32)
    np.cumsum(_spread(hashes ^ _ROLL), out=total[1:])
    level = np.bitwise_count(~hashes & (hashes - np.uint32(1)))
    ends = np.flatnonzero(level >= LEAST)
    levels, first = level[ends], np.searchsorted(ends, bounds)
    out = []
    for i, value in enumerate(values):
        start, stop = bounds[i] + WINDOW - 1, bounds[i + 1]
        # Boundaries among the zeros and the first places before the text are none.
        own = slice(np.searchsorted(ends[first[i] : first[i + 1]], start) + first[i], first[i + 1])
        places, sizes = ends[own] + 1, levels[own]
        if not value:
            out.append(f"{1 << LEAST}::")
            continue
        counts = np.bincount(sizes, minlength=34)[::-1].cumsum()[::-1]
        k = LEAST + int(np.argmax(counts[LEAST:] < PIECES))
        signed = []
        for size in (k, k + 1):
            cuts = places[sizes >= size]
            if not len(cuts) or cuts[-1] != stop:
                cuts = np.append(cuts, stop)
            sums = total[cuts] - total[np.concatenate([[start], cuts[:-1]])]
            codes = _spread(sums.astype(np.uint32)) & np.uint32(0xFFF)
            signed.append(_LETTERS[np.column_stack([codes >> np.uint32(6), codes & np.uint32(63)])].tobytes().decode())
        out.append(f"{1 << k}:{signed[0]}:{signed[1]}")
    return out


def _common(a: list[str], b: list[str]) -> int:
    """The length of the longest common subsequence, a row of the table at a time in the bits of a number."""
    where: dict[str, int] = {}
    for i, code in enumerate(a):
        where[code] = where.get(code, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for code in b:
        met = row & where.get(code, 0)
        row = (row + met | row - met) & full
    return len(a) - row.bit_count()


def _parts(fingerprint: str) -> dict[int, str]:
    size, once, twice = fingerprint.split(":")
    return {int(size): once, 2 * int(size): twice}


def likeness(a: str, b: str) -> float:
    """How much two fingerprints have in common, 0 to 1; 0 if they have no block size in common."""
    if a == b:
        return 1.0
    ours, theirs = _parts(a), _parts(b)
    shared = ours.keys() & theirs.keys()
    if not shared:
        return 0.0
    # At two common sizes the finer one tells more.
    size = min(shared)
    x, y = ours[size], theirs[size]
    codes_x, codes_y = [x[i : i + 2] for i in range(0, len(x), 2)], [y[i : i + 2] for i in range(0, len(y), 2)]
    pieces = len(codes_x) + len(codes_y)
    return 2.0 * _common(codes_x, codes_y) / pieces if pieces else 0.0


def alike(a: str | Column, b: str | Column) -> Column:
    """The likeness of two columns of fingerprints; null where one of them is null."""

    def compared(x: str | None, y: str | None) -> float | None:
        return None if x is None or y is None else likeness(x, y)

    return F.udf(compared, "double", useArrow=True)(a, b)


def fingerprint(docs: DataFrame, *, text: str = "text", into: str = "fingerprint") -> DataFrame:
    """`docs` with a column `into`, the fingerprint of the whole text, in place of a column of that name.

    A null text counts as empty. Equal texts have equal fingerprints, whatever the other columns, which all stay as
    they are. An empty table stays empty. A text is held whole by a task, ten bytes of memory for each of its own.
    """
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c != into]
    # Other names on the way, as tasks cannot have the dots that a column's name may have.
    inner = docs.select(F.col(f"`{text}`").alias("text"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = pa.array(signatures(texts(batch)), pa.string())
            schema = pa.schema([*list(batch.schema)[1:], ("fingerprint", pa.string())])
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], found], schema=schema)

    fields = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in inner.schema.fields[1:]] + ["fingerprint string"])
    return inner.mapInArrow(run, fields).toDF(*kept, into)


def edit(text: str, following: str) -> str:
    """The text, its later half (rounded down) replaced by as many of the first code points of another, or by all."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_RESULT = [
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
]
_RESULT_DDL = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
# A range adds to its rows what stands at its ends: the fingerprint and the text of its first and of its last document.
_PASS = pa.schema([*_RESULT, ("part", pa.int32()), ("role", pa.string()), ("text", pa.string())])
_PASS_DDL = f"{_RESULT_DDL}, part int, role string, text string"


def _compared(ids: list, own: list[str], marks: list[str], following: list[str], next_marks: list[str]) -> list[list]:
    """The columns of the result for texts and what follows each."""
    edited = [edit(a, b) for a, b in zip(own, following)]
    raw = [e.encode() for e in edited]
    edited_marks = signatures(raw)
    return [
        ids, [len(t) for t in own], [hashlib.sha256(r).hexdigest() for r in raw], marks, edited_marks,
        [likeness(a, b) for a, b in zip(marks, edited_marks)], [likeness(a, b) for a, b in zip(marks, next_marks)],
    ]


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, held = TaskContext.get().partitionId(), None

    def end(role: str, row: tuple) -> pa.RecordBatch:
        doc_id, text, mark = row
        values = [doc_id, len(text), None, mark, None, None, None, part, role, text]
        return pa.record_batch([pa.array([v], f.type) for v, f in zip(values, _PASS)], _PASS)

    for batch in slices(batches, limit=1 << 20):
        own = [t or "" for t in batch.column("text").to_pylist()]
        ids, marks = batch.column("doc_id").to_pylist(), signatures([t.encode() for t in own])
        if held is None:
            yield end("first", (ids[0], own[0], marks[0]))
        else:
            ids, own, marks = [held[0], *ids], [held[1], *own], [held[2], *marks]
        held = ids[-1], own[-1], marks[-1]
        if len(own) > 1:
            n = len(own) - 1
            columns = _compared(ids[:-1], own[:-1], marks[:-1], own[1:], marks[1:])
            columns += [[part] * n, [None] * n, [None] * n]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _PASS)], _PASS)
    if held is not None:
        yield end("last", held)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(_RESULT)
    for batch in slices(batches):
        read = [batch.column(c).to_pylist() for c in ("doc_id", "text", "fingerprint", "next_text", "next_fingerprint")]
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(_compared(*read), schema)], schema)


def compare_with_next(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document against the next one, in descending order of ids, and against its own text with half of that one.

    A row per row of `docs`: `doc_id`, `n_chars`, `edited_sha256` of the edited text, see `edit`, `fingerprint`,
    `edited_fingerprint`, and `near_edited` and `near_next`, the likeness of the first fingerprint to the second and to
    that of the next document. After the last document comes the first; one alone is its own next. Null ids stand last,
    rows with the same id in the order in which they are read. Null texts count as empty. Other columns are not looked
    at. An empty table gives no rows. What the ranges give is written to the shared folder.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = scratch(spark, "fingerprints")
    rows = docs.select(
        F.col(f"`{id}`").cast("bigint").alias("doc_id"), F.monotonically_increasing_id().alias("uid"),
        F.col(f"`{text}`").alias("text"),
    )
    order = [F.col("doc_id").desc_nulls_last(), F.col("uid")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    ranged.mapInArrow(_in_order, _PASS_DDL).write.parquet(folder)
    found = spark.read.schema(_PASS_DDL).parquet(folder)
    inner = found.where("role is null").select(*[name for name, _ in _RESULT])

    # A number for each range that has rows, and the next such range, the first again behind the last.
    parts = sorted(row["part"] for row in found.where("role = 'last'").select("part").collect())
    follows = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next_part int")
    firsts = found.where("role = 'first'").select(
        F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint")
    )
    lasts = found.where("role = 'last'").select("doc_id", "text", "fingerprint", "part")
    met = lasts.join(F.broadcast(follows), "part").join(firsts.hint("shuffle_hash"), "next_part")
    across = met.select("doc_id", "text", "fingerprint", "next_text", "next_fingerprint")
    return inner.unionByName(across.mapInArrow(_across, _RESULT_DDL))
