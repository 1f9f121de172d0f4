"""Packing token sequences by minimum bin slack.

Every document is cut into whole windows and a tail. The tails' lengths are counted: at most `size - 1` numbers, however
many documents there are, and all that comes to the driver. There the windows are planned: the longest tail left, and
of the others the multiset whose lengths come closest to what remains, by subset sums in a bitset with backtracked
counts. A pattern is used as often as the counts allow, so their number does not grow with the input. Where the best
multiset leaves more than `max_slack`, a further tail is cut to fill the window and its rest stays to be packed.

Tasks then deal: a document's place among those of equal tail length says which patterns take it. Groups of equal
tails, of which one may have a third of all rows, are sliced by a hash of the row's number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perron.llm.arrow import slices, small_batches
from perron.llm.tokens import encoder, id_kind, vocabulary_path
from perron.session import scratch

SIZE = 4096
MAX_SLACK = 8
SLICES = 256


@dataclass
class _Kind:
    """Items alike: `count` tails from place `first` on among those of `tail` tokens, each from token `start`."""

    length: int
    count: int
    tail: int
    first: int
    start: int

    def take(self, number: int) -> int:
        first, self.first, self.count = self.first, self.first + number, self.count - number
        return first


def fill(room: int, kinds: list[tuple[int, int]]) -> tuple[int, list[int]]:
    """The largest sum up to `room` of (length, available) and how many of each make it; the first fit wins.

    Bit n of `reach` says that n can be made of the kinds so far.
    """
    reach, mask, before = 1, (1 << room + 1) - 1, []
    for length, available in kinds:
        before.append(reach)
        left, step = min(available, room // length), 1
        while left:
            step = min(step, left)
            reach |= (reach << step * length) & mask
            left, step = left - step, step * 2
        if reach >> room & 1:
            break
    best = reach.bit_length() - 1
    counts, open_ = [0] * len(kinds), best
    for i in range(len(before) - 1, -1, -1):
        while not before[i] >> open_ & 1:
            open_ -= kinds[i][0]
            counts[i] += 1
    return best, counts


def plan(counts: dict[int, int], size: int = SIZE, max_slack: int = MAX_SLACK) -> tuple[np.ndarray, int]:
    """Which sequences take the tails, and the number of sequences.

    A row (tail, low, high, start, length, sequence, each, offset) deals the tails at places low..high-1 among
    those of `tail` tokens: their tokens from `start`, `length` many, go to the sequences from `sequence` on, `each`
    into one, behind one another from `offset`.
    """
    kinds = sorted((_Kind(n, c, n, 0, 0) for n, c in counts.items() if c), key=lambda k: -k.length)
    rows, sequence = [], 0
    while kinds:
        seed = kinds[0]
        room = size - seed.length
        others = [k for k in kinds if k.length <= room]
        best, number = fill(room, [(k.length, k.count - (k is seed)) for k in others])
        used = {id(seed): (seed, 1)}
        for kind, n in zip(others, number):
            if n:
                used[id(kind)] = (kind, n + (kind is seed))
        slack, cut = room - best, None
        if slack > max_slack:
            spare = [k for k in kinds if k.length > slack and k.count > used.get(id(k), (k, 0))[1]]
            cut = min(spare, key=lambda k: k.length, default=None)
        times = min(k.count // (n + (k is cut)) for k, n in used.values())
        if cut is not None and id(cut) not in used:
            times = min(times, cut.count)
        offset = 0
        for kind, n in used.values():
            low = kind.take(times * n)
            rows.append((kind.tail, low, low + times * n, kind.start, kind.length, sequence, n, offset))
            offset += n * kind.length
        if cut is not None:
            low = cut.take(times)
            rows.append((cut.tail, low, low + times, cut.start, slack, sequence, 1, offset))
            kinds.append(_Kind(cut.length - slack, times, cut.tail, low, cut.start + slack))
        sequence += times
        kinds = sorted((k for k in kinds if k.count), key=lambda k: -k.length)
    return np.array(rows, np.int64).reshape(-1, 8), sequence


_IDS_DDL = "uid bigint, doc_id bigint, ids binary, tokens bigint"


def _tokenise(path: str, end: int):
    schema = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.binary()), ("tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, end)
        for batch in slices(batches):
            ids = [encode.encode(t) for t in batch.column("text").to_pylist()]
            counts = [len(i) // encode.kind.itemsize for i in ids]
            columns = [batch.column("uid"), batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(counts, pa.int64())]
            yield pa.record_batch(columns, schema)

    return run


_PIECES_DDL = (
    "uid bigint, doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, ids binary"
)
_PIECES = pa.schema(
    [(c, pa.int64()) for c in "uid doc_id start length ids_crc32 doc_tokens sequence_id offset".split()] + [("ids", pa.binary())]
)


def _deal(rows: np.ndarray, packed: int, size: int, kind: np.dtype, with_ids: bool):
    by_tail = {int(t): rows[rows[:, 0] == t] for t in np.unique(rows[:, 0])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids"):
            out: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("uid", "doc_id", "ids", "tokens", "place", "whole")]
            for uid, doc_id, ids, tokens, place, whole in zip(*columns):
                wide = np.frombuffer(ids, kind).astype("<u4")
                tail = tokens % size
                pieces = [(k * size, size, packed + whole + k, 0) for k in range(tokens // size)]
                if tail:
                    of = by_tail[tail]
                    for _, low, _, start, length, sequence, each, offset in of[(of[:, 1] <= place) & (place < of[:, 2])].tolist():
                        turn, slot = divmod(place - low, each)
                        pieces.append((tokens - tail + start, length, sequence + turn, offset + slot * length))
                for start, length, sequence, offset in pieces:
                    part = wide[start : start + length].tobytes()
                    out.append((uid, doc_id, start, length, zlib.crc32(part), tokens, sequence, offset, part if with_ids else None))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), _PIECES)], _PIECES)

    return run


def pack(
    docs: DataFrame,
    path: str | None = None,
    end: int = 2,
    size: int = SIZE,
    max_slack: int = MAX_SLACK,
    *,
    id: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """A row per piece: document, its tokens `start`.. of `length`, and where they stand in which sequence.

    Every id, the end id behind each document included, lies in exactly one piece, so null and empty texts are one
    token. No sequence is longer than `size`. Texts of any length are cut at every `size` tokens. `ids` are
    little-endian unsigned 32-bit. Rows with the same id are different documents; `uid` tells them apart. An empty
    table gives no rows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    small_batches(spark)
    path = path or vocabulary_path("word_bpe_49k.json")
    folder = scratch(spark, "packing")
    source = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text")
    )
    source.mapInArrow(_tokenise(path, end), _IDS_DDL).write.parquet(f"{folder}/ids")
    documents = spark.read.schema(_IDS_DDL).parquet(f"{folder}/ids").select(
        "*",
        F.pmod("tokens", F.lit(size)).alias("tail"),
        F.expr(f"tokens div {size}").alias("windows"),
        F.pmod(F.xxhash64("uid"), F.lit(SLICES)).alias("slice"),
    )
    documents.groupBy("tail", "slice").agg(F.count("*").alias("docs"), F.sum("windows").alias("windows")).write.parquet(
        f"{folder}/groups"
    )
    groups = spark.read.parquet(f"{folder}/groups")
    tails = groups.groupBy("tail").agg(F.sum("docs").alias("docs"), F.sum("windows").alias("windows"))
    rows, packed = plan({r["tail"]: r["docs"] for r in tails.collect() if r["tail"]}, size, max_slack)

    # Where each group begins: among the tails of its length, and among all whole windows.
    within = Window.partitionBy("tail").orderBy("slice")
    begins = groups.join(
        tails.select("tail", (F.sum("windows").over(Window.orderBy("tail")) - F.col("windows")).alias("tail_windows")), "tail"
    ).select(
        "tail",
        "slice",
        (F.sum("docs").over(within) - F.col("docs")).alias("first_place"),
        (F.sum("windows").over(within) - F.col("windows") + F.col("tail_windows")).alias("first_window"),
    )
    group = Window.partitionBy("tail", "slice").orderBy("uid")
    placed = documents.join(begins, ["tail", "slice"]).select(
        "uid",
        "doc_id",
        "ids",
        "tokens",
        (F.col("first_place") + F.row_number().over(group) - 1).alias("place"),
        (F.col("first_window") + F.sum("windows").over(group) - F.col("windows")).alias("whole"),
    )
    return placed.mapInArrow(_deal(rows, packed, size, id_kind(path), with_ids), _PIECES_DDL)
