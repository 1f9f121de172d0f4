"""Exact deduplication with an extendible-hash index on shared files.

1. Each input task collapses its own equal texts, so a text that a third of all rows share leaves a task once. It
   writes a member row per document and, per distinct text, an entry: key, bytes, best document, number.
2. The directory: buckets are ranges of the key's leading bits. A bucket with more bytes than `bucket_bytes` is split by
   the next bit; if it already uses all bits of the directory, the directory doubles. A bucket with one key, or
   still overfull after `MAX_DOUBLINGS`, keeps its overflow, which costs time but no memory.
3. Owner tasks get whole buckets, sorted by key, and walk them: texts with the same key are chained and compared byte
   by byte, so equal keys of different texts do no harm. Only one key's distinct texts are in memory.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import chain as chain_

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perron.llm.arrow import WHITE, slices, small_batches, texts
from perron.session import scratch

BUCKET_BYTES = 8 << 20
MAX_DOUBLINGS = 6
# Bytes of distinct texts that a task remembers; beyond that it starts to remember anew.
HELD_BYTES = 32 << 20

_MEMBERS = [("uid", pa.int64()), ("doc_id", pa.int64()), ("rep", pa.int64())]
_ENTRIES = [
    ("key", pa.int64()), ("text", pa.binary()), ("best_points", pa.int64()), ("best_id", pa.int64()),
    ("best_uid", pa.int64()), ("rows", pa.int64()),
]
_MEMBERS_DDL = "uid bigint, doc_id bigint, rep bigint"
_ENTRIES_DDL = "key bigint, text binary, best_points bigint, best_id bigint, best_uid bigint, rows bigint"
_CLASSES = pa.schema(
    [("rep", pa.int64()), ("keep_uid", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("text_sha256", pa.string())]
)
_CLASSES_DDL = "rep bigint, keep_uid bigint, keep_id bigint, group_size bigint, text_sha256 string"
_NO_ID = 1 << 63


def _rank(points: int, doc_id: int | None, uid: int) -> tuple[int, int, int]:
    """The least of a group stays: most code points, then smallest id (null last), then first row."""
    return (-points, _NO_ID if doc_id is None else doc_id, uid)


def _normal(text: bytes) -> bytes:
    return text.translate(None, WHITE)


def _offers(carried: list[str]):
    """Per document a member row, and per distinct text that a task has met an entry with its best row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size, schema = 0, None

        def flushed() -> Iterator[pa.RecordBatch]:
            def rows() -> Iterator[tuple]:
                while held:
                    normal, (rep, best, count, text, rest) = held.popitem()
                    doc_id = None if best[1] == _NO_ID else best[1]
                    key = xxhash.xxh64_intdigest(normal) - (1 << 63)
                    yield None, None, rep, key, text, -best[0], doc_id, best[2], count, *rest

            return _batched(rows(), schema, lambda row: len(row[4]) + 200)

        for batch in slices(batches):
            if schema is None:
                schema = pa.schema([*_MEMBERS, *_ENTRIES, *[pa.field(c, batch.schema.field(c).type) for c in carried]])
            points = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()
            uids, ids, reps = batch.column("uid").to_pylist(), batch.column("doc_id").to_pylist(), []
            others = list(zip(*[batch.column(c).to_pylist() for c in carried])) if carried else [()] * len(uids)
            for text, n, uid, doc_id, rest in zip(texts(batch), points, uids, ids, others):
                normal, mine = _normal(text), _rank(n, doc_id, uid)
                known = held.get(normal)
                if known is None:
                    held[normal] = known = [uid, mine, 1, text, rest]
                    size += 2 * len(text) + 400
                else:
                    known[2] += 1
                    if mine < known[1]:
                        known[1], known[3], known[4] = mine, text, rest
                reps.append(known[0])
            members = [batch.column("uid"), batch.column("doc_id"), pa.array(reps, pa.int64())]
            yield pa.record_batch(members + [pa.nulls(len(reps), f.type) for f in list(schema)[3:]], schema)
            if size > HELD_BYTES:
                yield from flushed()
                size = 0
        if held:
            yield from flushed()

    return run


def _walked(batches: Iterator[pa.RecordBatch], carried: list[str]) -> Iterator[list]:
    """Chains of entries that come sorted by key: [text without white space, reps, best, rows, best row]."""
    current, chains = None, []
    names = ("key", "text", "rep", "best_points", "best_id", "best_uid", "rows")
    for batch in slices(batches):
        others = list(zip(*[batch.column(c).to_pylist() for c in carried])) if carried else [()] * batch.num_rows
        columns = [batch.column(c).to_pylist() for c in names]
        for key, text, rep, points, doc_id, uid, rows, rest in zip(*columns, others):
            if key != current:
                yield from chains
                current, chains = key, []
            normal, mine = _normal(text), _rank(points, doc_id, uid)
            for chain in chains:
                if chain[0] == normal:
                    chain[1].append(rep)
                    chain[3] += rows
                    if mine < chain[2]:
                        chain[2], chain[4] = mine, (text, *rest)
                    break
            else:
                chains.append([normal, [rep], mine, rows, (text, *rest)])
    yield from chains


def _batched(rows: Iterator[tuple], schema: pa.Schema, weigh) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weigh(row)
        if size > 1 << 22:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema)
            held, size = [], 0
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema)


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for normal, reps, best, count, _ in _walked(batches, []):
            sha, keep_id = hashlib.sha256(normal).hexdigest(), None if best[1] == _NO_ID else best[1]
            for rep in reps:
                yield rep, best[2], keep_id, count, sha

    yield from _batched(rows(), _CLASSES, lambda row: 200)


def _best_rows(carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        head = next(batches, None)
        if head is None:
            return
        schema = pa.schema([("text", pa.binary()), *[head.schema.field(c) for c in carried]])
        rows = (chain[4] for chain in _walked(chain_([head], batches), carried))
        yield from _batched(rows, schema, lambda row: len(row[0]) + 200)

    return run


def _prefix(depth: int) -> Column:
    """The leading bits of the key."""
    return F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("bigint")


def directory(entries: DataFrame, folder: str, bucket_bytes: int) -> tuple[DataFrame, int]:
    """Slots (`slot`, `bucket`) and the number of bits of a slot. Buckets are written below `folder` as (depth, prefix)."""
    spark = entries.sparkSession
    sized = entries.select("key", (F.octet_length("text") + F.lit(64)).alias("bytes"))
    total = sized.agg(F.sum("bytes")).first()[0] or 0
    depth = max(0, math.ceil(math.log2(max(1, total / bucket_bytes))))
    first, parents = depth, None
    while True:
        prefixed = sized.withColumn("prefix", _prefix(depth))
        if parents is not None:
            prefixed = prefixed.join(parents, F.shiftrightunsigned("prefix", 1) == F.col("parent"), "left_semi")
        overfull = (F.col("load") > bucket_bytes) & (F.col("low") < F.col("high")) & F.lit(depth - first < MAX_DOUBLINGS)
        level = prefixed.groupBy("prefix").agg(
            F.sum("bytes").alias("load"), F.min("key").alias("low"), F.max("key").alias("high")
        ).select(F.lit(depth).alias("depth"), "prefix", "load", overfull.alias("split"))
        level.write.parquet(f"{folder}/depth-{depth}")
        written = spark.read.parquet(f"{folder}/depth-{depth}")
        parents = written.where("split").select(F.col("prefix").alias("parent"))
        if parents.isEmpty():
            break
        depth += 1
    buckets = spark.read.parquet(*[f"{folder}/depth-{d}" for d in range(first, depth + 1)]).where("not split")
    width = F.lit(depth) - F.col("depth")
    start = F.expr(f"shiftleft(prefix, {depth} - depth)")
    slots = F.sequence(start, start + F.expr(f"shiftleft(1L, {depth} - depth)") - 1)
    return buckets.select(F.explode(slots).alias("slot"), start.alias("bucket")), depth


def _owned(offers: DataFrame, folder: str, bucket_bytes: int) -> DataFrame:
    """The entries, whole buckets to a task, sorted by key."""
    entries = offers.where("key is not null").drop("uid", "doc_id")
    slots, depth = directory(entries, f"{folder}/directory", bucket_bytes)
    return (
        entries.withColumn("slot", _prefix(depth))
        .join(slots, "slot")
        .repartition("bucket")
        .sortWithinPartitions("key", "rep")
        .select(*entries.columns)
    )


def _numbered(id: str, text: str, uid: str | None) -> list[Column]:
    number = F.col(f"`{uid}`").cast("bigint") if uid else F.monotonically_increasing_id()
    return [number.alias("uid"), F.col(f"`{id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text")]


def exact_dedup(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    uid: str | None = None,
    bucket_bytes: int = BUCKET_BYTES,
    folder: str | None = None,
) -> DataFrame:
    """One row per document: `uid`, `doc_id`, `keep_uid`, `keep_id`, `group_size`, `kept`, `text_sha256`.

    Texts are equal if they are the same bytes without ASCII white space; null counts as empty, so all empty texts
    are one group. Of a group the row with the most code points stays, then the smallest id (null last), then the
    first row, so that of repeated rows with the same id exactly one stays. `uid` numbers the rows of `docs` as they
    were read, or is the column that the parameter names, which must be different in every row. Other columns are not
    looked at, whatever their names. An empty table gives no rows. The index stays in `folder` (default: a new one in the shared folder): `offers`, `directory`, `classes`.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or scratch(spark, "exact-index")
    ddl = f"{_MEMBERS_DDL}, {_ENTRIES_DDL}"
    docs.select(*_numbered(id, text, uid)).mapInArrow(_offers([]), ddl).write.parquet(f"{folder}/offers")
    offers = spark.read.schema(ddl).parquet(f"{folder}/offers")
    _owned(offers, folder, bucket_bytes).mapInArrow(_classes, _CLASSES_DDL).write.parquet(f"{folder}/classes")
    classes = spark.read.schema(_CLASSES_DDL).parquet(f"{folder}/classes")
    return (
        offers.where("uid is not null")
        .select("uid", "doc_id", "rep")
        .join(classes, "rep")
        .select(
            "uid", "doc_id", "keep_uid", "keep_id", "group_size",
            (F.col("uid") == F.col("keep_uid")).alias("kept"), "text_sha256",
        )
    )


def survivors(docs: DataFrame, *, id: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The rows of `docs` that `exact_dedup` keeps, with all their columns.

    Entries carry their best row through the index, so no text moves a second time. A null text that stays is null again.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = scratch(spark, "exact-index")
    others = [c for c in docs.columns if c != text]
    carried = [f"__{i}" for i in range(len(others) + 1)]
    columns = [F.col(f"`{c}`").alias(n) for c, n in zip(others, carried)] + [F.col(f"`{text}`").isNull().alias(carried[-1])]
    kinds = [docs.schema[c].dataType.simpleString() for c in others] + ["boolean"]
    extra = ", ".join(f"{n} {k}" for n, k in zip(carried, kinds))
    ddl = f"{_MEMBERS_DDL}, {_ENTRIES_DDL}, {extra}"
    numbered = docs.select(*_numbered(id, text, None), *columns)
    numbered.mapInArrow(_offers(carried), ddl).where("key is not null").write.parquet(f"{folder}/offers")
    offers = spark.read.schema(ddl).parquet(f"{folder}/offers")
    best = _owned(offers, folder, bucket_bytes).mapInArrow(_best_rows(carried), f"text binary, {extra}")
    names = dict(zip(others, carried))
    original = F.when(~F.col(carried[-1]), F.col("text").cast("string"))
    return best.select(*[original.alias(c) if c == text else F.col(names[c]).alias(c) for c in docs.columns])
