"""SimHash near-duplicates with a hierarchical index in Gray order.

A document's fingerprint has a bit set if it is set in over half of the hashes of its word shingles. Equal fingerprints
are one entry, so copies cost nothing further. Two fingerprints that differ in at most `max_bits` bits agree on two of
`max_bits + 2` blocks of bits: they meet in the task that has one of their pairs of blocks.

There, the entries with the same pair of blocks are sorted by Gray rank, which puts entries with few different bits side
by side. Every `FAN` neighbours get a node with the bits that all of them share, nodes get nodes of their own up to one
root, and each keeps only the bits that the node above does not have. A search goes down from the root and adds up
differences; a node with more than `max_bits` so far is dropped with all below it. So is a node whose entries are known
to be linked to the one searched for, which keeps dense groups from making all their pairs. Tasks give a link per entry,
and components of the links are found in Spark.

No task holds a group of any size. One of more than `CROWD` entries is cut by the bits in which its entries may differ: these
are `max_bits + 1` further blocks, of which two linked entries agree on one. What is still as large, such as a family of copies
that have few bits of their own, is cut into pieces by a hash, and every two pieces meet in a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perron.llm.arrow import slices, small_batches, texts
from perron.llm.components import connected_components
from perron.session import scratch

SHINGLE = 4
MAX_BITS = 4
FAN = 16
SEED = 42
# Entries that a task indexes at once, and (entry, node) pairs that a search may hold.
INDEXED = 1 << 18
# Entries from which on a group is cut.
CROWD = 1 << 18
FRONTIER = 1 << 22


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of a text: A-Z lower-cased, words between ASCII white space."""
    words = text.lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    last = max(0, len(words) - shingle)
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    counts, total = np.zeros(64, np.int64), last + 1
    for low in range(0, total, 1 << 15):
        high = min(total, low + (1 << 15))
        hashes = [digest(whole[a : b - 1], SEED) for a, b in zip(starts[low:high], starts[low + width : high + width])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


_PRINTS = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("print", pa.int64())])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints = np.array([fingerprint(t, shingle) for t in texts(batch)], np.uint64).view(np.int64)
            yield pa.record_batch([batch.column("uid"), batch.column("doc_id"), pa.array(prints)], _PRINTS)

    return run


def gray_rank(prints: np.ndarray) -> np.ndarray:
    """The place of each fingerprint in the Gray code."""
    rank = prints.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class _Level:
    """Nodes over consecutive nodes of the level below: `first` child, and pattern on the bits of `mask`."""

    def __init__(self, group: np.ndarray, pattern: np.ndarray, mask: np.ndarray, last: np.ndarray, fan: int | None):
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        if fan:
            place = np.arange(len(group)) - np.repeat(starts, np.diff(np.r_[starts, len(group)]))
            starts = np.flatnonzero(place % fan == 0)
        self.first = np.r_[starts, len(group)]
        both, any_ = np.bitwise_and.reduceat(pattern, starts), np.bitwise_or.reduceat(pattern, starts)
        self.mask = np.bitwise_and.reduceat(mask, starts) & ~(both ^ any_)
        self.pattern, self.group = both & self.mask, group[starts]
        self.last = last[self.first[1:] - 1]
        # What the children have beside this: their own differences only.
        self.children_mask = mask & ~np.repeat(self.mask, np.diff(self.first))
        self.children_pattern, self.children_last = pattern, last


def _united(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after a[i] and b[i] have become one; a label is the least entry of its component."""
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        apart = low != high
        if not apart.any():
            return label
        np.minimum.at(label, high[apart], low[apart])
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped


def linked(group: np.ndarray, prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Per entry that is linked to an earlier one of its group: the entry and the least one of its component."""
    order = np.lexsort((gray_rank(prints), group))
    group, prints = group[order], prints[order]
    n = len(prints)
    levels = [_Level(group, prints, np.full(n, ~np.uint64(0)), np.arange(n), FAN)]
    while len(levels[-1].group) > 1 and (levels[-1].group[1:] == levels[-1].group[:-1]).any():
        top = levels[-1]
        levels.append(_Level(top.group, top.pattern, top.mask, top.last, FAN))
    sizes = np.diff(np.r_[np.flatnonzero(np.r_[True, group[1:] != group[:-1]]), n])
    root_of = np.repeat(np.arange(len(sizes)), sizes)
    cost = np.cumsum(np.minimum(np.repeat(sizes, sizes), FRONTIER))
    label, start = np.arange(n), 0
    while start < n:
        stop = max(start + 1, int(np.searchsorted(cost, (cost[start - 1] if start else 0) + FRONTIER, "right")))
        who, node = np.arange(start, stop), root_of[start:stop]
        top = levels[-1]
        far = np.bitwise_count((prints[who] ^ top.pattern[node]) & top.mask[node]).astype(np.int64)
        for index in range(len(levels) - 1, -1, -1):
            level = levels[index]
            stay = far <= max_bits
            who, node, far = who[stay], node[stay], far[stay]
            many = level.first[node + 1] - level.first[node]
            child = np.repeat(level.first[node] - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
            who, far = np.repeat(who, many), np.repeat(far, many)
            ahead = level.children_last[child] > who
            who, far, child = who[ahead], far[ahead], child[ahead]
            far = far + np.bitwise_count((prints[who] ^ level.children_pattern[child]) & level.children_mask[child])
            if index:
                begins = np.r_[0, level.children_last[:-1] + 1]
                least, most = np.minimum.reduceat(label, begins), np.maximum.reduceat(label, begins)
                unknown = (least[child] != label[who]) | (most[child] != label[who])
                who, far, child = who[unknown], far[unknown], child[unknown]
            node = child
        near = (far <= max_bits) & (label[who] != label[node])
        if near.any():
            label = _united(label, who[near], node[near])
        start = stop
    moved = np.flatnonzero(label != np.arange(n))
    return order[moved], order[label[moved]]


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _links(max_bits: int):
    def found(group: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        many = np.unique(group, return_counts=True, return_inverse=True)
        crowd = many[2][many[1]] > 1
        group, prints = group[crowd], prints[crowd]
        a, b = linked(group, prints.view(np.uint64), max_bits) if len(group) else (np.zeros(0, int),) * 2
        return pa.record_batch([pa.array(prints[a]), pa.array(prints[b])], _LINKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by pair of blocks, value and piece; groups are kept whole."""
        groups, prints, held, base, open_ = [], [], 0, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(name).to_numpy().astype(np.int64) for name in ("pair", "value", "piece")])
            fresh = np.r_[open_ is None or (open_ != key[:, 0]).any(), (key[:, 1:] != key[:, :-1]).any(axis=0)]
            number = base + np.cumsum(fresh)
            base, open_ = int(number[-1]), key[:, -1]
            groups.append(number)
            prints.append(batch.column("print").to_numpy())
            held += batch.num_rows
            if held >= INDEXED:
                group, entry = np.concatenate(groups), np.concatenate(prints)
                whole = int(np.searchsorted(group, base, "left"))
                if whole:
                    yield found(group[:whole], entry[:whole])
                groups, prints, held = [group[whole:]], [entry[whole:]], len(group) - whole
        if held:
            yield found(np.concatenate(groups), np.concatenate(prints))

    return run


def pair_masks(max_bits: int) -> list[int]:
    """The bits of every pair of `max_bits + 2` blocks."""
    cuts = np.linspace(0, 64, max_bits + 3).round().astype(int)
    blocks = [((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(cuts, cuts[1:])]
    return [a | b for a, b in combinations(blocks, 2)]


def finer_masks(mask: int, max_bits: int) -> list[int]:
    """The bits of a mask with each of `max_bits + 1` blocks of the others."""
    free = [bit for bit in range(64) if not mask >> bit & 1]
    return [mask | sum(1 << int(bit) for bit in part) for part in np.array_split(free, max_bits + 1)]


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def met_in_groups(entries: DataFrame, max_bits: int, crowd: int = CROWD) -> DataFrame:
    """Entries (`print`) by the groups in which they meet: `pair`, `value`, `piece`.

    Every two that differ in at most `max_bits` bits have a group in common, and a group has not many more than twice `crowd`.
    """
    masks = pair_masks(max_bits)
    met = _masked(entries.select("print"), F.array(*[F.lit(_signed(m)) for m in masks]))
    if entries.count() <= crowd:
        return met.withColumn("piece", F.lit(0).cast("bigint"))
    key = ["pair", "value"]

    def crowded(groups: DataFrame) -> DataFrame:
        return groups.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > crowd)

    calm = met.join(crowded(met), key, "left_anti").withColumn("piece", F.lit(0).cast("bigint"))
    finer = F.array(*[F.array(*[F.lit(_signed(m)) for m in finer_masks(mask, max_bits)]) for mask in masks])
    cut = _masked(
        met.join(crowded(met), key, "left_semi").select("print", F.col("pair").alias("of")),
        F.element_at(finer, F.col("of") + 1),
        # Pairs of blocks with a further one are numbered after the pairs.
        (F.col("of") + 1) * F.lit(len(masks)),
    )
    pieces = F.coalesce(F.ceil(F.col("rows") / F.lit(crowd)), F.lit(1).cast("bigint"))
    own, other = F.pmod(F.xxhash64("print"), F.col("pieces")), F.col("other")
    pieced = (
        cut.join(crowded(cut), key, "left")
        .select(*key, "print", pieces.alias("pieces"))
        .select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1)).alias("other"))
        .select(*key, "print", (F.least(own, other) * F.col("pieces") + F.greatest(own, other)).alias("piece"))
    )
    return calm.unionByName(pieced)


def _masked(entries: DataFrame, masks: Column, first: Column | None = None) -> DataFrame:
    """Entries once for each mask, numbered from `first`, with the bits that it leaves."""
    first = F.lit(0) if first is None else first
    return entries.select("print", first.alias("first"), F.posexplode(masks).alias("number", "mask")).select(
        (F.col("first") + F.col("number")).cast("int").alias("pair"),
        F.col("print").bitwiseAND(F.col("mask")).alias("value"),
        "print",
    )


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    *,
    id: str = "doc_id",
    text: str = "text",
    uid: str | None = None,
    crowd: int = CROWD,
) -> DataFrame:
    """One row per document: `uid`, `doc_id`, `fingerprint` (hex), `component_id`, `keep_uid`.

    `component_id` is the smallest id among the documents that can be reached over fingerprints differing in at
    most `max_bits` bits (null ids are passed over, and it is null if there are no others). `keep_uid` is the row with
    that id, the first of several. Texts of less than `shingle` words are one shingle; null, empty and blank texts have
    fingerprint zero, which links like any other. An empty table gives no rows. `uid` numbers the rows as read, or is
    the column that the parameter names. Other columns are not looked at, whatever their names.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = scratch(spark, "simhash")
    number = F.col(f"`{uid}`").cast("bigint") if uid else F.monotonically_increasing_id()
    source = docs.select(
        number.alias("uid"), F.col(f"`{id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text")
    )
    source.mapInArrow(_fingerprints(shingle), "uid bigint, doc_id bigint, print bigint").write.parquet(f"{folder}/prints")
    prints = spark.read.parquet(f"{folder}/prints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")).alias("first")
    prints.groupBy("print").agg(first).write.parquet(f"{folder}/entries")
    entries = spark.read.parquet(f"{folder}/entries")

    met = met_in_groups(entries, max_bits, crowd)
    groups = "pair", "value", "piece"
    links = met.repartition(*groups).sortWithinPartitions(*groups).mapInArrow(_links(max_bits), "a bigint, b bigint")
    component = connected_components(links)
    labelled = entries.join(component, entries["print"] == component["node"], "left").select(
        "print", "first", F.coalesce("component", "print").alias("component")
    )
    labelled.write.parquet(f"{folder}/labelled")
    labelled = spark.read.parquet(f"{folder}/labelled")
    labelled.groupBy("component").agg(F.min("first").alias("least")).write.parquet(f"{folder}/least")
    least = spark.read.parquet(f"{folder}/least")
    labelled.join(least, "component").select("print", "least").write.parquet(f"{folder}/classes")
    return prints.join(spark.read.parquet(f"{folder}/classes"), "print").select(
        "uid",
        "doc_id",
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        F.col("least.doc_id").alias("component_id"),
        F.col("least.uid").alias("keep_uid"),
    )


def first_of_groups(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, *, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of `docs` that stand for their group, with all their columns: `near_duplicates` says which.

    A row is known by a hash of its id and text, with the id, so no numbered copy is needed. Of rows that are equal in
    both, one stays. Only the keys of rows that go or are repeated are joined to the texts; texts move and are sorted
    only if these keys are too many to broadcast.
    """
    spark = docs.sparkSession
    key, number, stays = (f"__{name}_{len(docs.columns)}" for name in ("key", "id", "stays"))
    own_id, own_text = F.col(f"`{id}`"), F.col(f"`{text}`")
    keyed = docs.withColumns(
        {
            key: F.xxhash64(own_id.isNull(), own_id, own_text),
            number: F.coalesce(own_id.cast("bigint"), F.lit(0).cast("bigint")),
        }
    )
    looked_at = keyed.select(F.col(key).alias("row"), own_id.alias("id"), own_text.alias("text"))
    marked = scratch(spark, "simhash-marked")
    near_duplicates(looked_at, shingle, max_bits, id="id", uid="row").groupBy(
        F.col("uid").alias(key), F.coalesce("doc_id", F.lit(0).cast("bigint")).alias(number)
    ).agg(F.max(F.col("uid") == F.col("keep_uid")).alias(stays), F.count(F.lit(1)).alias("rows")).where(
        f"not {stays} or rows > 1"
    ).select(key, number, stays).write.parquet(marked)
    marks = spark.read.schema(f"{key} bigint, {number} bigint, {stays} boolean").parquet(marked)
    chosen = keyed.join(marks, [key, number], "left_anti")
    repeated = marks.where(stays)
    if not repeated.isEmpty():
        # The join and the choice among equal rows need the same partitioning: the texts move once.
        chosen = chosen.unionByName(keyed.join(repeated, [key, number], "left_semi").dropDuplicates([key, number]))
    return chosen.select(*[F.col(f"`{c}`") for c in docs.columns])
