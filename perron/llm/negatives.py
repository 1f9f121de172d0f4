"""Hard-negative mining by the threshold algorithm of Fagin over blocks of candidates.

Candidates are dealt into blocks, anchors into lots, by a hash of their row; a task has one block and one lot, so no
label, no vector that many rows share and no anchor makes a task larger than others. For its block a task has a list
per dimension, sorted by that component. An anchor goes down the lists of its non-zero components, from the top where
its own component is positive and from the bottom where it is negative. Each candidate that comes up for the first time
is scored whole. What has not come up yet cannot score more than the anchor's product with the components at the
places reached, the threshold; the search ends as soon as that is strictly below the k-th score of every window (a range of
scores), or below the window. Scores are exact integers.

The first pass finds each anchor's positives, whose scores are the windows of the second. A candidate meets an anchor in
one task of each pass; what the tasks find is merged by rank.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perron.session import scratch

#: Rows of a block and of a lot: some megabytes of vectors, and enough tasks at either size.
BLOCK, LOT = 4096, 16_384
_FIRST_STEP = 8

_PACKED_DDL = "uid bigint, id bigint, label string, anchor boolean, vector binary"
_PACKED = pa.schema(
    [("uid", pa.int64()), ("id", pa.int64()), ("label", pa.string()), ("anchor", pa.bool_()), ("vector", pa.binary())]
)


def integers(vector: str | Column, scale: int) -> Column:
    """Each component times `scale`, as double, rounded down; null for a vector that is null or has a component that is
    null, infinite or not a number."""
    column = F.col(vector) if isinstance(vector, str) else vector
    odd = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~odd, F.transform(column, lambda x: F.floor(x.cast("double") * scale)))


def pack(vector: np.ndarray) -> bytes:
    """The bytes of a component, 2, 4 or 8, and the components."""
    high = int(np.abs(vector.astype(np.float64)).max()) if len(vector) else 0
    width = 2 if high < 1 << 15 else 4 if high < 1 << 31 else 8
    return bytes([width]) + vector.astype(f"<i{width}").tobytes()


def unpack(packed: list[bytes], width: int | None = None) -> np.ndarray:
    """A row per vector; shorter ones end in zeros."""
    rows = [np.frombuffer(p, f"<i{p[0]}", offset=1) for p in packed]
    out = np.zeros((len(rows), max([width or 0, *map(len, rows)])), np.int64)
    for into, row in zip(out, rows):
        into[: len(row)] = row
    return out


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = [pack(np.array(v, np.int64)) for v in batch.column("vector").to_pylist()]
        columns = [*(batch.column(c) for c in ("uid", "id", "label", "anchor")), pa.array(vectors, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, schema=_PACKED)


class Block:
    """Candidates and, per dimension, their places sorted by that component."""

    def __init__(self, uids: np.ndarray, ids: np.ndarray, labels: list[str], vectors: np.ndarray) -> None:
        self.uids, self.ids, self.vectors = uids, ids, vectors
        names = {label: i for i, label in enumerate(dict.fromkeys(labels))}
        self.names, self.labels = names, np.array([names[label] for label in labels])
        self.orders = np.argsort(vectors, axis=0, kind="stable").T.astype(np.int32)
        self.high = int(np.abs(vectors.astype(np.float64)).max()) if vectors.size else 0
        self.exact = vectors.astype(np.float64)

    def _scoring(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vectors and anchor in the fastest form in which products cannot lose a digit."""
        most = self.high * int(np.abs(anchor.astype(np.float64)).max(initial=0)) * max(1, len(anchor))
        if most < 1 << 53:
            return self.exact, anchor.astype(np.float64)
        if most < 1 << 62:
            return self.vectors, anchor
        return self.vectors.astype(object), anchor.astype(object)

    def search(
        self, anchor: np.ndarray, eligible: np.ndarray, windows: list[tuple[float, float]], k: int
    ) -> tuple[list[list[tuple[int, int]]], int]:
        """For each window (least and greatest score) the scores and places of its first `k` eligible candidates, higher
        scores first, then smaller ids, then earlier rows; and how many candidates were scored."""
        n = len(self.ids)
        vectors, own = self._scoring(anchor)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        low, high = min(w[0] for w in windows), max(w[1] for w in windows)
        seen = np.zeros(n, bool)
        places, scores = [], []
        depth, step = 0, _FIRST_STEP if len(up) + len(down) else n
        while depth < n:
            reached = min(n, depth + step)
            met = np.zeros(n, bool)
            met[self.orders[up, n - reached : n - depth]] = True
            met[self.orders[down, depth:reached]] = True
            if reached == n:
                met[:] = True
            new = np.flatnonzero(met & ~seen)
            seen |= met
            score = vectors[new] @ own
            fits = eligible[new] & (score >= low) & (score <= high)
            places.append(new[fits])
            scores.append(score[fits])
            depth, step = reached, step * 2
            if depth < n:
                # No candidate that has not come up has a better component in any list than the next one there.
                best = vectors[self.orders[up, n - 1 - depth], up] @ own[up]
                threshold = best + vectors[self.orders[down, depth], down] @ own[down]
                scores = [np.concatenate(scores)]
                if all(_settled(scores[0], window, threshold, k) for window in windows):
                    break
        at, score = np.concatenate(places or [np.zeros(0, int)]), np.concatenate(scores or [np.zeros(0)])
        return [self._first(at, score, window, k) for window in windows], int(seen.sum())

    def _first(self, at: np.ndarray, score: np.ndarray, window: tuple, k: int) -> list[tuple[int, int]]:
        inside = (score >= window[0]) & (score <= window[1])
        at, score = at[inside], score[inside]
        if len(at) > k:
            kth = np.partition(score, len(score) - k)[len(score) - k]
            at, score = at[score >= kth], score[score >= kth]
        order = np.lexsort((self.uids[at], self.ids[at], -score))[:k]
        return [(int(score[i]), int(at[i])) for i in order]


def _settled(scores: np.ndarray, window: tuple, threshold: float, k: int) -> bool:
    """Whether nothing that scores at most `threshold` can be among a window's first `k`."""
    if threshold < window[0]:
        return True
    inside = scores[(scores >= window[0]) & (scores <= window[1])]
    return len(inside) >= k and threshold < np.partition(inside, len(inside) - k)[len(inside) - k]


_FOUND_DDL = "anchor bigint, floor bigint, score bigint, id bigint, uid bigint"
_FOUND = pa.schema([(name, pa.int64()) for name in ("anchor", "floor", "score", "id", "uid")])


def _searched(k: int, same: bool, low: int, high: int):
    """Walks cells: first the candidates of a block, then the anchors of a lot one after another."""

    def windows_of(bounds: list[int] | None) -> dict[int, tuple]:
        """A window for each positive's score, less those that no score can lie in."""
        if same:
            return {0: (-math.inf, math.inf)}
        found = {s: (-(-low * s // 100), high * s // 100) for s in bounds or []}
        return {s: w for s, w in found.items() if w[0] <= w[1]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, waiting, block = None, [], None
        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in ("cell", "role", "uid", "id", "label", "vector", "bounds")])
            out = []
            for place, role, uid, id, label, vector, bounds in rows:
                if place != cell:
                    cell, waiting, block = place, [], None
                if role == 0:
                    waiting.append((uid, id, label, vector))
                    continue
                if not waiting and block is None:
                    continue
                if block is None:
                    uids, ids, labels, vectors = zip(*waiting)
                    block, waiting = Block(np.array(uids), np.array(ids), list(labels), unpack(list(vectors))), []
                anchor = unpack([vector], block.vectors.shape[1])[0]
                # Components beyond those of all candidates meet nothing but zeros.
                anchor = anchor[: block.vectors.shape[1]]
                alike = block.labels == block.names.get(label, -1)
                eligible = alike & (block.uids != uid) if same else ~alike
                windows = windows_of(bounds)
                if not windows or not eligible.any():
                    continue
                found, _ = block.search(anchor, eligible, list(windows.values()), k)
                for floor, hits in zip(windows, found):
                    out += [(uid, floor, score, int(block.ids[at]), int(block.uids[at])) for score, at in hits]
            if out:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), _FOUND)], _FOUND)

    return run


def _dealt(candidates: DataFrame, anchors: DataFrame, blocks: int, lots: int) -> DataFrame:
    """The rows of every cell, a block of candidates and a lot of anchors, as one partition, candidates first."""
    block = F.pmod(F.xxhash64("uid"), F.lit(blocks))
    lot = F.pmod(F.xxhash64(F.lit("anchor"), "uid"), F.lit(lots))
    kept = ["uid", "id", "label", "vector"]
    ours = candidates.select(
        *kept, F.lit(None).cast("array<bigint>").alias("bounds"), F.lit(0).alias("role"), block.alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(lots - 1))).alias("lot"),
    )
    theirs = anchors.select(
        *kept, "bounds", F.lit(1).alias("role"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        lot.cast("int").alias("lot"),
    )
    cells = ours.unionByName(theirs).withColumn("cell", (F.col("block") * lots + F.col("lot")).cast("int"))
    return cells.drop("block", "lot").repartitionById(blocks * lots, "cell").sortWithinPartitions("cell", "role")


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    *,
    id: str = "vec_id",
    vector: str = "vector",
    label: str = "label",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    block: int = BLOCK,
    lot: int = LOT,
) -> DataFrame:
    """`anchor_id`, `positive_id`, `rank`, `negative_id`, `positive_score`, `negative_score` for the rows of `anchor`.

    `vector` is an array of integers, see `integers`; a row's score is its inner product with the anchor. An anchor's
    positives are its first `positives` other rows of the same label, and the negatives of a positive the first
    `negatives` rows of another label with `low` to `high` per cent of its score: higher scores first, then smaller
    ids, then earlier rows. A positive without such a row gives none, one with a score below zero neither unless `low`
    is at least `high`.

    Rows with a null id, label or vector, or a null component, take no part. A vector shorter than others counts as
    ending in zeros. Repeated rows are rows of their own, also as anchors, and may be each other's positives. Other
    columns are not looked at. An empty table, or none but one label, gives no rows. Scores must fit a BIGINT.
    """
    spark = rows.sparkSession
    folder = scratch(spark, "negatives")
    whole = F.col(f"`{vector}`").isNotNull() & ~F.exists(F.col(f"`{vector}`"), lambda x: x.isNull())
    taken = rows.select(
        F.monotonically_increasing_id().alias("uid"), F.col(f"`{id}`").cast("bigint").alias("id"),
        F.col(f"`{label}`").cast("string").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col(f"`{vector}`").cast("array<bigint>").alias("vector"), whole.alias("whole"),
    ).where("whole and id is not null and label is not null").drop("whole")
    taken.mapInArrow(_packed, _PACKED_DDL).write.parquet(f"{folder}/rows")
    packed = spark.read.schema(_PACKED_DDL).parquet(f"{folder}/rows")
    sizes = packed.agg(F.count("*").alias("rows"), F.count_if("anchor").alias("anchors")).first()
    blocks, lots = max(1, -(-sizes["rows"] // block)), max(1, -(-sizes["anchors"] // lot))

    def first(found: DataFrame, k: int) -> DataFrame:
        order = Window.partitionBy("anchor", "floor").orderBy(F.desc("score"), "id", "uid")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    anchors = packed.where("anchor")
    unbounded = anchors.withColumn("bounds", F.lit(None).cast("array<bigint>"))
    pass_one = _dealt(packed, unbounded, blocks, lots).mapInArrow(_searched(positives, True, low, high), _FOUND_DDL)
    first(pass_one, positives).select("anchor", "score", "id", "uid").write.parquet(f"{folder}/positives")
    near = spark.read.schema("anchor bigint, score bigint, id bigint, uid bigint").parquet(f"{folder}/positives")

    bounds = near.groupBy(F.col("anchor").alias("uid")).agg(F.collect_set("score").alias("bounds"))
    bounded = anchors.join(bounds, "uid")
    pass_two = _dealt(packed, bounded, blocks, lots).mapInArrow(_searched(negatives, False, low, high), _FOUND_DDL)
    hard = first(pass_two, negatives).select(
        "anchor", F.col("floor").alias("score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    named = near.join(anchors.select(F.col("uid").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return named.join(hard, ["anchor", "score"]).select(
        "anchor_id", F.col("id").alias("positive_id"), "rank", "negative_id",
        F.col("score").alias("positive_score"), "negative_score",
    )
