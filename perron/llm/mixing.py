"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, repeated up to `repeats` times. A copy's virtual finish
time is the number of words its queue has sent with it, divided by the source's target. The mix is all copies in order
of that time, cut where the total budget is spent. By time 1 each queue has sent its target but for the copy that it
is sending, and the targets add up to the budget, so the cut comes about then and no source is off its target by much
more than one of its documents.

Both orders, that of the queues and that of the mix, are ranges of small rows without texts, written to the shared
folder: what a range holds is then fixed even when executors are lost. Adding up ranges tells what stands before each,
and a window over one range does the rest, so a source with a third of all rows is no single group. The order within a
source comes from the MD5 of the id. Ranges wholly before or behind the cut need no window at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perron.session import scratch

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
REPEATS = 3
_ROW_BITS = 33


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, repeats: int) -> DataFrame:
    """`key`, `total` and `target`, the words to take from each source, for rows (`source`, `key`, `total`).

    Weights are dealt to sources by code point, null last. No target exceeds `repeats` times its source; what is
    above is shared out again by weight until none is above. That is one water level: in the order of limit over
    weight, the level is what the sources so far leave, per weight of the others, at the first source that it
    does not fill. There is one row per source here, so the windows without partitions stay small.
    """
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]),
        F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights))) + 1,
    ).cast("bigint")
    rows = sources.withColumn("weight", weight).withColumn("limit", F.lit(repeats) * F.col("total"))
    filled = Window.orderBy((F.col("limit") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    rows = rows.select(
        "*",
        F.row_number().over(filled).alias("turn"),
        (F.sum("total").over(everything) * F.lit(float(share))).alias("budget"),
        (F.sum("limit").over(filled.rowsBetween(Window.unboundedPreceding, 0)) - F.col("limit")).alias("spent"),
        F.sum("weight").over(filled.rowsBetween(0, Window.unboundedFollowing)).alias("open"),
    ).withColumn("level", (F.col("budget") - F.col("spent")) / F.col("open"))
    holds = F.col("level") * F.col("weight") <= F.col("limit")
    level = F.min(F.when(holds, F.struct("turn", "level"))).over(everything)["level"]
    limit = F.col("limit").cast("double")
    return rows.select("key", "total", F.coalesce(F.least(limit, level * F.col("weight")), limit).alias("target"))


def _ordered(rows: DataFrame, order: list[str], folder: str) -> DataFrame:
    """The rows in ranges of `order`, as written, with `part`, the number of the range, and `position` in it."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.withColumn("position", F.monotonically_increasing_id()).write.parquet(folder)
    return rows.sparkSession.read.parquet(folder).withColumn("part", F.shiftright("position", _ROW_BITS))


def _queues(
    docs: DataFrame, folder: str, looked_at: list[str], weights, share: float, repeats: int, seed: str, id: str, text: str, source: str
) -> DataFrame:
    """`uid`, `doc_id`, `source`, `key`, `size`, and of the source `total`, `target` and the words `before` each row."""
    own_id, own_source, own_text = F.col(f"`{id}`"), F.col(f"`{source}`"), F.col(f"`{text}`")
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"), own_id.alias("doc_id"), own_source.alias("source"),
        F.coalesce(F.concat(F.lit("="), own_source), F.lit("null")).alias("key"), word_count(own_text).alias("size"),
        F.md5(F.concat_ws(":", F.lit(seed), own_id.cast("string"))).alias("hash"), F.xxhash64(*[F.col(f"`{c}`") for c in looked_at]).alias("content"),
    )
    placed = _ordered(rows, ["key", "hash", "doc_id", "size", "content", "uid"], f"{folder}/queues")
    placed.groupBy("source", "key", "part").agg(F.sum("size").alias("words")).write.parquet(f"{folder}/sums")
    sums = rows.sparkSession.read.parquet(f"{folder}/sums")
    told = targets(sums.groupBy("source", "key").agg(F.sum("words").alias("total")), weights, share, repeats)
    first = F.sum("words").over(Window.partitionBy("key").orderBy("part")) - F.col("words")
    places = sums.select("key", "part", first.alias("first")).join(told, "key")
    running = F.sum("size").over(Window.partitionBy("part", "key").orderBy("position").rowsBetween(Window.unboundedPreceding, 0))
    queued = placed.withColumn("running", running).join(places, ["part", "key"]).select(
        "uid", "doc_id", "source", "key", "size", "total", "target",
        (F.col("first") + F.col("running") - F.col("size")).alias("before"),
    )
    queued.write.parquet(f"{folder}/queued")
    return rows.sparkSession.read.parquet(f"{folder}/queued")


def _copies(queued: DataFrame, folder: str, share: float, repeats: int) -> DataFrame:
    """The copies that the budget pays for, the last one in part: `uid`, `finish`, `key`, `start` and `words`."""
    start = F.col("epoch") * F.col("total") + F.col("before")
    rows = queued.where((F.col("size") > 0) & (F.col("target") > 0)).select(
        "uid", "key", "size", "total", "target", "before",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(repeats - 1).cast("bigint"))).alias("epoch"),
    ).select("uid", "key", "size", start.alias("start"), ((start + F.col("size")) / F.col("target")).alias("finish"))
    sent = _ordered(rows, ["finish", "key", "start"], f"{folder}/sent")
    # One row per range, so the window without partitions stays small.
    ranges = sent.groupBy("part").agg(F.sum("size").alias("in_part"))
    budget = queued.agg(F.floor(F.coalesce(F.sum("size"), F.lit(0)) * F.lit(float(share))).alias("budget"))
    first = F.sum("in_part").over(Window.orderBy("part")) - F.col("in_part")
    reached = ranges.withColumn("first", first).join(F.broadcast(budget)).where("first < budget")
    reached.write.parquet(f"{folder}/reached")
    reached = queued.sparkSession.read.parquet(f"{folder}/reached")
    whole = F.col("first") + F.col("in_part") <= F.col("budget")
    kept = ["uid", "finish", "key", "start"]
    before = sent.join(reached.where(whole), "part").select(*kept, F.col("size").alias("words"))
    running = F.sum("size").over(Window.partitionBy("part").orderBy("position").rowsBetween(Window.unboundedPreceding, 0))
    left = F.col("budget") - F.col("first") - F.col("running") + F.col("size")
    at_cut = sent.join(reached.where(~whole), "part").withColumn("running", running).select(
        *kept, F.least(F.col("size"), left).alias("words")
    )
    return before.unionByName(at_cut.where("words > 0"))


def schedule(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.0,
    repeats: int = REPEATS,
    seed: str = "mix",
    *,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """A row for each of `docs`: `doc_id`, `source`, `size`, its source's `source_size` and `target`, and `taken`.

    `taken` are the words of the document that the mix takes, repeats counted; of the one copy at which the budget ends
    those before the end. Null text has no words and is never taken; null sources are one source. Rows with the same id,
    null ids too, follow one another by size and content; equal rows are alike in all. Other columns are not looked at,
    whatever their names. An empty table gives no rows.
    """
    folder = scratch(docs.sparkSession, "mix")
    queued = _queues(docs, folder, [text], weights, share, repeats, seed, id, text, source)
    taken = _copies(queued, folder, share, repeats).groupBy("uid").agg(F.sum("words").alias("taken"))
    return queued.join(taken, "uid", "left").select(
        "doc_id", "source", "size", F.col("total").alias("source_size"), "target",
        F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken"),
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.0,
    repeats: int = REPEATS,
    seed: str = "mix",
    *,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The mix itself: a row per copy in the order of training, with the columns of the documents, whatever their names.

    Takes what `schedule` takes. Texts stay whole, also that of the copy at which the budget ends. `docs` is read twice and
    must give the same rows in the same order, as files do.
    """
    folder = scratch(docs.sparkSession, "mix")
    # The same columns are read both times, so that rows are numbered alike even behind a shuffle.
    looked_at = [f.name for f in docs.schema if "map<" not in f.dataType.simpleString()]
    queued = _queues(docs, folder, looked_at, weights, share, repeats, seed, id, text, source)
    copies = _copies(queued, folder, share, repeats).select("uid", "finish", "key", "start")
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    order = ["finish", "key", "start"]
    mixed = rows.join(copies, "uid").repartitionByRange(*order).sortWithinPartitions(*order)
    return mixed.select("row.*")
