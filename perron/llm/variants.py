"""Spelling variants: words one edit away from a much more frequent word, grouped under it.

Near words are found by asymmetric q-chunks. One word gives two chunks of half its length that do not overlap, the other
all its grams of that length with their places. An inserted, deleted or replaced character spoils one chunk at most,
so the other one stands in the near word, and there within one place of its own; of all grams only those that a chunk
can stand at are sent. Words that share such a chunk are joined and verified by their edit distance.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perron.llm.arrow import slices, small_batches, texts
from perron.operators.joins import sized_join
from perron.session import scratch

#: Words that a task counts before it hands its counts on.
HELD = 300_000

_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])


def slipped(doc_id: int | None, word: str, every: int) -> str:
    """The word, or without one of its characters if a hash of it and its document is divisible by `every`."""
    h = crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def _counted(pattern: str, least: int, every: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, held = re.compile(pattern), Counter()

        def flushed() -> pa.RecordBatch:
            batch = pa.record_batch([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], _COUNTS)
            held.clear()
            return batch

        for batch in slices(batches):
            # Of bytes, lower() changes A to Z alone.
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                for word, n in Counter(runs.findall(text.lower().decode())).items():
                    word = slipped(doc_id, word, every) if every else word
                    if len(word) >= least:
                        held[word] += n
                if len(held) > HELD:
                    yield flushed()
        if held:
            yield flushed()

    return run


def count_words(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", least: int = 6, every: int | None = 199
) -> DataFrame:
    """`word` and `n`, how often it stands in all texts, for words of at least `least` characters.

    Words are runs of A to Z, a to z and U+00C0 to U+00FF, as long as they go, in whole texts; only A to Z are
    lower-cased. With `every`, words slip in some documents, see `slipped`; a null id is then written as nothing. A null
    text has no words, and so has an empty table. Repeated rows count each. Other columns are not looked at.
    """
    small_batches(docs.sparkSession)
    pattern = "[A-Za-zÀ-ÿ]{%d,}" % max(1, least)
    rows = docs.select(F.col(f"`{id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    parts = rows.where(F.col("text").isNotNull()).mapInArrow(_counted(pattern, least, every), "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def _key(length: Column, part: int, piece: Column) -> Column:
    return F.concat_ws(":", length.cast("string"), F.lit(part), piece)


def _piece(word: Column, start: Column, size: Column) -> Column:
    return F.substring(word, (start + 1).cast("int"), size.cast("int"))


def _chunks(words: DataFrame) -> DataFrame:
    """Two rows per word: the halves that do not overlap, under its own length."""
    word, length = F.col("word"), F.length("word")
    size = F.floor(length / 2)
    keys = [_key(length, part, _piece(word, size * part, size)) for part in (0, 1)]
    return words.select("word", "n", F.explode(F.array(*keys)).alias("chunk"))


def _grams(words: DataFrame) -> DataFrame:
    """The grams of a word at which a chunk of a word that is one shorter, as long or one longer can stand."""
    word, length = F.col("word"), F.length("word")
    keys = []
    for more in (-1, 0, 1):
        size = F.floor((length + more) / 2)
        for part in (0, 1):
            # An edit before the chunk shifts it by as much as the lengths differ, one behind it not at all.
            for shift in {0, -more}:
                start = size * part + shift
                fits = (start >= 0) & (start + size <= length)
                keys.append(F.when(fits, _key(length + more, part, _piece(word, start, size))))
    distinct = F.array_distinct(F.array_compact(F.array(*keys)))
    return words.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.explode(distinct).alias("gram"))


def near_words(words: DataFrame) -> DataFrame:
    """`word`, `n`, `near`, `near_n` for every word and each word of `words` (`word`, `n`; words distinct) one inserted,
    deleted or replaced code point away: both directions of each pair, once. A null word has no near word."""
    words = words.where(F.col("word").isNotNull())
    joined = sized_join(_chunks(words), _grams(words), "chunk", "gram", "inner")
    found = joined.where(F.levenshtein("word", "near", 1) == 1)
    return found.groupBy("word", "near").agg(F.first("n").alias("n"), F.first("near_n").alias("near_n"))


def group_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """`word`, `form`, `root`, `n`, `n_near`, `form_n` for each of `words` (`word`, `n`; words distinct and not null).

    A word's form is its near word of largest `n` (of several the first in code-point order), if that is at least
    `ratio` (above 1) times its own; else null. The root is where following forms ends, the word itself if it has none.
    Counts grow along the way, so there are no circles and few steps. An empty table gives no rows.
    """
    spark = words.sparkSession
    folder = scratch(spark, "variants")

    def written(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{folder}/{name}")

    words = written(words.select("word", F.col("n").cast("bigint").alias("n")), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near")))
    near = written(
        near_words(words).groupBy(F.col("word").alias("near_of")).agg(
            F.first("n").alias("own"), F.count("*").alias("n_near"), best.alias("best")
        ).select(
            "near_of", "n_near",
            F.when(-F.col("best.minus") >= ratio * F.col("own"), F.col("best.near")).alias("form"),
            F.when(-F.col("best.minus") >= ratio * F.col("own"), -F.col("best.minus")).alias("form_n"),
        ),
        "near",
    )
    # Each round doubles the steps that a root is ahead.
    roots = near.where("form is not null").select(F.col("near_of").alias("start"), F.col("form").alias("root"))
    rounds, going = 0, True
    while going:
        ahead = roots.select(F.col("start").alias("via"), F.col("root").alias("further"))
        joined = sized_join(roots, ahead, "root", "via", "left", unique_right=True)
        stepped = written(
            joined.select("start", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            f"roots-{rounds}",
        )
        going = not stepped.where("moved").isEmpty()
        roots, rounds = stepped.select("start", "root"), rounds + 1
    counted = sized_join(words, near, "word", "near_of", "left", unique_left=True, unique_right=True)
    ended = sized_join(counted, roots, "word", "start", "left", unique_left=True, unique_right=True)
    return ended.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n",
    )


def spelling_variants(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", least: int = 6, often: int = 5, ratio: int = 5, every: int | None = 199
) -> DataFrame:
    """`group_variants` of the words of `docs` that `count_words` finds at least `often` times."""
    return group_variants(count_words(docs, id=id, text=text, least=least, every=every).where(F.col("n") >= often), ratio)
