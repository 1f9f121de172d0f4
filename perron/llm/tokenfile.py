"""Token ids in files of directly addressable codes.

An id is split into chunks of eight bits, the lowest first. Level 0 has the first chunk of every id, level 1 the second
chunk of those that need one, and so on. A bitmap per level tells which ids go on, and a directory has the number of
set bits before every 512th: the place of an id's next chunk is the number of set bits before its own, so any id can be
read without decoding what stands before it.

A file set is a folder of Parquet files; a row is a block of whole documents in ascending order of their ids:
`shard`, `block` and `first` (ids of the shard before the block) place it, `chunks`, `bitmaps` and `ranks` have one
entry per level, `doc_ids` and `bounds` are the documents and where each begins, with the end as last. Shards
follow one another in the order of document ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perron.llm.arrow import slices, small_batches
from perron.llm.tokens import encoder, vocabulary_path

BLOCK_IDS = 1 << 19
_RANK_BITS = 512
_RANK_WORDS = _RANK_BITS // 64

_BLOCKS_DDL = (
    "shard int, block int, first bigint, n bigint, chunks array<binary>, bitmaps array<binary>, ranks array<binary>, "
    "doc_ids array<bigint>, bounds array<bigint>"
)
_BLOCKS = pa.schema(
    [
        ("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n", pa.int64()),
        ("chunks", pa.list_(pa.binary())), ("bitmaps", pa.list_(pa.binary())), ("ranks", pa.list_(pa.binary())),
        ("doc_ids", pa.list_(pa.int64())), ("bounds", pa.list_(pa.int64())),
    ]
)


def encode_block(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """Chunks, bitmaps and rank directories of all levels."""
    chunks, bitmaps, ranks = [], [], []
    rest = ids.astype(np.uint32)
    while len(rest):
        more = rest > 0xFF
        words = np.zeros(-(-len(rest) // 64) * 8, np.uint8)
        bits = np.packbits(more, bitorder="little")
        words[: len(bits)] = bits
        counts = np.bitwise_count(words.view("<u8")).astype(np.uint32)
        before = np.cumsum(counts, dtype=np.uint32) - counts
        chunks.append((rest & 0xFF).astype(np.uint8).tobytes())
        bitmaps.append(words.tobytes())
        ranks.append(before[::_RANK_WORDS].astype("<u4").tobytes())
        rest = rest[more] >> 8
    return chunks, bitmaps, ranks


def _set_before(words: np.ndarray, ranks: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Set bits before each place: the directory's entry, less than eight words since then, and part of the last."""
    word, bit = places >> 6, (places & 63).astype(np.uint64)
    group = word // _RANK_WORDS
    since = group[:, None] * _RANK_WORDS + np.arange(_RANK_WORDS)
    counts = np.bitwise_count(words[np.minimum(since, len(words) - 1)]).astype(np.int64)
    counts[since >= word[:, None]] = 0
    last = np.bitwise_count(words[np.minimum(word, len(words) - 1)] & ((np.uint64(1) << bit) - np.uint64(1)))
    return ranks[np.minimum(group, len(ranks) - 1)] + counts.sum(axis=1) + last


def access(chunks: list[bytes], bitmaps: list[bytes], ranks: list[bytes], places: np.ndarray) -> np.ndarray:
    """The ids at any places of a block, in any order; of each level no more than eight words are looked at per id."""
    out = np.zeros(len(places), np.uint32)
    who, at = np.arange(len(places)), places.astype(np.int64)
    for level, (chunk, bitmap, rank) in enumerate(zip(chunks, bitmaps, ranks)):
        out[who] |= np.frombuffer(chunk, np.uint8)[at].astype(np.uint32) << np.uint32(8 * level)
        words = np.frombuffer(bitmap, "<u8")
        goes_on = (words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
        who, at = who[goes_on], at[goes_on]
        if not len(who):
            break
        at = _set_before(words, np.frombuffer(rank, "<u4").astype(np.int64), at)
    return out


def access_range(chunks: list[bytes], bitmaps: list[bytes], ranks: list[bytes], start: int, stop: int) -> np.ndarray:
    """The ids from one place of a block to before another; the directory tells where they begin at each level."""
    out, who = np.zeros(stop - start, np.uint32), np.arange(stop - start)
    for level, (chunk, bitmap, rank) in enumerate(zip(chunks, bitmaps, ranks)):
        if not len(who):
            break
        out[who] |= np.frombuffer(chunk, np.uint8, stop - start, start).astype(np.uint32) << np.uint32(8 * level)
        first = start >> 3
        bits = np.frombuffer(bitmap, np.uint8, -(-stop // 8) - first, first)
        who = who[np.unpackbits(bits, bitorder="little")[start & 7 :][: stop - start].astype(bool)]
        words, directory = np.frombuffer(bitmap, "<u8"), np.frombuffer(rank, "<u4").astype(np.int64)
        start = int(_set_before(words, directory, np.array([start]))[0])
        stop = start + len(who)
    return out


def _encode(path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = encoder(path, end), TaskContext.get().partitionId()
        block, first, held, docs, size = 0, 0, [], [], 0

        def flushed() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), encode.kind)
            bounds = np.cumsum([0] + [len(h) // encode.kind.itemsize for h in held])
            row = (shard, block, first, len(ids), *encode_block(ids), docs, bounds)
            return pa.record_batch([pa.array([v], f.type) for v, f in zip(row, _BLOCKS)], _BLOCKS)

        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                held.append(encode.encode(text))
                docs.append(doc_id)
                size += len(held[-1]) // encode.kind.itemsize
                if size >= BLOCK_IDS:
                    yield flushed()
                    block, first, held, docs, size = block + 1, first + size, [], [], 0
        if held:
            yield flushed()

    return run


def write_tokens(
    docs: DataFrame, folder: str, path: str | None = None, end: int = 0, *, id: str = "doc_id", text: str = "text"
) -> None:
    """Encodes whole texts, each followed by the end id, and writes them in ascending order of their ids.

    Null and empty texts are the end id alone. Null ids come last; rows with the same id follow one another as they
    were read. An empty table gives an empty file set. Other columns are not looked at.
    """
    small_batches(docs.sparkSession)
    source = docs.select(
        F.col(id).cast("bigint").alias("doc_id"), F.monotonically_increasing_id().alias("uid"), F.col(text).alias("text")
    )
    order = [F.col("doc_id").asc_nulls_last(), F.col("uid")]
    ranged = source.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    ranged.mapInArrow(_encode(path or vocabulary_path("byte_bpe_50k.json"), end), _BLOCKS_DDL).write.parquet(folder)


def read_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The blocks with `start`, the number of ids before each in the whole file set.

    Sums come to the driver, one for each shard: as many as there were partitions to write. Blocks stay where they are read.
    """
    blocks = spark.read.schema(_BLOCKS_DDL).parquet(folder)
    begins, begin = [], 0
    for row in blocks.groupBy("shard").agg(F.sum("n").alias("ids")).orderBy("shard").collect():
        begins.append((row["shard"], begin))
        begin += row["ids"]
    table = spark.createDataFrame(begins, "shard int, begin bigint")
    return blocks.join(F.broadcast(table), "shard").withColumn("start", F.col("begin") + F.col("first"))


_DIGEST_DDL = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
_DIGEST = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            bounds = row["bounds"]
            ids = access_range(row["chunks"], row["bitmaps"], row["ranks"], 0, row["n"]).astype("<u4")
            crcs = [zlib.crc32(ids[a:b]) for a, b in zip(bounds, bounds[1:])]
            starts = [row["start"] + a for a in bounds[:-1]]
            counts = [b - a for a, b in zip(bounds, bounds[1:])]
            columns = [pa.array(c, pa.int64()) for c in (row["doc_ids"], starts, counts, crcs)]
            yield pa.record_batch(columns, _DIGEST)


def digest(spark: SparkSession, folder: str) -> DataFrame:
    """Of each document in the files: its place, length, and the CRC-32 of its ids as little-endian 32-bit integers."""
    return read_blocks(spark, folder).select(
        "start", "n", "chunks", "bitmaps", "ranks", "doc_ids", "bounds"
    ).mapInArrow(_digest, _DIGEST_DDL)


def tokens_at(spark: SparkSession, folder: str, place: int) -> int | None:
    """One id of the file set; None if there is none at that place. Only the block that has it is read whole."""
    blocks = read_blocks(spark, folder)
    found = blocks.where((F.col("start") <= place) & (place < F.col("start") + F.col("n")))
    hit = found.select("shard", "block", "start").first()
    if hit is None:
        return None
    one = spark.read.schema(_BLOCKS_DDL).parquet(folder).where(
        (F.col("shard") == hit["shard"]) & (F.col("block") == hit["block"])
    ).select("chunks", "bitmaps", "ranks").first()
    return int(access(one["chunks"], one["bitmaps"], one["ranks"], np.array([place - hit["start"]]))[0])
