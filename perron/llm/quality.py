"""Quality rules: a calibrated classifier on hashed word and character n-grams behind plain counts.

A logistic regression is fitted on labelled documents, its scores are turned into probabilities on labelled documents
that it has not seen, and every document is scored in Arrow batches against a fixed threshold. Counts come from the same
pass: equal words have equal numbers in a batch's dictionary, and windows of words are named step by step (pairs,
fours, fives), so they are compared exactly.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perron.llm.arrow import WHITE, joined, segment_sums, slices, small_batches, texts
from perron.llm.linear import byte_grams, dense, fit_logistic, sigmoid, sparse_rows
from perron.operators.joins import sized_join

#: Most labelled documents that the classifier is fitted on; a third of them calibrates it.
SAMPLE = 2400
THRESHOLD = 0.5
MIN_WORDS = 10
REPEATED_PERCENT = 20
BITS = 12
SYMBOLS = b"#*$%&|<>"

_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_IS_CHARACTER = ~np.isin(np.arange(256), list(WHITE)) & ((np.arange(256) & 0xC0) != 0x80)


def _words(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Numbers of the words of all texts, where each text's begin, and the words that the numbers mean."""
    lists = pc.ascii_split_whitespace(pa.array(values, pa.binary()).cast(pa.large_binary()).view(pa.large_string()))
    flat, bounds = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    before = np.r_[0, np.cumsum(real)]
    coded = flat.filter(pa.array(real)).dictionary_encode()
    bounds = before[bounds - bounds[0]]
    return coded.indices.to_numpy().astype(np.int64), bounds, coded.dictionary.cast(pa.large_binary()).to_pylist()


def _named(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def _repeated(words: np.ndarray, bounds: np.ndarray, size: int = 5) -> np.ndarray:
    """Per text, the words that lie in windows of five words found twice or more in it."""
    of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    n = len(words)
    if n < size:
        return np.zeros(len(bounds) - 1, np.int64)
    span = int(words.max()) + 1
    own = _named(of * span + words)  # a word of one text differs from that of another
    span = int(own.max()) + 1
    pairs = _named(own[:-1] * span + own[1:])
    fours = _named(pairs[:-2] * (int(pairs.max()) + 1) + pairs[2:])
    keys = fours[:-1] * span + own[4:]
    whole = of[: n - size + 1] == of[size - 1 :]
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    twice = (counts[inverse] > 1) & whole
    covered = np.zeros(n + 1, np.int64)
    covered[: n - size + 1] += twice
    covered[size : n + 1] -= twice
    return segment_sums((np.cumsum(covered[:n]) > 0).astype(np.int64), bounds)


def _duplicate_lines(text: bytes) -> int:
    if b"\n" not in text:
        return 0
    lines = [line for line in text.split(b"\n") if line.strip(WHITE)]
    return len(lines) - len(set(lines))


def _counts(values: list[bytes], words: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    data, ends = joined(values)
    return {
        "n_words": np.diff(bounds),
        "word_chars": segment_sums(_IS_CHARACTER[data].astype(np.int64), ends),
        "n_symbols": segment_sums(_IS_SYMBOL[data].astype(np.int64), ends),
        "n_dup_lines": np.array([_duplicate_lines(v) for v in values], np.int64),
        "n_repeat_words": _repeated(words, bounds),
    }


def _grams(values: list[bytes], words: np.ndarray, bounds: np.ndarray, known: list[bytes]) -> np.ndarray:
    """Square roots of the shares of hashed words, word pairs, and runs of three and four characters."""
    width = 1 << BITS
    out = np.zeros((len(values), 4 * width), np.float32)
    hashes = np.array([zlib.crc32(w) for w in known], np.uint32)[words] if len(words) else np.zeros(0, np.uint32)
    mixed = hashes * np.uint32(0x9E3779B1)
    pairs = (mixed[:-1] * np.uint32(31) + hashes[1:]) * np.uint32(0x85EBCA6B)
    points = [np.frombuffer(v.decode("utf-8", "replace").encode("utf-32-le"), "<u4") for v in values]
    data, ends = np.concatenate([np.zeros(0, np.uint32), *points]), np.cumsum([0, *map(len, points)])
    parts = [
        (mixed >> np.uint32(32 - BITS), bounds, 1),
        (pairs >> np.uint32(32 - BITS), bounds, 2),
        (byte_grams(data, 3, BITS), ends, 3),
        (byte_grams(data, 4, BITS), ends, 4),
    ]
    for part, (grams, edges, n) in enumerate(parts):
        for i, (start, stop) in enumerate(zip(edges, edges[1:])):
            own = grams[start : max(start, stop - n + 1)]
            if len(own):
                out[i, part * width : (part + 1) * width] = np.sqrt(np.bincount(own, minlength=width) / len(own))
    return out


def features(values: list[bytes]) -> np.ndarray:
    return _grams(values, *_words(values))


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    #: Calibration: probability = sigmoid(scale * score + shift).
    scale: float = 1.0
    shift: float = 0.0

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.scale * (x @ self.weights + self.bias).astype(np.float64) + self.shift)


def _calibrated(scores: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the probability, by Newton steps on softened targets."""
    good, bad = int(y.sum()), int(len(y) - y.sum())
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(slope * scores + shift)
        gradient = np.array([((p - target) * scores).sum(), (p - target).sum()])
        v = p * (1 - p)
        second = np.array([[(v * scores * scores).sum(), (v * scores).sum()], [(v * scores).sum(), v.sum()]]) + 1e-6 * np.eye(2)
        slope, shift = np.array([slope, shift]) - np.linalg.solve(second, gradient)
        slope = float(np.clip(slope, 0.05, 20.0))
        shift = float(np.clip(shift, -20.0, 20.0))
    return slope, shift


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, *, id: str = "doc_id", text: str = "text") -> Model:
    """Fits on the `sample` labelled documents whose ids hash lowest; null labels, ids and texts take no part.

    Only labels of documents that have a text here are counted. Of rows that share an id one is used, and of
    several labels of an id the best, so no more than `sample` rows come to the driver. Texts are used whole. With labels of
    one kind only, or none, every document has the probability of that kind (1 if there are none).
    """
    small_batches(docs.sparkSession)
    own_id, own_text = F.col(f"`{id}`"), F.col(f"`{text}`")
    rows = docs.where(own_id.isNotNull() & own_text.isNotNull()).select(
        own_id.alias("id"), own_text.alias("text"), F.xxhash64(own_id, own_text).alias("turn")
    )
    marked = (
        labels.select(F.col(f"`{id}`").alias("label_id"), F.col("quality").cast("bigint").alias("quality"))
        .where("label_id is not null and quality is not null")
        .groupBy("label_id")
        .agg(F.max("quality").alias("quality"))
    )
    chosen = (
        sized_join(rows.select("id", "turn"), marked, "id", "label_id", "inner", unique_right=True)
        .groupBy("id")
        .agg(F.min("turn").alias("turn"), F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample)
    )
    once = rows.join(F.broadcast(chosen), ["id", "turn"]).groupBy("id").agg(
        F.first("quality").alias("quality"), F.first("text").alias("text")
    )
    rows = sparse_rows(once.withColumn("turn", F.xxhash64("id")), features, ["turn", "quality"]).collect()
    rows.sort(key=lambda r: (r["turn"], r["values"]))
    y = np.array([r["quality"] for r in rows], np.float64)
    if len(set(y)) < 2:
        certain = 20.0 if not len(y) or y[0] else -20.0
        return Model(np.zeros(4 << BITS, np.float32), certain)
    x, third = dense(rows, 4 << BITS), np.arange(len(rows)) % 3 == 0
    weights, bias = fit_logistic(x[~third], y[~third, None], np.ones(int((~third).sum())))
    model = Model(weights[:, 0], float(bias[0]))
    if len(set(y[third])) == 2:
        model.scale, model.shift = _calibrated((x[third] @ model.weights + model.bias).astype(np.float64), y[third])
    return model


_NUMBERS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SCORED = pa.schema(
    [("doc_id", pa.int64()), *[(c, pa.int64()) for c in _NUMBERS], ("base_failed", pa.bool_()), ("probability", pa.float64()), ("kept", pa.bool_())]
)
_SCORED_DDL = f"doc_id bigint, {', '.join(c + ' bigint' for c in _NUMBERS)}, base_failed boolean, probability double, kept boolean"


def judge(docs: DataFrame, model: Model, threshold: float = THRESHOLD, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with its counts, `base_failed`, the `probability` of good quality, and `kept`.

    Too few words or too many repeated ones fail a document whatever the classifier says; so null and empty texts always
    fail. Texts are judged whole; a task holds some 1 MB of them, or one longer text. Repeated rows are judged each for itself, null ids stay null, an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=1 << 20):
            values = texts(batch)
            words, bounds, known = _words(values)
            found = _counts(values, words, bounds)
            failed = (found["n_words"] < MIN_WORDS) | (100 * found["n_repeat_words"] > REPEATED_PERCENT * found["n_words"])
            probability = model.probability(_grams(values, words, bounds, known))
            kept = ~failed & (probability >= threshold)
            yield pa.record_batch(
                [batch.column("doc_id"), *[pa.array(found[c], pa.int64()) for c in _NUMBERS], pa.array(failed), pa.array(probability), pa.array(kept)],
                _SCORED,
            )

    return docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, _SCORED_DDL)
