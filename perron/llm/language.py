"""Language identification by error-correcting output codes.

Every language has a codeword. For each of its bits a logistic regression on hashed byte n-grams tells the languages
with that bit from those without. A text's language is the one whose codeword loses least on the bits' margins, each
bit weighed by how often its classifier is right about that language; a text for which the second codeword comes close
is flagged as ambiguous.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perron.llm.arrow import joined, slices, small_batches, texts
from perron.llm.linear import Sparse, blocks, byte_grams, fit_logistic, sparse_rows
from perron.llm.sampling import least_turns

#: Most training texts of a language, and of all; with more languages than fit, each has fewer texts, but one at least.
SAMPLE = 400
ROWS = 16_384
BITS = 12
UNKNOWN = "und"
#: A text is ambiguous below this score: the winner's share against the others.
AMBIGUOUS = 0.5

_MAYBE = re.compile(r"[^\W\d_]")
# Digits and marks say nothing about the language; they and white space all become a blank.
_PLAIN = bytes(
    b if b >= 128 or chr(b) in string.ascii_lowercase else ord(chr(b).lower()) if chr(b) in string.ascii_uppercase else 32
    for b in range(256)
)


def lettered(text: bytes) -> bool:
    """Whether a text has a letter: a character of one of Unicode's categories L. Fractions and numerals are none."""
    return any(found.group().isalpha() for found in _MAYBE.finditer(text.decode("utf-8", "replace")))


def features(values: list[bytes]) -> np.ndarray:
    """Square roots of the shares of hashed byte pairs, triples and quadruples."""
    out = np.zeros((len(values), 3 << BITS), np.float32)
    data, bounds = joined([b" " + v.translate(_PLAIN) + b" " for v in values])
    for part, n in enumerate((2, 3, 4)):
        grams = byte_grams(data, n, BITS)
        for i, (start, stop) in enumerate(zip(bounds, bounds[1:])):
            own = grams[start : max(start, stop - n + 1)]
            if len(own):
                counts = np.bincount(own, minlength=1 << BITS)
                out[i, part << BITS : (part + 1) << BITS] = np.sqrt(counts / len(own))
    return out


def codewords(k: int) -> np.ndarray:
    """A row of +1 and -1 per language; no column is constant, equal or opposite to another.

    Up to five languages have all columns there are; more have random ones, the best of several drawings.
    """
    if k < 2:
        return np.ones((k, 0), np.int8)
    if k <= 5:
        columns = range(1, 1 << (k - 1))
        return np.array([[-1 if c >> i & 1 else 1 for c in columns] for i in range(k)], np.int8)
    length, random = max(15, int(np.ceil(10 * np.log2(k)))), np.random.default_rng(0)
    best, distance = None, -1
    for _ in range(50):
        drawn = set()
        while len(drawn) < length:
            column = random.choice([-1, 1], k)
            column *= column[0]
            if (column < 0).any():
                drawn.add(tuple(int(v) for v in column))
        code = np.array(sorted(drawn), np.int8).T
        apart = _apart(code)
        if apart > distance:
            best, distance = code, apart
    return best


def _apart(code: np.ndarray) -> int:
    """In how many bits the two closest codewords differ."""
    sign, most = code.astype(np.float32), -code.shape[1]
    for start in range(0, len(code), 1024):
        alike = sign[start : start + 1024] @ sign.T
        alike[np.arange(len(alike)), np.arange(start, start + len(alike))] = -code.shape[1]
        most = max(most, int(alike.max()))
    return (code.shape[1] - most) // 2


def dealt(counts: list[int], sample: int, rows: int) -> int:
    """The most texts that each language may have, up to `sample`, for `rows` in all; one at least."""
    low, high = 1, max(1, sample)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if sum(min(n, middle) for n in counts) <= rows else (low, middle - 1)
    return low


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    trust: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def predict(self, values: list[bytes]) -> tuple[list[str], np.ndarray]:
        """Languages and scores in 0..1; a text without letters is unknown with score 0.

        Of several codewords that lose the same, that of the first language by code point is taken.
        """
        known = np.array([lettered(v) for v in values], bool)
        if not self.languages:
            return [UNKNOWN] * len(values), np.zeros(len(values))
        margins = features(values) @ self.weights + self.bias
        best, score = np.zeros(len(values), np.int64), np.zeros(len(values))
        plus, minus = (self.trust * (self.code > 0)).T, (self.trust * (self.code < 0)).T
        step = max(1, (1 << 22) // len(self.languages))
        for start in range(0, len(values), step):
            own = slice(start, start + step)
            # Log-loss of every codeword, the bits weighed by the trust that each language has in them.
            loss = np.logaddexp(0, -margins[own]) @ plus + np.logaddexp(0, margins[own]) @ minus
            share = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
            score[own] = 1.0 / share.sum(axis=1)
            best[own] = loss.argmin(axis=1)
        score = np.where(known, score, 0.0)
        return [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, known)], score


def held_out(id: Column) -> Column:
    """Documents kept from training: CRC-32 of the id as text leaves 1 when divided by 3. A null id is not held out."""
    return F.coalesce(F.crc32(id.cast("string")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame, sample: int = SAMPLE, most: int = ROWS, *, id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> Model:
    """Fits the classifiers on at most `sample` texts of each language, and on `most` in all, but one of each at least.

    All languages are learned that have a text here. Which texts, a hash of id and text says: rows with the same id and
    text are one, rows that share an id but not the text are as many. No more than these come to the driver. Held-out
    documents, null languages, ids and texts take no part. Texts are used whole.
    """
    spark = docs.sparkSession
    small_batches(spark)
    own_id, own_text, own_lang = (F.col(f"`{c}`") for c in (id, text, lang))
    rows = docs.where(~held_out(own_id) & own_id.isNotNull() & own_lang.isNotNull() & own_text.isNotNull()).select(
        own_text.alias("text"), own_lang.cast("string").alias("lang"), F.xxhash64(own_id, own_text).alias("turn")
    )
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if len(languages) < 2:
        code = codewords(len(languages))
        return Model(languages, code, np.ones(code.shape), np.zeros((3 << BITS, 0), np.float32), np.zeros(0, np.float32))
    sample = dealt(list(counts.values()), sample, most)
    chosen = least_turns(rows, "lang", "turn", sample)
    # `chosen` has `most` rows at most, or one for each language.
    once = rows.join(F.broadcast(chosen), ["lang", "turn"]).groupBy("lang", "turn").agg(F.first("text").alias("text"))
    kept = sparse_rows(once, features, ["lang", "turn"]).collect()
    kept.sort(key=lambda r: (r["turn"], r["lang"]))
    code, number = codewords(len(languages)), {k: i for i, k in enumerate(languages)}
    of = np.array([number[r["lang"]] for r in kept])
    x, y = Sparse(kept, 3 << BITS), (code[of] > 0).astype(np.float32)
    del kept
    weight = (1.0 / np.bincount(of, minlength=len(languages)))[of]
    weights, bias = fit_logistic(x, y, weight)
    right = np.concatenate([np.sign(part @ weights + bias) == code[of[own]] for own, part in blocks(x)]).astype(np.float64)
    trust = np.array([right[of == k].mean(axis=0) for k in range(len(languages))]) + 1e-6
    return Model(languages, code, trust / trust.mean(axis=1, keepdims=True), weights, bias)


_PREDICTED = pa.schema([("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])


_PREDICTED = pa.schema([("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])


def _judged(docs: DataFrame, text: str, kept: list[str], found, told: list[str]) -> DataFrame:
    """What `found` makes of a batch and its texts. The text comes first and then the columns `kept`, which have numbers for
    names on the way, as names with dots cannot go through a task."""
    small_batches(docs.sparkSession)
    frame = docs.select(F.col(f"`{text}`").alias("text"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)])
    types = dict(frame.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=1 << 20):
            yield found(batch, texts(batch))

    return frame.mapInArrow(run, ", ".join(f"{c} {types[c]}" if c in types else c for c in told))


def identify(docs: DataFrame, model: Model, kept: list[str], *, text: str = "text") -> DataFrame:
    """The columns `kept` with `lang_pred`, `score` and `ambiguous`, for whole texts, of whatever length.

    A null text, or one without a letter, is `und` with score 0 and ambiguous; so is every text if nothing was learned.
    Repeated rows are judged each for itself; an empty table gives no rows.
    """

    def found(batch: pa.RecordBatch, values: list[bytes]) -> pa.RecordBatch:
        languages, score = model.predict(values)
        flags = [s < AMBIGUOUS for s in score]
        told = [pa.array(languages, pa.string()), pa.array(score), pa.array(flags, pa.bool_())]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[1:], *told], schema=pa.schema([*list(batch.schema)[1:], *_PREDICTED])
        )

    told = [f"c{i}" for i in range(len(kept))] + ["lang_pred string", "score double", "ambiguous boolean"]
    return _judged(docs, text, kept, found, told).toDF(*kept, *_PREDICTED.names)


def accepted(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, whose language is neither unknown nor ambiguous."""

    def found(batch: pa.RecordBatch, values: list[bytes]) -> pa.RecordBatch:
        languages, score = model.predict(values)
        return batch.filter(pa.array([k != UNKNOWN and s >= AMBIGUOUS for k, s in zip(languages, score)], pa.bool_()))

    others = [c for c in docs.columns if c != text]
    rows = _judged(docs, text, others, found, ["text", *[f"c{i}" for i in range(len(others))]]).toDF(text, *others)
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
