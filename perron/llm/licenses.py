"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a run of words, wherever lines end, of at most `STRETCH` times the words of the template; without `stretch` it
is a line. It contains a template if at least `THRESHOLD` of the template's distinct words stand in it. Words are put in
one order, rarest first, by the number of texts (or lines) of the whole corpus that have them. A template of n words of
which m must be there has at least one of its n-m+1 rarest words in every such text, so only texts that share one are
looked at (prefix filter); one with less than m words of templates is passed over (length filter), and so is one where
too few words come after the shared one (positional filter). What remains is counted, in runs by one pass over the
places of the template's words.

Templates are a parameter of some dozens; their words go to every task and their counts to the driver. Words that no
template has cannot add to what is shared and are left out of blocks beforehand, which changes no result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perron.llm.arrow import slices, small_batches, texts

THRESHOLD = 0.9
#: Headers stand in files with names, marks and comment signs in between: a run may have this many times the words.
STRETCH = 2.0
#: Phrases that are labels by themselves wherever their words stand one after another.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
TEMPLATES = {
    "apache": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that "
    "the following conditions are met",
    "cc-by": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "gpl": "this work is licensed under the gnu general public license version 3",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files to deal in the software without restriction",
    "mpl": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "reserved": "all rights reserved",
}
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = rb"[^0-9a-z\x80-\xff]+"


def _phrase(words: str) -> re.Pattern:
    body = _GAP.join(w.encode() for w in words.split())
    return re.compile(rb"(?<![0-9a-z\x80-\xff])" + body + rb"(?![0-9a-z\x80-\xff])")


@dataclass
class Index:
    """Templates as places in the order of words, and the templates that have a word in their prefix."""

    order: dict[bytes, int]
    templates: list[tuple[str, list[int], int]]
    prefix: dict[int, list[tuple[int, int]]]

    @staticmethod
    def build(templates: dict[str, str], threshold: float, counts: dict[bytes, int]) -> Index:
        words = {name: set(_WORD.findall(text.encode().lower())) for name, text in templates.items()}
        every = sorted(set().union(*words.values()), key=lambda w: (counts.get(w, 0), w))
        order = {w: i for i, w in enumerate(every)}
        found, prefix = [], {}
        for number, (name, own) in enumerate(sorted(words.items())):
            places = sorted(order[w] for w in own)
            needed = max(1, math.ceil(threshold * len(places) - 1e-9))
            found.append((name, places, needed))
            for at, place in enumerate(places[: len(places) - needed + 1]):
                prefix.setdefault(place, []).append((number, at))
        return Index(order, found, prefix)

    def contained(self, block: list[int]) -> list[tuple[str, float]]:
        """Templates that a block contains, and how much of each; the block's places come sorted."""
        hits, tried = [], set()
        for j, place in enumerate(block):
            for number, i in self.prefix.get(place, ()):
                if number in tried:
                    continue
                name, own, needed = self.templates[number]
                if len(block) < needed or min(len(own) - i, len(block) - j) < needed:
                    continue
                tried.add(number)
                shared = len(set(own).intersection(block))
                if shared >= needed:
                    hits.append((name, shared / len(own)))
        return hits


def _blocks(text: bytes, vocabulary: frozenset[bytes]) -> tuple[int, list[tuple[int, int, frozenset[bytes]]]]:
    """The number of words, and per line its first word, its words, and those that templates have."""
    total, found = 0, []
    for line in text.split(b"\n"):
        words = _WORD.findall(line)
        found.append((total, len(words), vocabulary.intersection(words)))
        total += len(words)
    return total, found


def _runs(words: list[bytes], own: frozenset[bytes], needed: int, reach: int) -> list[tuple[int, int, int]]:
    """Runs of at most `reach` words with at least `needed` of `own`: first word, words, and how many of `own`.

    Every word is tried as the last one of a run. Of runs that overlap, the first with the most of `own` stays.
    """
    places = [i for i, w in enumerate(words) if w in own]
    held: Counter = Counter()
    found: list[tuple[int, int, int]] = []
    left = 0
    for i in places:
        held[words[i]] += 1
        # What is out of reach goes, and at the front also what comes again.
        while i - places[left] >= reach or held[words[places[left]]] > 1:
            word = words[places[left]]
            held[word] -= 1
            if not held[word]:
                del held[word]
            left += 1
        if len(held) >= needed:
            run = (places[left], i + 1 - places[left], len(held))
            if not found or run[0] >= found[-1][0] + found[-1][1]:
                found.append(run)
            elif run[2] > found[-1][2]:
                found[-1] = run
    return found


def word_counts(docs: DataFrame, templates: dict[str, str], *, lines: bool = True, text: str = "text") -> dict[bytes, int]:
    """In how many lines, or else texts, of the corpus each word of the templates stands."""
    small_batches(docs.sparkSession)
    vocabulary = frozenset(w for t in templates.values() for w in _WORD.findall(t.encode().lower()))
    schema = pa.schema([("word", pa.binary()), ("blocks", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(batches, text):
            for value in texts(batch, text):
                if lines:
                    for _, _, words in _blocks(value.lower(), vocabulary)[1]:
                        counts.update(words)
                else:
                    counts.update(vocabulary.intersection(_WORD.findall(value.lower())))
        yield pa.record_batch([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], schema)

    rows = docs.select(text).mapInArrow(run, "word binary, blocks bigint").groupBy("word").agg(F.sum("blocks").alias("blocks"))
    return {bytes(r["word"]): r["blocks"] for r in rows.collect()}


_SCAN_DDL = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
    "labels string, score double, spans array<struct<label:string,first_word:bigint,words:bigint,contained:double>>"
)
_SPAN = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("words", pa.int64()), ("contained", pa.float64())])
_SCAN = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "n_words", "n_base", "first_word", "last_word")]
    + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(_SPAN))]
)


def scan(
    docs: DataFrame,
    templates: dict[str, str] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
    threshold: float = THRESHOLD,
    *,
    stretch: float | None = None,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: words, places of the phrases, labels, and `spans`, the blocks that contain a template.

    With `stretch` blocks are runs of words of at most that many times the words of a template, over line ends and within
    long lines. Without, each line is one block however long it is, and a template that is wrapped is not found.
    `score` is the largest part of a template that a block contains, 1 if a phrase stands there, and 0 without either.
    Null and empty texts have no words, empty labels and score 0.
    Repeated rows are scanned each for itself, null ids stay null, an empty table gives no rows.
    """
    index = Index.build(templates, threshold, word_counts(docs, templates, lines=stretch is None, text=text))
    vocabulary = frozenset(index.order)
    sought = {}
    for name, _, needed in index.templates:
        every = _WORD.findall(templates[name].encode().lower())
        sought[name] = (frozenset(every), needed, max(len(every), math.ceil((stretch or 0) * len(every))))
    patterns = [(p.split()[0].encode(), p.split()[-1].encode(), _phrase(p), label) for p, label in sorted(phrases.items())]

    def in_lines(low: bytes) -> tuple[int, list[dict]]:
        total, blocks = _blocks(low, vocabulary)
        spans = []
        for first, words, present in blocks:
            if present:
                for label, part in index.contained(sorted(index.order[w] for w in present)):
                    spans.append({"label": label, "first_word": first, "words": words, "contained": part})
        return total, spans

    def in_runs(low: bytes) -> tuple[int, list[dict]]:
        words = _WORD.findall(low)
        spans = []
        for label, _ in index.contained(sorted(index.order[w] for w in vocabulary.intersection(words))):
            own, needed, reach = sought[label]
            for first, many, shared in _runs(words, own, needed, reach):
                spans.append({"label": label, "first_word": first, "words": many, "contained": shared / len(own)})
        return len(words), sorted(spans, key=lambda s: s["first_word"])

    def one(doc_id: int | None, value: bytes) -> tuple:
        low = value.lower()
        total, spans = in_lines(low) if stretch is None else in_runs(low)
        places, base = [], set()
        for head, tail, pattern, label in patterns:
            if head in low and tail in low:
                for match in pattern.finditer(low):
                    places.append(len(_WORD.findall(low, 0, match.start())))
                    base.add(label)
        labels = base | {s["label"] for s in spans}
        score = 1.0 if base else max((s["contained"] for s in spans), default=0.0)
        ends = (min(places), max(places)) if places else (None, None)
        return doc_id, total, len(places), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), score, spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [one(*pair) for pair in zip(batch.column("doc_id").to_pylist(), texts(batch))]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCAN)], _SCAN)

    return docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, _SCAN_DDL)
