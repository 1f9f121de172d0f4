"""Removal of repeated passages: every byte covered by a string of `WINDOW` bytes that also starts earlier.

Every string of that length (a window) is named after the smallest hashed `GRAM`-byte piece in it, its anchor. Equal
windows have equal anchors at equal places, so

1. anchors that occur once in the corpus prove all their windows unique: tasks send each anchor's hash once, owner tasks
   tell which came twice, and documents without any such anchor are done;
2. windows of the other anchors are sent as contexts (the bytes of neighbouring windows with the same anchor) to the
   owner of the anchor. A task sends equal contexts once, for the first; the others repeat it. An anchor that very many
   documents have is cut further: its windows go one by one to the owner of their own hash;
3. an owner sorts the suffixes of one block of contexts at a time. They are sorted by their first 16 bytes; ties are
   resolved by the ranks of a difference cover's samples, which were computed for the block beforehand: for any two
   places a short step leads to samples on both sides, so two rank comparisons and 16 last bytes stand for 100. Of
   equal windows all but the first are repeated.

Names decide only where windows meet, and which cannot repeat; equality is decided by all their bytes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perron.llm.arrow import slices, small_batches
from perron.session import scratch

WINDOW = 100
GRAM = 32
#: Bytes of text that a task looks at together, and of contexts that are sorted together.
FLUSH_BYTES = 12 << 20
BLOCK_BYTES = 1 << 20
OWNER_BYTES = 8 << 20
#: An anchor in more documents has its windows sent one by one.
HOT_DOCS = 50_000

_CHUNK = 1 << 18
_PLACE = np.uint64((1 << 20) - 1)
_MODULUS = 13
_COVER = (0, 1, 3, 9)  # every difference modulo 13 is one of two of these
_HEAD = 16
_STEPS = np.array(
    [
        [next(d for d in range(_MODULUS) if (a + d) % _MODULUS in _COVER and (b + d) % _MODULUS in _COVER) for b in range(_MODULUS)]
        for a in range(_MODULUS)
    ]
)


def _hashed(data: np.ndarray) -> np.ndarray:
    """A mixed hash of the GRAM bytes from each place on, by doubling."""
    h, width, factor = data.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    while width < GRAM:
        h = h[:-width] * np.uint64(factor) + h[width:]
        width, factor = 2 * width, factor * factor % (1 << 64)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def anchors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with the same anchor: its hash, the first and the last window's place, and the document.

    `data` is all documents behind one another, `bounds` where each begins, with the end as last. Of equal hashes
    in a window the first counts.
    """
    out: list[tuple] = []
    reach = WINDOW - GRAM + 1
    for start in range(0, len(data), _CHUNK):
        part = data[start : start + _CHUNK + WINDOW - 1]
        if len(part) < WINDOW:
            break
        names = _hashed(part)
        least = (names & ~_PLACE) | np.arange(len(names), dtype=np.uint64)
        width = 1
        while 2 * width <= reach:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        if width < reach:
            least = np.minimum(least[: len(least) - (reach - width)], least[reach - width :])
        n = len(least)
        first = int(np.searchsorted(bounds, start, "right")) - 1
        last = int(np.searchsorted(bounds, start + n, "left"))
        edges = np.clip(bounds[first : last + 1], start, start + n) - start
        doc = np.repeat(np.arange(first, last), np.diff(edges))
        places = np.flatnonzero(np.arange(start, start + n) + WINDOW <= bounds[doc + 1])
        if not len(places):
            continue
        at = (least[places] & _PLACE).astype(np.int64)
        fresh = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (places[1:] != places[:-1] + 1)])
        ends = np.r_[fresh[1:], len(places)] - 1
        out.append((names[at[fresh]].view(np.int64), places[fresh] + start, places[ends] + start, doc[places[fresh]]))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(c) for c in zip(*out))


def _lists(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    offsets = np.r_[starts, len(values)].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _flushes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in slices(batches, limit=FLUSH_BYTES // 4):
        held.append(batch)
        size += batch.column("text").nbytes
        if size >= FLUSH_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _whole(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    values = [t or b"" for t in table.column("text").cast(pa.large_binary()).to_pylist()]
    bounds = np.zeros(len(values) + 1, np.int64)
    np.cumsum([len(v) for v in values], out=bounds[1:])
    return np.frombuffer(b"".join(values), np.uint8), bounds


_NAMES = pa.schema([("owner", pa.int64()), ("sent", pa.bool_()), ("keys", pa.list_(pa.int64())), ("names", pa.list_(pa.int64())), ("twice", pa.list_(pa.bool_()))])
_NAMES_DDL = "owner bigint, sent boolean, keys array<bigint>, names array<bigint>, twice array<boolean>"
_TOLD = pa.schema([("back", pa.int64()), ("keys", pa.list_(pa.int64())), ("names", pa.list_(pa.int64()))])
_TOLD_DDL = "back bigint, keys array<bigint>, names array<bigint>"
_KEYED = pa.schema([("key", pa.int64()), ("names", pa.list_(pa.int64()))])
_KEYED_DDL = "key bigint, names array<bigint>"


def _runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)


def _by_back(key: np.ndarray, name: np.ndarray, backs: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Names of documents, together for those that go back the same way."""
    back = key % backs
    order = np.argsort(back, kind="stable")
    starts = _runs(back[order])
    return pa.array(back[order][starts]), _lists(key[order], starts), _lists(name[order], starts)


def _send_names(owners: int):
    """Each name once per flush to its owner. Names that a flush has twice are known to be repeated there already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _flushes(batches):
            name, _, _, doc = anchors(*_whole(table))
            key = table.column("key").to_numpy()[doc]
            _, first, inverse, counts = np.unique(name, return_index=True, return_inverse=True, return_counts=True)
            known = counts[inverse] > 1
            if known.any():
                back, keys, names = _by_back(key[known], name[known], owners)
                none = pa.ListArray.from_arrays(pa.array(np.zeros(len(back) + 1, np.int32)), pa.array([], pa.bool_()))
                yield pa.record_batch([back, pa.array([False] * len(back)), keys, names, none], _NAMES)
            if len(first):
                owner = name[first] % owners
                order = np.lexsort((first, owner))
                owner, first, twice = owner[order], first[order], (counts > 1)[order]
                starts = _runs(owner)
                yield pa.record_batch(
                    [pa.array(owner[starts]), pa.array([True] * len(starts)), _lists(key[first], starts), _lists(name[first], starts), _lists(twice, starts)],
                    _NAMES,
                )

    return run


def _repeated_names(owners: int):
    """Rows come sorted by owner: names that came twice go back to the documents that do not know it yet."""

    def decided(held: list[tuple]) -> pa.RecordBatch:
        key, name, twice = (np.concatenate(c) for c in zip(*held))
        _, inverse, counts = np.unique(name, return_inverse=True, return_counts=True)
        repeated = (counts[inverse] > 1) | (np.bincount(inverse, twice)[inverse] > 0)
        tell = repeated & ~twice
        return pa.record_batch(list(_by_back(key[tell], name[tell], owners)), _TOLD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        current = None
        for batch in batches:
            owner, sent = batch.column("owner").to_pylist(), batch.column("sent").to_pylist()
            for i in range(batch.num_rows):
                if owner[i] != current and held:
                    yield decided(held)
                    held = []
                current = owner[i]
                if sent[i]:
                    values = [batch.column(c)[i].values.to_numpy(zero_copy_only=False).copy() for c in ("keys", "names", "twice")]
                    held.append(tuple(values))
                else:
                    yield pa.record_batch([batch.column(c).slice(i, 1) for c in ("owner", "keys", "names")], _TOLD)
        if held:
            yield decided(held)

    return run


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by their way back: a document's names together."""
    held: list[tuple] = []
    current = None

    def together() -> pa.RecordBatch:
        key, name = (np.concatenate(c) for c in zip(*held))
        order = np.argsort(key, kind="stable")
        starts = _runs(key[order])
        return pa.record_batch([pa.array(key[order][starts]), _lists(name[order], starts)], _KEYED)

    for batch in batches:
        back = batch.column("back").to_pylist()
        for i in range(batch.num_rows):
            if back[i] != current and held:
                yield together()
                held = []
            current = back[i]
            held.append(tuple(batch.column(c)[i].values.to_numpy().copy() for c in ("keys", "names")))
    if held:
        yield together()


_CONTEXTS = pa.schema(
    [
        ("owner", pa.int64()), ("sent", pa.bool_()), ("bytes", pa.binary()), ("lengths", pa.list_(pa.int64())),
        ("groups", pa.list_(pa.int64())), ("uids", pa.list_(pa.int64())), ("doc_ids", pa.list_(pa.int64())), ("places", pa.list_(pa.int64())),
    ]
)
_CONTEXTS_DDL = (
    "owner bigint, sent boolean, bytes binary, lengths array<bigint>, groups array<bigint>, uids array<bigint>, "
    "doc_ids array<bigint>, places array<bigint>"
)
_SPANS = pa.schema([("uid", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])
_SPANS_DDL = "uid bigint, starts array<bigint>, ends array<bigint>"
_NO_ID = np.iinfo(np.int64).max


def _send_contexts(owners: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _flushes(batches):
            # Documents in their order, so that the first of equal contexts is the earliest.
            table = table.sort_by([("order", "ascending"), ("uid", "ascending")])
            data, bounds = _whole(table)
            raw = data.tobytes()
            uids, orders = table.column("uid").to_numpy(), table.column("order").to_numpy()
            name, low, high, doc = anchors(data, bounds)
            begins = np.searchsorted(doc, np.arange(table.num_rows + 1))
            first: dict[bytes, None] = {}
            sent: list[tuple] = []
            known: list[tuple] = []
            names, hots = table.column("names"), table.column("hot")
            for d in range(table.num_rows):
                span = slice(begins[d], begins[d + 1])
                own = np.flatnonzero(np.isin(name[span], names[d].values.to_numpy())) + begins[d]
                hot = set(hots[d].as_py() or ())
                for a in own.tolist():
                    a_low, a_high, group = int(low[a]), int(high[a]), int(name[a])
                    if group in hot:
                        pieces = [(p, p, None) for p in range(a_low, a_high + 1)]
                    else:
                        pieces = [(a_low, a_high, group)]
                    for p, q, at in pieces:
                        text = raw[p : q + WINDOW]
                        if at is None:
                            at = xxhash.xxh64_intdigest(text, 7) - (1 << 63)
                        if text in first:
                            known.append((int(uids[d]), p - int(bounds[d]), q + WINDOW - int(bounds[d])))
                        else:
                            first[text] = None
                            sent.append((at % owners, at, text, int(uids[d]), int(orders[d]), p - int(bounds[d])))
            if known:
                yield _as_contexts(known, owners)
            sent.sort(key=lambda r: r[0])
            rows, start = [], 0
            while start < len(sent):
                stop = start
                while stop < len(sent) and sent[stop][0] == sent[start][0]:
                    stop += 1
                _, groups, parts, ids, docs, places = zip(*sent[start:stop])
                rows.append((sent[start][0], True, b"".join(parts), [len(t) for t in parts], groups, ids, docs, places))
                start = stop
            if rows:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _CONTEXTS)], _CONTEXTS)

    return run


def _as_contexts(known: list[tuple], owners: int) -> pa.RecordBatch:
    """Spans that are decided, in the layout of contexts: one row per document."""
    by_uid: dict[int, tuple[list, list]] = {}
    for uid, start, end in known:
        starts, ends = by_uid.setdefault(uid, ([], []))
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    rows = [(uid % owners, False, None, ends, None, [uid], None, starts) for uid, (starts, ends) in by_uid.items()]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _CONTEXTS)], _CONTEXTS)


def _words(data: np.ndarray, places: np.ndarray, size: int = 8) -> np.ndarray:
    """The bytes from each place on as a number that sorts like them."""
    out = np.zeros(len(places), np.uint64)
    for k in range(size):
        out = (out << np.uint64(8)) | data[places + k]
    return out


def _dense(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Ranks from 0, equal for equal keys, given an order that sorts them."""
    step = np.zeros(len(order), bool)
    for key in keys:
        sorted_ = key[order]
        step[1:] |= sorted_[1:] != sorted_[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(step)
    return rank


def cover_ranks(data: np.ndarray) -> np.ndarray:
    """Ranks of the 52 bytes from each sample of the difference cover on; other places have -1.

    Samples 13 bytes apart are samples alike, so ranks of 13 bytes give those of 26 and these those of 52. `data` ends
    with at least 52 bytes to spare.
    """
    n = len(data) - 4 * _MODULUS
    places = np.flatnonzero(np.isin(np.arange(n) % _MODULUS, _COVER))
    head, rest = _words(data, places), _words(data, places + 8, 5)
    rank = np.full(len(data), -1, np.int64)
    rank[places] = _dense(np.lexsort((rest, head)), head, rest)
    for step in (_MODULUS, 2 * _MODULUS):
        pair = rank[places] * (n + 1) + rank[places + step] + 1
        rank[places] = _dense(np.argsort(pair, kind="stable"), pair)
    return rank


def equal_windows(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Sorts the windows at `places` and numbers them: equal numbers for equal windows.

    Ties of the first 16 bytes are split around a pivot each, all at once, until every part is equal to its pivot.
    """
    data = np.r_[data, np.zeros(2 * WINDOW, np.uint8)]
    rank = cover_ranks(data)
    first, second = _words(data, places), _words(data, places + 8)
    order = np.lexsort((second, first))
    part = np.cumsum(np.r_[False, (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1])])
    number = np.full(len(places), -1, np.int64)
    given = 0
    active, part = order, part
    while len(active):
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        sizes = np.diff(np.r_[starts, len(active)])
        pivot = np.repeat(active[starts + sizes // 2], sizes)
        p, q = places[active], places[pivot]
        step = _STEPS[p % _MODULUS, q % _MODULUS]
        sign = np.sign(rank[p + step] - rank[q + step])
        # The second comparison begins between bytes 36 and 48, where the first has not yet ended.
        later = step + np.where(step <= 9, 39, 26)
        sign = np.where(sign == 0, np.sign(rank[p + later] - rank[q + later]), sign)
        tied = np.flatnonzero(sign == 0)
        for at in (WINDOW - _HEAD, WINDOW - 8):
            mine, other = _words(data, p[tied] + at), _words(data, q[tied] + at)
            sign[tied] = np.where(sign[tied] != 0, sign[tied], (mine > other).astype(np.int64) - (mine < other))
        same = sign == 0
        ids = np.cumsum(np.r_[False, part[1:] != part[:-1]])
        number[active[same]] = given + ids[same]
        given += int(ids[-1]) + 1
        rest = np.flatnonzero(~same)
        key = ids[rest] * 2 + (sign[rest] > 0)
        by = np.argsort(key, kind="stable")
        active, part = active[rest][by], key[by]
    return number


def _repeats(data: np.ndarray, bounds: np.ndarray, uids: np.ndarray, docs: np.ndarray, places: np.ndarray):
    """Windows of a block that are not the first of their kind, as (context, first, last) runs within the contexts."""
    lengths = np.diff(bounds) - WINDOW + 1
    context = np.repeat(np.arange(len(lengths)), lengths)
    within = np.arange(len(context)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    number = equal_windows(data, bounds[context] + within)
    order = np.lexsort((places[context] + within, uids[context], docs[context], number))
    later = np.zeros(len(order), bool)
    later[order[1:]] = number[order[1:]] == number[order[:-1]]
    hits = np.flatnonzero(later)
    if not len(hits):
        return context[:0], within[:0], within[:0]
    fresh = np.r_[True, (hits[1:] != hits[:-1] + 1) | (context[hits[1:]] != context[hits[:-1]])]
    starts = np.flatnonzero(fresh)
    ends = np.r_[starts[1:], len(hits)] - 1
    return context[hits[starts]], within[hits[starts]], within[hits[ends]]


def _spans(uid: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((start, uid))
    uid, start, end = uid[order], start[order], end[order]
    begins = _runs(uid)
    return pa.record_batch([pa.array(uid[begins]), _lists(start, begins), _lists(end, begins)], _SPANS)


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by owner; contexts of an owner are sorted by group and taken block by block."""
    held: list[tuple] = []
    current = None

    def decided() -> Iterator[pa.RecordBatch]:
        raw = b"".join(h[0] for h in held)
        lengths, groups, uids, docs, places = (np.concatenate(c) for c in list(zip(*held))[1:])
        offsets = np.cumsum(lengths) - lengths
        # Equal contexts repeat the earliest of them as a whole.
        first: dict[bytes, None] = {}
        alone, again = [], []
        for i in np.lexsort((places, uids, docs)).tolist():
            text = raw[offsets[i] : offsets[i] + lengths[i]]
            if text in first:
                again.append(i)
            else:
                first[text] = None
                alone.append(i)
        del first
        if again:
            yield _spans(uids[again], places[again], places[again] + lengths[again])
        # Windows of one context differ, as their anchor stands at another place in each.
        order = np.array(alone)[np.argsort(groups[alone], kind="stable")]
        edges = np.r_[_runs(groups[order]), len(order)]
        order = order[np.repeat(np.diff(edges) > 1, np.diff(edges))]
        if not len(order):
            return
        raw = np.frombuffer(raw, np.uint8)
        sizes = np.cumsum(lengths[order])
        edges = np.r_[_runs(groups[order]), len(order)]
        start = 0
        while start < len(order):
            limit = (sizes[start - 1] if start else 0) + BLOCK_BYTES
            stop = int(np.searchsorted(sizes, limit, "right"))
            fits = edges[(edges > start) & (edges <= stop)]
            stop = int(fits[-1]) if len(fits) else int(edges[edges > start][0])
            chosen = order[start:stop]
            bounds = np.r_[0, np.cumsum(lengths[chosen])]
            take = np.arange(bounds[-1]) + np.repeat(offsets[chosen] - bounds[:-1], lengths[chosen])
            context, first, last = _repeats(raw[take], bounds, uids[chosen], docs[chosen], places[chosen])
            who = chosen[context]
            if len(who):
                yield _spans(uids[who], places[who] + first, places[who] + last + WINDOW)
            start = stop

    for batch in batches:
        owner, sent = batch.column("owner").to_pylist(), batch.column("sent").to_pylist()
        for i in range(batch.num_rows):
            if owner[i] != current and held:
                yield from decided()
                held = []
            current = owner[i]
            numbers = {c: batch.column(c)[i].values for c in ("lengths", "uids", "places")}
            lengths, uids, places = (v.to_numpy().copy() for v in numbers.values())
            if sent[i]:
                groups, docs = (batch.column(c)[i].values.to_numpy().copy() for c in ("groups", "doc_ids"))
                held.append((batch.column("bytes")[i].as_py(), lengths, groups, uids, docs, places))
            else:
                yield _spans(np.repeat(uids, len(lengths)), places, lengths)
    if held:
        yield from decided()


_CUT_DDL = "uid bigint, doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, removed array<struct<start:bigint,end:bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_CUT = pa.schema(
    [(c, pa.int64()) for c in ("uid", "doc_id", "n_bytes", "n_removed", "n_spans")] + [("kept_sha256", pa.string()), ("removed", pa.list_(_RUN))]
)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = []
        columns = [batch.column("uid"), batch.column("doc_id"), batch.column("text").cast(pa.large_binary()), batch.column("starts"), batch.column("ends")]
        for uid, doc_id, text, starts, ends in zip(*[c.to_pylist() for c in columns]):
            text, runs = text or b"", []
            for start, end in sorted(zip([s for part in starts or () for s in part], [e for part in ends or () for e in part])):
                if runs and start <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], end)
                else:
                    runs.append([start, end])
            digest, at = hashlib.sha256(), 0
            for start, end in runs:
                digest.update(text[at:start])
                at = end
            digest.update(text[at:])
            removed = sum(end - start for start, end in runs)
            rows.append((uid, doc_id, len(text), removed, len(runs), digest.hexdigest(), [{"start": s, "end": e} for s, e in runs]))
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _CUT)], _CUT)


def repeated_passages(docs: DataFrame, hot_docs: int = HOT_DOCS, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: `doc_id`, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256`, `removed` (runs of bytes).

    Earlier is a smaller id (null last), of rows with the same id any one, and in a document the earlier place. What is
    removed is judged on the input. Null counts as empty; texts of less than `WINDOW` bytes lose nothing. An empty table
    gives no rows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = scratch(spark, "passages")
    key: Column = F.xxhash64(F.col(id).isNull(), F.col(id), F.col(text))
    source = docs.select(key.alias("key"), F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    owners = max(1, math.ceil(total / OWNER_BYTES))
    names = source.select("key", "text").mapInArrow(_send_names(owners), _NAMES_DDL)
    told = names.repartition("owner").sortWithinPartitions("owner").mapInArrow(_repeated_names(owners), _TOLD_DDL)
    by_document = told.repartition("back").sortWithinPartitions("back").mapInArrow(_by_document, _KEYED_DDL)
    by_document.write.parquet(f"{folder}/named")
    named = spark.read.schema(_KEYED_DDL).parquet(f"{folder}/named")

    each = named.select("key", F.explode("names").alias("name"))
    each.groupBy("name").count().where(F.col("count") > hot_docs).select("name").write.parquet(f"{folder}/hot")
    hot = spark.read.parquet(f"{folder}/hot")
    suspects = source.join(named, "key")
    if hot.isEmpty():
        suspects = suspects.withColumn("hot", F.array().cast("array<bigint>"))
    else:
        each.join(hot, "name").groupBy("key").agg(F.collect_set("name").alias("hot")).write.parquet(f"{folder}/hot-by-key")
        suspects = suspects.join(spark.read.parquet(f"{folder}/hot-by-key"), "key", "left")
    order = F.coalesce("doc_id", F.lit(int(_NO_ID)))
    suspects.select(
        "key", F.monotonically_increasing_id().alias("uid"), "doc_id", order.alias("order"), "text", "names", "hot"
    ).write.parquet(f"{folder}/suspects")
    suspects = spark.read.parquet(f"{folder}/suspects")

    sent = suspects.agg(F.sum(F.size("names"))).first()[0] or 0
    owners = max(1, math.ceil(sent * (WINDOW + 31) / OWNER_BYTES))
    contexts = suspects.select("uid", "order", "text", "names", "hot").mapInArrow(_send_contexts(owners), _CONTEXTS_DDL)
    spans = contexts.repartition("owner").sortWithinPartitions("owner").mapInArrow(_decide, _SPANS_DDL)
    spans.groupBy("uid").agg(F.collect_list("starts").alias("starts"), F.collect_list("ends").alias("ends")).write.parquet(
        f"{folder}/spans"
    )
    spans = spark.read.parquet(f"{folder}/spans")
    cut = suspects.select("uid", "doc_id", "text").join(spans, "uid").mapInArrow(_cut, _CUT_DDL)
    cut.write.parquet(f"{folder}/cut")
    cut = spark.read.schema(_CUT_DDL).parquet(f"{folder}/cut")

    # Documents that nothing was removed from: those that were never suspected, and those that proved clean.
    whole = F.coalesce(F.col("text"), F.lit(""))
    nothing = [F.lit(0).cast("bigint").alias("n_removed"), F.lit(0).cast("bigint").alias("n_spans")]
    plain = [F.octet_length(whole).cast("bigint").alias("n_bytes"), *nothing, F.sha2(whole, 256).alias("kept_sha256")]
    runs = F.array().cast("array<struct<start:bigint,end:bigint>>").alias("removed")
    never = source.select("key", "doc_id", *plain, runs).join(named.select("key"), "key", "left_anti").drop("key")
    clean = suspects.select("uid", "doc_id", *plain, runs).join(cut.select("uid"), "uid", "left_anti").drop("uid")
    return cut.drop("uid").unionByName(never).unionByName(clean)
