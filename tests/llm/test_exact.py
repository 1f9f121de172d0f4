import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import awkward, frame

from perron.llm import exact


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def groups(rows):
    found = defaultdict(list)
    for row in rows:
        found[normal(row[1])].append(row)
    return found


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(exact, "HELD_BYTES", 2000)
    rows = awkward()
    got = exact.exact_dedup(frame(spark, rows).withColumn("a.b", F.lit(1)), bucket_bytes=700).collect()
    assert len(got) == len(rows) == len({r["uid"] for r in got})
    by_hash = defaultdict(list)
    for r in got:
        by_hash[r["text_sha256"]].append(r)
    expected = groups(rows)
    assert {hashlib.sha256(t.encode()).hexdigest() for t in expected} == set(by_hash)
    for text, members in expected.items():
        mine = by_hash[hashlib.sha256(text.encode()).hexdigest()]
        best = min(members, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        assert sorted(str(r["doc_id"]) for r in mine) == sorted(str(m[0]) for m in members)
        assert {r["keep_id"] for r in mine} == {best[0]} and {r["group_size"] for r in mine} == {len(members)}
        kept = [r for r in mine if r["kept"]]
        assert len(kept) == 1 and kept[0]["doc_id"] == best[0]


def test_survivors_keep_their_columns(spark):
    rows = awkward()
    docs = frame(spark, rows)
    got = exact.survivors(docs, bucket_bytes=900)
    assert got.dtypes == docs.dtypes
    best = [min(m, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0)) for m in groups(rows).values()]
    assert sorted(str(r["doc_id"]) for r in got.collect()) == sorted(str(b[0]) for b in best)
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    assert all(texts[b[0]] == b[1] for b in best if normal(b[1]))


def test_equal_keys_of_different_texts_are_chained(spark, monkeypatch):
    batches = list(
        exact._offers([])(
            frame(spark, [(i, t) for i, t in enumerate(["x y", "xy", "z", None])], "doc_id bigint, text string", 1)
            .selectExpr("monotonically_increasing_id() as uid", "doc_id", "text").toArrow().to_batches()
        )
    )
    entries = [r for b in batches for r in b.to_pylist() if r["key"] is not None]
    assert len(entries) == 3
    import pyarrow as pa

    same = pa.RecordBatch.from_pylist([{**e, "key": 7} for e in entries + entries], schema=batches[0].schema)
    sizes = sorted(r["group_size"] for b in exact._classes(iter([same])) for r in b.to_pylist())
    assert sizes == [2, 2, 2, 2, 4, 4]


@pytest.mark.parametrize("uid", ["5", "'x'", "cast(null as double)"])
def test_a_column_named_uid_says_nothing(spark, uid):
    docs = frame(spark, [(i, t) for i, t in enumerate("abcd" * 2)], "doc_id bigint, text string").withColumn("uid", F.expr(uid))
    got = exact.exact_dedup(docs).collect()
    assert len(got) == 8 and sum(r["kept"] for r in got) == 4 and len({r["uid"] for r in got}) == 8
    assert exact.survivors(docs).count() == 4
    own = exact.exact_dedup(docs.withColumn("n", F.col("doc_id") * 10), uid="n").collect()
    assert sorted(r["uid"] for r in own) == [10 * i for i in range(8)]


def test_directory_doubles(spark, tmp_path):
    entries = frame(spark, [(k << 56, b"x" * 100) for k in range(-128, 128)] + [(5, b"y" * 5000)] * 3, "key bigint, text binary")
    slots, depth = exact.directory(entries, str(tmp_path / "d"), 3000)
    found = [r["slot"] for r in slots.collect()]
    assert len(found) == len(set(found)) and depth > 4
    keys = {r["key"] & (2**64 - 1) for r in entries.collect()}
    assert {k >> 64 - depth for k in keys} <= set(found)


def test_empty(spark):
    assert exact.exact_dedup(frame(spark, [])).count() == 0
    assert exact.survivors(frame(spark, [])).count() == 0
