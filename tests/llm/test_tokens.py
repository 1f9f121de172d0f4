import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import awkward, frame
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from perron.llm import packing, tokenfile, tokens

PARTS = ["a", "B", "the", "é", "ß", "中", "1", "23", "'s", "’", ".", ",", "#", "_", " ", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\x1c", "\x85",
         " ", "​", "́", "İ", "ﬁ", "<|", "|>", "<|endoftext|>", "🙂"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_is_the_library(name):
    path = tokens.vocabulary_path(name)
    library, encoder = Tokenizer.from_file(path), tokens.Encoder(path, 2)

    @settings(max_examples=400, deadline=None)
    @given(st.lists(st.sampled_from(PARTS), max_size=20).map("".join) | st.text(max_size=40))
    def check(text):
        want = library.encode(text, add_special_tokens=False).ids + [2]
        assert np.frombuffer(encoder.encode(text), encoder.kind).tolist() == want

    check()


def library_ids(name, end, rows):
    library = Tokenizer.from_file(tokens.vocabulary_path(name))
    return [(r[0], library.encode(r[1] or "", add_special_tokens=False).ids + [end]) for r in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing_has_every_id_once(spark):
    rows = awkward()
    got = packing.pack(frame(spark, rows), size=512).collect()
    whole, sequences = defaultdict(dict), defaultdict(list)
    for r in got:
        assert len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        assert r["start"] not in whole[r["uid"]]
        whole[r["uid"]][r["start"]] = np.frombuffer(r["ids"], "<u4").tolist()
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert all(r["doc_tokens"] == sum(map(len, whole[r["uid"]].values())) for r in got)
    ids = {r["uid"]: r["doc_id"] for r in got}
    made = sorted((str(ids[u]), sum((p[k] for k in sorted(p)), [])) for u, p in whole.items())
    assert all(sum(len(p[j]) for j in p if j < k) == k for p in whole.values() for k in p)
    assert made == sorted((str(i), t) for i, t in library_ids("word_bpe_49k.json", 2, rows))
    slack = []
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 512
        slack.append(512 - at)
    assert sorted(sequences) == list(range(len(sequences)))
    assert sorted(slack)[-2] <= packing.MAX_SLACK


@given(st.lists(st.tuples(st.integers(1, 30), st.integers(1, 5)), max_size=6, unique_by=lambda k: k[0]), st.integers(0, 60))
@settings(deadline=None)
def test_fill_is_the_best_sum(kinds, room):
    sums = {0}
    for length, count in kinds:
        sums = {s + k * length for s in sums for k in range(count + 1)}
    best, counts = packing.fill(room, kinds)
    assert best == max(s for s in sums if s <= room) == sum(k[0] * c for k, c in zip(kinds, counts))
    assert all(c <= k[1] for k, c in zip(kinds, counts))


@pytest.mark.parametrize("counts", [{2100: 100_000}, {4095: 5, 1: 3}, {7: 1}, {n: n % 13 for n in range(1, 4096)}, {3000: 10**9, 1000: 5}])
def test_plan_wastes_little(counts):
    rows, sequences = packing.plan(counts)
    total = sum(k * v for k, v in counts.items())
    assert sequences - total / 4096 <= 1 + sequences * packing.MAX_SLACK / 4096
    taken = defaultdict(int)
    for tail, low, high, start, length, *_ in rows.tolist():
        taken[tail] += (high - low) * length
    assert taken == {k: k * v for k, v in counts.items() if v}


def test_token_files_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfile, "BLOCK_IDS", 700)
    rows, folder = awkward(), str(tmp_path / "files")
    tokenfile.write_tokens(frame(spark, rows), folder)
    got = tokenfile.digest(spark, folder).orderBy("start").collect()
    want = library_ids("byte_bpe_50k.json", 0, rows)
    ordered = [r["doc_id"] for r in got]
    assert ordered == sorted(ordered, key=lambda i: (i is None, i or 0))
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((str(i), len(t), crc(t)) for i, t in want)
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    first = next(t for i, t in want if i == 0)
    assert [tokenfile.tokens_at(spark, folder, k) for k in (0, len(first) - 1)] == [first[0], 0]
    assert tokenfile.tokens_at(spark, folder, at) is None


def test_codes_are_directly_addressable():
    random = np.random.default_rng(2)
    for top in (200, 60_000, 1 << 24, 1 << 32):
        ids = random.integers(0, top, 3000).astype(np.uint32)
        parts, places = tokenfile.encode_block(ids), random.integers(0, 3000, 500)
        assert (tokenfile.access(*parts, places) == ids[places]).all()
        for start, stop in [(0, 3000), (0, 0), (3000, 3000), (511, 513), (1024, 2999), *np.sort(random.integers(0, 3001, (40, 2))).tolist()]:
            assert (tokenfile.access_range(*parts, start, stop) == ids[start:stop]).all()


def test_one_id_needs_no_decoding_of_others(spark):
    """Bits before the directory's entry are not looked at: spoil them, and later ids stay."""
    ids = np.where(np.arange(4000) % 3 == 0, 70_000, 5).astype(np.uint32)
    chunks, bitmaps, ranks = tokenfile.encode_block(ids)
    spoilt = [bytes(128) + b[128:] for b in bitmaps]
    places = np.arange(1024 + 512, 4000)
    assert (tokenfile.access(chunks[:1], spoilt[:1], ranks[:1], places) == ids[places] & 0xFF).all()
    words, directory = np.frombuffer(spoilt[0], "<u8"), np.frombuffer(ranks[0], "<u4").astype(np.int64)
    assert (tokenfile._set_before(words, directory, places) == [(ids[:p] > 255).sum() for p in places]).all()


def test_blocks_stay_where_they_are_read(spark, tmp_path):
    """No shuffle has chunks in it, neither to digest the files nor to find one id."""
    tokenfile.write_tokens(frame(spark, awkward()), str(tmp_path / "files"))
    plan = tokenfile.digest(spark, str(tmp_path / "files"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_empty(spark, tmp_path):
    assert packing.pack(frame(spark, [])).count() == 0
    tokenfile.write_tokens(frame(spark, []), str(tmp_path / "none"))
    assert tokenfile.digest(spark, str(tmp_path / "none")).count() == 0
