import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from helpers import awkward, frame

from perron.llm import simhash
from perron.llm.components import connected_components


def brute_print(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(n, linked):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def near_rows():
    rng = random.Random(4)
    rows = awkward()
    for i in range(40):
        words = rows[i % 10][1].split(" ")
        if words:
            words[rng.randrange(len(words))] = "changed"
        rows.append((1000 + i, " ".join(words)))
    return rows


def test_against_brute_force(spark):
    rows = near_rows()
    got = simhash.near_duplicates(frame(spark, rows).withColumn("a.b", F.lit(1))).collect()
    prints = [brute_print(r[1]) for r in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    roots = components(len(rows), pairs)
    least = {}
    for r, row in zip(roots, rows):
        if row[0] is not None:
            least[r] = min(least.get(r, 1 << 60), row[0])
    want = sorted((str(row[0]), f"{p:016x}", str(least.get(r))) for row, p, r in zip(rows, prints, roots))
    assert want == sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got)
    assert sum(r["uid"] == r["keep_uid"] for r in got) == len(set(roots))
    first = simhash.first_of_groups(frame(spark, rows))
    assert first.columns == frame(spark, rows).columns and first.count() == len(set(roots))


def test_index_finds_all_links():
    rng = np.random.default_rng(5)
    for trial in range(60):
        n = int(rng.integers(1, 300))
        group = np.sort(rng.integers(0, int(rng.integers(1, 9)), n))
        prints = rng.integers(0, 1 << 63, 5).astype(np.uint64)[rng.integers(0, 5, n)]
        for _ in range(int(rng.integers(1, 7))):
            prints ^= np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
        close = (np.bitwise_count(prints[:, None] ^ prints[None]) <= 4) & (group[:, None] == group[None])
        want = components(n, np.argwhere(close).tolist())
        assert components(n, zip(*[x.tolist() for x in simhash.linked(group, prints, 4)])) == want


def test_every_close_pair_meets_in_a_pair_of_blocks():
    masks = simhash.pair_masks(4)
    assert len(masks) == 15
    rng = random.Random(1)
    for _ in range(2000):
        difference = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(difference & m == 0 for m in masks)


def test_every_close_pair_meets_in_a_finer_block():
    rng = random.Random(2)
    for mask in simhash.pair_masks(4):
        finer = simhash.finer_masks(mask, 4)
        assert len(finer) == 5 and all(m & mask == mask != m for m in finer)
        free = [b for b in range(64) if not mask >> b & 1]
        for _ in range(200):
            difference = sum(1 << b for b in rng.sample(free, 4))
            assert any(difference & m == 0 for m in finer)


def family(rng, n):
    """Fingerprints that differ in few bits, and others."""
    near = [0x0F0F_1234_5678_9ABC ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for _ in range(n)]
    return sorted({p - (1 << 64) if p >> 63 else p for p in near + [rng.getrandbits(64) for _ in range(n // 3)]})


@pytest.mark.parametrize("crowd", [1, 7, 60, 1000])
def test_crowded_groups_lose_no_link(spark, crowd):
    prints = family(random.Random(crowd), 240)
    entries = frame(spark, [(p,) for p in prints], "print bigint")
    met = {}
    for r in simhash.met_in_groups(entries, 4, crowd).collect():
        met.setdefault((r["pair"], r["value"], r["piece"]), []).append(r["print"])
    together = {(a, b) for held in met.values() for a in held for b in held}
    assert all((a, b) in together for a in prints for b in prints if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4)
    assert all(len(set(held)) == len(held) for held in met.values())
    # Pieces are as even as their hash.
    assert crowd < 60 or max(map(len, met.values())) <= 3 * crowd


@pytest.mark.parametrize("crowd", [1, 5])
def test_crowded_groups_have_the_same_components(spark, crowd):
    docs = frame(spark, near_rows())
    want = [(r["uid"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()]
    got = [(r["uid"], r["component_id"]) for r in simhash.near_duplicates(docs, crowd=crowd).collect()]
    assert sorted(got) == sorted(want)


def test_components_of_long_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7), (2000, 1999)]
    got = {r["node"]: r["component"] for r in connected_components(frame(spark, links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(50)}, 2000: 1999, 1999: 1999}


def test_empty(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0
    assert simhash.first_of_groups(frame(spark, [])).count() == 0


@pytest.mark.parametrize("uid", ["5", "'x'"])
def test_a_column_named_uid_says_nothing(spark, uid):
    rows = near_rows()
    docs = frame(spark, rows).withColumn("uid", F.expr(uid)).withColumn("a.b", F.lit(2))
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows) == len({r["uid"] for r in got})
    first = simhash.first_of_groups(docs)
    assert first.columns == docs.columns and first.count() == sum(r["uid"] == r["keep_uid"] for r in got)


def moved(plan):
    """The columns that an executed plan's exchanges move, broadcast ones too."""
    nodes, names = [plan], set()
    while nodes:
        node = nodes.pop()
        if node.getClass().getSimpleName() in ("ShuffleExchangeExec", "BroadcastExchangeExec"):
            names |= {node.output().apply(i).name() for i in range(node.output().size())}
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            nodes.append(node.initialPlan())
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return names


def test_first_of_groups_moves_no_texts_for_few_near_rows(spark, tmp_path):
    rows = [(i, " ".join(f"w{i * 40 + j}" for j in range(40))) for i in range(200)]
    rows += [(1000 + i, rows[i][1].upper()) for i in range(5)]
    frame(spark, rows).write.parquet(str(tmp_path / "docs"))
    first = simhash.first_of_groups(spark.read.parquet(str(tmp_path / "docs")))
    assert sorted(r["doc_id"] for r in first.collect()) == list(range(200))
    names = moved(first._jdf.queryExecution().executedPlan())
    assert names and "text" not in names


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_first_of_groups_keeps_one_of_equal_rows(spark, tmp_path, threshold):
    text = [" ".join(f"w{i * 40 + j}" for j in range(40)) for i in range(6)]
    rows = [(1, text[0])] * 7 + [(2, text[0])] * 3 + [(None, text[1])] * 4 + [(0, text[1])] * 2
    rows += [(None, None)] * 5 + [(None, "")] + [(5, text[2]), (6, text[3])] + [(None, text[4])] * 2
    frame(spark, rows).write.parquet(str(tmp_path / "docs"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = simhash.first_of_groups(spark.read.parquet(str(tmp_path / "docs"))).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    kept = sorted((str(r["doc_id"]), r["text"] or "") for r in got)
    assert kept == sorted([("1", text[0]), ("0", text[1]), ("None", ""), ("5", text[2]), ("6", text[3]), ("None", text[4])])
