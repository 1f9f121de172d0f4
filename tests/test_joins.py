"""Joins against brute force, with and without hot keys."""

import itertools

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from perron.operators.joins import broadcast_limit, fits_broadcast, hot_keys, sized_join, star_join

KEYS = st.one_of(st.none(), st.integers(0, 3))
SIDE = st.lists(KEYS, max_size=12)


def brute(left, right, how):
    """Pairs of row numbers; None stands for no partner."""
    pairs = [(i, j) for (i, a), (j, b) in itertools.product(enumerate(left), enumerate(right))
             if a is not None and a == b]
    matched_left, matched_right = {i for i, _ in pairs}, {j for _, j in pairs}
    if how == "left_anti":
        return [(i,) for i in range(len(left)) if i not in matched_left]
    if how in ("left", "full"):
        pairs += [(i, None) for i in range(len(left)) if i not in matched_left]
    if how == "full":
        pairs += [(None, j) for j in range(len(right)) if j not in matched_right]
    return pairs


def side(spark, keys, name, slices=3):
    data = list(enumerate(keys))
    frame = spark.createDataFrame(data, f"{name}_row long, {name}_key long")
    return frame.repartition(slices) if data else frame


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def check(spark, left, right, how, **options):
    joined = sized_join(side(spark, left, "l"), side(spark, right, "r"), "l_key", "r_key", how, **options)
    columns = ["l_row"] if how == "left_anti" else ["l_row", "r_row"]
    key = lambda r: [(v is not None, v or 0) for v in r]
    assert sorted(map(tuple, joined.select(*columns).collect()), key=key) == sorted(brute(left, right, how), key=key)


@pytest.mark.parametrize("how", ["inner", "left", "full", "left_anti"])
@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_join_with_hot_keys(spark, no_broadcast, how, hot_rows):
    left = [None] * 5 + [1] * 9 + [2] * 2 + [3] + [7] * 6
    right = [None] * 4 + [1] * 5 + [2] * 8 + [4] * 7 + [5]
    check(spark, left, right, how, hot_rows=hot_rows)


@pytest.mark.parametrize("how", ["inner", "left", "full", "left_anti"])
def test_join_with_broadcast(spark, how):
    check(spark, [None, 1, 1, 2], [None, 1, 3, 3], how)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=SIDE, right=SIDE, how=st.sampled_from(["inner", "left", "full", "left_anti"]))
def test_any_join_with_every_key_hot(spark, no_broadcast, left, right, how):
    check(spark, left, right, how, hot_rows=0.5)


def test_empty_sides(spark, no_broadcast):
    for how in ("inner", "left", "full", "left_anti"):
        check(spark, [], [1, None], how, hot_rows=1)
        check(spark, [1, None], [], how, hot_rows=1)


def test_rows_of_a_hot_key_are_spread(spark, no_broadcast):
    """Equal rows of one key, a third of all, end in several partitions, and so do NULL keys."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id"))
        left = spark.range(0, 30000, 1, 16).select(key.alias("k"))
        right = spark.range(0, 3000).select(F.col("id").alias("r"))
        joined = sized_join(left, right, "k", "r", "left", unique_right=True, hot_rows=100)
        places = joined.withColumn("p", F.spark_partition_id()).groupBy("k").agg(
            F.countDistinct("p").alias("places"), F.count(F.lit(1)).alias("n"))
        found = {row["k"]: (row["places"], row["n"]) for row in places.where("k = 1 or k is null").collect()}
        assert found[1][0] >= 2 and found[1][1] == 10000
        assert found[None][0] >= 3 and found[None][1] == 10000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("how", ["left", "full"])
def test_null_keys_are_spread(spark, no_broadcast, how):
    """Also when no key is hot, and on the right side of a full join."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        def some(name, rows):
            return spark.range(0, rows, 1, 12).select(
                F.when(F.col("id") % 2 == 0, F.col("id")).alias(name), F.lit(1).alias(name + "_in"))

        left, right = some("l", 6000), some("r", 3000)
        joined = sized_join(left, right, "l", "r", how, left_like=left if how == "left" else None)
        places = {
            name: joined.where(F.col(name).isNull() & F.col(name + "_in").isNotNull())
            .select(F.spark_partition_id()).distinct().count()
            for name in ("l", "r")
        }
        assert places["l"] >= 3 and (how == "left" or places["r"] >= 3)
        assert joined.count() == {"left": 6000, "full": 7500}[how]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hot_keys(spark):
    frame = side(spark, [1] * 10 + [2] * 3 + [None] * 8 + [3], "l")
    assert hot_keys(frame, "l_key", hot_rows=2) == {1: 8, None: 6}
    assert hot_keys(frame, "l_key", hot_rows=100) == {}


def test_hot_keys_of_many_rows(spark):
    frame = spark.range(0, 300_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    found = hot_keys(frame, "k", hot_rows=50_000)
    assert list(found) == [7] and found[7] in (5, 6)


def test_size_check(spark):
    assert broadcast_limit(spark) == 10 << 20
    assert fits_broadcast(spark.range(1000))
    assert not fits_broadcast(spark.range(10**6))
    texts = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert fits_broadcast(texts) and not fits_broadcast(texts, limit=50_000)
    assert not fits_broadcast(spark.range(1), limit=-1)
    assert fits_broadcast(spark.range(3).select(F.array(F.lit(1)).alias("a"), F.lit(None).cast("string").alias("s")))


def test_broadcast_is_decided_by_size(spark):
    left = spark.range(100).withColumnRenamed("id", "a")
    small, large = spark.range(10).withColumnRenamed("id", "b"), spark.range(10**6).withColumnRenamed("id", "b")
    plans = [sized_join(left, right, "a", "b", "left")._jdf.queryExecution().optimizedPlan().toString() for right in (small, large)]
    assert "strategy=broadcast" in plans[0] and "strategy=broadcast" not in plans[1]


def test_shared_column_names_are_refused(spark):
    with pytest.raises(ValueError, match="both sides: id"):
        sized_join(spark.range(1), spark.range(1), "id", "id", "inner")
    with pytest.raises(ValueError, match="from the sides themselves"):
        check(spark, [1], [1], "full", left_like=side(spark, [2], "l"))
    with pytest.raises(ValueError, match="unknown join"):
        sized_join(spark.range(1), spark.range(1), "id", "id", "cross")


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_a_frame_that_stands_for_the_left_side(spark, no_broadcast, hot_rows):
    left = [None] * 6 + [1] * 9 + [2] * 2 + [7]
    for like, how in (([1] * 5, "left"), ([None, 3], "left"), ([], "left"), ([1, 3, 3], "inner"), ([9, 9, 1], "left_anti")):
        check(spark, left, [1, 1, 2, 3], how, hot_rows=hot_rows, left_like=side(spark, like, "l"))


def test_star_join_with_hot_keys(spark, no_broadcast):
    fact = spark.createDataFrame([(i, i % 2 or None, i % 3) for i in range(30)], "f int, a int, b int")
    first = spark.createDataFrame([(1, 0), (1, 2)], "k int, c int")
    second = spark.createDataFrame([(0, "x"), (0, "y"), (2, "z")], "n int, d string")
    third = spark.createDataFrame([(2, "c2")], "m int, e string")
    got = rows(star_join(fact, [("a", first, "k"), ("b", second, "n"), ("c", third, "m")], hot_rows=1), "f", "c", "d", "e")
    want = [
        (f, c, d, "c2" if c == 2 else None)
        for f in range(30)
        for c in ((0, 2) if f % 2 else (None,))
        for d in {0: ("x", "y"), 1: (None,), 2: ("z",)}[f % 3]
    ]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_star_join(spark):
    fact = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "f long, d string")
    dim = spark.createDataFrame([("a", 7)], "k string, e long")
    outer = spark.createDataFrame([(7, "seven")], "n long, name string")
    assert rows(star_join(fact, [("d", dim, "k"), ("e", outer, "n")]), "f", "name") == [
        (1, "seven"), (2, None), (3, None)]


def test_a_side_measured_as_too_large_is_not_broadcast(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(5000).select(F.col("id").alias("b"), F.repeat(F.lit("x"), 2000).alias("w")).coalesce(1).write.parquet(path)
    wide, left = spark.read.parquet(path), spark.range(100).select(F.col("id").alias("a"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2m")
    try:
        assert not fits_broadcast(wide)
        for how in ("inner", "left"):
            joined = sized_join(left, wide, "a", "b", how)
            joined.collect()
            assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
