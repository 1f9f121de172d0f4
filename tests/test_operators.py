"""Projections, aggregates, keys and key reports."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from perron.operators import aggregates, keys, projection, quality


def test_conform_goes_by_name(spark):
    frame = spark.createDataFrame([("7", "x", 1)], "B string, c string, a int")
    got = projection.conform(frame, "a bigint, b int")
    assert got.dtypes == [("a", "bigint"), ("b", "int")] and rows(got) == [(1, 7)]
    with pytest.raises(ValueError, match="missing: d, e"):
        projection.conform(frame, "a int, d int, e int")


def test_projection_and_filters(spark):
    frame = spark.createDataFrame([("a,b", True, 1), (None, None, 2), ("c", False, None)], "t string, f boolean, k int")
    assert rows(projection.without_token(frame, "t", ","), "t") == [("c",)]
    assert rows(projection.drop_null_keys(frame, "k"), "k") == [(1,), (2,)]
    assert rows(projection.default_flags(frame, "f"), "f") == [(False,), (False,), (True,)]
    assert projection.project(frame, ["k", "t"], {"t": "text"}).columns == ["k", "text"]


PAIRS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.one_of(st.none(), st.integers(-3, 3))), max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(PAIRS)
def test_aggregates_against_brute_force(spark, pairs):
    frame = spark.createDataFrame(pairs, "k int, v int")
    groups = {}
    for k, v in pairs:
        groups.setdefault(k, []).append(v)
    assert dict(map(tuple, aggregates.count_per_key(frame, "k", "n").collect())) == {k: len(v) for k, v in groups.items()}

    def mean(values):
        values = [v for v in values if v is not None]
        if not values:
            return None
        total, n = sum(values), len(values)
        return (abs(total) * 2 + n) // (2 * n) * (1 if total >= 0 else -1)

    assert dict(map(tuple, aggregates.rounded_mean(frame, "k", "v", "m").collect())) == {
        k: mean(v) for k, v in groups.items()}
    least = {k: min(v, key=lambda x: (x is not None, x or 0)) for k, v in groups.items()}
    assert dict(map(tuple, aggregates.first_per_key(frame, "k", ["v"]).collect())) == least
    assert Counter(map(tuple, aggregates.distinct_rows(frame, "k", "v").collect())) == Counter(set(pairs))
    repeated = {k: len(v) for k, v in groups.items() if len(v) > 1 or k is None}
    assert dict(map(tuple, quality.pk_violations(frame, "k").collect())) == repeated
    repeated.pop(None, None)
    assert dict(map(tuple, quality.pk_violations(frame, "k", nullable=True).collect())) == repeated


def test_first_per_key_breaks_ties_by_the_other_columns(spark):
    frame = spark.createDataFrame([("b", 1, 5), ("a", 1, 5), ("z", 1, 4), ("y", 2, 9)], "x string, k int, o int")
    got = aggregates.first_per_key(frame, "k", ["o"])
    assert got.columns == ["x", "k", "o"] and rows(got) == [("y", 2, 9), ("z", 1, 4)]
    ties = frame.where("o = 5")
    assert rows(aggregates.first_per_key(ties, "k", ["o"])) == [("a", 1, 5)]


def test_dim_with_count_keeps_null(spark):
    dim = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    facts = spark.createDataFrame([("a",), ("a",), (None,), ("x",)], "f string")
    assert rows(aggregates.dim_with_count(dim, "k", facts, "f", "n")) == [(None, None), ("a", 2), ("b", None)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_dense_ids(spark, partitions):
    frame = spark.range(0, 500, 1, partitions).select((F.col("id") * 37 % 500).alias("v"))
    got = rows(keys.with_dense_id(frame, "n", ["v"], start=10))
    assert sorted(got) == [(v + 10, v) for v in range(500)]


def test_dense_ids_of_equal_and_no_rows(spark):
    same = spark.range(0, 300, 1, 6).select(F.lit(1).alias("v"))
    assert sorted(keys.with_dense_id(same, "n", ["v"]).toPandas()["n"]) == list(range(1, 301))
    assert keys.with_dense_id(same.where("v = 2"), "n", ["v"]).count() == 0


def test_unique_ids(spark):
    got = keys.with_row_id(spark.range(0, 100, 1, 5), "n", start=50).toPandas()["n"]
    assert got.nunique() == 100 and got.min() == 50
    assert keys.next_id(None, "n") == 1
    assert keys.next_id(spark.range(5), "id") == 5
    assert keys.next_id(spark.range(0), "id") == 1
    assert keys.next_id(spark.range(1 << 62, (1 << 62) + 1), "id") == 1


@pytest.mark.parametrize("limit", ["10485760b", "-1"])
def test_fk_orphans(spark, limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        child = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (4, "x")], "r int, f string")
        parent = spark.createDataFrame([("a",), ("a",), (None,)], "p string")
        assert rows(quality.fk_orphans(child, "f", parent, "p", hot_rows=1)) == [(2, "x"), (4, "x")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_constraint_report(spark):
    tables = {
        "child": spark.createDataFrame([(1, "a"), (1, "x"), (None, None), (4, "x")], "id int, f string"),
        "parent": spark.createDataFrame([("a", None), ("b", None), ("b", "u")], "p string, u string"),
    }
    report = quality.constraint_report(
        tables, {"child": "id", "parent": "p"}, {"parent": "u"}, [("child", "f", "parent", "p")])
    assert rows(report) == [
        ("foreign", "child.f -> parent.p", 1, 2), ("primary", "child.id", 2, 3),
        ("primary", "parent.p", 1, 2), ("unique", "parent.u", 0, 0)]
