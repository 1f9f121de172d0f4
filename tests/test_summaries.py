"""What is known of written rows, and joins that are laid out by it without reading."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from perron.operators.joins import fits_broadcast, hot_keys, sized_join, star_join
from perron.operators.summaries import KEPT, Summary, merged, settled, shared_keys, write_summarised
from perron.plans.consumption import flat_view
from perron.plans.refresh import join_keys


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def jobs(spark):
    """How many jobs have run since the test began."""
    group = f"summaries-{id(object())}"
    spark.sparkContext.setJobGroup(group, "")
    yield lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def skewed(spark, n=3000):
    """A third of the rows under 7, a third under NULL."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id"))
    return spark.range(n).select(key.alias("k"), F.concat(F.lit("t"), F.col("id") % 2).alias("s"), F.col("id").alias("v"))


def written(spark, frame, path, **options):
    def write(rows):
        rows.write.parquet(str(path))
        return spark.read.parquet(str(path))

    return write_summarised(frame, write, **options)


def test_summary_of_what_was_written(spark, tmp_path):
    frame = skewed(spark)
    stored, known = written(spark, frame, tmp_path / "a", keys=["k", "s"], hot_rows=10)
    assert rows(stored) == rows(frame)
    assert known.rows == 3000 and known.widths == {"k": 0, "s": 3000 * 10, "v": 0}
    # One row has its own number, 7.
    assert known.keys["k"] == {7: 1001, None: 1000}
    assert known.keys["s"] == {"t0": 1500, "t1": 1500}
    assert Summary.from_json(known.to_json()) == known
    assert known.size(["k", "s"]) == 3000 * (24 + 16) + 30000


def test_few_rows_are_not_looked_at(spark, tmp_path):
    assert written(spark, skewed(spark), tmp_path / "a", keys=["k"])[1].keys == {}


def test_no_rows(spark, tmp_path):
    for number, frame in enumerate((spark.createDataFrame([], "k long, s string"), skewed(spark).where("k < 0"))):
        stored, known = written(spark, frame, tmp_path / str(number), keys=["k"], hot_rows=0)
        assert (known.rows, known.keys, stored.count()) == (0, {}, 0)
        assert known.widths["s"] == 0 and fits_broadcast(stored, known=known)


def test_odd_columns(spark, tmp_path):
    frame = spark.sql("select array(1, 2) as `a.b`, cast(1.5 as decimal(4, 1)) as d, 'x' as `t.u`, null as n, date'2024-01-31' as e")
    stored, known = written(spark, frame.drop("n"), tmp_path / "a", keys=["d", "t.u", "e"], hot_rows=0)
    assert known.widths == {"d": 0, "t.u": 9, "e": 0} and known.keys == {"t.u": {"x": 1}}
    assert known.size(stored.columns) is None and known.size(["d", "t.u"]) == 40 + 9


def test_keys_of_many_rows_are_estimated(spark):
    frame = spark.range(0, 30_000_000, 1, 8).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    found = shared_keys(frame, ["k"], 30_000_000)["k"]
    assert set(found) == {-1} and found[-1] == pytest.approx(10_000_000, rel=0.05)


def test_a_projection_keeps_what_is_known():
    known = Summary(5, {"a": 10, "b": 0}, {"a": {"x": 3}})
    assert known.renamed({"c": "a", "d": "b", "e": "a"}) == Summary(5, {"c": 10, "d": 0, "e": 10}, {"c": {"x": 3}, "e": {"x": 3}})
    assert known.renamed({"c": "unknown"}).size(["c"]) is None


def test_parts_add_up():
    one, two = Summary(5, {"a": 10, "b": 0}, {"a": {"x": 3}, "b": {1: 2}}), Summary(7, {"a": 1}, {"a": {"x": 1, None: 4}})
    assert merged([one, two]) == Summary(12, {"a": 11}, {"a": {"x": 4, None: 4}})
    assert merged([one, None]) is None and merged([]) is None and merged([one]) == one


def test_hot_keys_by_summary(spark, jobs):
    known = Summary(900, {"k": 0}, {"k": {7: 400, None: 300, 8: 90}})
    frame = skewed(spark)
    # With 4 shuffle partitions a fair share is 225 rows.
    assert hot_keys(frame, "k", 10, known) == {7: 8, None: 6}
    assert hot_keys(frame, "k", 350, known) == {7: 5}
    assert hot_keys(frame, "k", 900, known) == {}
    assert jobs() == 0


def test_hot_keys_too_rare_for_the_summary_are_looked_for(spark, jobs):
    known = Summary(900, {"k": 0}, {"k": {}})
    spark.conf.set("spark.sql.shuffle.partitions", str(KEPT + 1))
    try:
        assert hot_keys(skewed(spark, 30), "k", hot_rows=9 / KEPT, known=known)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert jobs() > 0


@pytest.mark.parametrize("how", ["inner", "left", "full", "left_anti"])
def test_joins_by_summary_read_nothing_before_and_give_the_same(spark, no_broadcast, tmp_path, jobs, how):
    left, of_left = written(spark, skewed(spark, 60).select("k", "v"), tmp_path / "l", keys=["k"], hot_rows=1)
    right = skewed(spark, 12).select(F.col("k").alias("r"), F.col("s"))
    right, of_right = written(spark, right, tmp_path / "r", keys=["r"], hot_rows=1)
    before = jobs()
    got = sized_join(left, right, "k", "r", how, hot_rows=1, left_known=of_left, right_known=of_right)
    assert jobs() == before
    assert rows(got) == rows(left.join(right, left["k"] == right["r"], how))


def test_a_wrong_summary_costs_no_row(spark, no_broadcast):
    left, right = skewed(spark, 60).select("k", "v"), skewed(spark, 12).select(F.col("k").alias("r"), "s")
    wrong = Summary(10**9, {}, {"k": {1: 10**9, None: 5}, "r": {7: 10**9, 999: 10**9}})
    for how in ("inner", "left", "full", "left_anti"):
        got = sized_join(left, right, "k", "r", how, hot_rows=1, left_known=wrong, right_known=wrong)
        assert rows(got) == rows(left.join(right, left["k"] == right["r"], how))


def test_broadcast_by_summary(spark, jobs):
    small, large = Summary(10, {"b": 0}), Summary(10**7, {"b": 0})
    left, right = spark.range(10).withColumnRenamed("id", "a"), spark.range(10).withColumnRenamed("id", "b")
    joined = sized_join(left, right, "a", "b", "left", unique_left=True, right_known=small)
    assert "strategy=broadcast" in joined._jdf.queryExecution().optimizedPlan().toString() and jobs() == 0
    assert not fits_broadcast(right, known=large) and jobs() == 0


def test_star_join_by_summaries(spark, no_broadcast, jobs):
    fact, of_fact = settled(skewed(spark, 90).select("k", "s", "v"), "fact", "k", "s")
    first, of_first = settled(spark.createDataFrame([(7, "x"), (1, "y"), (1, "z")], "a long, b string"), "first", "a", "b")
    second, of_second = settled(spark.createDataFrame([("t0", 1), ("t0", 2)], "c string, d int"), "second", "c")
    before = jobs()
    edges = [("k", first, "a", of_first), ("s", second, "c", of_second)]
    got = star_join(fact, edges, known=of_fact)
    assert jobs() == before
    want = fact.join(first, fact["k"] == first["a"], "left").join(second, fact["s"] == second["c"], "left")
    assert rows(got) == rows(want)
    assert rows(star_join(fact, edges, hot_rows=1, known=of_fact)) == rows(want)


def _star(warehouse, spark, calls):
    """A release of three tables."""
    fact = "vehicle_id string, operator_abbr string, date date"
    with warehouse.release("consumption", ["transport_fact", "operators_dim", "business_types_dim"]) as release:
        frame = spark.createDataFrame([("v", "A", None)] * calls + [(None, None, None)], fact)
        release.write("transport_fact", frame, fact, keys=["operator_abbr"])
        operators = spark.createDataFrame([("A", "1"), ("B", None)], "abbreviation string, business_type_id string")
        release.write("operators_dim", operators, "abbreviation string, business_type_id string", keys=["abbreviation"])
        types = spark.createDataFrame([("1", "rail")], "business_type_id string, business_type_de string")
        release.write("business_types_dim", types, "business_type_id string, business_type_de string")


def test_released_tables_are_known_and_read_once(spark, warehouse, jobs):
    tables = ["transport_fact", "operators_dim", "business_types_dim"]
    _star(warehouse, spark, 3)
    _star(warehouse, spark, 5)
    star = warehouse.released("consumption", tables)
    assert {name: known.rows for name, known in star.known.items()} == dict(zip(tables, (6, 2, 1)))
    wanted = {"business_types_dim": ["business_type_de"]}
    before = jobs()
    flat = flat_view(star, wanted, star.known)
    # The one job writes the operators with their business types.
    assert jobs() - before <= 2
    assert rows(flat, "operator_abbr", "business_types_dim_business_type_de") == [(None, None)] + [("A", "rail")] * 5
    assert rows(flat_view(star, wanted)) == rows(flat)
    # What is known of a snapshot goes with it: those of this release and the last are left.
    _star(warehouse, spark, 1)
    folder = f"{warehouse.root}/_summaries/{warehouse.database('consumption')}"
    assert sum(not name.startswith(".") for name in os.listdir(folder)) == 6


def test_join_keys():
    assert join_keys("transport_fact") == ["vehicle_id", "operator_abbr", "line_id", "stop_id"]
    assert join_keys("stops_dim") == ["sloid", "municipality_id", "stop_id"]
    assert join_keys("parking_dim") == ["stop_id"]
