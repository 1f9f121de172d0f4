"""What a filter reads of rows that lie in ranges."""

from datetime import date

from pyspark.sql import functions as F

from conftest import rows
from perron.model.tables import CONSUMPTION
from perron.operators.projection import conform
from perron.operators.ranges import in_ranges
from perron.plans.refresh import publish_star


def read_of(frame):
    """The rows that the scan under a filter hands on, as its metrics tell, and those that the filter leaves."""
    left = len(frame.collect())
    scan = frame._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value(), left


def calls(spark, n, days):
    """Calls whose days come in no order; other columns are NULL."""
    frame = spark.range(0, n, 1, 8).select(
        F.col("id"), F.date_add(F.lit(date(2024, 1, 1)), (F.xxhash64("id") % days).cast("int")).alias("date"),
        (F.col("id") % 50).alias("stop_id"),
    )
    wanted = spark.createDataFrame([], CONSUMPTION["transport_fact"]).schema
    return conform(frame.withColumns({f.name: F.lit(None) for f in wanted if f.name not in frame.columns}), wanted)


def test_a_day_of_the_fact_reads_little(spark, warehouse):
    source = calls(spark, 1_000_000, 50)
    publish_star(warehouse, lambda table: source, [])
    fact = warehouse.released("consumption", ["transport_fact"])["transport_fact"]
    read, left = read_of(fact.where("date = date'2024-01-10'").select("id", "date"))
    assert 5_000 < left <= read < 100_000
    read, few = read_of(fact.where("date = date'2024-01-10' and stop_id = 7").select("id", "date", "stop_id"))
    assert 0 < few < left and read < 100_000
    # Without ranges all is read.
    source.write.parquet(f"{warehouse.root}/plain")
    plain = spark.read.parquet(f"{warehouse.root}/plain")
    assert read_of(plain.where("date = date'2024-01-10'").select("id", "date"))[0] == 1_000_000
    same = [c for c in fact.columns if c != "id"]
    assert rows(fact.groupBy(*same).count()) == rows(source.groupBy(*same).count())


def test_rows_of_one_value_are_split(spark):
    frame = spark.range(0, 40_000, 1, 8).select(F.lit(1).alias("d"), F.lit(None).cast("int").alias("s"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = in_ranges(frame, ["d", "s"], ["id"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 20_000


def test_nothing_is_lost(spark):
    frame = spark.createDataFrame([(None, 1), (2, None), (2, None), (1, 1)], "d int, s int")
    assert rows(in_ranges(frame, ["d"], ["s"])) == rows(frame)
    assert in_ranges(frame.limit(0), ["d"], ["s"]).count() == 0


def test_ranges_are_more_if_rows_are_many(spark):
    frame = spark.range(0, 40_000, 1, 8).select((F.col("id") % 7).alias("d"), "id")
    sizes = in_ranges(frame, ["d"], ["id"], 4_000).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 10 and max(r["count"] for r in sizes) < 8_000
    assert rows(in_ranges(frame, ["d"], ["id"], 4_000).groupBy("d").count()) == rows(frame.groupBy("d").count())
    assert in_ranges(frame.limit(0), ["d"], ["id"], 10).count() == 0
