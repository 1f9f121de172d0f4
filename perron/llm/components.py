"""Connected components of a graph too large for one machine, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perron.session import scratch


def connected_components(links: DataFrame) -> DataFrame:
    """Rows (`node`, `component`), the least node of each component, for every node of `links` (`a`, `b`: bigint).

    Each round hangs a node's larger neighbours, and then its smaller ones, on the least of them, until every
    component is a star around its least node. Every step is written to the shared folder, which cuts lineage and
    lets the adaptive planner split a node with very many links.
    """
    spark = links.sparkSession
    folder = scratch(spark, "components")
    rounds = 0

    def written(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}-{rounds}")
        return spark.read.parquet(f"{folder}/{name}-{rounds}")

    def least(frame: DataFrame, name: str) -> DataFrame:
        return written(frame.groupBy("u").agg(F.min("v").alias("m")), name)

    def state(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = written(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    before = state(edges)
    while before[0]:
        rounds += 1
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = least(both, "large").select("u", F.least("m", "u").alias("m"))
        larger = written(
            both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "hung"
        )
        lowest = least(larger, "small")
        smaller = larger.join(lowest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(smaller.union(lowest.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
