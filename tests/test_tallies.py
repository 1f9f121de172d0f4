"""Counts of key values that add up over the parts of a table, and what is told by them without reading it."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from perron.model.tables import CONSUMPTION, CURATED
from perron.operators.aggregates import dim_with_count
from perron.operators.quality import constraint_report
from perron.operators.tallies import added, read_tally, write_tally
from perron.plans.consumption import violations
from perron.plans.refresh import create_tables, publish_star, published

KEYS = {"primary": {"fact": "id", "dim": "k"}, "unique": {"fact": "id"}, "foreign": [("fact", "k", "dim", "k")]}


def tallied(spark, frame, path, counted=("k",), alone=("id",)):
    text = write_tally(frame, lambda counts: counts.write.parquet(str(path)), counted, alone)
    return read_tally(spark.read.parquet(str(path)), text)


def calls(spark, *rows_):
    return spark.createDataFrame(list(rows_), "id long, k string")


def report(tables, tallies=None):
    return rows(constraint_report(tables, **KEYS, tallies=tallies))


def unread(frame):
    """Rows that fail whoever reads them."""
    return frame.select(*[F.raise_error(F.lit("read")).cast(f.dataType).alias(f.name) for f in frame.schema])


@pytest.fixture
def parts(spark):
    """Repeated ids and NULLs in each part, ids apart; a value that no dimension has in both."""
    return (
        calls(spark, (1, "a"), (2, "a"), (2, None), (3, "x"), (None, "a")),
        calls(spark, (10, "b"), (11, "x"), (11, "b"), (11, ""), (None, None)),
    )


def test_added_tallies_tell_what_the_rows_tell(spark, tmp_path, parts):
    dim = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("c",)], "k string")
    whole = parts[0].unionByName(parts[1])
    tally = added([tallied(spark, part, tmp_path / str(n)) for n, part in enumerate(parts)])
    want = report({"fact": whole, "dim": dim})
    assert ("foreign", "fact.k -> dim.k", 2, 3) in want and ("primary", "fact.id", 3, 7) in want
    assert report({"fact": unread(whole), "dim": dim}, {"fact": tally}) == want
    counted = dim_with_count(dim.distinct(), "k", unread(whole), "k", "n", tally=tally)
    assert rows(counted) == rows(dim_with_count(dim.distinct(), "k", whole, "k", "n"))
    assert rows(counted) == [(None, None), ("a", 3), ("b", 2), ("c", None)]


def test_only_faults_of_a_lone_key_are_kept(spark, tmp_path, parts):
    tally = tallied(spark, parts[1], tmp_path / "t")
    assert rows(tally.counts.where("column = 'id'"), "value", "rows") == [(None, 1), ("11", 3)]
    assert tally.faults == {"id": [(10, 11)]} and tally.tells("id", alone=True) and not tally.tells("id", alone=False)


def test_overlapping_parts_are_read(spark, tmp_path):
    parts = calls(spark, (1, "a"), (5, "a")), calls(spark, (5, "b"), (9, "b"))
    tally = added([tallied(spark, part, tmp_path / str(n)) for n, part in enumerate(parts)])
    assert not tally.tells("id", alone=True)
    whole, dim = parts[0].unionByName(parts[1]), calls(spark, (1, "a"), (2, "b"))
    got = report({"fact": whole, "dim": dim}, {"fact": tally})
    assert got == report({"fact": whole, "dim": dim}) and ("primary", "fact.id", 1, 2) in got


def test_no_rows_and_one_value(spark, tmp_path):
    none = calls(spark).where("id > 0")
    same = spark.range(5000).select(F.lit(None).cast("long").alias("id"), F.lit("a").alias("k"))
    empty, hot = tallied(spark, none, tmp_path / "a"), tallied(spark, same, tmp_path / "b")
    assert rows(empty.counts) == [] and empty.faults == {"id": []}
    assert rows(hot.counts, "column", "value", "rows") == [("id", None, 5000), ("k", "a", 5000)]
    both, dim = added([empty, hot]), calls(spark, (1, "a"))
    assert report({"fact": unread(same), "dim": dim}, {"fact": both}) == report({"fact": same, "dim": dim})


def test_odd_names_and_types(spark, tmp_path):
    frame = spark.sql("select 'x' as `a.b`, 1.5 as d, cast(3 as int) as value")
    tally = tallied(spark, frame, tmp_path / "a", ["a.b", "value"], [])
    assert rows(tally.counts, "column", "value", "rows") == [("a.b", "x", 1), ("value", "3", 1)]
    assert rows(tally.per_value("value", frame.schema["value"].dataType, "k", "n")) == [(3, 1)]
    for counted, alone in ((["d"], []), ([], ["a.b"])):
        with pytest.raises(TypeError):
            tallied(spark, frame, tmp_path / "b", counted, alone)
    with pytest.raises(KeyError):
        tally.per_value("d", frame.schema["d"].dataType, "k", "n")


def test_parts_that_differ(spark, tmp_path, parts):
    first, second = tallied(spark, parts[0], tmp_path / "a"), tallied(spark, parts[1], tmp_path / "b", ["id"], [])
    assert added([first, None]) is None and added([]) is None
    both = added([first, second])
    assert both.counted == frozenset() and both.faults == {}


def star(spark, operators=("A", "B"), calls=()):
    """Curated tables: calls as (operator, day of January), and what else there is."""
    found = {table: spark.createDataFrame([], schema) for table, schema in CURATED.items()}
    found["curated_operators"] = _filled(spark, "curated_operators", "abbreviation string", [(o,) for o in operators])
    days = [(operator, f"2024-01-{day:02}") for operator, day in calls]
    found["curated_transport"] = _filled(spark, "curated_transport", "operator_abbr string, date string", days)
    return found.__getitem__


def _filled(spark, table, some, rows_):
    frame = spark.createDataFrame(rows_, some)
    wanted = spark.createDataFrame([], CURATED[table]).schema
    return frame.select(
        *[(F.col(f.name) if f.name in frame.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted]
    )


def counts(warehouse):
    return rows(published(warehouse)["operators_dim"], "abbreviation", "trips_count")


def test_additions_to_the_star(spark, warehouse, monkeypatch):
    create_tables(warehouse)
    publish_star(warehouse, star(spark, calls=[("A", 1), ("A", 1), ("C", 2)]), add=True)
    assert counts(warehouse) == [("A", 2), ("B", None)]
    publish_star(warehouse, star(spark, ("A", "C"), calls=[("A", 3), ("D", 3), (None, 3)]), add=True)
    publish_star(warehouse, star(spark, ("A", "C"), calls=[]), add=True)
    assert counts(warehouse) == [("A", 3), ("C", 1)]
    tables = published(warehouse)
    fact = tables["transport_fact"]
    assert fact.count() == fact.select("id").distinct().count() == 6
    assert rows(fact, "operator_abbr") == [(None,), ("A",), ("A",), ("A",), ("C",), ("D",)]
    # By SQL as by release, and what is known is of all parts.
    assert rows(spark.table(warehouse.name("consumption", "transport_fact"))) == rows(fact)
    assert tables.known["transport_fact"].rows == 6
    blind = {**tables, "transport_fact": unread(fact)}
    assert rows(violations(blind, tables.tallies)) == rows(violations(tables))

    # A release that fails adds nothing, and the next goes on from the last.
    def lost(table):
        if table == "curated_operators":
            raise LookupError(table)
        return star(spark, calls=[("A", 4)])(table)

    with pytest.raises(LookupError):
        publish_star(warehouse, lost, add=True)
    assert counts(warehouse) == [("A", 3), ("C", 1)] and published(warehouse)["transport_fact"].count() == 6

    # After so many additions all is written as one snapshot; a release without `add` begins anew.
    monkeypatch.setattr("perron.sinks.warehouse.PARTS", 2)
    publish_star(warehouse, star(spark, ("A",), calls=[("A", 5)]), add=True)
    assert counts(warehouse) == [("A", 4)]
    text = warehouse._branches("consumption", "transport_fact")
    assert text[max(text)].count("transport_fact__") == 1
    publish_star(warehouse, star(spark, ("A",), calls=[("A", 6)]))
    assert counts(warehouse) == [("A", 1)] and published(warehouse)["transport_fact"].count() == 1
    # Tallies go with their snapshots: those of this release and the last are left.
    assert len(os.listdir(f"{warehouse.root}/_tallies/{warehouse.database('consumption')}")) == 2


def test_an_addition_alone_is_written(spark, warehouse):
    schema = CONSUMPTION["municipality_dim"]
    for release_number, value in enumerate((1, 2, 3)):
        with warehouse.release("consumption", ["municipality_dim"]) as release:
            more = spark.createDataFrame([(value, None)], schema)
            release.append("municipality_dim", more, schema, counted=["municipality_id"])
            snapshot = release.written["municipality_dim"][0]
            assert warehouse.read("consumption", snapshot).count() == 1
            assert release.read("municipality_dim").count() == release_number + 1
            assert release.tally("municipality_dim").counts.count() == release_number + 1
    # Another layout is not added to.
    with pytest.raises(ValueError, match="other columns"), warehouse.release("consumption", ["municipality_dim"]) as release:
        release.append("municipality_dim", spark.createDataFrame([(4,)], "municipality_id long"), "municipality_id bigint")
    got = warehouse.released("consumption", ["municipality_dim"])["municipality_dim"]
    assert rows(got, "municipality_id") == [(1,), (2,), (3,)]


def test_columns_are_counted_one_by_one(spark, tmp_path, parts):
    """No aggregate holds values of several columns, and none is keyed by the ids, of which only blocks are counted."""
    plans = []

    def write(counts):
        plans.append(counts._jdf.queryExecution().optimizedPlan().toString())
        counts.write.parquet(str(tmp_path / "t"))

    frame = spark.range(-500, 500).select("id", F.lit("a").alias("k"))
    text = write_tally(frame, write, ["k"], ["id"])
    tally = read_tally(spark.read.parquet(str(tmp_path / "t")), text)
    assert "Generate" not in plans[0] and rows(tally.counts, "column", "value", "rows") == [("k", "a", 1000)]
    assert tally.faults == {"id": [(-500, 499)]} and tally.tells("id", alone=True)


def test_repeated_numbers_are_found_at_the_ends(spark, tmp_path):
    ends = [-(2**63), -(2**63), -1, 0, 63, 64, 64, 64, 2**63 - 1, 2**63 - 1, None]
    frame = spark.createDataFrame([(n, None) for n in ends], "id long, k string")
    tally = tallied(spark, frame, tmp_path / "t", [])
    want = [(None, 1), ("-9223372036854775808", 2), ("64", 3), ("9223372036854775807", 2)]
    assert rows(tally.counts, "value", "rows") == want and tally.faults == {"id": [(-(2**63), 2**63 - 1)]}


def test_shared_keys_are_told_by_the_tally(spark, warehouse, monkeypatch):
    monkeypatch.setattr("perron.sinks.warehouse.HOT_ROWS", 10)
    monkeypatch.setattr("perron.operators.summaries.shared_keys", lambda *_: pytest.fail("looked at"))
    create_tables(warehouse)
    publish_star(warehouse, star(spark, calls=[("A", 1), ("A", 1), ("C", 2), (None, 3)] * 5), [])
    known = published(warehouse).known["transport_fact"]
    assert known.rows == 20 and known.keys["operator_abbr"] == {"A": 10, "C": 5, None: 5}
    assert known.keys["stop_id"] == {None: 20}


def test_snapshots_and_tallies_are_packed(spark, warehouse):
    create_tables(warehouse)
    publish_star(warehouse, star(spark, calls=[("A", 1)]), [])
    for folder in (f"{warehouse.root}/_tallies", f"{warehouse.root}/consumption"):
        names = [n for _, _, files in os.walk(folder) for n in files if n.endswith(".parquet")]
        assert names and all(".zstd." in name for name in names)
