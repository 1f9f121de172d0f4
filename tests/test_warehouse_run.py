"""The whole way from landing files to the star schema, with hand-checked rows."""

from datetime import date, datetime
from decimal import Decimal

import pytest

import landing
from conftest import rows
from perron.model.datasets import BY_TABLE
from perron.model.tables import CONSUMPTION, CURATED, RAW
from perron.plans.consumption import flat_view, violations
from perron.plans.raw import load_dataset
from perron.plans.refresh import create_tables, ingest, published, refresh_consumption, refresh_curated, run_all
from perron.sinks.warehouse import Warehouse


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    files = landing.write(root / "landing")
    warehouse = Warehouse(spark, str(root / "tables"), prefix="run_")
    run_all(warehouse, files)
    return warehouse


def raw(built, table, *columns):
    return rows(built.read("raw", table), *columns)


def test_transport_rows_and_rejects(built):
    ids = [r[0] for r in raw(built, "raw_transport", "trip_id")]
    assert ids == sorted(
        [None, "", "from-gzip", "no-forecast", "no-operator", "on-off", 'semi;colon "quoted"\nnext line',
         "short-row", "t1", "too-long"], key=lambda v: (v is not None, str(v)))
    rejected = [(r["reasons"], r["cells"][1]) for r in built.rejects("raw", "raw_transport").collect()]
    assert sorted(rejected) == [
        (["arrival_time"], "unpadded"), (["date"], "bad-date"), (["stop_id"], "huge-id"),
        (["stop_id"], "quoted-empty-number"), (["transit"], "bad-flag"),
    ]
    assert all(r[0].endswith("a.csv") for r in built.rejects("raw", "raw_transport").select("source_file").collect())


def test_transport_values(built):
    call = built.read("raw", "raw_transport").where("trip_id = 't1'").first()
    assert call["date"] == date(2024, 1, 31)
    assert call["arrival_time"] == datetime(2024, 1, 31, 5, 7)
    assert call["arrival_prognose"] == datetime(2024, 1, 31, 5, 7, 9)
    assert (call["additional_trip"], call["was_cancelled"], call["transit"]) == (False, True, False)
    on = built.read("raw", "raw_transport").where("trip_id = 'on-off'").first()
    assert (on["additional_trip"], on["was_cancelled"], on["transit"]) == (True, False, True)
    assert built.read("raw", "raw_transport").where("trip_id = ''").first()["stop_id"] == 8503001
    short = built.read("raw", "raw_transport").where("trip_id = 'short-row'").first()
    assert short["date"] == date(2024, 2, 1) and short["stop_id"] is None


def test_ids_are_unique_and_grow_over_reloads(built, spark, tmp_path):
    first = raw(built, "raw_transport", "id")
    assert len({r[0] for r in first}) == len(first)
    other = Warehouse(spark, str(tmp_path / "tables"), prefix="grow_")
    files = landing.write(tmp_path / "landing", ["daily"])
    load_dataset(other, BY_TABLE["raw_transport"], files)
    before = max(r[0] for r in rows(other.read("raw", "raw_transport"), "id"))
    load_dataset(other, BY_TABLE["raw_transport"], files)
    after = rows(other.read("raw", "raw_transport"), "id")
    assert len(after) == len(first) and min(r[0] for r in after) > before


def test_other_rejects(built):
    assert [r["reasons"] for r in built.rejects("raw", "raw_operators").collect()] == [["organisation_number"]]
    assert [r["reasons"] for r in built.rejects("raw", "raw_accessibility_2").collect()] == [["inclination"]]
    assert [r["reasons"] for r in built.rejects("raw", "raw_occupancy_data").collect()] == [["year"]]
    assert raw(built, "raw_accessibility_2", "sloid", "height") == [("both", Decimal("35.3")), ("right", Decimal("55.0"))]


def test_parking(built):
    assert raw(built, "raw_parking_data") == [
        (8500010,) + (None,) * 11,
        (8500099,) + (None,) * 11,
        (8503000, 1, 24, 3, 1, 70, 700, 2, 10, 2, None, None),
    ]
    assert raw(built, "raw_bike_parking_data") == [
        (None, 3), (8500010, 4), (8503000, 10), (8503000, 15), (8599999, 1)]
    assert rows(built.read("curated", "curated_parking"), "stop_id", "max_day_price", "capacity_bike") == [
        (8500010, None, 4), (8503000, 3, 13)]


def test_curated_accessibility(built):
    got = rows(built.read("curated", "curated_accessibility"), "sloid", "t_autonomy", "platform",
               "parent_sloid", "height", "toilet_designation")
    assert got == [
        (None, None, None, "p2", Decimal("55.0"), None),
        (None, True, "keyless", None, None, None),
        ("both", True, "p", "p1", Decimal("35.3"), "north"),
        ("both", True, "p", "p1", Decimal("35.3"), "south"),
        ("left", False, None, None, None, None),
    ]
    assert rows(built.read("consumption", "accessibility_dim"), "sloid") == [("both",), ("both",), ("left",)]


def test_curated_vehicles_and_types(built):
    assert rows(built.read("curated", "curated_vehicles"), "vehicle_id", "international", "public_use",
                "ref_netex_transportsubmode") == [
        (None, False, False, None), ("IC", False, False, "rail"), ("S", True, False, "sub urban")]
    assert rows(built.read("curated", "curated_transport_types"), "transport_type_id", "international") == [
        (None, True), ("T1", False)]


def test_curated_lines(built):
    assert rows(built.read("curated", "curated_line_data"), "slnid", "departure_station",
                "final_destination", "midstation_count") == [
        ("s1", "A", " B", 0), ("s2", "A", " C", 1), ("s3", "None", "None", 0), ("s4", "None", "None", 0),
        ("s5", "None", "None", 0), ("s6", "Q", " S", 1), ("s7", "X", " Y", 0)]
    assert rows(built.read("consumption", "lines_dim"), "line_id") == [("L1",), ("L1",), ("L2",), ("L3",), ("L4",), ("L5",)]


def test_curated_operators_and_business(built):
    assert rows(built.read("curated", "curated_operators"), "sboid", "company_name", "business_type_id") == [
        ("b1", "Federal", "10"), ("b2", "Bus", "20"), ("b4", "", None), ("b5", "No abbreviation", "10")]
    assert rows(built.read("curated", "curated_business_types"), "business_type_id", "business_type_de") == [
        ("10", "Zug"), ("20", "Bus")]


def test_curated_stops(built):
    assert rows(built.read("curated", "curated_stop_data"), "stop_id", "stop_abbr", "coord_e", "sloid") == [
        (None, None, None, None),
        (8500010, "BS", None, "ch:1:sloid:10"),
        (8503000, "ZG", 2681000.5, "ch:1:sloid:3000"),
        (8503000, "ZUG", 2681000.5, "ch:1:sloid:3000"),
        (8700001, None, None, "ch:1:sloid:200001"),
    ]
    assert rows(built.read("curated", "curated_municipality_data")) == [
        (None, None), (None, "Nowhere"), (7, "Zug"), (8, "Basel")]
    assert rows(built.read("consumption", "municipality_dim")) == [(7, "Zug"), (8, "Basel")]


def test_curated_occupancy(built):
    assert rows(built.read("curated", "curated_occupancy")) == [
        (8503000, 11500, 11000, None, 11499, 10998, None),
        (8503000, 11500, 11000, None, 1500, -1000, None),
    ]


def test_usage_counts(built):
    assert rows(built.read("consumption", "operators_dim"), "abbreviation", "trips_count") == [
        (None, None), ("PAG", None), ("SBB", 8), ("ZZZ", None)]
    assert rows(built.read("consumption", "vehicles_dim"), "vehicle_id", "vehicle_trips_count") == [
        ("IC", 7), ("S", 1)]


def test_schemas(built):
    for layer, tables in (("raw", RAW), ("curated", CURATED), ("consumption", CONSUMPTION)):
        for table, ddl in tables.items():
            expected = built.spark.createDataFrame([], ddl).schema
            got = built.read(layer, table).schema
            assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in expected], table


def test_violations(built):
    found = {r["target"]: (r["bad_keys"], r["bad_rows"]) for r in violations(published(built)).collect()}
    assert len(found) == 11 + 2 + 10
    assert found["accessibility_dim.sloid"] == (1, 2)
    assert found["operators_dim.abbreviation"] == (1, 1)
    assert found["operators_dim.sboid"] == (0, 0)
    assert found["transport_fact.vehicle_id -> vehicles_dim.vehicle_id"] == (1, 1)
    assert found["lines_dim.line_id"] == (1, 2)
    assert found["stops_dim.stop_id"] == (1, 2)


def test_flat_view(built):
    flat = flat_view(published(built), {
        "operators_dim": ["company_name"], "business_types_dim": ["business_type_de"],
        "municipality_dim": ["municipality"], "transport_types_dim": ["transport_type"]})
    call = flat.where("trip_id = 'on-off'").select(
        "operators_dim_company_name", "business_types_dim_business_type_de",
        "municipality_dim_municipality", "transport_types_dim_transport_type").distinct()
    assert rows(call) == [("Federal", "Zug", "Zug", "Train")]
    assert "id" in flat.columns


def test_running_again_changes_nothing(built, spark):
    before = {t: rows(built.read("consumption", t).drop("id")) for t in CONSUMPTION}
    refresh_curated(built)
    refresh_consumption(built)
    assert before == {t: rows(built.read("consumption", t).drop("id")) for t in CONSUMPTION}
    refresh_consumption(built)
    tables = spark.sql("show tables in run_consumption like 'transport_fact__*'").collect()
    assert len(tables) == 2


def test_ingest_by_frequency(warehouse, tmp_path):
    files = landing.write(tmp_path / "landing")
    assert ingest(warehouse, files, "monthly") == [
        "raw_bike_parking_data", "raw_transport_subtypes", "raw_parking_data", "raw_transport_types"]
    assert not warehouse.exists("raw", "raw_transport")


def test_refresh_before_every_file_has_come(warehouse, tmp_path):
    create_tables(warehouse)
    ingest(warehouse, landing.write(tmp_path / "landing"), "daily")
    refresh_curated(warehouse)
    refresh_consumption(warehouse)
    counts = {table: frame.count() for table, frame in published(warehouse).items()}
    assert counts.pop("transport_fact") == 10 and set(counts.values()) == {0}
    create_tables(warehouse)
    assert warehouse.read("consumption", "transport_fact").count() == 10
