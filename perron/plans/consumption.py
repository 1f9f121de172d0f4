"""Curated tables to the published star schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from perron.model.tables import CONSUMPTION, FOREIGN_KEYS, PRIMARY_KEYS, UNIQUE_KEYS
from perron.operators.aggregates import dim_with_count
from perron.operators.joins import HOT_ROWS, star_join
from perron.operators.keys import with_row_id
from perron.operators.projection import conform, drop_null_keys
from perron.operators.quality import constraint_report
from perron.operators.summaries import Summary, settled
from perron.operators.tallies import Tally

# Dimensions that are their curated table less the rows without a key.
PLAIN_DIMENSIONS = {
    "accessibility_dim": "curated_accessibility",
    "business_types_dim": "curated_business_types",
    "lines_dim": "curated_line_data",
    "municipality_dim": "curated_municipality_data",
    "occupancy_dim": "curated_occupancy",
    "parking_dim": "curated_parking",
    "stops_dim": "curated_stop_data",
    "transport_types_dim": "curated_transport_types",
}


def transport_fact(curated_transport: DataFrame, start: int = 1) -> DataFrame:
    """All stop calls under new ids."""
    return conform(with_row_id(curated_transport.drop("id"), "id", start), CONSUMPTION["transport_fact"])


def plain_dimension(table: str, curated: DataFrame) -> DataFrame:
    return conform(drop_null_keys(curated, PRIMARY_KEYS[table]), CONSUMPTION[table])


def operators_dim(
    curated_operators: DataFrame, fact: DataFrame, hot_rows: int = HOT_ROWS, tally: Tally | None = None
) -> DataFrame:
    """Operators with their number of stop calls. Rows without an abbreviation stay."""
    counted = dim_with_count(
        curated_operators, "abbreviation", fact, "operator_abbr", "trips_count", hot_rows, tally
    )
    return conform(counted, CONSUMPTION["operators_dim"])


def vehicles_dim(
    curated_vehicles: DataFrame, fact: DataFrame, hot_rows: int = HOT_ROWS, tally: Tally | None = None
) -> DataFrame:
    """Vehicles with their number of stop calls."""
    keyed = drop_null_keys(curated_vehicles, PRIMARY_KEYS["vehicles_dim"])
    counted = dim_with_count(keyed, "vehicle_id", fact, "vehicle_id", "vehicle_trips_count", hot_rows, tally)
    return conform(counted, CONSUMPTION["vehicles_dim"])


def dimension(
    table: str, curated: Callable[[str], DataFrame], fact: DataFrame, tally: Tally | None = None
) -> DataFrame:
    """A dimension by name, from curated tables given by name; `tally` is that of the fact."""
    if table == "operators_dim":
        return operators_dim(curated("curated_operators"), fact, tally=tally)
    if table == "vehicles_dim":
        return vehicles_dim(curated("curated_vehicles"), fact, tally=tally)
    return plain_dimension(table, curated(PLAIN_DIMENSIONS[table]))


def violations(published: dict[str, DataFrame], tallies: dict[str, Tally | None] | None = None) -> DataFrame:
    """Every declared primary, unique and foreign key with what violates it.

    `tallies` are those of the tables, as `Tables` has them: what they tell of is not read.
    """
    return constraint_report(published, PRIMARY_KEYS, UNIQUE_KEYS, FOREIGN_KEYS, tallies)


def flat_view(
    published: dict[str, DataFrame], columns: dict[str, list[str]], known: dict[str, Summary | None] | None = None
) -> DataFrame:
    """The fact with columns of the dimensions around it, along the declared foreign keys.

    `columns` lists what to take from each dimension; the result calls them `<dimension>_<column>`.
    Dimensions of dimensions are joined to these first, so the fact is joined to four at most. Such a join is
    written to the shared folder once. `known` are summaries of the tables, as `Tables` has them: a table that has one is
    read only by the join itself, one without is read before to be measured.
    """
    known = known or {}

    def edges(child: str) -> list[tuple[str, DataFrame, str, Summary | None]]:
        found = []
        for table, key, parent, parent_key in FOREIGN_KEYS:
            if table == child and wanted(parent):
                dimension, summary = extended(parent)
                found.append((column_of(child, key), dimension, f"__{parent}_key", summary))
        return found

    def wanted(table: str) -> bool:
        below = [parent for child, _, parent, _ in FOREIGN_KEYS if child == table]
        return table in columns or any(wanted(parent) for parent in below)

    def column_of(table: str, key: str) -> str:
        return key if table == "transport_fact" else f"__{table}_{key}_fk"

    def extended(table: str) -> tuple[DataFrame, Summary | None]:
        frame = published[table]
        keys = [key for child, key, parent, _ in FOREIGN_KEYS if child == table and wanted(parent)]
        key = f"__{table}_key"
        names = {key: PRIMARY_KEYS[table]}
        names |= {column_of(table, name): name for name in keys}
        names |= {f"{table}_{name}": name for name in columns.get(table, [])}
        picked = frame.select(*[frame[old].alias(new) for new, old in names.items()])
        summary = known.get(table)
        summary = summary and summary.renamed(names)
        below = edges(table)
        if not below:
            return picked, summary
        return settled(star_join(picked, below, known=summary), table, key)

    flat = star_join(published["transport_fact"], edges("transport_fact"), known=known.get("transport_fact"))
    return flat.select(*[name for name in flat.columns if not name.startswith("__")])
