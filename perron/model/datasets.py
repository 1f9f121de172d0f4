"""Which files arrive how often, where they land and which table they fill."""

from __future__ import annotations

from dataclasses import dataclass

from perron.model import tables
from perron.model.tables import Field


@dataclass(frozen=True)
class Delimited:
    """A `;` separated dataset. `multi_line=None` looks at the files first, see `read_delimited`."""

    table: str
    folder: str
    columns: list[Field]
    id_column: str | None = None
    multi_line: bool | None = None

    @property
    def schema(self) -> str:
        return (f"{self.id_column} bigint, " if self.id_column else "") + tables.ddl(self.columns)


@dataclass(frozen=True)
class Document:
    """A JSON dataset: the documents fill `staging`, their features fill `table`."""

    table: str
    folder: str
    staging: str
    paths: dict[str, str]
    sizes: tuple[str, ...] = ()
    layout: str = "document"

    @property
    def schema(self) -> str:
        return ", ".join(f"{name} bigint" for name in self.paths)


# The landing folders, grouped by how often their files arrive.
DATASETS = {
    "daily": [
        Delimited("raw_transport", "daily", tables.TRANSPORT, id_column="id"),
    ],
    "weekly": [
        Delimited("raw_line_data", "weekly/line_files", tables.LINE_DATA),
        Delimited("raw_accessibility_1", "weekly/bfr_files", tables.ACCESSIBILITY_1),
        Delimited("raw_toilets", "weekly/full_toilet_files", tables.TOILETS),
        Delimited("raw_accessibility_2", "weekly/platform_files", tables.ACCESSIBILITY_2),
        Delimited("raw_stop_data", "weekly/bav_files", tables.STOP_DATA),
        Delimited("raw_operators", "weekly/org_files", tables.OPERATORS),
    ],
    "monthly": [
        Document(
            "raw_bike_parking_data", "monthly/bike_files", "raw_json_bike_parking",
            tables.BIKE_PARKING_PATHS,
        ),
        Delimited("raw_transport_subtypes", "monthly/tsub_files", tables.TRANSPORT_SUBTYPES),
        Document(
            "raw_parking_data", "monthly/parking_files", "raw_json_parking",
            tables.PARKING_PATHS, sizes=("days_open",),
        ),
        Delimited("raw_transport_types", "monthly/tmode_files", tables.TRANSPORT_TYPES),
    ],
    "yearly": [
        Delimited("raw_occupancy_data", "yearly/occupancy_files", tables.OCCUPANCY_DATA),
    ],
}

BY_TABLE = {dataset.table: dataset for group in DATASETS.values() for dataset in group}
