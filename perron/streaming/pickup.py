"""Files that arrive in a landing folder replace their raw table, each version of a file once.

A run takes all that has come since the last one as a single batch, which must hold the whole snapshot. A file is
known by its path, length and time of change, so new content under an old name is new. Which versions a table has taken is a
table of its own that is published with the snapshot, in one step: a run that fails, before or after that, leaves
either both or none. Without new versions the table stays as it is.
"""

from __future__ import annotations

from perron.model.datasets import DATASETS, Delimited, Document
from perron.plans.raw import landing_folder, load_files
from perron.sinks import warehouse as layers
from perron.sinks.warehouse import Warehouse
from perron.sources.files import VERSION, clear, literal, versions

_KEY = [field.split()[0] for field in VERSION.split(", ")]


def pick_up(
    warehouse: Warehouse, dataset: Delimited | Document, landing: str, archive: str | None = None, purge: bool = False
) -> bool:
    """One run over the landing folder of a dataset; whether it loaded anything.

    With `purge`, versions that the table has taken are deleted, with `archive` they are moved there; also those that an
    earlier run took and did not come to delete. What has changed since it was taken stays for the next run. The names of
    files come to the driver, as they do in any listing.
    """
    spark, folder = warehouse.spark, landing_folder(dataset, landing)
    since = warehouse.version(layers.RAW, dataset.table)
    lying = versions(spark, folder).collect()
    found = spark.createDataFrame(lying, VERSION)
    taken = warehouse.files(layers.RAW, dataset.table)
    fresh = found.join(taken, _KEY, "left_anti").collect()
    if fresh:
        # Versions that lie here no more cannot come again, so they need not be remembered.
        load_files(warehouse, dataset, sorted(literal(row["path"]) for row in fresh), files=found, since=since)
    if purge or archive:
        clear(spark, lying, archive)
    return bool(fresh)


def pick_up_all(
    warehouse: Warehouse, landing: str, frequency: str, archive: str | None = None, purge: bool = False
) -> list[str]:
    """Pick up what has come of every dataset of a frequency; the tables that were replaced."""
    return [
        dataset.table for dataset in DATASETS[frequency] if pick_up(warehouse, dataset, landing, archive, purge)
    ]
