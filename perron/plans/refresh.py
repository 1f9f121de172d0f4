"""Writing the three layers."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from perron.model.datasets import DATASETS
from perron.model.tables import CONSUMPTION, CURATED, FOREIGN_KEYS, PRIMARY_KEYS, RAW
from perron.operators.ranges import in_ranges
from perron.plans import consumption, curated
from perron.plans.raw import load_dataset
from perron.sinks import warehouse as layers
from perron.sinks.warehouse import Tables, Warehouse

T = TypeVar("T")

# Calls that one task sorts, some 300 MB.
SORTED = 1_000_000

DIMENSIONS = [table for table in CONSUMPTION if table != "transport_fact"]


def join_keys(table: str) -> list[str]:
    """The columns by which a published table is joined: what refers to others, and what others refer to."""
    above = [key for child, key, _, _ in FOREIGN_KEYS if child == table]
    referred = [parent_key for _, _, parent, parent_key in FOREIGN_KEYS if parent == table]
    return list(dict.fromkeys(above + referred))


def at_once(spark: SparkSession, work: Callable[[T], None], tables: Iterable[T], jobs: int = 4) -> None:
    """Tables that do not depend on each other, a few at a time; the first failure is raised.

    The threads take over the job group and pool of the caller.
    """
    with ThreadPoolExecutor(jobs) as pool:
        list(pool.map(inheritable_thread_target(spark)(work), tables))


def create_tables(warehouse: Warehouse) -> None:
    """Empty tables for all that do not exist yet, so that a refresh need not wait for every file."""
    layouts = {layers.RAW: RAW, layers.CURATED: CURATED, layers.CONSUMPTION: CONSUMPTION}
    missing = {
        (layer, table): schema
        for layer, tables in layouts.items()
        for table, schema in tables.items()
        if not warehouse.exists(layer, table)
    }

    def create(key: tuple[str, str]) -> None:
        warehouse.replace(*key, warehouse.spark.createDataFrame([], missing[key]), missing[key])

    at_once(warehouse.spark, create, missing)


def ingest(warehouse: Warehouse, landing: str, frequency: str, purge: bool = True) -> list[str]:
    """Load every dataset of a frequency from its landing folder; the datasets' tables.

    Loaded files are deleted, so that the next run does not load them again, see `load_dataset`; with `purge=False` they
    stay. `perron.streaming.pickup` keeps files and knows which it has loaded instead.
    """
    datasets = {dataset.table: dataset for dataset in DATASETS[frequency]}
    at_once(warehouse.spark, lambda table: load_dataset(warehouse, datasets[table], landing, purge), datasets)
    return list(datasets)


def refresh_curated(warehouse: Warehouse, tables: Iterable[str] = tuple(CURATED)) -> None:
    """Rebuild curated tables from the raw tables as they are."""

    def rebuild(table: str) -> None:
        build, sources = curated.BUILDERS[table]
        frame = build(*[warehouse.read(layers.RAW, source) for source in sources])
        warehouse.replace(layers.CURATED, table, frame, CURATED[table])

    at_once(warehouse.spark, rebuild, tables)


def by_day(calls: DataFrame) -> DataFrame:
    """Calls in ranges of day and stop."""
    return in_ranges(calls, ["date", "stop_id"], ["id"], SORTED)


def publish_star(
    warehouse: Warehouse,
    source: Callable[[str], DataFrame],
    dimensions: Iterable[str] = tuple(DIMENSIONS),
    add: bool = False,
) -> None:
    """Publish the fact and dimensions, from curated tables given by name, as one release.

    Usage counts are those of the new fact. Its ids go on from the fact that it replaces. Readers see all tables of one
    release or all of the next; a failure leaves the last. The fact lies in ranges of day and stop, so that a query of some
    days, or of a day's stops, reads those.

    With `add` the calls come to those of the last release, which are neither read nor written again: the keys of calls are
    counted when they are published, and usage counts are taken from these counts. Dimensions are always written whole.
    """
    fact = "transport_fact"
    first = warehouse.next_id(layers.CONSUMPTION, fact, "id")
    with warehouse.release(layers.CONSUMPTION, [fact, *dimensions]) as release:
        calls = consumption.transport_fact(source("curated_transport"), first)
        told = {"first_id": first, "keys": join_keys(fact), "counted": join_keys(fact), "alone": [PRIMARY_KEYS[fact]]}
        if add:
            release.append(fact, calls, CONSUMPTION[fact], **told, arrange=by_day)
        else:
            release.write(fact, by_day(calls), CONSUMPTION[fact], **told)
        written, tally = release.read(fact), release.tally(fact)

        def publish(table: str) -> None:
            frame = consumption.dimension(table, source, written, tally)
            release.write(table, frame, CONSUMPTION[table], keys=join_keys(table))

        at_once(warehouse.spark, publish, dimensions)


def refresh_consumption(warehouse: Warehouse, add: bool = False) -> None:
    """Publish everything from the curated tables as they are; with `add` the curated calls are new ones, see `publish_star`."""
    publish_star(warehouse, lambda table: warehouse.read(layers.CURATED, table), add=add)


def published(warehouse: Warehouse) -> Tables:
    """The star, all tables of one release, with what is known of them."""
    return warehouse.released(layers.CONSUMPTION, list(CONSUMPTION))


def run_all(warehouse: Warehouse, landing: str, purge: bool = True) -> None:
    """Load all landing folders and rebuild both layers above. Loaded files are deleted as by `ingest`."""
    for frequency in DATASETS:
        ingest(warehouse, landing, frequency, purge)
    refresh_curated(warehouse)
    refresh_consumption(warehouse)
