"""Landing files to raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from perron.model.datasets import Delimited, Document
from perron.model.tables import RAW
from perron.operators.keys import with_row_id
from perron.sinks import warehouse as layers
from perron.sinks.warehouse import Warehouse
from perron.sources.delimited import positional_copy, read_delimited
from perron.sources.documents import check_features, read_documents
from perron.sources.files import landed, literal, remove


def landing_folder(dataset: Delimited | Document, landing: str) -> str:
    return f"{landing.rstrip('/')}/{dataset.folder}"


def load_files(
    warehouse: Warehouse,
    dataset: Delimited | Document,
    paths: list[str],
    files: DataFrame | None = None,
    since: frozenset[str] | None = None,
) -> None:
    """Replace a raw table by files or folders; rows that cannot be read go to its rejects.

    `files` are the versions that the table has taken from then on, see `pick_up`; `since` is the version of the table
    that the load began with.
    """
    spark = warehouse.spark
    since = warehouse.version(layers.RAW, dataset.table) if since is None else since
    if isinstance(dataset, Document):
        documents = read_documents(spark, paths, dataset.layout)
        warehouse.replace_checked(layers.RAW, dataset.staging, documents, RAW[dataset.staging])
        staged = warehouse.read(layers.RAW, dataset.staging)
        features = check_features(staged, dataset.paths, dataset.sizes, warehouse.name(layers.RAW, dataset.staging))
        warehouse.replace_checked(layers.RAW, dataset.table, features, dataset.schema, files=files, since=since)
        return
    cells = read_delimited(spark, paths, dataset.columns, dataset.multi_line)
    checked = positional_copy(cells, dataset.columns)
    first = None
    if dataset.id_column:
        # Ids go on from the rows that a reload replaces.
        first = warehouse.next_id(layers.RAW, dataset.table, dataset.id_column)
        checked = with_row_id(checked, dataset.id_column, first)
    warehouse.replace_checked(layers.RAW, dataset.table, checked, dataset.schema, first, files, since)


def load_dataset(warehouse: Warehouse, dataset: Delimited | Document, landing: str, purge: bool = False) -> None:
    """Replace a raw table by all that lies in its landing folder.

    With `purge`, exactly the files that were loaded are deleted once the table shows them. A load that fails deletes
    nothing, and files that come while it runs stay for the next one. Without any files the table stays as it is.
    """
    folder = landing_folder(dataset, landing)
    if not purge:
        return load_files(warehouse, dataset, [folder])
    paths = landed(warehouse.spark, folder)
    if paths:
        load_files(warehouse, dataset, [literal(path) for path in paths])
        remove(warehouse.spark, paths)
