"""Snapshot tables in the three layers raw, curated and consumption.

A load writes a whole new managed table beside the current one and then points a view at it. Readers
see the old snapshot or the new one and never a part, a failed load leaves the old one in place, and
a load may read the table that it replaces.

Several loads of a table may be in flight. Each claims its snapshot by a file that no other can create, and what is claimed
is dropped by no other load. A load publishes only if the table is still what it was when the load began, else it is told by
`Conflict` and its snapshot goes. Publishing itself is done under a lock, for the moment that it takes.

Tables that belong together are published together, see `Release`.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perron.operators.keys import next_id
from perron.operators.projection import conform, layout
from perron.operators.summaries import HOT_ROWS, KEPT, Summary, merged, write_summarised
from perron.operators.tallies import TALLY, Tally, added, read_tally, write_tally
from perron.sources.files import VERSION, ages, create_new, read_text, remove, remove_folder, write_text
from perron.sources.rejects import REJECT_COLUMNS, REJECTED

RAW, CURATED, CONSUMPTION = "raw", "curated", "consumption"

# Accepted and rejected rows are written side by side, where Spark would sort each task's rows first.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
# How snapshots are packed: about a third less than with Spark's default, at no more time.
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}
# The property of a table that tells where the ids of its last load begin.
FIRST_ID = "perron.first_id"
# Names the view that a checked table and its rejects look at.
LOADED = "_loaded"
# Additions to a table after which it is written anew as one snapshot.
PARTS = 100
# Seconds after which the claim of a load counts as left behind by one that was killed, and the lock of one that publishes.
CLAIMED = 24 * 3600
LOCKED = 600
# Ends the name of the table of file versions that a snapshot has taken.
FILES = "_files"
# The file that completes the folder with the tally of a snapshot.
TALLIED = "_tally.json"
# The view whose one row names the published release of a layer.
RELEASE = "current_release"


class Conflict(RuntimeError):
    """Another load of the table was published after this one began. Nothing of this one is left."""


class Warehouse:
    """Tables below a folder that all executors share. `prefix` keeps several warehouses apart."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = "") -> None:
        self.spark = spark
        self.prefix = prefix
        self.root = root.rstrip("/")
        if int(spark.conf.get(WRITERS, "0")) == 0:
            spark.conf.set(WRITERS, "2")
        for layer in (RAW, CURATED, CONSUMPTION):
            spark.sql(
                f"create database if not exists {self.database(layer)} "
                f"location '{self.root}/{layer}'"
            )

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.database(layer)}.{table}"

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def rejects(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, f"{table}_rejects"))

    def version(self, layer: str, table: str) -> frozenset[str]:
        """What the table is made of now. A load that is given it as `since` publishes only if that is still so."""
        return frozenset(self._named(layer, table))

    def files(self, layer: str, table: str) -> DataFrame:
        """The versions of files that the table has taken, see `replace_checked`."""
        for snapshot in sorted(self._named(layer, table), reverse=True):
            if self.exists(layer, snapshot + FILES):
                return self.read(layer, snapshot + FILES)
        return self.spark.createDataFrame([], VERSION)

    def replace(
        self,
        layer: str,
        table: str,
        frame: DataFrame,
        schema: str,
        first_id: int | None = None,
        since: frozenset[str] | None = None,
    ) -> None:
        """The rows become the whole content of the table, matched to `schema` by name.

        `first_id` is where the ids of this load begin. The table keeps it, see `next_id`. `since` is the version that the
        load began with, by default that of now.
        """

        def switch() -> None:
            self._view(layer, table, self._select(layer, snapshot, [f.name for f in layout(schema)]), first_id)
            for name in (f"{table}_rejects", table + LOADED):
                self.spark.sql(f"drop view if exists {self.name(layer, name)}")

        with self._load(layer, table, since) as (snapshot, publish):
            self._write(layer, table, conform(frame, schema), snapshot=snapshot)
            publish(switch)

    def next_id(self, layer: str, table: str, column: str) -> int:
        """The first id for the next load: above all that earlier loads gave, also if the last one had no rows."""
        if not self.exists(layer, table):
            return 1
        return max([1, *self._first_id(layer, table), next_id(self.read(layer, table), column)])

    def replace_checked(
        self,
        layer: str,
        table: str,
        copied: DataFrame,
        schema: str,
        first_id: int | None = None,
        files: DataFrame | None = None,
        since: frozenset[str] | None = None,
    ) -> None:
        """As `replace`, for the result of a checked read.

        Accepted and rejected rows are written in one pass as two partitions of the snapshot; the
        second is seen as table `<table>_rejects`. Both tables look at `<table>_loaded`, which alone is switched, so
        they always tell of the same load. `files` are the versions of files that the table has taken from then on,
        by default those of before; they are a table beside the snapshot and known by its name, so they are switched with it.
        """
        columns = [f.name for f in layout(schema)]
        wanted = copied.select(*columns, *REJECT_COLUMNS, REJECTED)
        taken = self.files(layer, table) if files is None else files

        def switch() -> None:
            self._view(layer, table + LOADED, self._select(layer, snapshot, wanted.columns), first_id)
            for name, seen, side in (
                (f"{table}_rejects", REJECT_COLUMNS, REJECTED), (table, columns, f"not {REJECTED}")
            ):
                select = f"{self._select(layer, table + LOADED, seen)} where {side}"
                if not self.exists(layer, name) or self._text(layer, name) != select:
                    self._view(layer, name, select)

        with self._load(layer, table, since) as (snapshot, publish):
            self._write(layer, table, wanted, REJECTED, snapshot=snapshot)
            conform(taken, VERSION).coalesce(1).write.format("parquet").saveAsTable(self.name(layer, snapshot + FILES))
            publish(switch)

    def append(
        self, layer: str, table: str, frame: DataFrame, schema: str, since: frozenset[str] | None = None
    ) -> None:
        """Adds rows to the current content, matched to `schema` by name.

        They are a snapshot of their own, which the view names from then on beside those before: readers see all of an
        addition or nothing, and one that fails can be tried again. After `PARTS` additions all is written anew.
        """
        if not self.exists(layer, table):
            return self.replace(layer, table, frame, schema, since=since)
        with self._load(layer, table, since) as (snapshot, publish):
            named, before = self._switch(layer, table), self._named(layer, table)
            content = self.read(layer, named)
            rows = conform(frame, schema)
            added = {f.name: F.lit(None) for f in content.schema if f.name not in rows.columns}
            if REJECTED in added:
                added[REJECTED] = F.lit(False)
            rows = conform(rows.withColumns(added), content.schema)
            whole = len(before) >= PARTS
            rows = content.unionByName(rows) if whole else rows
            taken = self.files(layer, table)
            self._write(layer, table, rows, *([REJECTED] if REJECTED in rows.columns else []), snapshot=snapshot)
            if whole and named != table:
                taken.write.format("parquet").saveAsTable(self.name(layer, snapshot + FILES))
            select = self._select(layer, snapshot, content.columns)
            text = select if whole else f"{self._text(layer, named)} union all {select}"
            publish(lambda: self._view(layer, named, text, *self._first_id(layer, table)))

    @contextmanager
    def _load(self, layer: str, table: str, since: frozenset[str] | None) -> Iterator[tuple[str, Callable]]:
        """A claimed snapshot and what publishes it. A load that does not come to publish leaves nothing behind."""
        since = self.version(layer, table) if since is None else since
        snapshot = self._claim(layer, table)
        published = False

        def publish(switch: Callable[[], None]) -> None:
            nonlocal published
            with self._locked(layer, table):
                if self.version(layer, table) != since:
                    raise Conflict(f"{self.name(layer, table)} was loaded by another while this load ran")
                switch()
                published = True

        try:
            yield snapshot, publish
        finally:
            if not published:
                self._drop(layer, snapshot)
            remove(self.spark, [self._claims(layer, snapshot)])
        self._drop_old(layer, table, snapshot, set(since))

    def _claims(self, layer: str, name: str = "") -> str:
        return f"{self.root}/_claims/{self.database(layer)}/{name}".rstrip("/")

    def _claim(self, layer: str, table: str) -> str:
        """A name for a snapshot that no other load has."""
        while True:
            snapshot = f"{table}__{time.time_ns():020d}"
            if create_new(self.spark, self._claims(layer, snapshot)):
                return snapshot

    @contextmanager
    def _locked(self, layer: str, table: str) -> Iterator[None]:
        """Alone among all that publish the table. The lock of a load that was killed is broken after `LOCKED` seconds."""
        folder, lock = self._claims(layer) + "_locks", f"{table}.lock"
        while not create_new(self.spark, f"{folder}/{lock}"):
            if ages(self.spark, folder).get(lock, 0) > LOCKED:
                remove(self.spark, [f"{folder}/{lock}"])
            time.sleep(0.05)
        try:
            yield
        finally:
            remove(self.spark, [f"{folder}/{lock}"])

    def _drop(self, layer: str, snapshot: str) -> None:
        for name in (snapshot, snapshot + FILES):
            self.spark.sql(f"drop table if exists {self.name(layer, name)}")
        remove(self.spark, [self._summary(layer, snapshot)])
        remove_folder(self.spark, self._tallied(layer, snapshot))

    @contextmanager
    def release(self, layer: str, tables: list[str]) -> Iterator[Release]:
        """Tables that are written one by one and seen all at once when the block ends.

        The view of each table then names its snapshot of the last release and that of this one, and which of them is seen
        says `current_release`, whose single row is switched in one step. Until then, and if anything fails, all tables
        of the layer are those of the last release. Tables that this release does not write stay as they were.
        """
        number = self._release_number(layer)
        release = Release(self, layer, {table: self.version(layer, table) for table in tables})
        try:
            yield release
            with self._locked(layer, RELEASE):
                changed = [t for t, since in release.since.items() if self.version(layer, t) != since]
                if changed or self._release_number(layer) != number:
                    raise Conflict(f"{self.database(layer)} was released by another while this release was made")
                kept = self._extend(layer, number, release)
                self._view(layer, RELEASE, f"select {number + 1}L as release")
                release.published = True
        finally:
            for table, (snapshot, _) in release.written.items():
                # A view may name it already, for a release that does not come; the next one takes it out and drops it.
                if not release.published and snapshot not in self._named(layer, table):
                    self._drop(layer, snapshot)
                remove(self.spark, [self._claims(layer, snapshot)])
        for table, (snapshot, _) in release.written.items():
            self._drop_old(layer, table, snapshot, kept[table])

    def released(self, layer: str, tables: list[str]) -> Tables:
        """Tables of one and the same release, also if another is published meanwhile."""
        while True:
            number = self._release_number(layer)
            texts = {table: self._branches(layer, table) for table in tables}
            if all(number in branches or not branches for branches in texts.values()):
                found = Tables(
                    (table, self.spark.sql(branches[number]) if branches else self.read(layer, table))
                    for table, branches in texts.items()
                )
                shown = {table: branches[number] for table, branches in texts.items() if branches}
                found.known = {table: self._known(layer, table, select) for table, select in shown.items()}
                found.tallies = {table: self._tally(layer, table, select) for table, select in shown.items()}
                return found

    def _summary(self, layer: str, snapshot: str) -> str:
        return f"{self.root}/_summaries/{self.database(layer)}/{snapshot}"

    def _tallied(self, layer: str, snapshot: str) -> str:
        return f"{self.root}/_tallies/{self.database(layer)}/{snapshot}"

    def _known(self, layer: str, table: str, select: str) -> Summary | None:
        """The summary of all rows of the snapshots that a text names."""
        texts = [
            read_text(self.spark, self._summary(layer, snapshot))
            for snapshot in re.findall(rf"\b{re.escape(table)}__\d+", select)
        ]
        return merged([text and Summary.from_json(text) for text in texts])

    def _tally(self, layer: str, table: str, select: str) -> Tally | None:
        """The tally of all rows of the snapshots that a text names."""
        parts = []
        for snapshot in re.findall(rf"\b{re.escape(table)}__\d+", select):
            folder = self._tallied(layer, snapshot)
            text = read_text(self.spark, f"{folder}/{TALLIED}")
            if text is None:
                return None
            parts.append(read_tally(self.spark.read.schema(TALLY).parquet(folder), text))
        return added(parts)

    def _release_number(self, layer: str) -> int:
        if not self.exists(layer, RELEASE):
            return 0
        return self.read(layer, RELEASE).first()["release"]

    def _branches(self, layer: str, table: str) -> dict[int, str]:
        """What the view of a table shows, by the number of the release; empty for a table that is not released."""
        text = self._text(layer, table) if self.exists(layer, table) else ""
        seen = re.escape(self._seen(layer))
        shown: dict[int, list[str]] = {}
        for select, n in re.findall(rf"(?:^| union all )(select (?:(?! union all ).)*?) where {seen} = (\d+)", text):
            shown.setdefault(int(n), []).append(select)
        return {n: " union all ".join(selects) for n, selects in shown.items()}

    def _seen(self, layer: str) -> str:
        return f"(select release from {self.name(layer, RELEASE)})"

    def _extend(self, layer: str, number: int, release: Release) -> dict[str, set[str]]:
        """Has every released table name what it shows in the next release; the snapshots that each named before in this."""
        if not self.exists(layer, RELEASE):
            self._view(layer, RELEASE, f"select {number}L as release")
        found = self.spark.sql(f"show views in {self.database(layer)}").collect()
        others = {row["viewName"] for row in found} - {RELEASE}
        kept = {}
        for table in sorted(others | set(release.written)):
            branches = self._branches(layer, table)
            if table not in release.written and number not in branches:
                continue
            now = branches.get(number)
            if now is None and self.exists(layer, table):
                columns = ", ".join(f"`{c}`" for c in self.read(layer, table).columns)
                now = f"select {columns} from ({self._text(layer, table)})"
            kept[table] = set(re.findall(rf"\b{re.escape(table)}__\d+", now or ""))
            then, first_id = now, self._first_id(layer, table)[:1] if now else []
            if table in release.written:
                snapshot, ids = release.written[table]
                then = self._select(layer, snapshot, self.read(layer, snapshot).columns)
                if table in release.additions:
                    then = f"{now} union all {then}"
                first_id = [ids] if ids is not None else first_id
            shown = [(now, number), (then, number + 1)] if now else [(then, number + 1)]
            parts = [f"{part} where {self._seen(layer)} = {n}" for text, n in shown for part in text.split(" union all ")]
            self._view(layer, table, " union all ".join(parts), *first_id)
        return kept

    def _switch(self, layer: str, table: str) -> str:
        """The view that names the snapshots of a table: of a checked one, what it and its rejects look at."""
        return table + LOADED if self.exists(layer, table + LOADED) else table

    def _text(self, layer: str, view: str) -> str:
        about = self.spark.sql(f"describe table extended {self.name(layer, view)}")
        return about.where(F.col("col_name") == "View Text").first()["data_type"]

    def _named(self, layer: str, table: str) -> set[str]:
        """The snapshots that are seen as the table."""
        switch = self._switch(layer, table)
        if not self.exists(layer, switch):
            return set()
        return set(re.findall(rf"\b{re.escape(table)}__\d+", self._text(layer, switch)))

    def _first_id(self, layer: str, table: str) -> list[int]:
        shown = self.spark.sql(f"show tblproperties {self.name(layer, self._switch(layer, table))}")
        return [int(row["value"]) for row in shown.where(F.col("key") == FIRST_ID).collect()]

    def _snapshots(self, layer: str, table: str) -> list[str]:
        database = self.database(layer)
        found = self.spark.sql(f"show tables in {database} like '{table}__*'").collect()
        pattern = re.compile(re.escape(table) + r"__\d+")
        return sorted(row["tableName"] for row in found if pattern.fullmatch(row["tableName"]))

    def _write(self, layer: str, table: str, frame: DataFrame, *partitions: str, snapshot: str | None = None) -> str:
        snapshot = snapshot or f"{table}__{time.time_ns():020d}"
        writer = frame.write.format("parquet").options(**PACKED)
        if partitions:
            writer = writer.partitionBy(*partitions)
        writer.saveAsTable(f"{self.database(layer)}.{snapshot}")
        return snapshot

    def _select(self, layer: str, source: str, columns: list[str]) -> str:
        return f"select {', '.join(f'`{name}`' for name in columns)} from {self.name(layer, source)}"

    def _view(self, layer: str, view: str, select: str, first_id: int | None = None) -> None:
        """Points a view at something else in one step; replacing it would take it away for a moment."""
        name = self.name(layer, view)
        if not self.exists(layer, view):
            properties = "" if first_id is None else f"tblproperties ('{FIRST_ID}' = '{first_id}') "
            self.spark.sql(f"create or replace view {name} {properties}as {select}")
            return
        if first_id is not None:
            # Before the rows are seen: ids may only go up.
            self.spark.sql(f"alter view {name} set tblproperties ('{FIRST_ID}' = '{first_id}')")
        self.spark.sql(f"alter view {name} as {select}")

    def _drop_old(self, layer: str, table: str, snapshot: str, before: set[str]) -> None:
        """What was seen before the new snapshot stays for readers that have begun, and as part of what is appended to.

        `before` are the snapshots that were seen. Older snapshots go, and so do those of loads that were killed before they were published. Those of loads in flight
        stay, which a claim tells that is no older than `CLAIMED` seconds.
        """
        claims = ages(self.spark, self._claims(layer))
        kept = before | self._named(layer, table) | {name for name, age in claims.items() if age < CLAIMED}
        for old in self._snapshots(layer, table):
            if old < snapshot and old not in kept:
                self._drop(layer, old)
                if old in claims:
                    remove(self.spark, [self._claims(layer, old)])


class Release:
    """The tables of a release that is being made."""

    def __init__(self, warehouse: Warehouse, layer: str, since: dict[str, frozenset[str]]) -> None:
        self.warehouse, self.layer, self.since = warehouse, layer, since
        self.written: dict[str, tuple[str, int | None]] = {}
        self.additions: dict[str, Tables] = {}
        self.published = False

    def write(
        self,
        table: str,
        frame: DataFrame,
        schema: str,
        first_id: int | None = None,
        keys: Iterable[str] = (),
        counted: Iterable[str] = (),
        alone: Iterable[str] = (),
    ) -> None:
        """The rows are the content of the table in this release, matched to `schema` by name; `first_id` as for `replace`.

        What is known of them afterwards is kept beside the snapshot, see `write_summarised`; `keys` are the columns by
        which the table is joined. With `counted` or `alone` so is a tally of these columns, see `write_tally`; it tells which
        of the counted keys many rows share, and only others are looked at.
        """
        warehouse, layer = self.warehouse, self.layer
        keys, counted, alone = list(keys), list(counted), list(alone)
        snapshot = warehouse._claim(layer, table)
        self.written[table] = snapshot, first_id

        def write(rows: DataFrame) -> DataFrame:
            warehouse._write(layer, table, rows, snapshot=snapshot)
            return warehouse.read(layer, snapshot)

        stored, known = write_summarised(conform(frame, schema), write, [key for key in keys if key not in counted])
        if counted or alone:
            folder = warehouse._tallied(layer, snapshot)
            text = write_tally(stored, lambda counts: counts.write.options(**PACKED).parquet(folder), counted, alone)
            write_text(warehouse.spark, f"{folder}/{TALLIED}", text)
            if known.rows > HOT_ROWS:
                kinds = {key: stored.schema[key].dataType for key in keys if key in counted}
                shared = warehouse._tally(layer, table, snapshot).shared(kinds, known.rows / KEPT)
                known = replace(known, keys=known.keys | shared)
        write_text(warehouse.spark, warehouse._summary(layer, snapshot), known.to_json())

    def append(
        self,
        table: str,
        frame: DataFrame,
        schema: str,
        first_id: int | None = None,
        keys: Iterable[str] = (),
        counted: Iterable[str] = (),
        alone: Iterable[str] = (),
        arrange: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    ) -> None:
        """As `write`, but the rows come to what the last release has in the table. Only they are written and counted.

        They are a snapshot of their own, with the columns of the others. A table without a release before, and one of `PARTS`
        additions, is written whole. `arrange` lays out what is written.
        """
        warehouse = self.warehouse
        before = warehouse.released(self.layer, [table]) if warehouse.exists(self.layer, table) else Tables()
        if table not in before:
            pass
        elif table not in before.known or len(self.since[table]) >= PARTS:
            frame = conform(before[table], schema).unionByName(conform(frame, schema))
        elif [(f.name, f.dataType) for f in before[table].schema] != [(f.name, f.dataType) for f in layout(schema)]:
            raise ValueError(f"{warehouse.name(self.layer, table)} has other columns")
        else:
            self.additions[table] = before
        self.write(table, arrange(conform(frame, schema)), schema, first_id, keys, counted, alone)

    def read(self, table: str) -> DataFrame:
        """The table as this release has it."""
        rows = self.warehouse.read(self.layer, self.written[table][0])
        return self.additions[table][table].unionByName(rows) if table in self.additions else rows

    def tally(self, table: str) -> Tally | None:
        """The tally of the table as this release has it, if all its parts have one."""
        name = self.written[table][0]
        own = self.warehouse._tally(self.layer, table, name)
        return added([self.additions[table].tallies[table], own]) if table in self.additions else own


class Tables(dict[str, DataFrame]):
    """Tables by name, what has been known of them since they were written, and how many rows have each value of their
    keys, where these were kept."""

    known: dict[str, Summary | None] = {}
    tallies: dict[str, Tally | None] = {}
