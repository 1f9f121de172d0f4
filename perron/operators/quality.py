"""Reports on declared keys. Nothing is repaired or rejected here."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perron.operators.joins import HOT_ROWS, sized_join
from perron.operators.tallies import Tally


def pk_violations(frame: DataFrame, *keys: str, nullable: bool = False) -> DataFrame:
    """Keys that occur more than once and, unless `nullable`, keys that are NULL, with their rows.

    `nullable` is for a unique constraint, where NULLs never clash.
    """
    missing = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])
    counts = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    if nullable:
        return counts.where(~missing & (F.col("rows") > 1))
    return counts.where(missing | (F.col("rows") > 1))


def fk_orphans(
    child: DataFrame, fk: str, parent: DataFrame, pk: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Rows of the child whose foreign key has a value that the parent lacks."""
    keys = parent.select(F.col(pk).alias("__parent_key")).where(F.col("__parent_key").isNotNull())
    return sized_join(
        child.where(F.col(fk).isNotNull()), keys, fk, "__parent_key", "left_anti", hot_rows=hot_rows
    )


def constraint_report(
    tables: dict[str, DataFrame],
    primary: dict[str, str],
    unique: dict[str, str],
    foreign: list[tuple[str, str, str, str]],
    tallies: dict[str, Tally | None] | None = None,
) -> DataFrame:
    """One row per declared constraint: how many keys and how many rows violate it.

    Each table is read once; columns that a table's tally tells of are taken from there, and a table whose tally tells of
    all is not read. A domain is a declared key with all columns that refer to it; a row gives every domain
    it is in the value it has there. Rows are counted per value before the one shuffle, so a value that many rows share,
    or NULL, is one row of a task in it, and what a value violates is told from its counts. Values are compared as text,
    so a key and what refers to it must be of one type.
    """
    domains: dict[tuple[str, str], list[tuple[str, str]]] = {}
    lines = []
    for kind, declared in (("primary", primary), ("unique", unique)):
        for table, key in declared.items():
            domains.setdefault((table, key), [(table, key)])
            lines.append((kind, f"{table}.{key}", (table, key), 0))
    for table, key, parent, parent_key in foreign:
        kinds = tables[table].schema[key].dataType, tables[parent].schema[parent_key].dataType
        if kinds[0] != kinds[1]:
            raise ValueError(f"{table}.{key} and {parent}.{parent_key} differ in type")
        members = domains.setdefault((parent, parent_key), [(parent, parent_key)])
        lines.append(("foreign", f"{table}.{key} -> {parent}.{parent_key}", (parent, parent_key), len(members)))
        members.append((table, key))

    numbers = {domain: number for number, domain in enumerate(domains)}
    counts = _values(tables, domains, tallies or {}).groupBy("domain", "value").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("member") == m, F.col("rows"))), F.lit(0)).alias(f"rows{m}")
            for m in range(max(map(len, domains.values())))
        ]
    )
    faults = [
        F.when(
            (F.col("domain") == numbers[domain]) & _violated(kind, member),
            F.struct(F.lit(line).alias("line"), F.col(f"rows{member}").alias("rows")),
        )
        for line, (kind, _, domain, member) in enumerate(lines)
    ]
    found = (
        counts.select(F.explode(F.array_compact(F.array(*faults))).alias("fault"))
        .groupBy(F.col("fault.line").alias("line"))
        .agg(F.count(F.lit(1)).alias("bad_keys"), F.sum("fault.rows").alias("bad_rows"))
    )
    spark = next(iter(tables.values())).sparkSession
    declared = spark.createDataFrame(
        [(line, kind, target) for line, (kind, target, _, _) in enumerate(lines)], "line int, kind string, target string"
    )
    return declared.join(found, "line", "left").select(
        "kind", "target", *[F.coalesce(name, F.lit(0)).alias(name) for name in ("bad_keys", "bad_rows")]
    )


def _values(
    tables: dict[str, DataFrame],
    domains: dict[tuple[str, str], list[tuple[str, str]]],
    tallies: dict[str, Tally | None],
) -> DataFrame:
    """The domain, which member of it a column is, a value, and how many rows have it: a row per row of a table that is
    read, or per row of a tally."""

    def place(number: int, member: int, value: Column, rows: Column) -> Column:
        return F.struct(
            F.lit(number).alias("domain"), F.lit(member).alias("member"), value.alias("value"), rows.alias("rows")
        )

    read: dict[str, list[Column]] = {}
    told: dict[str, list[Column]] = {}
    for number, members in enumerate(domains.values()):
        for member, (table, column) in enumerate(members):
            tally = tallies.get(table)
            if tally and tally.tells(column, alone=len(members) == 1):
                counted = place(number, member, F.col("value"), F.col("rows"))
                told.setdefault(table, []).append(F.when(F.col("column") == column, counted))
            else:
                value = F.col(column).cast("string")
                read.setdefault(table, []).append(place(number, member, value, F.lit(1).cast("bigint")))
    parts = [tables[table].select(F.inline(F.array(*places))) for table, places in read.items()]
    parts += [
        tallies[table].counts.select(F.inline(F.array_compact(F.array(*places)))) for table, places in told.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _violated(kind: str, member: int) -> Column:
    rows, missing = F.col(f"rows{member}"), F.col("value").isNull()
    if kind == "primary":
        return (rows > 1) | (missing & (rows > 0))
    if kind == "unique":
        return ~missing & (rows > 1)
    return ~missing & (rows > 0) & (F.col("rows0") == 0)
