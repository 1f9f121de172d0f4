"""`;` separated text files, read by column position with a check of every typed cell."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perron.functions.casts import read_kind
from perron.model.tables import Field
from perron.operators.joins import sized_join
from perron.sources.files import list_files
from perron.sources.rejects import CELLS, REASONS, REJECTED, SOURCE

# A quoted empty cell is an empty text, an unquoted one is NULL. The reader gives this mark for the
# former, which keeps the two apart.
QUOTED_EMPTY = "\x01"
# A row whose last cell begins with a quote that nothing closes. It is rejected for this reason.
OPEN = "open_quote"

# The file format.
FORMAT = {
    "sep": ";",
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "\\N",
    "emptyValue": QUOTED_EMPTY,
}


def cell_schema(columns: list[Field]) -> str:
    """Text columns c1..cN up to the last one that is read; further ones in the file are ignored."""
    last = max(field.ordinal for field in columns)
    return ", ".join(f"c{i} string" for i in range(1, last + 1))


# A line that ends within a quoted cell: cells that end, each up to its `;`, then one whose quote nothing closes. The
# quantifiers never go back, so a line is gone through once.
_OPEN_LINE = r'^(?:(?:"(?:[^"]++|"")*+"[^;]*+|[^";][^;]*+)?+;)*+"(?:[^"]++|"")*+\z'


def _ends_open(line: Column) -> Column:
    """Whether a line that begins outside quotes ends within a quoted cell. Pairs of quotes are taken out before.

    A quote counts only at the start of a cell, and what follows a closing one up to the `;` belongs to the cell.
    """
    closed = F.regexp_replace(line, r'(^|;)"[^"]*"[^;]*', "$1")
    return closed.rlike('(^|;)"')


def _single_quotes(line: Column) -> Column:
    return F.replace(line, F.lit('""'), F.lit(""))


def broken_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """Files in which some line ends within a quoted cell, so that a cell may hold a line break."""
    # As `_ends_open(_single_quotes(...))` says, without putting each line together anew.
    lines = spark.read.text(paths).where(F.contains("value", F.lit('"')) & F.col("value").rlike(_OPEN_LINE))
    return [row[0] for row in lines.select("_metadata.file_path").distinct().collect()]


def _read(spark: SparkSession, paths: list[str], columns: list[Field], multi_line: bool) -> DataFrame:
    cells = spark.read.schema(cell_schema(columns)).options(**FORMAT, multiLine=multi_line).csv(paths)
    return cells.select("*", F.col("_metadata.file_path").alias(SOURCE))


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines with their number and split, and how they end when they begin outside (`from_out`) or within (`from_in`) quotes.

    Within quotes a quote must end the cell. One that anything but `;` or the end of the line follows does not: what was
    open before was no quoted cell, and the line begins anew (`anew`).
    """
    text = F.col("bare")
    quote = F.instr(text, '"')
    rest = text.substr(quote + 1, F.length(text))
    ends = (quote > 0) & ((rest == "") | rest.startswith(";"))
    return (
        spark.read.text(paths)
        .select(
            F.col("value").alias("line"),
            F.col("_metadata.file_path").alias(SOURCE),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("number"),
        )
        .withColumn("bare", _single_quotes(F.col("line")))
        .withColumn("from_out", _ends_open(text).cast("int"))
        .withColumn("anew", (quote > 0) & ~ends)
        .withColumn(
            "from_in",
            F.when(quote == 0, 1).when(ends, _ends_open(rest).cast("int")).otherwise(F.col("from_out")),
        )
        .drop("bare")
    )


def _state(start: Column | int) -> Column:
    """The state after a line, if its split began in `start`.

    It is that of the last line that leaves no choice, and as many turns as have come since.
    """
    began = F.lit(start) if isinstance(start, int) else start
    since = F.col("turns") - F.coalesce("turns_then", F.lit(0))
    return (F.coalesce("fixed", began) + since) % 2


def _starts(before: Column) -> Column:
    return (before == 0) | F.col("anew")


def _records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Records of files whose cells may hold line breaks, as `record` with their file, and whether a quote stays open.

    Files are read in splits. Every line says how it passes on the state of quotes; each split is summed up in one row,
    and the splits of a file, some hundred, are gone through in their order. A record takes lines up to the one that
    closes its quote. Where that never comes, its lines are records of their own: nothing is swallowed, and only
    the one with the quote is `open`. Line breaks in cells become `\\n`; blank lines and headers are left out.
    """
    order = Window.partitionBy(SOURCE, "split").orderBy("number")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    fixed, turn = F.col("from_out") == F.col("from_in"), F.col("from_out") > F.col("from_in")
    lines = (
        _lines(spark, paths)
        .withColumn("fixed", F.last(F.when(fixed, F.col("from_out")), ignorenulls=True).over(so_far))
        .withColumn("turns", F.sum(turn.cast("int")).over(so_far))
        .withColumn("filled", F.sum((F.trim("line") != "").cast("int")).over(so_far))
        .withColumn("turns_then", F.last(F.when(fixed, F.col("turns")), ignorenulls=True).over(so_far))
    )
    # The state before a line and the number of its record's first line, for both states in which a split may begin.
    for start in (0, 1):
        before = F.coalesce(F.lag(_state(start)).over(order), F.lit(start))
        lines = lines.withColumn(f"before{start}", before)
        first = F.last(F.when(_starts(F.col(f"before{start}")), F.col("number")), ignorenulls=True).over(so_far)
        lines = lines.withColumn(f"first{start}", first)
    splits = lines.groupBy(SOURCE, "split").agg(
        *[F.max_by(F.struct(_state(s).alias("after"), F.col(f"first{s}").alias("first")), "number").alias(f"end{s}") for s in (0, 1)]
    )

    def step(done: Column, split: Column) -> Column:
        end = F.when(done["after"] == 0, split["end0"]).otherwise(split["end1"])
        began = F.struct(split["split"].alias("split"), done["after"].alias("start"), done["first"].alias("begun"))
        return F.struct(
            end["after"].cast("bigint").alias("after"),
            F.coalesce(end["first"], done["first"]).alias("first"),
            F.concat(done["splits"], F.array(began)).alias("splits"),
        )

    zero = F.struct(
        F.lit(0).cast("bigint").alias("after"),
        F.lit(None).cast("bigint").alias("first"),
        F.array().cast("array<struct<split: bigint, start: bigint, begun: bigint>>").alias("splits"),
    )
    starts = (
        splits.groupBy(SOURCE)
        .agg(F.array_sort(F.collect_list(F.struct("split", "end0", "end1"))).alias("splits"))
        .select(SOURCE, F.inline(F.aggregate("splits", zero, step)["splits"]))
    )

    def chosen(name: str) -> Column:
        return F.when(F.col("start") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))

    placed = lines.join(starts, [SOURCE, "split"]).select(
        SOURCE, "line", "split", "number", F.col("from_out").alias("open"),
        ((F.col("split") == 0) & (F.col("filled") == 1) & (F.trim("line") != "")).alias("header"),
        _starts(chosen("before")).alias("starts"),
        _state(F.col("start")).alias("after"),
        F.coalesce(chosen("first"), F.col("begun")).alias("first"),
    )
    single = F.col("starts") & (F.col("after") == 0)
    alone = (F.trim("line") != "") & ~F.col("header")
    record = [SOURCE, F.col("line").alias("record"), (F.col("open") == 1).alias("open")]
    several = placed.where(~single)
    ended = several.groupBy("first").agg(F.max_by("after", F.struct("split", "number")).alias("last"))
    known = sized_join(several, ended.withColumnRenamed("first", "known"), "first", "known", "inner", measure=False)
    whole = (
        known.where(F.col("last") == 0)
        .groupBy(SOURCE, "first")
        .agg(F.array_sort(F.collect_list(F.struct("split", "number", "line"))).alias("parts"), F.max("header").alias("header"))
        .where(~F.col("header"))
        .select(SOURCE, F.array_join(F.col("parts.line"), "\n").alias("record"), F.lit(False).alias("open"))
    )
    never_ended = known.where((F.col("last") == 1) & alone).select(*record)
    return placed.where(single & alone).select(*record).unionByName(never_ended).unionByName(whole)


def _read_records(spark: SparkSession, paths: list[str], columns: list[Field]) -> DataFrame:
    options = {**FORMAT, "multiLine": "true"}
    cells = F.from_csv("record", F.lit(cell_schema(columns)), options)
    return _records(spark, paths).select(cells.alias("cells"), SOURCE, F.col("open").alias(OPEN)).select("cells.*", SOURCE, OPEN)


def read_delimited(
    spark: SparkSession, paths: list[str], columns: list[Field], multi_line: bool | None = None
) -> DataFrame:
    """The cells of files or folders as text, with the file each row is from. gzip files are read as such.

    By default all files are looked through first, and those with cells that go over line ends are put together from
    their lines, see `_records`, in splits as well. With `multi_line=False` every line is a row. With `True` Spark's
    reader reads each file whole in one task, and a quote that is never closed takes in what follows.
    """
    if multi_line is not None:
        return _read(spark, paths, columns, multi_line)
    broken = set(broken_files(spark, paths))
    if not broken:
        return _read(spark, paths, columns, False)
    files = list_files(spark, paths)
    records = _read_records(spark, [path for uri, path in files.items() if uri in broken], columns)
    others = [path for uri, path in files.items() if uri not in broken]
    return records.unionByName(_read(spark, others, columns, False).withColumn(OPEN, F.lit(False))) if others else records


def cell(ordinal: int) -> Column:
    """The text of a cell, in which a quoted empty one is an empty text."""
    text = F.col(f"c{ordinal}")
    return F.when(text == QUOTED_EMPTY, F.lit("")).otherwise(text)


def positional_copy(cells: DataFrame, columns: list[Field]) -> DataFrame:
    """Typed columns, and for each row whether a typed cell holds text that cannot be read or a quote stays open.

    Casts are done once; the verdict compares their results with the cells. Text never fails. A typed
    cell that is empty in quotes is not NULL but no value either, and fails like other text.
    """
    typed_columns = [f for f in columns if f.kind != "text"]
    values = {
        f.name: cell(f.ordinal) if f.kind == "text" else read_kind(F.col(f"c{f.ordinal}"), f.kind)
        for f in columns
    }
    read = cells.withColumns(values)
    failed = {f.name: F.col(f"c{f.ordinal}").isNotNull() & F.col(f.name).isNull() for f in typed_columns}
    if OPEN in cells.columns:
        failed[OPEN] = F.col(OPEN)
    rejected = reduce(lambda a, b: a | b, failed.values(), F.lit(False))
    reasons = F.array_compact(
        F.array(*[F.when(test, F.lit(name)) for name, test in failed.items()]).cast("array<string>")
    )
    originals = F.array(*[cell(f.ordinal) for f in columns])
    return read.withColumn(REJECTED, rejected).select(
        *[f.name for f in columns],
        REJECTED,
        F.when(F.col(REJECTED), reasons).alias(REASONS),
        F.when(F.col(REJECTED), originals).alias(CELLS),
        F.when(F.col(REJECTED), F.col(SOURCE)).alias(SOURCE),
    )
