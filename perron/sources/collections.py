"""One JSON document with very many features, read by many tasks.

A file is read in splits as pieces that end with a closing brace, whatever lines it has. Every piece is summed up by how it
passes on whether a string is open, and by how much deeper it leaves the nesting for either case; these add up within a
split, and over the splits of a file, some hundred. So every piece knows in which state and how deep it begins, and
where the list of features begins and each feature ends. The pieces of a feature are put together by one shuffle
by feature, and what is left of the document without its features, the frame, must be a whole document by itself.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perron.session import scratch
from perron.sources.rejects import SOURCE

_FEATURES = r'"features"\s*:\s*\['
_ORDER = ["split", "number"]


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _unescaped(text: Column) -> Column:
    """Without escaped characters, so that every quote left opens or closes a string."""
    return F.regexp_replace(text, r"(?s)\\.", "")


def _outside(text: Column, inside: bool) -> Column:
    """What stands outside of strings in a text without escapes, if one is open at its start or not."""
    rest = F.regexp_replace(text, '^[^"]*("|$)', "") if inside else text
    return F.regexp_replace(rest, '"[^"]*("|$)', "")


def _deeper(text: Column) -> Column:
    return _count(text, "{") + _count(text, "[") - _count(text, "}") - _count(text, "]")


def _pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Pieces with their place, `turns` (1: a string is open after it if none was before) and `deeper0`, `deeper1`, how much
    deeper the nesting is after it, beginning outside or inside of a string."""
    bare = _unescaped(F.col("value"))
    pieces = spark.read.option("lineSep", "}").text(paths).select(
        "value", F.col("_metadata.file_path").alias(SOURCE), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("number"),
        bare.alias("bare"),
    )
    turns = _count(F.col("bare"), '"') % 2
    # The brace at which the piece was cut is not in it; it closes something unless it stands in a string.
    return pieces.select(
        SOURCE, "size", *_ORDER, "value", turns.alias("turns"),
        (_deeper(_outside(F.col("bare"), False)) - F.when(turns == 0, 1).otherwise(0)).alias("deeper0"),
        (_deeper(_outside(F.col("bare"), True)) - F.when(turns == 1, 1).otherwise(0)).alias("deeper1"),
    )


def _sum_before(column: str) -> Column:
    """The sum of what stands before a piece in its split."""
    order = Window.partitionBy(SOURCE, "split").orderBy("number")
    return F.coalesce(F.sum(column).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _earlier(column: str | Column) -> Column:
    """The sum over the splits of a file before one: a row per split."""
    order = Window.partitionBy(SOURCE).orderBy("split")
    return F.coalesce(F.sum(column).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _nested(pieces: DataFrame, folder: str) -> DataFrame:
    """Pieces with the state (`inside` a string) and the `depth` in which they begin and end, written to the shared folder."""
    pieces = pieces.withColumn("turned", _sum_before("turns") % 2)
    for start in (0, 1):
        own = F.when((F.col("turned") + start) % 2 == 0, F.col("deeper0")).otherwise(F.col("deeper1"))
        pieces = pieces.withColumn(f"own{start}", own)
        pieces = pieces.withColumn(f"gone{start}", _sum_before(f"own{start}"))
    pieces.write.parquet(f"{folder}/pieces")
    pieces = pieces.sparkSession.read.parquet(f"{folder}/pieces")
    splits = pieces.groupBy(SOURCE, "split").agg(
        F.sum("turns").alias("turns"), F.sum("own0").alias("sum0"), F.sum("own1").alias("sum1")
    )
    splits = splits.withColumn("inside", _earlier("turns") % 2)
    splits = splits.withColumn("depth", _earlier(F.when(F.col("inside") == 0, F.col("sum0")).otherwise(F.col("sum1"))))
    starts = splits.select(SOURCE, "split", F.col("inside").alias("inside_at"), F.col("depth").alias("depth_at"))

    def chosen(name: str) -> Column:
        return F.when(F.col("inside_at") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))

    before = F.col("depth_at") + chosen("gone")
    return pieces.join(starts, [SOURCE, "split"]).select(
        SOURCE, "size", *_ORDER, "value", "turns",
        ((F.col("inside_at") + F.col("turned")) % 2).alias("inside"), before.alias("depth"),
        (before + chosen("own")).alias("depth_after"),
    )


def _marked(nested: DataFrame, folder: str) -> DataFrame:
    """Pieces with `opens` (the list of features begins in it), `ended` (features that have ended before it) and `part`: 0
    before the list, 1 where it begins, 2 within and 3 behind it; written to the shared folder."""
    spark = nested.sparkSession
    first = F.min_by(F.ltrim("value", F.lit("\ufeff \t\r\n")), F.struct(*_ORDER))
    # There is a row per file here, as in the listing that the driver has.
    roots = nested.where("split = 0").groupBy(SOURCE).agg(F.when(first.startswith("["), 2).otherwise(1).alias("root"))
    bare = _unescaped(F.regexp_extract("value", rf"(?s)^(.*?){_FEATURES}", 1))
    # Only a list that is a member of the outer object; the text before it decides how deep it stands.
    outside = (F.col("inside") + _count(bare, '"')) % 2 == 0
    depth = F.col("depth") + F.when(F.col("inside") == 0, _deeper(_outside(bare, False))).otherwise(_deeper(_outside(bare, True)))
    opens = F.col("value").rlike(_FEATURES) & outside & (depth == F.col("root"))
    level, at = F.col("root") + 1, F.struct(*_ORDER)
    closes = (F.col("inside") == 0) & (F.col("depth") == level) & F.ltrim("value", F.lit(" \t\r\n")).startswith("]")
    ends = ((F.col("inside") + F.col("turns")) % 2 == 0) & (F.col("depth_after") == level)
    marked = nested.join(F.broadcast(roots), SOURCE).select(
        *nested.columns, opens.cast("int").alias("opens"), closes.alias("closes"), ends.cast("int").alias("ends")
    )
    marked.write.parquet(f"{folder}/marked")
    marked = spark.read.parquet(f"{folder}/marked")
    begun = marked.groupBy(SOURCE).agg(F.min(F.when(F.col("opens") == 1, at)).alias("open_at"))
    marked = marked.join(F.broadcast(begun), SOURCE)
    closed = marked.where(F.col("closes") & (at > F.col("open_at"))).groupBy(SOURCE).agg(F.min(at).alias("close_at"))
    marked = marked.join(F.broadcast(closed), SOURCE, "left")
    part = (
        F.when(F.col("open_at").isNull() | (at < F.col("open_at")), 0)
        .when(at == F.col("open_at"), 1)
        .when(F.col("close_at").isNull() | (at < F.col("close_at")), 2)
        .otherwise(3)
    )
    # Braces that end something on that level before the list shift the numbers of all features alike.
    splits = marked.groupBy(SOURCE, "split").agg(F.sum("ends").alias("ends"))
    starts = splits.select(SOURCE, "split", _earlier("ends").alias("ends_at"))
    counted = marked.withColumn("part", part).withColumn("ends_so_far", _sum_before("ends"))
    return counted.join(starts, [SOURCE, "split"]).select(
        SOURCE, "size", *_ORDER, "value", "opens", "part", (F.col("ends_at") + F.col("ends_so_far")).alias("ended")
    )


def split_documents(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, list[str]]:
    """The features of documents as `json_data` and their file, each as a document `{"features": [feature]}`, and the files
    that cannot be read so, whose rows are not among them.

    A file can be read so if it is one JSON object, or one in a list, with one list `features` of objects and no other text.
    That is all checked: what is not read so must be read whole, and then says what is wrong with it. Files are
    not compressed. What is put together is written to the shared folder.
    """
    folder = scratch(spark, "documents")
    marked = _marked(_nested(_pieces(spark, paths), folder), folder)
    brace, part = F.lit("}"), F.col("part")
    after_open = F.regexp_replace("value", rf"(?s)^.*?{_FEATURES}", "")
    up_to_open = F.regexp_extract("value", rf"(?s)^(.*?{_FEATURES})", 1)
    texts = marked.select(
        SOURCE, "size", *_ORDER, F.octet_length("value").alias("bytes"), "ended", "opens",
        F.when(part.isin(0, 3), F.concat("value", brace)).when(part == 1, up_to_open).alias("frame"),
        F.when(part == 2, F.concat("value", brace)).when(part == 1, F.concat(after_open, brace)).alias("feature"),
    )
    put_together = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*_ORDER, "feature"))), lambda p: p["feature"]), "")
    features = texts.where("feature is not null").groupBy(SOURCE, "ended").agg(put_together.alias("text"))
    # Features stand behind a comma, but for the first. Braces that ended before the list began shift all numbers alike.
    numbered = features.select(
        SOURCE, "ended", F.regexp_extract("text", r"(?s)^\s*(,?)\s*\{", 1).alias("comma"),
        F.col("text").rlike(r"^\s*,?\s*\{").alias("object"),
        F.try_parse_json(F.regexp_replace("text", r"^\s*,?", "")).alias("feature"),
    )
    numbered.write.parquet(f"{folder}/features")
    numbered = spark.read.parquet(f"{folder}/features")
    told = numbered.groupBy(SOURCE).agg(
        F.bool_and(F.col("object") & F.col("feature").isNotNull()).alias("read"),
        (F.count_if(F.col("comma") == "") == 1).alias("one_first"),
        (F.min_by(F.col("comma") == "", "ended")).alias("first_first"),
    )
    frames = texts.groupBy(SOURCE).agg(
        (F.max("size") - F.sum(F.col("bytes") + 1)).alias("missing"), F.sum("opens").alias("opens"),
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.when(F.col("frame").isNotNull(), F.struct(*_ORDER, "frame")))), lambda p: p["frame"]
            ), ""
        ).alias("frame"),
    )
    # A file that does not end with a brace is a byte short of what was put behind its last piece; a byte order mark is three.
    text = F.ltrim("frame", F.lit("\ufeff"))
    whole = F.when(F.col("missing").isin(-1, 2), F.substring(text, F.lit(1), F.length(text) - 1)).when(
        F.col("missing").isin(0, 3), text
    )
    document = F.try_parse_json(F.concat(F.lit("["), whole, F.lit("]")))
    empty = [
        F.coalesce(F.array_size(F.try_variant_get(document, f"$[0]{inner}.features", "array<variant>")) == 0, F.lit(False))
        for inner in ("", "[0]")
    ]
    alone = F.array_size(F.try_variant_get(document, "$", "array<variant>")) == 1
    in_list = F.coalesce(F.array_size(F.try_variant_get(document, "$[0]", "array<variant>")), F.lit(1)) == 1
    sound = (F.col("opens") == 1) & alone & in_list & reduce(lambda a, b: a | b, empty)
    verdict = frames.select(SOURCE, F.coalesce(sound, F.lit(False)).alias("sound")).join(told, SOURCE, "left")
    good = F.col("sound") & F.coalesce(F.col("read") & F.col("one_first") & F.col("first_first"), F.lit(False))
    files = {row[SOURCE]: row["good"] for row in verdict.select(SOURCE, good.alias("good")).collect()}
    others = [file for file, fine in files.items() if not fine]
    documents = numbered.where(~F.col(SOURCE).isin(others)) if others else numbered
    one = F.to_variant_object(F.struct(F.array("feature").alias("features")))
    return documents.select(one.alias("json_data"), SOURCE), others
