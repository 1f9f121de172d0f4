"""JSON documents as VARIANT rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perron.functions.nested import explode_path, size_at, unreadable_at, whole_at
from perron.operators.joins import size_in_bytes
from perron.sources.collections import split_documents
from perron.sources.files import literal
from perron.sources.rejects import CELLS, REASONS, REJECTED, SOURCE, accepted


BYTE_ORDER_MARK = "\ufeff"
# The ends of names of files that are read as one stream.
COMPRESSED = (".gz", ".bz2", ".deflate", ".snappy", ".lz4", ".zst")


def _bracketed(text: Column) -> Column:
    """The parser stops after a first document. In brackets, whatever follows makes the text invalid."""
    return F.concat(F.lit("["), F.ltrim(text, F.lit(BYTE_ORDER_MARK)), F.lit("]"))


def _parsed(text: Column) -> Column:
    """The text as an array of one document; empty for empty text, NULL for text that is no JSON."""
    return F.try_parse_json(_bracketed(text))


def _feature_documents(text: Column) -> Column:
    """The features of a text, each in a document of its own; NULL for text that is no JSON.

    A VARIANT has a largest size, which a feature stays below whatever the size of the document around it.
    """
    one = "array<struct<features: array<variant>>>"
    nested = F.ltrim(text, F.lit(BYTE_ORDER_MARK + " \t\r\n")).startswith("[")
    documents = F.when(nested, F.flatten(F.from_json(_bracketed(text), f"array<{one}>"))).otherwise(
        F.from_json(_bracketed(text), one)
    )
    with_features = F.filter(documents, lambda d: d["features"].isNotNull())
    features = F.flatten(F.transform(with_features, lambda d: d["features"]))
    return F.transform(features, lambda f: F.to_variant_object(F.struct(F.array(f).alias("features"))))


def parse_documents(texts: DataFrame, layout: str = "document") -> DataFrame:
    """`json_data` per document; an outer array is unwrapped into its elements.

    With layout `document` a file is one document over any number of lines or, when its first line is
    a document by itself, one document per line. A text too large for one VARIANT gives a row per feature
    instead, from which `flatten_features` reads the same. Text that is no JSON makes a rejected row.
    """
    if layout == "document":
        first_line = F.regexp_extract("value", r"^\s*(\S[^\n]*)", 1)
        lines = F.when(_parsed(first_line).isNotNull(), F.split("value", "\n")).otherwise(F.array("value"))
        texts = texts.select(SOURCE, F.explode(lines).alias("value"))
    parsed = texts.withColumn("parsed", _parsed(F.col("value")))
    parts = F.coalesce(_array_of("parsed"), _feature_documents(F.col("value")), F.array("parsed"))
    documents = parsed.select("value", SOURCE, F.explode(parts).alias("doc"))
    broken = F.col("json_data").isNull()
    return documents.select("value", SOURCE, F.explode(_elements("doc")).alias("json_data")).select(
        "json_data",
        broken.alias(REJECTED),
        F.when(broken, F.array(F.lit("json_data"))).alias(REASONS),
        F.when(broken, F.array("value")).alias(CELLS),
        F.when(broken, F.col(SOURCE)).alias(SOURCE),
    )


def read_documents(
    spark: SparkSession, paths: str | list[str], layout: str = "document", split_from: int | None = None
) -> DataFrame:
    """The documents of files or folders, see `parse_documents`.

    With layout `document` a file is read whole by one task, unless it is not compressed and longer than `split_from` bytes (by
    default a split of Spark's readers): then its features are read by as many tasks as it has splits, with a row for each, from
    which `flatten_features` reads the same. A file that `split_documents` cannot read so is read whole after all.
    `lines` lets any file be split among tasks.
    """
    paths = [paths] if isinstance(paths, str) else paths
    if layout != "document":
        return _read_texts(spark, paths, layout)
    limit = size_in_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")) if split_from is None else split_from
    listed = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias(SOURCE), "path", "length")
    files = {row[SOURCE]: (literal(row["path"]), row["length"]) for row in listed.collect()}
    large = [uri for uri, (path, length) in files.items() if length > limit and not path.endswith(COMPRESSED)]
    if not large:
        return _read_texts(spark, paths, layout)
    features, others = split_documents(spark, [files[uri][0] for uri in large])
    split = features.select(
        "json_data", F.lit(False).alias(REJECTED), F.lit(None).cast("array<string>").alias(REASONS),
        F.lit(None).cast("array<string>").alias(CELLS), F.lit(None).cast("string").alias(SOURCE),
    )
    whole = [path for uri, (path, _) in files.items() if uri not in large or uri in others]
    return split.unionByName(_read_texts(spark, whole, layout)) if whole else split


def _read_texts(spark: SparkSession, paths: list[str], layout: str) -> DataFrame:
    texts = spark.read.text(paths, wholetext=layout == "document")
    return parse_documents(texts.select("value", F.col("_metadata.file_path").alias(SOURCE)), layout)


def _array_of(document: str) -> Column:
    return F.try_variant_get(document, "$", "array<variant>")


def _elements(document: str) -> Column:
    """The elements of an array, or the document itself."""
    return F.coalesce(_array_of(document), F.array(document))


def check_features(
    documents: DataFrame, paths: dict[str, str], sizes: tuple[str, ...] = (), source: str | None = None
) -> DataFrame:
    """A row per element of `features`: a whole number per path, array lengths for `sizes`, and whether it is rejected.

    A feature with something else than a number at a path is rejected as a whole; one without a value there, or with
    the JSON null, has NULL. A length is NULL where there is no array. `source` names where the documents are from.
    """
    features = explode_path(documents, "json_data", "$.features", "feature")
    read = features.withColumns(
        {name: (size_at if name in sizes else whole_at)("feature", path) for name, path in paths.items()}
    )
    reasons = F.array_compact(
        F.array(*[
            F.when(unreadable_at("feature", path, F.col(name)), F.lit(name))
            for name, path in paths.items() if name not in sizes
        ]).cast("array<string>")
    )
    read = read.withColumn(REASONS, reasons).withColumn(REJECTED, F.size(REASONS) > 0)
    return read.select(
        *paths,
        REJECTED,
        F.when(F.col(REJECTED), F.col(REASONS)).alias(REASONS),
        F.when(F.col(REJECTED), F.array(F.to_json("feature"))).alias(CELLS),
        F.when(F.col(REJECTED), F.lit(source)).alias(SOURCE),
    )


def flatten_features(documents: DataFrame, paths: dict[str, str], sizes: tuple[str, ...] = ()) -> DataFrame:
    """The features that `check_features` accepts."""
    return accepted(check_features(documents, paths, sizes))
