"""Names of landed files, without reading them."""

from __future__ import annotations

import re
import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# The columns of Spark's binary file source. Content that is not selected is not read.
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"
# A file as it was at a time: the same path with other content is another version. `modified` is in milliseconds.
VERSION = "path string, length bigint, modified bigint"


def literal(path: str) -> str:
    """A path that readers take as it stands, whatever pattern characters are in its name."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def list_files(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The path of each file, ready for readers, by the encoded form in which rows name their file."""
    files = spark.read.format("binaryFile").load(paths).select("_metadata.file_path", "path")
    return {row[0]: literal(row[1]) for row in files.collect()}


def landed(spark: SparkSession, folder: str) -> list[str]:
    """The paths of the files in a folder, as they are; `literal` makes them ready for readers."""
    return [row["path"] for row in spark.read.format("binaryFile").load(folder).select("path").collect()]


def versions(spark: SparkSession, folder: str) -> DataFrame:
    """The files in a folder as they are now, see `VERSION`; none if there is no such folder. No content is read."""
    if not _file(spark, folder)[1].exists(_file(spark, folder)[0]):
        return spark.createDataFrame([], VERSION)
    files = spark.read.format("binaryFile").schema(BINARY_FILE).load(folder)
    return files.select("path", "length", F.unix_millis("modificationTime").alias("modified"))


def _file(spark: SparkSession, path: str):
    """A path and its file system."""
    file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return file, file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Deletes files, in whatever file system they are. One that is gone already is no error."""
    for path in paths:
        file, system = _file(spark, path)
        system.delete(file, False)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder with all that is in it; one that is gone already is no error."""
    folder, system = _file(spark, path)
    system.delete(folder, True)


def clear(spark: SparkSession, files: list[Row], archive: str | None = None) -> None:
    """Deletes files of given versions, or moves them to the folder `archive`. A file that has changed since stays."""
    for version in files:
        file, system = _file(spark, version["path"])
        if not system.exists(file):
            continue
        status = system.getFileStatus(file)
        if (status.getLen(), status.getModificationTime()) != (version["length"], version["modified"]):
            continue
        if archive is None:
            system.delete(file, False)
            continue
        folder, _ = _file(spark, archive)
        system.mkdirs(folder)
        # Other content under the same name is another file there.
        place, _ = _file(spark, f"{archive.rstrip('/')}/{version['modified']}-{file.getName()}")
        system.rename(file, place)


def create_new(spark: SparkSession, path: str) -> bool:
    """Creates an empty file unless there is one; whether it did. Of several that try at once one does, where the file system
    creates files in one step (local disks and HDFS do)."""
    file, system = _file(spark, path)
    system.mkdirs(file.getParent())
    if system.getUri().getScheme() == "file":
        return bool(spark.sparkContext._jvm.java.io.File(file.toUri().getPath()).createNewFile())
    try:
        system.create(file, False).close()
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file with a text, in place of any that is there."""
    file, system = _file(spark, path)
    stream = system.create(file, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is no such file."""
    file, system = _file(spark, path)
    if not system.exists(file):
        return None
    stream = system.open(file)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def ages(spark: SparkSession, folder: str) -> dict[str, float]:
    """The names of the files in a folder, and how many seconds ago each was written."""
    file, system = _file(spark, folder)
    if not system.exists(file):
        return {}
    now = time.time()
    return {s.getPath().getName(): now - s.getModificationTime() / 1000 for s in system.listStatus(file)}
