"""Files and folders through Spark's own file systems, whatever the store."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _at(spark, path)
    return system.exists(where)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names directly below a folder; none if it is not there."""
    system, where = _at(spark, folder)
    return [status.getPath().getName() for status in system.listStatus(where)] if system.exists(where) else []


def uri(spark: SparkSession, path: str) -> str:
    """A path as Spark names the file that a row is from."""
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).toUri().toString()


def listing(spark: SparkSession, path: str) -> Iterator[tuple[str, int]]:
    """(path, modification time in ms) of a file, or of the files below a
    folder. Hidden files and folders, as Spark's readers see them, are left out."""
    system, where = _at(spark, path)
    base = where.depth()
    found = system.listFiles(where, True)
    while found.hasNext():
        status = found.next()
        parts = status.getPath().toString().split("/")[-max(1, status.getPath().depth() - base) :]
        if not any(part.startswith(("_", ".")) for part in parts):
            yield status.getPath().toString(), status.getModificationTime()


def summary(spark: SparkSession, folder: str) -> list[int]:
    """Files, bytes and modification time of a folder."""
    system, where = _at(spark, folder)
    content = system.getContentSummary(where)
    return [content.getFileCount(), content.getLength(), system.getFileStatus(where).getModificationTime()]


def delete(spark: SparkSession, path: str) -> None:
    system, where = _at(spark, path)
    system.delete(where, True)


def read_text(spark: SparkSession, path: str) -> str:
    system, where = _at(spark, path)
    stream = system.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with this text, whole or not at all. False, and
    nothing changed, if it exists: of several writers, one succeeds."""
    system, where = _at(spark, path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    if system.exists(where):
        return False
    aside = hadoop.Path(where.getParent(), f".{uuid.uuid4().hex}")
    stream = system.create(aside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = hadoop.FileContext.getFileContext(where.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        context.rename(aside, where, plain)
    except Py4JJavaError as error:
        system.delete(aside, False)
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    return True
