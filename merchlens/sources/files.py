"""Small files and folders in any store that Spark reads."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str) -> tuple:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _is(error: Py4JJavaError, name: str) -> bool:
    return error.java_exception.getClass().getSimpleName() == name


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder; none if it is not there."""
    fs, where = _at(spark, folder)
    try:
        return sorted(s.getPath().getName() for s in fs.listStatus(where))
    except Py4JJavaError as e:
        if _is(e, "FileNotFoundException"):
            return []
        raise


def modified(spark: SparkSession, path: str) -> float:
    """When a file or folder was last changed, in seconds."""
    fs, where = _at(spark, path)
    return fs.getFileStatus(where).getModificationTime() / 1000


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that is not there yet; False if another writer has made it."""
    fs, where = _at(spark, path)
    try:
        out = fs.create(where, False)
    except Py4JJavaError as e:
        if _is(e, "FileAlreadyExistsException"):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder; raises if it is still there afterwards."""
    fs, where = _at(spark, path)
    if not fs.delete(where, True) and fs.exists(where):
        raise OSError(f"could not remove {path}")
