"""Small files and file operations on any Hadoop file system, by the session's own settings."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """Hadoop path and its file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _at(spark, path)
    return bool(fs.exists(at))


def remove(spark: SparkSession, path: str) -> None:
    at, fs = _at(spark, path)
    fs.delete(at, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    at, fs = _at(spark, path)
    if not fs.rename(at, _at(spark, to)[0]):
        raise OSError(f"cannot rename {path} to {to}")


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder, in order; empty if there is no such folder."""
    at, fs = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside ``path`` and rename it into place, so a reader sees all of it or none."""
    at, fs = _at(spark, path)
    aside, _ = _at(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(at):
        fs.delete(at, False)
    if not fs.rename(aside, at):
        raise OSError(f"cannot rename {aside.toString()} to {path}")


def read_text(spark: SparkSession, path: str) -> str:
    at, fs = _at(spark, path)
    size = int(fs.getFileStatus(at).getLen())
    source = fs.open(at)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(source, size)).decode()
    finally:
        source.close()


def concat(spark: SparkSession, folder: str, parts: list[str], name: str) -> None:
    """Join the files ``parts`` of a folder, in this order, to the file ``name``, by the file system itself.

    No task and no driver stream holds the data: HDFS moves block references.
    A file system without such an operation makes this fail
    (``RuntimeError``); the parts stay as they are then.
    """
    _, fs = _at(spark, folder)
    if fs.getScheme() == "file":
        fs = fs.getRawFileSystem()  # the checksummed view of a local folder cannot join files
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    aside, to = path(f"{folder}/_joining-{uuid.uuid4().hex}"), path(f"{folder}/{name}")
    full = [p for p in map(path, (f"{folder}/{p}" for p in parts)) if fs.getFileStatus(p).getLen() > 0]
    fs.create(aside, True).close()
    if full:
        sources = spark.sparkContext._gateway.new_array(path, len(full))
        for i, p in enumerate(full):
            sources[i] = p
        try:
            fs.concat(aside, sources)
        except (PySparkException, Py4JJavaError) as e:
            fs.delete(aside, False)
            raise RuntimeError(
                f"the file system of {folder} cannot join files; write the ranks as ordered part files (single_file=False)"
            ) from e
    if not fs.rename(aside, to):
        raise OSError(f"cannot rename to {folder}/{name}")
