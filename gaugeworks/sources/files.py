"""Listing and removing folders with the file system of their path (local, HDFS, object store)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(context._jsc.hadoopConfiguration()), folder


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty when it does not exist."""
    fs, folder = _at(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, folder = _at(spark, path)
    fs.delete(folder, True)


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, length and time of change of the files directly below a folder; hidden ones are left out."""
    fs, folder = _at(spark, path)
    found = fs.listStatus(folder) if fs.exists(folder) else []
    named = [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found if s.isFile()]
    return [f for f in named if f[0][0] not in "._"]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file, in place of any other."""
    fs, file = _at(spark, path)
    out = fs.create(file, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None where there is none."""
    fs, file = _at(spark, path)
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
