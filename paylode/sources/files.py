"""Paths on whatever file system the table lives on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; empty when it does not exist."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    fs, target = _file_system(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _file_system(spark, path)
    stream = fs.create(target, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def rename_new(spark: SparkSession, source: str, target: str) -> None:
    """Rename that fails if ``target`` exists, as Spark's own stream logs do it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(target)
    context = hadoop.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    context.rename(hadoop.Path(source), at, options)
