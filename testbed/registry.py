"""Where the queries and their SQL are collected, and how results are made comparable."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Days, times and lists as text, the same in both engines."""
    columns = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            value = value.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.ArrayType):
            value = F.array_join(value, ",")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            value = value.cast("bigint")
        columns.append(value.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
