"""Tables of the lake: partitioned facts, versioned dimensions, quarantine, published data."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paylode.contracts import CONTRACTS
from paylode.sources.files import children, exists, remove


@dataclass(frozen=True)
class Lake:
    """``root`` holds bronze, silver, quarantine, marts and gold; ``landing`` belongs to the feeds."""

    root: str
    landing: str

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    # ---------------------------------------------------------------- reading
    def bronze(self, spark: SparkSession, entity: str) -> DataFrame:
        return read_table(spark, self.path("bronze", entity), CONTRACTS[entity].bronze_schema())

    def silver(self, spark: SparkSession, entity: str) -> DataFrame:
        """The current table, by contract schema; without files it is empty, not an error.

        The explicit schema is matched by name, so files written before a column existed
        read it as NULL.
        """
        contract = CONTRACTS[entity]
        path = self.path("silver", entity)
        if contract.event_date:
            return read_table(spark, path, contract.silver_schema())
        return read_version(spark, path, contract.silver_schema())

    def has_silver(self, spark: SparkSession, entity: str) -> bool:
        return exists(spark, self.path("silver", entity))

    def table(self, spark: SparkSession, *parts: str, schema: StructType | str) -> DataFrame:
        return read_table(spark, self.path(*parts), schema)


def read_table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A Parquet table by schema; a filter on its partition column prunes directories."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def on_days(table: DataFrame, days: Iterable[dt.date | str], column: str = "dt") -> DataFrame:
    """Only the given days, resolved when files are listed."""
    return table.where(F.col(column).isin([dt.date.fromisoformat(str(d)) for d in days]))


# ------------------------------------------------------------------ partitions
def overwrite_partitions(
    df: DataFrame, path: str, column: str, expected: Iterable[str] = (), rebalance: bool = True,
) -> None:
    """Replace the partitions of ``df``, and empty those of ``expected`` that got no row.

    REBALANCE gives one file per small partition and splits a large one, where
    ``repartition(column)`` would make one task write a whole hot day.  Without it rows
    are written where they are, for input that already comes day by day.  Files are staged
    and moved when all tasks are done, so ``df`` may read the table it replaces.
    """
    spark = df.sparkSession
    expected = {str(value) for value in expected}
    before = {value: children(spark, f"{path}/{column}={value}") for value in expected}
    rows = df.hint("rebalance", column) if rebalance else df
    (
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(column).parquet(path)
    )
    # A dynamic overwrite leaves a partition alone when it has no row for it: stale rows would stay.
    empty = spark.createDataFrame([], StructType([f for f in df.schema.fields if f.name != column]))
    for value, files in before.items():
        if files and children(spark, f"{path}/{column}={value}") == files:
            empty.write.mode("overwrite").parquet(f"{path}/{column}={value}")


# -------------------------------------------------------------------- versions
def _versions(spark: SparkSession, path: str) -> list[str]:
    """Committed versions, oldest first: the marker file is the last thing a write makes."""
    names = [name for name in children(spark, path) if name.startswith("version=")]
    return [name for name in names if exists(spark, f"{path}/{name}/_SUCCESS")]


def read_version(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    versions = _versions(spark, path)
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{versions[-1]}")


def write_version(df: DataFrame, path: str, keep: int = 2) -> None:
    """Write ``df`` beside the version it may have been read from.

    Readers see the old state until the new one is complete, and a lost executor or
    driver loses nothing.  Versions before the last ``keep`` are dropped afterwards.
    """
    spark = df.sparkSession
    names = [name for name in children(spark, path) if name.startswith("version=")]
    number = int(names[-1].partition("=")[2]) + 1 if names else 1
    df.hint("rebalance").write.parquet(f"{path}/version={number:09d}")
    for name in _versions(spark, path)[:-keep]:
        remove(spark, f"{path}/{name}")
