"""Where keys are stored: a bucketed table of key and event day, so that no merge searches the facts themselves.

The table is append-only: each merge adds the places of its keys, and the newest place of a key counts.  It is
written in buckets by the key's hash and read by bucket, so a lookup shuffles the keys that are asked for and never
the table; Parquet Bloom filters on the key let a search for single keys skip whole files.  ``compact`` rewrites
the newest places into a new folder, which readers use once it is complete.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylode.sources.files import children, exists, remove


@dataclass(frozen=True)
class KeyIndex:
    """Places (``dt``) of the values of one text column ``key``, below ``path``."""

    path: str
    key: str

    def _folders(self, spark: SparkSession) -> list[str]:
        names = [n for n in children(spark, self.path) if n.startswith("version=")]
        return [n for n in names if exists(spark, f"{self.path}/{n}/_SUCCESS")]

    def is_built(self, spark: SparkSession) -> bool:
        return bool(self._folders(spark))

    @contextmanager
    def _table(self, spark: SparkSession, folder: str) -> Iterator[str]:
        """The folder as a table, which the catalog knows inside only; what makes it bucketed is in the names of its files."""
        buckets = int(folder.rpartition("-")[2])
        name = f"key_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {name} ({self.key} STRING, dt DATE, written BIGINT) USING parquet "
            # Adaptive: a filter of the size that the keys of a file ask for, not of a megabyte in every file.
            f"OPTIONS ('parquet.bloom.filter.enabled#{self.key}' 'true', "
            f"'parquet.bloom.filter.adaptive.enabled#{self.key}' 'true', 'parquet.bloom.filter.adaptive.enabled' 'true') "
            f"CLUSTERED BY ({self.key}) SORTED BY ({self.key}) INTO {buckets} BUCKETS "
            f"LOCATION '{self.path}/{folder}'")
        try:
            yield name
        finally:
            spark.sql(f"DROP TABLE {name}")

    def _append(self, places: DataFrame, folder: str) -> None:
        spark = places.sparkSession
        rows = places.select(F.col(self.key), F.col("dt").cast("date").alias("dt"), F.lit(time.time_ns()).alias("written"))
        # One file per bucket and merge.
        rows = rows.repartition(int(folder.rpartition("-")[2]), self.key)
        with self._table(spark, folder) as name:
            rows.write.insertInto(name)

    def rows(self, spark: SparkSession) -> DataFrame:
        folders = self._folders(spark)
        if not folders:
            return spark.createDataFrame([], f"{self.key} string, dt date, written bigint")
        with self._table(spark, folders[-1]) as name:
            return spark.table(name)

    def record(self, places: DataFrame) -> None:
        """Add places of keys; adding them again changes nothing that ``newest`` or ``every`` tell."""
        folders = self._folders(places.sparkSession)
        self._append(places.distinct(), folders[-1] if folders else self._folder(places.sparkSession, 1))

    @staticmethod
    def _folder(spark: SparkSession, number: int) -> str:
        """A new folder's name, with as many buckets as the session shuffles to: they stay what they are."""
        return f"version={number:09d}-{spark.conf.get('spark.sql.shuffle.partitions')}"

    def _asked(self, keys: DataFrame) -> DataFrame:
        asked = keys.where(F.col(self.key).isNotNull()).select(self.key).distinct()
        return self.rows(keys.sparkSession).join(asked, self.key, "left_semi")

    def newest(self, keys: DataFrame) -> DataFrame:
        """``key, dt``: where each of the keys is stored now, for those that are."""
        return self._asked(keys).groupBy(self.key).agg(F.max_by("dt", "written").alias("dt"))

    def every(self, keys: DataFrame) -> DataFrame:
        """``key, dt``: all days that were ever recorded for the keys."""
        return self._asked(keys).select(self.key, "dt").distinct()

    def compact(self, spark: SparkSession, newest_only: bool = True) -> None:
        """Rewrite into a new folder: the newest place of each key, or each different place once."""
        folders = self._folders(spark)
        if not folders:
            return
        rows = self.rows(spark)
        if newest_only:
            rows = rows.groupBy(self.key).agg(F.max_by("dt", "written").alias("dt"))
        else:
            rows = rows.select(self.key, "dt").distinct()
        started = max(int(n[8:17]) for n in children(spark, self.path) if n.startswith("version="))
        self._append(rows, self._folder(spark, started + 1))
        for name in folders[:-1]:
            remove(spark, f"{self.path}/{name}")
