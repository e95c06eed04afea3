"""Latest row per key, and the upserts built on it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylode.contracts import Contract


def latest_per_key(rows: DataFrame, key: Sequence[str], newest_first: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the given order.

    Spark keeps only the top row per key and map task before the shuffle
    (WindowGroupLimit), so a hot key does not travel whole.
    """
    order = [F.col(c).desc() if isinstance(c, str) else c for c in newest_first]
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def recency(contract: Contract) -> list[Column]:
    """Newest first: version time, ingest time, ingest day, then a hash so that ties are settled."""
    return [
        F.col(contract.order_by).desc(),
        F.col("_ingested_at").desc(),
        F.col("_ingest_date").desc(),
        F.xxhash64(*contract.names).desc(),
    ]


def latest(rows: DataFrame, contract: Contract) -> DataFrame:
    return latest_per_key(rows, contract.business_key, recency(contract))


def current_state_upsert(
    existing: DataFrame, batch: DataFrame, key: Sequence[str], newest_first: Sequence[Column | str],
) -> DataFrame:
    """One row per key over all that is known (slowly changing dimension, type 1)."""
    return latest_per_key(existing.unionByName(batch, allowMissingColumns=True), key, newest_first)


def partition_upsert(
    existing: DataFrame, batch: DataFrame, key: Sequence[str], newest_first: Sequence[Column | str],
    touched: Sequence[dt.date | str], partition: str = "dt",
) -> DataFrame:
    """New content of the ``touched`` days, which alone are read of ``existing``; other days do not appear."""
    kept = existing.where(F.col(partition).isin([dt.date.fromisoformat(str(day)) for day in touched]))
    return latest_per_key(kept.unionByName(batch, allowMissingColumns=True), key, newest_first)


def partitions_of_moved_keys(
    existing: DataFrame, batch: DataFrame, key: Sequence[str], partition: str = "dt",
) -> DataFrame:
    """Partitions of ``existing`` that hold a key of the batch under another partition value.

    The batch is first reduced to one row per key, so a key sent many times joins once.  A
    stored value differs from one of several exactly if it differs from their least or greatest.
    """
    arriving = batch.groupBy(*key).agg(F.min(partition).alias("_least"), F.max(partition).alias("_greatest"))
    stored = F.col(partition)
    return (
        existing.select(*key, partition)
        .join(arriving, list(key))
        .where((stored != F.col("_least")) | (stored != F.col("_greatest")))
        .select(partition)
        .distinct()
    )


def delete_insert(target: DataFrame, fresh: DataFrame, key: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in ``fresh``, plus ``fresh``; new columns are added."""
    kept = target.join(fresh.select(*key), list(key), "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)
