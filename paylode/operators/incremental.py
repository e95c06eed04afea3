"""Which days to process, and how far the run has come."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def after_watermark(landed: DataFrame, watermark: dt.date | str | None) -> DataFrame:
    """Landed days strictly after the watermark; all of them when there is none."""
    days = landed.select(F.col("ingest_date").cast("date").alias("ingest_date")).distinct()
    if watermark is None:
        return days
    return days.where(F.col("ingest_date") > F.lit(watermark).cast("date"))


def between_days(landed: DataFrame, first: dt.date | str, last: dt.date | str) -> DataFrame:
    """Landed days of a backfill, which may be processed as one batch."""
    days = landed.select(F.col("ingest_date").cast("date").alias("ingest_date")).distinct()
    return days.where(F.col("ingest_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def advanced_watermark(log: DataFrame) -> DataFrame:
    """Current value per watermark name; the log is append-only and the value never goes back."""
    return log.groupBy("name").agg(F.max("value").alias("value"))


def reprocess_from(target: DataFrame, day: str, days: int) -> Column:
    """First day of the reprocess window: the newest day of ``target`` less ``days``, as a scalar subquery."""
    return target.agg(F.date_sub(F.max(day), days)).scalar()


def in_reprocess_window(source: DataFrame, target: DataFrame, day: str, days: int) -> DataFrame:
    return source.where(F.col(day) >= reprocess_from(target, day, days))
