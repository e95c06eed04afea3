"""Payments that arrive after what refers to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_arrived_parents(waiting: DataFrame, arrived: DataFrame, days: int) -> DataFrame:
    """Waiting rows with ``payment_found`` and ``_parent_amount`` of arrived payments in their window.

    ``arrived`` has ``payment_id, amount, dt``, one row per payment.
    """
    parents = arrived.select(
        F.col("payment_id").alias("_parent_id"), F.col("amount").alias("_parent_amount"), F.col("dt").alias("_parent_dt"))
    in_window = F.col("_parent_dt") >= F.date_sub(F.col("_ingest_date").cast("date"), days)
    found = waiting.join(parents, (F.col("payment_id") == F.col("_parent_id")) & in_window, "left")
    return found.withColumn("payment_found", F.col("_parent_id").isNotNull()).drop("_parent_id", "_parent_dt")


def exceeding() -> Column:
    """Whether a row that has met its payment is above it."""
    return F.coalesce(F.col("amount") > F.col("_parent_amount"), F.lit(False))
