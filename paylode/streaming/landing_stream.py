"""Continuous counterpart of the daily jobs: landed files as a stream, merged batch by batch.

The stream only decides which files are new (its checkpoint replaces the date watermark);
every micro-batch goes through the same validation and upsert as the daily job, so late
rows are merged or quarantined with a reason.  An event-time watermark would drop them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from paylode.contracts import CONTRACTS, LATE_DATA_DAYS
from paylode.plans.jobs import silver_batch
from paylode.session import staged, use_utc
from paylode.sources.lake import Lake
from paylode.sources.landing import parse, with_origin


def read_stream(spark: SparkSession, lake: Lake, entity: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return parse(with_origin(reader.text(f"{lake.landing}/{entity}")), CONTRACTS[entity])


def merge_stream(
    spark: SparkSession, lake: Lake, entity: str, checkpoint: str, *,
    late_days: int = LATE_DATA_DAYS, files_per_batch: int | None = None,
) -> StreamingQuery:
    """Merge all files that have landed since the last call, then stop.

    The upsert is idempotent, and what fails is written under the number of its micro-batch,
    so a micro-batch repeated after a failure changes nothing.
    """
    use_utc(spark)

    def merge(batch: DataFrame, number: int) -> None:
        # The stream runs in a session of its own.
        session = batch.sparkSession
        rows = staged(batch, f"stream-{entity}")
        # Rows of files outside the folders of days are set aside unread: no rule of theirs can be checked.
        stray = rows.where("ingest_date is null")
        if not stray.isEmpty():
            stray.write.mode("overwrite").parquet(lake.path("quarantine_stray", entity, f"batch={number}"))
        rows = rows.where("ingest_date is not null")
        days = [str(r[0]) for r in rows.select("ingest_date").distinct().collect()]
        if days:
            failed = lake.path("quarantine_stream", entity, f"batch={number}")
            silver_batch(session, lake, entity, rows, sorted(days), late_days, failed)

    return (
        read_stream(spark, lake, entity, files_per_batch)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
