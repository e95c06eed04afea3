"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from paylode.sources.files import remove

# What every job relies on.  Joins carry no broadcast hint for dimensions: Spark
# compares the measured size with the thresholds below, and falls back to a
# sort-merge join whose skewed partitions AQE splits.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_session(app: str = "paylode", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` adds to or replaces them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Event dates and epoch seconds are defined in UTC, whoever built the session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without: it gets a temporary folder, because
    there the driver and the executors are one machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
        named = tempfile.mkdtemp(prefix="paylode-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


_OWNER = "paylode.scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, never reused path below the shared folder, in the folder of the job that owns it if there is one."""
    owner = spark.sparkContext.getLocalProperty(_OWNER)
    parts = [shared_dir(spark), *([owner] if owner else []), f"{name}-{uuid.uuid4().hex}"]
    return "/".join(parts)


@contextmanager
def owned_scratch(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is removed at the end, also after a failure; scopes may be nested.

    Threads started through Spark's inheritable targets stage into the same folder.  Results that are
    still to be computed from staged tables must be written before the end.
    """
    context = spark.sparkContext
    outer = context.getLocalProperty(_OWNER)
    owner = "/".join([*([outer] if outer else []), f"job-{uuid.uuid4().hex}"])
    context.setLocalProperty(_OWNER, owner)
    try:
        yield
    finally:
        context.setLocalProperty(_OWNER, outer)
        remove(spark, f"{shared_dir(spark)}/{owner}")


def settled(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The result of ``build`` as a written table; what was staged on the way is removed."""
    path = scratch_path(spark, name)
    with owned_scratch(spark):
        result = build()
        result.write.parquet(path)
    return spark.read.schema(result.schema).parquet(path)


def staged(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage on storage that outlives an executor, and keeps it columnar,
    so each later reader scans only the columns (and partitions) it needs.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clustered(df: DataFrame, name: str, column: str) -> DataFrame:
    """Like ``staged``, but in buckets of ``column``, which several joins on that column alone read without a shuffle.

    Rows of equal ``column`` are one task's in those joins, which AQE does not split: for columns that
    identify a row of ``df``.  The catalog knows the table only while it is written.
    """
    spark = df.sparkSession
    path, table = scratch_path(spark, name), f"{name}_{uuid.uuid4().hex}".replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Dealt like the buckets, so that a task writes one file.
    dealt = df.repartition(buckets, column)
    dealt.write.bucketBy(buckets, column).sortBy(column).option("path", path).option("compression", "zstd").saveAsTable(table)
    try:
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")
