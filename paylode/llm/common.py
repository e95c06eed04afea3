"""What the operators share: reading tables, shipping this package to Python workers, connected groups."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylode.session import staged

EDGES_PER_TASK = 200_000
BATCH_BYTES = "8m"
_BATCH, _DEFAULT_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"

ROOT = str(Path(__file__).resolve().parents[2])


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package also where the driver only has it on ``sys.path``.

    A session that leaves the size of Arrow batches at Spark's default gets smaller ones: a task holds each
    batch in the JVM and in Python.
    """
    if spark.conf.get(_BATCH) == _DEFAULT_BATCH:
        spark.conf.set(_BATCH, BATCH_BYTES)
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(":")
    if ROOT not in paths:
        environment["PYTHONPATH"] = ":".join(p for p in (*paths, ROOT) if p)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def text_md5(column: str = "text") -> Column:
    """16 bytes that stand for a whole text; null counts as the empty text."""
    return F.unhex(F.md5(F.coalesce(F.col(column), F.lit("")).cast("binary")))


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``most_bytes`` of one text column; one longer text is a piece of its own.

    Bounds what numpy holds at once, whatever the size of an Arrow batch.
    """
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(lengths):
        yield batch.slice(start)


def hash_sample(rows: DataFrame, most: int, total: int, key: str, *ties: str) -> DataFrame:
    """The ``most`` rows with the smallest hash of their key, of about ``total``.

    Rows above the hash that leaves somewhat more than ``most`` go at once, so that not every task keeps that many.
    """
    share = min(1.0, (most + 6 * most ** 0.5 + 10) / max(total, 1))
    hashed = F.xxhash64(key)
    return rows.where(hashed <= min(int(share * 2**64) - 2**63, 2**63 - 1)).orderBy(hashed, key, *ties).limit(most)


def merged_only(df: DataFrame) -> DataFrame:
    """``df`` for a join that never broadcasts a side.

    Spark sizes a table by its files and its columns' types: it takes a list for one element, an explode for a row
    each and a text for 20 bytes, and does not go back on a broadcast.  For joins that have such a side.
    """
    return df.hint("merge")


def few_tasks(df: DataFrame, rows: int, per_task: int) -> DataFrame:
    """No more tasks than ``rows`` need; many rows keep the partitions that they have."""
    return df.coalesce(1 + rows // per_task)


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour and none that has one itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("lower"), F.lit(0).alias("upper")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("lower").alias("lower"), F.max("upper").alias("upper")).where(
        "lower > 1 or lower = 1 and upper = 1").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (the smallest id reachable) for every node of ``edges``.

    Large-star and small-star rounds: each hands a node's neighbours to the smallest of them, until only
    stars are left.  A round is two grouped minimums and joins on them; the minimum combines before the
    shuffle and a join splits a hot node, so no neighbourhood is ever gathered.  Each round's edges are a
    written table; only their number reaches the driver.
    """
    current = staged(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct(), "edges")
    rows = current.count()

    def sized(df: DataFrame) -> DataFrame:
        return few_tasks(df, 2 * rows, EDGES_PER_TASK)

    current = sized(current)
    while rows and not _is_stars(current):
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = sized(both.groupBy("u").agg(F.min("v").alias("low"))).select("u", F.least("u", "low").alias("low"))
        large = sized(both.where("v > u").join(lowest, "u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = sized(staged(sized(large.distinct()), "large-star"))
        lowest = sized(large.groupBy("u").agg(F.min("v").alias("low")))
        small = sized(large.join(lowest, "u")).where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        current = sized(staged(sized(small.union(lowest.select("u", F.col("low").alias("v"))).distinct()), "small-star"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
