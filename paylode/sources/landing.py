"""Landing feeds: ``<entity>/ingest_date=YYYY-MM-DD/*`` with one JSON object per line."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paylode.contracts import ENTITIES, Contract
from paylode.functions.records import fingerprint, json_members, last_values
from paylode.sources.files import children, exists

DAY_IN_PATH = r"ingest_date=(\d{4}-\d{2}-\d{2})"
PROFILE_SCHEMA = "kind string, name string, rows bigint, ingest_date date"
# Unknown names of a day that a log entry spells out; the stored profile has all of them.
LISTED_NAMES = 100


class MissingSourceError(RuntimeError):
    """A feed has not delivered the day; trying again at once would not help."""


def feed_path(landing: str, entity: str, day: dt.date | str) -> str:
    return f"{landing.rstrip('/')}/{entity}/ingest_date={day}"


def landed_days(spark: SparkSession, landing: str, entity: str = "payments") -> list[dt.date]:
    """Days with a partition in the landing zone, in order; a directory listing, no scan."""
    names = children(spark, f"{landing.rstrip('/')}/{entity}")
    return [dt.date.fromisoformat(n.partition("=")[2]) for n in names if n.startswith("ingest_date=")]


def require_feed(spark: SparkSession, landing: str, entity: str, days: Iterable[dt.date | str]) -> list[str]:
    paths = [feed_path(landing, entity, day) for day in days]
    for path in paths:
        if not exists(spark, path):
            raise MissingSourceError(f"no {entity} feed at {path}")
    return paths


def lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Non-blank text lines with the file and the day they came from."""
    return with_origin(spark.read.text(list(paths)))


def with_origin(text: DataFrame) -> DataFrame:
    """Lineage from the file itself, so that it is the same in batch and in streams."""
    source = F.col("_metadata.file_path")
    return text.where(F.trim("value") != "").select(
        "value",
        source.alias("_source_file"),
        # A stray file outside the folders of days has no day; it must not stop the others.
        F.try_to_date(F.regexp_extract(source, DAY_IN_PATH, 1)).alias("ingest_date"),
    )


def parse(text: DataFrame, contract: Contract) -> DataFrame:
    """Lines to bronze rows: every value as text, in one pass and without inferring a schema.

    * columns of the contract, NULL where the record does not have them;
    * ``_extra``: what the contract does not know, by name;
    * ``_absent``: contract columns the record did not mention at all;
    * ``_corrupt_record``: the line, if it is not a JSON object;
    * lineage and a fingerprint over all that was received.
    """
    known = F.array(*[F.lit(name) for name in contract.names])
    fields = F.col("_fields")
    # Two columns, so that a line is parsed once however often its members are used.
    parsed = text.withColumn("_members", json_members(F.col("value"))).withColumn(
        "_fields", last_values(F.col("_members"))
    )
    received = F.coalesce(fields, F.create_map().cast("map<string,string>"))
    return parsed.select(
        *[fields[name].alias(name) for name in contract.names],
        F.map_filter(received, lambda name, _: ~F.array_contains(known, name)).alias("_extra"),
        F.array_except(known, F.map_keys(received)).alias("_absent"),
        F.when(fields.isNull(), F.col("value")).alias("_corrupt_record"),
        "_source_file",
        F.current_timestamp().alias("_ingested_at"),
        fingerprint(received).alias("_row_hash"),
        "ingest_date",
    )


def read_feed(spark: SparkSession, landing: str, contract: Contract, days: Iterable[dt.date | str]) -> DataFrame:
    """Bronze rows of some landed days; several days are one scan."""
    return parse(lines(spark, require_feed(spark, landing, contract.entity, days)), contract)


def profile(bronze: DataFrame, contract: Contract) -> DataFrame:
    """``ingest_date, kind, name, rows``: what the days contained, in one pass over the bookkeeping columns.

    Kinds are ``lines``, ``corrupt``, ``unknown`` (names outside the contract), ``absent``
    (required names a record lacks) and ``version`` (contract version of the record).  Counts
    are combined before the shuffle; the result has a row per name and day.
    """
    required = F.array(*[F.lit(name) for name in contract.required_names])
    version = F.lit(1)
    for column in contract.columns:
        if column.since > 1:
            sent = ~F.array_contains("_absent", column.name)
            version = F.greatest(version, F.when(sent, column.since).otherwise(1))

    def entry(kind: str, name) -> Column:
        return F.struct(F.lit(kind).alias("kind"), name.cast("string").alias("name"))

    entries = F.concat(
        F.array(
            entry("lines", F.lit("")),
            entry("version", version),
            F.when(F.col("_corrupt_record").isNotNull(), entry("corrupt", F.lit(""))),
        ),
        F.transform(F.map_keys("_extra"), lambda name: entry("unknown", name)),
        F.transform(F.array_intersect("_absent", required), lambda name: entry("absent", name)),
    )
    return (
        bronze.select("ingest_date", F.explode(F.array_compact(entries)).alias("_entry"))
        .groupBy("ingest_date", "_entry.kind", "_entry.name")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def listed(profiled: DataFrame, limit: int = LISTED_NAMES) -> DataFrame:
    """A profile with at most ``limit`` unknown names a day: those of most rows, equal ones by name.

    The limit holds in every task before names meet in one, so a day of any number of names is no large group.
    The other kinds have the names of the contract and stay whole.
    """
    own = F.when(F.col("kind") != "unknown", F.col("name"))
    most = Window.partitionBy("ingest_date", "kind", own).orderBy(F.col("rows").desc(), "name")
    return profiled.withColumn("_place", F.row_number().over(most)).where(F.col("_place") <= limit).drop("_place")


def drift_of(profiled: DataFrame) -> DataFrame:
    """``ingest_date, kind, columns``: names nobody agreed to (those that ``listed`` has), and required names no
    record of the day had."""
    day = Window.partitionBy("ingest_date")
    lines = F.max(F.when(F.col("kind") == "lines", F.col("rows"))).over(day)
    missing = (F.col("kind") == "absent") & (F.col("rows") == F.col("_lines"))
    return (
        listed(profiled).withColumn("_lines", lines)
        .where((F.col("kind") == "unknown") | missing)
        .groupBy(
            "ingest_date",
            F.when(missing, "missing_required_columns").otherwise("unknown_columns").alias("kind"),
        )
        .agg(F.array_sort(F.collect_set("name")).alias("columns"))
    )


def counts_of(profiled: DataFrame) -> DataFrame:
    """Per day: lines read, unreadable lines, and the newest contract version seen."""
    def total(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rows"))), F.lit(0))

    return profiled.groupBy("ingest_date").agg(
        total("lines").alias("rows_read"),
        total("corrupt").alias("corrupt_lines"),
        F.max(F.when(F.col("kind") == "version", F.col("name").cast("int"))).alias("contract_version"),
    )


def drift(bronze: DataFrame, contract: Contract) -> DataFrame:
    return drift_of(profile(bronze, contract))


def ingest_counts(bronze: DataFrame, contract: Contract) -> DataFrame:
    return counts_of(profile(bronze, contract))


def landing_completeness(
    spark: SparkSession, landing: str, days: Sequence[dt.date | str], entities: Sequence[str] = ENTITIES,
) -> DataFrame:
    """``entity, ingest_date, present, rows`` for every feed and day expected.

    The expected list has one row per feed and day, and presence is a directory listing;
    the lines are counted by Spark.
    """
    expected = [
        (entity, str(day), exists(spark, feed_path(landing, entity, day))) for entity in entities for day in days
    ]
    calendar = spark.createDataFrame(expected, "entity string, ingest_date string, present boolean")
    paths = [feed_path(landing, entity, day) for entity, day, present in expected if present]
    if not paths:
        return calendar.withColumn("rows", F.lit(None).cast("bigint"))
    counted = (
        lines(spark, paths)
        .select(
            F.regexp_extract("_source_file", r"([^/]+)/ingest_date=", 1).alias("entity"),
            F.col("ingest_date").cast("string").alias("ingest_date"),
        )
        .groupBy("entity", "ingest_date").agg(F.count(F.lit(1)).alias("_lines"))
    )
    rows = F.when(F.col("present"), F.coalesce("_lines", F.lit(0))).alias("rows")
    return calendar.join(counted, ["entity", "ingest_date"], "left").select(
        "entity", "ingest_date", "present", rows
    )
