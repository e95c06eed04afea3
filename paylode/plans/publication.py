"""What is published: immutable versions of the datasets, and one record that names a version of each.

``gold/<dataset>/version=<v>[/fecha=<day>]`` is written once and never changed.  A publication is a record of
``gold/_publications/<channel>``: for every dataset and day the version that holds it, and its rows.  Readers go
through the newest record, so they see all datasets of one publication or all of the one before, whatever
happens between.  A day that did not change is named again, not written again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylode.plans import gold
from paylode.sources.control import VersionedRecord
from paylode.sources.files import children, remove
from paylode.sources.lake import Lake, on_days

CURRENT = "current"
WHOLE = ""  # the part of a dataset that has no days
KEPT = 2


class PublicationConflict(RuntimeError):
    """Another run published meanwhile; its publication stays."""


def channel(lake: Lake, name: str = CURRENT) -> VersionedRecord:
    return VersionedRecord(lake.path("gold", "_publications", name))


def published_record(spark: SparkSession, lake: Lake, name: str = CURRENT) -> dict | None:
    return channel(lake, name).newest(spark)[1]


def partition_last(schema: str, column: str) -> str:
    """A schema text with its partition column behind the others, where files have it."""
    fields = schema.split(", ")
    own = [f for f in fields if f.startswith(f"{column} ")]
    return ", ".join([f for f in fields if f not in own] + own)


def read_gold(spark: SparkSession, lake: Lake, name: str, of: str = CURRENT) -> DataFrame:
    """A published dataset with its columns in published order; filters on ``fecha`` prune folders."""
    return read_parts(spark, lake, name, (published_record(spark, lake, of) or {"parts": {}})["parts"].get(name, {}))


def read_parts(spark: SparkSession, lake: Lake, name: str, parts: Mapping[str, Mapping]) -> DataFrame:
    schema, root = gold.GOLD_SCHEMAS[name], lake.path("gold", name)
    if not parts:
        return spark.createDataFrame([], schema)
    names = [field.split(" ")[0] for field in schema.split(", ")]
    files = partition_last(schema, "fecha") if name in gold.DATED else schema
    paths = [_folder(root, name, day, part["version"]) for day, part in sorted(parts.items())]
    return spark.read.schema(f"{files}, version string").option("basePath", root).parquet(*paths).select(*names)


def _folder(root: str, name: str, day: str, version: str) -> str:
    return f"{root}/version={version}" + (f"/fecha={day}" if name in gold.DATED else "")


# --------------------------------------------------------------------- writing
@dataclass
class Draft:
    """A publication being written; nobody sees it before ``announce``."""

    spark: SparkSession
    lake: Lake
    number: int
    before: dict | None
    stamp: str
    parts: dict[str, dict[str, dict]]

    def write(self, name: str, rows: DataFrame, days: Iterable[str] | None = None) -> None:
        """The dataset, or for one by day only those ``days``; the other days stay as they were published."""
        version = f"{self.number:09d}-{self.stamp}"
        root = self.lake.path("gold", name)
        path = f"{root}/version={version}"
        if name not in gold.DATED:
            rows.hint("rebalance").write.parquet(path)
            self.parts[name] = {WHOLE: {"version": version, "rows": self.spark.read.parquet(path).count()}}
            return
        earlier = {} if self.before is None else self.before["parts"].get(name, {})
        if days is None or self.before is None:
            due, kept = rows, {}
        else:
            days = set(days)
            due, kept = on_days(rows, sorted(days), "fecha"), {d: p for d, p in earlier.items() if d not in days}
            if not days:
                self.parts[name] = kept
                return
        due.hint("rebalance", "fecha").write.partitionBy("fecha").parquet(path)
        # Answered from the footers; a row per day written.
        written = [n.partition("=")[2] for n in children(self.spark, path) if n.startswith("fecha=")]
        fresh = {day: {"version": version, "rows": 0} for day in written}
        counted = read_parts(self.spark, self.lake, name, fresh).groupBy("fecha").agg(F.count(F.lit(1)).alias("n"))
        self.parts[name] = kept | {str(r["fecha"]): {"version": version, "rows": r["n"]} for r in counted.collect()}

    def announce(self, of: str = CURRENT, **about) -> dict:
        """Make it the publication, all datasets at once; raises if another one came first."""
        record = record_of(self.parts, **about)
        if not channel(self.lake, of).put(self.spark, self.number, record):
            raise PublicationConflict(f"publication {self.number} of {of} exists")
        return record


def draft(spark: SparkSession, lake: Lake, stamp: str) -> Draft:
    number, before = channel(lake).newest(spark)
    return Draft(spark, lake, number + 1, before, stamp, {})


def record_of(
    parts: Mapping[str, Mapping], run_id: str, days: list[str], kind: str, quality: dict | None = None,
    warnings: dict | None = None,
) -> dict:
    quality = quality or {}
    return {
        "run_id": run_id,
        "dates": days,
        "published_at": dt.datetime.now(dt.UTC).replace(microsecond=0).isoformat(),
        "datasets": {name: sum(part["rows"] for part in parts[name].values()) for name in gold.GOLD_DATASETS},
        "kind": kind,
        "quality": {
            "quarantined": quality.get("quarantined", 0), "duplicates_removed": quality.get("duplicates_removed", 0),
            "late_rows": quality.get("late_rows", 0), "quarantine_by_reason": quality.get("quarantine_by_reason", {}),
        },
        "test_warnings": warnings or {},
        "parts": {name: dict(parts[name]) for name in gold.GOLD_DATASETS},
    }


def publish_as_of(spark: SparkSession, lake: Lake, day: dt.date | str, of: str) -> dict:
    """Publish under the name ``of`` what the current publication held when ``day`` was its last day.

    The record names the same immutable versions without the later days: no row is read or written.
    Datasets without days stay whole.
    """
    if of == CURRENT:
        raise ValueError("an earlier day is published under a name of its own")
    current = published_record(spark, lake)
    if current is None:
        raise LookupError("nothing is published")
    last = str(day)
    parts = {
        name: {d: part for d, part in current["parts"][name].items() if name not in gold.DATED or d <= last}
        for name in gold.GOLD_DATASETS
    }
    number, _ = channel(lake, of).newest(spark)
    days = [d for d in current["dates"] if d <= last]
    quality = current["quality"] if days == current["dates"] else {}
    whole = Draft(spark, lake, number + 1, None, "", parts)
    return whole.announce(of, run_id=current["run_id"], days=days, kind="as_of", quality=quality,
                          warnings=current["test_warnings"])


def drop_unpublished(spark: SparkSession, lake: Lake, keep: int = KEPT) -> list[str]:
    """Remove what none of the last ``keep`` records of any channel names; returns the folders removed.

    A superseded day goes by itself.  A version that no kept record names at all is an older publication or one
    that never was announced.
    """
    kept: list[dict] = []
    ended: list[dict] = []
    for name in children(spark, lake.path("gold", "_publications")):
        record = channel(lake, name)
        numbers = record.versions(spark)
        kept += [record.at(spark, number) for number in numbers[-keep:]]
        ended += [record.at(spark, number) for number in numbers[-keep - 1:-keep]]
    gone = []
    for name in gold.GOLD_DATASETS:
        root = lake.path("gold", name)
        named = {(day, part["version"]) for record in kept for day, part in record["parts"][name].items()}
        versions = {version for _, version in named}
        gone += [f"{root}/{folder}" for folder in children(spark, root) if folder.startswith("version=")
                 and folder.partition("=")[2] not in versions]
        over = {(day, part["version"]) for record in ended for day, part in record["parts"][name].items()} - named
        gone += [_folder(root, name, day, version) for day, version in sorted(over) if version in versions]
    for folder in gone:
        remove(spark, folder)
    return gone
