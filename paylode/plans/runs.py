"""Runs: which days are due, what was done about them, and how far the lake has come.

Everything a run leaves is below ``control``: ``runs``, ``task_runs`` and ``schema_events`` are append-only log
tables (the operators of ``paylode.operators.audit`` read them), ``watermarks/<name>`` and ``lease`` are records
written by compare-and-set.  The watermark moves after a success only, never back, and never on a backfill.
Only one run changes a lake at a time; a run that was killed gives way when its lease has run out.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylode.contracts import ENTITIES
from paylode.operators import audit
from paylode.operators.checks import Check
from paylode.operators.incremental import after_watermark, between_days
from paylode.plans.jobs import JobResult, refresh_days
from paylode.sources.control import VersionedRecord
from paylode.sources.files import exists, rename_new, write_text
from paylode.sources.lake import Lake
from paylode.sources.landing import landed_days

WATERMARK = "ingest_date"
LEASE_HOURS = 12.0
BY_DAY = ("bronze.", "silver.")


class RunFailed(RuntimeError):
    """A run ended without success; the watermark is where it was."""


class LakeBusy(RuntimeError):
    """Another run holds the lake."""


def _now() -> dt.datetime:
    return dt.datetime.now(dt.UTC)


# ------------------------------------------------------------------- watermark
def _watermark(lake: Lake, name: str) -> VersionedRecord:
    return VersionedRecord(lake.path("control", "watermarks", name))


def watermark(spark: SparkSession, lake: Lake, name: str = WATERMARK) -> str | None:
    record = _watermark(lake, name).newest(spark)[1]
    return record and record["value"]


def advance(spark: SparkSession, lake: Lake, value: dt.date | str, run_id: str, name: str = WATERMARK) -> str:
    """Move the watermark to ``value`` unless it is there or beyond; returns where it is then.

    Of several writers each looks again at what the other wrote, so the value never goes back.
    """
    log, value = _watermark(lake, name), str(value)
    while True:
        version, record = log.newest(spark)
        if record and record["value"] >= value:
            return record["value"]
        if log.put(spark, version + 1, {"name": name, "value": value, "updated_at": _now().isoformat(), "run_id": run_id}):
            return value


def watermark_log(spark: SparkSession, lake: Lake, name: str = WATERMARK) -> DataFrame:
    """Every value the watermark has had."""
    log, schema = _watermark(lake, name), f"{audit.WATERMARKS_SCHEMA}, run_id string"
    return spark.read.schema(schema).json(log.path) if log.versions(spark) else spark.createDataFrame([], schema)


# ----------------------------------------------------------------------- lease
@contextmanager
def exclusive(spark: SparkSession, lake: Lake, run_id: str, hours: float = LEASE_HOURS) -> Iterator[Callable[[], None]]:
    """Hold the lake for a run; yields a function that prolongs the lease and raises if it was lost."""
    lease = VersionedRecord(lake.path("control", "lease"))
    version, holder = lease.newest(spark)
    if holder and holder["held_until"] > _now().isoformat():
        raise LakeBusy(f"run {holder['run_id']} works on the lake")
    held, lock = [version], Lock()

    def hold(until: dt.datetime) -> None:
        with lock:  # tasks of a run prolong it from several threads
            if not lease.put(spark, held[0] + 1, {"run_id": run_id, "held_until": until.isoformat()}):
                raise LakeBusy("another run has taken the lake")
            held[0] += 1

    def prolong() -> None:
        hold(_now() + dt.timedelta(hours=hours))

    prolong()
    try:
        yield prolong
    finally:
        try:
            hold(_now())
        except LakeBusy:  # the lease ran out and another run goes on: nothing to give back
            pass


# --------------------------------------------------------------------- run log
@dataclass
class RunLog:
    """Writes the log tables of a lake.

    The entries of one event are a file of JSON lines, renamed into place: tasks that run side by side can log
    at the same time, which writers of one Spark table cannot.
    """

    spark: SparkSession
    lake: Lake
    run_id: str
    kind: str
    days: list[str]
    started: dt.datetime = field(default_factory=_now)

    def _append(self, table: str, entries: Sequence[dict]) -> None:
        if not entries:
            return
        name = uuid.uuid4().hex
        lines = "".join(json.dumps(entry, default=dt.datetime.isoformat, ensure_ascii=False) + "\n" for entry in entries)
        staged = self.lake.path("control", table, f".{name}.tmp")
        write_text(self.spark, staged, lines)
        rename_new(self.spark, staged, self.lake.path("control", table, f"{name}.json"))

    def run(self, status: str, error: str | None = None) -> None:
        ended = None if status == "running" else _now()
        self._append("runs", [{
            "run_id": self.run_id, "kind": self.kind, "dates": json.dumps(self.days), "status": status,
            "started_at": self.started, "finished_at": ended, "error": error}])

    def around(self, prolong: Callable[[], None]) -> Callable[[str, Callable[[], JobResult]], JobResult]:
        """What logs the tasks of the run: an entry when one starts and one when it ends."""
        def logged(task: str, work: Callable[[], JobResult]) -> JobResult:
            prolong()
            started, clock = _now(), time.perf_counter()
            self._tasks(task, "running", started, None, None)
            try:
                result = work()
            except BaseException as failed:
                self._tasks(task, "failed", started, time.perf_counter() - clock, None, _text(failed))
                raise
            self._tasks(task, "success", started, time.perf_counter() - clock, result)
            self._append("schema_events", [
                {**event, "columns": json.dumps(event["columns"]), "detected_at": _now()}
                for event in result.details.get("schema_events", [])])
            return result

        return logged

    def _tasks(
        self, task: str, status: str, started: dt.datetime, seconds: float | None, result: JobResult | None,
        error: str | None = None,
    ) -> None:
        """An entry per day of the run for tasks that go by day, else a single one.

        The days of a batch share its seconds evenly.  Figures that are not known by day, those of the features,
        are on the first day.
        """
        days: list[str | None] = [None] if task in ("dbt.build", "publish") else list(self.days)
        entries = []
        for place, day in enumerate(days):
            figures: dict = {}
            if result is not None:
                figures = self._figures(task, result, day, place == 0)
            entries.append(audit.task_row(
                self.run_id, task, day, 1, status, started, None if seconds is None else round(seconds / len(days), 3),
                **figures, error=error))
        self._append("task_runs", entries)

    def _figures(self, task: str, result: JobResult, day: str | None, first: bool) -> dict:
        if task.startswith(BY_DAY):
            own = result.by_day.get(day, {})
            counts = {name: own.get(name, 0) for name in ("rows_read", "rows_written", "rows_quarantined")}
            details = {name: value for name, value in own.items() if name not in counts}
        else:
            counts = {name: getattr(result, name) if first else 0 for name in ("rows_read", "rows_written", "rows_quarantined")}
            details = result.details if first else {}
        return counts | {"partitions": json.dumps(result.partitions if first else []), "details": json.dumps(details, default=str)}


def _text(error: BaseException) -> str:
    return f"{type(error).__name__}: {error}"[:2000]


def _log(spark: SparkSession, lake: Lake, table: str, schema: str) -> DataFrame:
    path = lake.path("control", table)
    return spark.read.schema(schema).json(path) if exists(spark, path) else spark.createDataFrame([], schema)


def runs(spark: SparkSession, lake: Lake) -> DataFrame:
    """The last known state of every run."""
    log = _log(spark, lake, "runs", audit.RUNS_SCHEMA)
    state = F.struct(*[name for name in log.columns if name != "run_id"])
    return log.groupBy("run_id").agg(F.max_by(state, F.col("finished_at").isNotNull()).alias("_s")).select("run_id", "_s.*")


def task_runs(spark: SparkSession, lake: Lake) -> DataFrame:
    """The last known state of every attempt at a task."""
    log = _log(spark, lake, "task_runs", audit.TASK_RUNS_SCHEMA)
    key = ["run_id", "task", "ingest_date", "attempt"]
    state = F.struct(*[name for name in log.columns if name not in key])
    latest = log.groupBy(*key).agg(F.max_by(state, F.col("status") != "running").alias("_s"))
    return latest.select(*key, "_s.*").select(*log.columns)


def schema_events(spark: SparkSession, lake: Lake) -> DataFrame:
    return _log(spark, lake, "schema_events", audit.SCHEMA_EVENTS_SCHEMA)


# ------------------------------------------------------------------------ runs
def _landed(spark: SparkSession, lake: Lake, entities: Sequence[str]) -> DataFrame:
    days = sorted({day for entity in entities for day in landed_days(spark, lake.landing, entity)})
    return spark.createDataFrame([(day,) for day in days], "ingest_date date")


def _listed(days: DataFrame) -> list[str]:
    return sorted(str(row["ingest_date"]) for row in days.collect())


def pending_days(
    spark: SparkSession, lake: Lake, until: dt.date | str | None = None, entities: Sequence[str] = ENTITIES,
) -> list[str]:
    """Landed days after the watermark, up to ``until``."""
    days = after_watermark(_landed(spark, lake, entities), watermark(spark, lake))
    return _listed(days if until is None else days.where(F.col("ingest_date") <= F.lit(str(until)).cast("date")))


def run_incremental(
    spark: SparkSession, lake: Lake, until: dt.date | str | None = None, **options,
) -> str | None:
    """All landed days that no run has taken yet, as one batch; None if there are none."""
    return _run(spark, lake, "incremental", lambda: pending_days(spark, lake, until), **options)


def run_days(spark: SparkSession, lake: Lake, days: Iterable[dt.date | str], **options) -> str | None:
    """Given days again or for the first time; the watermark moves if they are newer."""
    chosen = sorted({str(day) for day in days})
    return _run(spark, lake, "date", lambda: chosen, **options)


def backfill(spark: SparkSession, lake: Lake, first: dt.date | str, last: dt.date | str, **options) -> str:
    """The landed days of a span again; the watermark stays."""
    def chosen() -> list[str]:
        days = _listed(between_days(_landed(spark, lake, ENTITIES), first, last))
        if not days:
            raise RunFailed(f"nothing has landed from {first} to {last}")
        return days

    return _run(spark, lake, "backfill", chosen, **options)


def _run(
    spark: SparkSession, lake: Lake, kind: str, choose: Callable[[], list[str]], *,
    checks: Sequence[Check] | None = None, every_feed: bool = True, lease_hours: float = LEASE_HOURS,
) -> str | None:
    """One run from landing to gold; returns its id.

    With ``every_feed`` each feed must have each day; otherwise a feed takes part with the days that it has.
    The days are chosen while the lake is held, so two runs never take the same ones.
    """
    run_id = f"{_now():%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:6]}"
    with exclusive(spark, lake, run_id, lease_hours) as prolong:
        days = choose()
        if not days:
            return None
        log = RunLog(spark, lake, run_id, kind, days)
        log.run("running")
        try:
            due = {entity: days if every_feed else _landed_of(spark, lake, entity, days) for entity in ENTITIES}
            refresh_days(
                spark, lake, days, run_id, kind, [e for e in ENTITIES if due[e]], checks, due.__getitem__, log.around(prolong))
            if kind != "backfill":
                advance(spark, lake, days[-1], run_id)
        except BaseException as failed:
            log.run("failed", _text(failed))
            if isinstance(failed, Exception):
                raise RunFailed(f"run {run_id} failed: {_text(failed)}") from failed
            raise
        log.run("success")
        return run_id


def _landed_of(spark: SparkSession, lake: Lake, entity: str, days: list[str]) -> list[str]:
    landed = {str(day) for day in landed_days(spark, lake.landing, entity)}
    return [day for day in days if day in landed]
