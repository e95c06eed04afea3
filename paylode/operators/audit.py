"""Rollups over the run log: ``runs``, ``task_runs`` and ``schema_events`` as DataFrames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylode.contracts import ENTITIES

RUNS_SCHEMA = (
    "run_id string, kind string, dates string, status string, started_at timestamp, finished_at timestamp, error string"
)
TASK_RUNS_SCHEMA = (
    "run_id string, task string, ingest_date string, attempt int, status string, started_at timestamp, "
    "duration_s double, rows_read bigint, rows_written bigint, rows_quarantined bigint, partitions string, "
    "details string, error string"
)
SCHEMA_EVENTS_SCHEMA = "ingest_date string, entity string, kind string, columns string, detected_at timestamp"
WATERMARKS_SCHEMA = "name string, value string, updated_at timestamp"
DETAILS_SCHEMA = (
    "duplicates_removed bigint, late_rows bigint, quarantine_reasons map<string,bigint>, "
    "corrupt_lines bigint, unknown_columns array<string>"
)

# Stages in order with the task prefix of each, and when a silent run counts as interrupted.
STAGES = (
    ("bronze", "bronze."), ("silver", "silver."), ("features", "features"), ("dbt", "dbt.build"),
    ("publish", "publish"),
)
STALE_SECONDS = 30 * 60
HOUR_SECONDS, DAY_SECONDS = 3600, 24 * 3600


def append_rows(spark: SparkSession, path: str, rows: Sequence[Mapping], schema: str) -> None:
    """Add the few rows of one run to a log table."""
    spark.createDataFrame([dict(row) for row in rows], schema).coalesce(1).write.mode("append").parquet(path)


def stage_of(task: Column) -> Column:
    found = F.lit(None).cast("string")
    for stage, prefix in reversed(STAGES):
        found = F.when(task.startswith(prefix), F.lit(stage)).otherwise(found)
    return found


def entity_of(task: Column) -> Column:
    return F.substring_index(task, ".", -1)


def with_details(task_runs: DataFrame) -> DataFrame:
    return task_runs.withColumn("_d", F.from_json("details", DETAILS_SCHEMA))


def _zero(value: Column | str) -> Column:
    return F.coalesce(value, F.lit(0))


# -------------------------------------------------------------------- quality
def reason_totals(task_runs: DataFrame) -> DataFrame:
    """``run_id, reason, rows`` over the successful silver tasks; reasons with zero rows do not count."""
    silver = with_details(task_runs).where((F.col("status") == "success") & F.col("task").startswith("silver."))
    return (
        silver.select("run_id", F.explode("_d.quarantine_reasons").alias("reason", "n"))
        .where(F.col("n") > 0)
        .groupBy("run_id", "reason").agg(F.sum("n").alias("rows"))
    )


def run_quality(task_runs: DataFrame) -> DataFrame:
    """What silver set aside or corrected, per run, with the reasons as a map."""
    silver = with_details(task_runs).where((F.col("status") == "success") & F.col("task").startswith("silver."))
    totals = silver.groupBy("run_id").agg(
        F.sum(_zero("rows_quarantined")).alias("quarantined"),
        F.sum(_zero("_d.duplicates_removed")).alias("duplicates_removed"),
        F.sum(_zero("_d.late_rows")).alias("late_rows"),
    )
    by_reason = reason_totals(task_runs).groupBy("run_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "rows")))).alias("quarantine_by_reason")
    )
    nothing = F.create_map().cast("map<string,bigint>")
    return totals.join(by_reason, "run_id", "left").withColumn(
        "quarantine_by_reason", F.coalesce("quarantine_by_reason", nothing)
    )


def entity_quality(task_runs: DataFrame) -> DataFrame:
    """Per run and feed: quarantined, duplicates, late rows, unreadable lines and unknown columns."""
    done = with_details(task_runs).where((F.col("status") == "success") & F.col("details").isNotNull())
    in_silver, in_bronze = F.col("task").startswith("silver."), F.col("task").startswith("bronze.")

    def total(where: Column, value: str) -> Column:
        return F.sum(F.when(where, _zero(value)).otherwise(0))

    names = F.when(in_bronze, F.col("_d.unknown_columns"))
    return (
        done.where(in_silver | in_bronze)
        .groupBy("run_id", entity_of(F.col("task")).alias("entity"))
        .agg(
            total(in_silver, "rows_quarantined").alias("quarantined"),
            total(in_silver, "_d.duplicates_removed").alias("duplicates_removed"),
            total(in_silver, "_d.late_rows").alias("late_rows"),
            total(in_bronze, "_d.corrupt_lines").alias("corrupt_lines"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set(names)))).alias("unknown_columns"),
        )
    )


# ----------------------------------------------------------------------- tasks
def task_totals(task_runs: DataFrame) -> DataFrame:
    """Attempts, seconds, rows and failures per run and task, in order of the first start."""
    return (
        task_runs.groupBy("run_id", "task")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("duration_s").alias("secs"),
            F.sum("rows_read").alias("rows_read"),
            F.sum("rows_written").alias("rows_written"),
            F.sum("rows_quarantined").alias("rows_quarantined"),
            F.count_if(F.col("status") == "failed").alias("fails"),
            F.min("started_at").alias("first_start"),
        )
        .orderBy("run_id", "first_start", "task")
    )


def latest_runs(runs: DataFrame, limit: int = 10) -> DataFrame:
    """The newest runs; a top-k per task and then overall, not a full sort."""
    return runs.orderBy(F.col("started_at").desc(), "run_id").limit(limit)


def _spent(now: Column) -> Column:
    """Seconds of an attempt; a running one counts up to ``now``."""
    running = F.greatest(F.lit(0.0), _seconds(now) - _seconds(F.col("started_at")))
    return F.coalesce("duration_s", running)


def _seconds(moment: Column) -> Column:
    return F.unix_micros(moment) / F.lit(1e6)


def last_attempts(task_runs: DataFrame, now: Column | None = None) -> DataFrame:
    """One row per unit (run, task, day): its last attempt and how often it failed; one grouping gives both."""
    now = F.current_timestamp() if now is None else now
    last = F.struct("status", "rows_read", "rows_written", "rows_quarantined", "error")
    return task_runs.groupBy("run_id", "task", "ingest_date").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(F.col("status") == "failed").alias("failed_attempts"),
        F.count_if(F.col("status") == "running").alias("running_attempts"),
        F.sum(_spent(now)).alias("seconds"),
        F.max_by(last, F.struct("attempt", "started_at")).alias("_last"),
    ).select("*", "_last.*", stage_of(F.col("task")).alias("stage")).drop("_last")


# -------------------------------------------------------------------- runs
def run_summary(runs: DataFrame, task_runs: DataFrame, now: Column | None = None) -> DataFrame:
    """Status, duration, retries and seconds per stage of each run."""
    now = F.current_timestamp() if now is None else now
    attempts = task_runs.select(
        "run_id",
        stage_of(F.col("task")).alias("stage"),
        _spent(now).alias("_spent"),
        (_seconds(F.col("started_at")) + _spent(now)).alias("_until"),
        (F.col("status") == "failed").alias("_failed"),
    )
    in_stage = [
        F.sum(F.when(F.col("stage") == stage, F.col("_spent"))).alias(f"{stage}_seconds") for stage, _ in STAGES
    ]
    spent = attempts.groupBy("run_id").agg(
        *in_stage, F.max("_until").alias("_until"), F.count_if("_failed").alias("_failures")
    )
    start = _seconds(F.col("started_at"))
    last = F.greatest(start, F.col("_until"))
    silent = (F.col("status") == "running") & (_seconds(now) - last > STALE_SECONDS)
    status = F.when(silent, F.lit("interrupted")).otherwise(F.col("status"))
    end = F.coalesce(_seconds(F.col("finished_at")), F.when(status == "running", _seconds(now)).otherwise(last))
    return runs.join(spent, "run_id", "left").select(
        "run_id", "kind", "dates", status.alias("status"), "started_at", "finished_at",
        F.round(end - start, 1).alias("duration_s"),
        _zero("_failures").alias("retries"),
        *[F.round(F.coalesce(f"{stage}_seconds", F.lit(0.0)), 2).alias(f"{stage}_seconds") for stage, _ in STAGES],
    )


def _expected(stage: Column, kind: Column, n_days: Column) -> Column:
    """How many tasks a run should have in a stage; a run of a single task has only that one."""
    feeds = len(ENTITIES)
    full = (
        F.when(stage.isin("bronze", "silver"), n_days * feeds)
        .when(stage == "features", n_days)
        .otherwise(1)
    )
    only = stage_of(F.regexp_replace(kind, "^task:", ""))
    single = F.when(stage == only, 1).otherwise(0)
    return F.when(kind.startswith("task:") & only.isNotNull(), single).otherwise(full)


def stage_status(runs: DataFrame, task_runs: DataFrame, now: Column | None = None) -> DataFrame:
    """State of every stage of every run, from the last attempts of its tasks."""
    now = F.current_timestamp() if now is None else now
    units = last_attempts(task_runs, now)
    ok = F.col("status") == "success"
    per_stage = units.groupBy("run_id", "stage").agg(
        F.count(F.lit(1)).alias("_units"),
        F.count_if(ok).alias("done"),
        F.count_if(F.col("status") == "failed").alias("_failed"),
        F.sum("failed_attempts").alias("retries"),
        F.sum("running_attempts").alias("_running"),
        F.sum(F.when(ok, F.col("rows_read"))).alias("rows_read"),
        F.sum(F.when(ok, F.col("rows_written"))).alias("rows_written"),
        F.sum(F.when(ok, F.col("rows_quarantined"))).alias("rows_quarantined"),
        F.sum("seconds").alias("duration_s"),
    )
    n_days = F.coalesce(F.size(F.from_json("dates", "array<string>")), F.lit(0))
    wanted = run_summary(runs, task_runs, now).select(
        "run_id", F.col("status").alias("run_status"), "kind", n_days.alias("_days"),
        F.posexplode(F.array(*[F.lit(stage) for stage, _ in STAGES])).alias("position", "stage"),
    ).withColumn("expected", _expected(F.col("stage"), F.col("kind"), F.col("_days")))

    rows = wanted.join(per_stage, ["run_id", "stage"], "left")
    for name in ("_units", "done", "_failed", "retries", "_running", "rows_read", "rows_written", "rows_quarantined"):
        rows = rows.withColumn(name, _zero(name))
    running = F.col("run_status") == "running"
    started = F.col("_units") > 0
    waiting = F.when(F.col("run_status").isin("failed", "interrupted"), "skipped").otherwise("waiting")
    state = (
        F.when((F.col("_failed") > 0) & ~running, "failed")
        .when(F.col("_running") > 0, "running")
        .when((F.col("_failed") > 0) & running, "retrying")
        .when((F.col("expected") == 0) & ~started, "skipped")
        .when(started & (F.col("done") >= F.col("expected")), F.when(F.col("retries") > 0, "retried").otherwise("ok"))
        .when(running & started, "running")
        .otherwise(waiting)
    )
    return rows.select(
        "run_id", "position", "stage", state.alias("status"), "done", "expected", "retries",
        "rows_read", "rows_written", "rows_quarantined",
        F.round(F.coalesce("duration_s", F.lit(0.0)), 1).alias("duration_s"),
    )


def stage_flow(stages: DataFrame) -> DataFrame:
    """Rows between the layers of each run, from ``stage_status``: read by bronze, silver and features,
    written by silver, published."""
    def of(stage: str, value: str) -> Column:
        return F.sum(F.when(F.col("stage") == stage, F.col(value)).otherwise(0))

    return stages.groupBy("run_id").agg(
        of("bronze", "rows_read").alias("landed"),
        of("silver", "rows_read").alias("bronze"),
        of("features", "rows_read").alias("scored"),
        of("silver", "rows_written").alias("silver"),
        of("publish", "rows_written").alias("published"),
    )


def run_spans(runs: DataFrame, task_runs: DataFrame, now: Column | None = None) -> DataFrame:
    """``run_id, span_start, span_end`` of each run, in which it can have seen something.

    A run without an end is taken to go on for ``STALE_SECONDS`` after its last sign of life, which is the last start
    or end of one of its attempts (its own start without any), but not beyond ``now``.
    """
    now = F.current_timestamp() if now is None else now
    ended = F.timestamp_micros((F.unix_micros("started_at") + F.round(F.coalesce("duration_s", F.lit(0.0)) * 1e6)).cast("long"))
    signs = task_runs.groupBy("run_id").agg(F.max(ended).alias("_sign"))
    alive = F.greatest("started_at", "_sign") + F.make_dt_interval(secs=F.lit(STALE_SECONDS))
    end = F.coalesce("finished_at", F.least(alive, F.greatest(now, F.col("started_at"))))
    return runs.join(signs, "run_id", "left").select("run_id", F.col("started_at").alias("span_start"), end.alias("span_end"))


def events_in_runs(schema_events: DataFrame, runs: DataFrame, task_runs: DataFrame, now: Column | None = None) -> DataFrame:
    """Schema events detected while a run was going on, as ``run_spans`` has it.

    The range condition gets an equality on a bin of time first, so Spark hashes by bin instead of comparing
    every event with every run.  Bins follow the run's length: hours for a run of up to a day, else days, so a
    run has few of them and an event meets only the runs of its hour or the long ones of its day.
    """
    length = F.unix_seconds("span_end") - F.unix_seconds("span_start")
    width = F.when(length <= DAY_SECONDS, HOUR_SECONDS).otherwise(DAY_SECONDS)

    def bin_of(moment: str, seconds: Column) -> Column:
        return F.floor(F.unix_seconds(moment) / seconds)

    spans = run_spans(runs, task_runs, now).withColumn("_width", width).select(
        "run_id", "span_start", "span_end", "_width",
        F.explode(F.sequence(bin_of("span_start", F.col("_width")), bin_of("span_end", F.col("_width")))).alias("_bin"),
    )
    events = schema_events.withColumn("_width", F.explode(F.array(F.lit(HOUR_SECONDS), F.lit(DAY_SECONDS)))).withColumn(
        "_bin", bin_of("detected_at", F.col("_width")))
    return (
        events.join(spans, ["_width", "_bin"])
        .where(F.col("detected_at").between(F.col("span_start"), F.col("span_end")))
        .select("run_id", "ingest_date", "entity", "kind", "columns", "detected_at")
    )


def task_row(
    run_id: str, task: str, ingest_date: str | None, attempt: int, status: str, started_at: dt.datetime,
    duration_s: float | None = None, **figures,
) -> dict:
    """A ``task_runs`` row; figures not given are NULL."""
    row = {
        "run_id": run_id, "task": task, "ingest_date": ingest_date, "attempt": attempt, "status": status,
        "started_at": started_at, "duration_s": duration_s,
    }
    rest = ("rows_read", "rows_written", "rows_quarantined", "partitions", "details", "error")
    return row | {name: figures.get(name) for name in rest}
