"""The daily work, layer by layer.  Each job takes all its days as one Spark batch.

A job returns a ``JobResult`` with the figures of the run log.  Running a job again with
the same days gives the same tables.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylode.contracts import CONTRACTS, ENTITIES, LATE_DATA_DAYS, Contract
from paylode.functions.rules import MALFORMED
from paylode.operators.checks import RENAMED, Check, mart_checks, run_checks
from paylode.operators.features import FEATURE_COLUMNS, FRAME_DAYS, merchant_daily, payment_features
from paylode.operators.upsert import current_state_upsert, latest, partition_upsert, partitions_of_moved_keys, recency
from paylode.operators.parents import exceeding, with_arrived_parents
from paylode.operators.validate import (
    accepted,
    malformed,
    readable,
    rejected_lines,
    sealed,
    set_aside,
    validate,
)
from paylode.plans import gold, marts
from paylode.plans.publication import draft, drop_unpublished, partition_last, read_gold
from paylode.session import owned_scratch, staged, use_utc
from paylode.sources.files import children
from paylode.sources.key_index import KeyIndex
from paylode.sources.lake import Lake, on_days, overwrite_partitions, read_table, write_version
from paylode.sources.landing import PROFILE_SCHEMA, listed, profile, read_feed

QUARANTINE_SCHEMA = (
    "_raw string, _reasons array<string>, _source_file string, _quarantined_at timestamp, ingest_date date"
)
FEATURES_SCHEMA = (
    "payment_id string, customer_id string, merchant_id string, category string, risk_segment string, "
    "amount double, transaction_date timestamp, txn_count_7d bigint, amount_7d double, avg_amount_7d double, "
    "seconds_since_prev bigint, high_velocity boolean, amount_spike boolean, dt date"
)
MERCHANT_DAILY_SCHEMA = (
    "merchant_id string, category string, approved_payments bigint, tpv double, max_ticket double, dt date"
)
FCT_PAYMENTS_SCHEMA = (
    "payment_id string, customer_id string, merchant_id string, merchant_category string, risk_segment string, "
    "payment_method string, channel string, status string, currency string, amount double, amount_cop double, "
    "transaction_date timestamp, flag_high_velocity boolean, flag_amount_spike boolean, updated_at timestamp, "
    "transaction_day date"
)
CHILD_FACTS = {
    "refunds": (
        "refund_day", marts.fct_refunds,
        "refund_id string, payment_id string, amount double, refund_date timestamp, payment_found boolean, amount_cop double, "
        "payment_amount double, payment_day date, refund_day date",
    ),
    "chargebacks": (
        "chargeback_day", marts.fct_chargebacks,
        "chargeback_id string, payment_id string, reason string, amount double, chargeback_date timestamp, "
        "payment_found boolean, amount_cop double, merchant_id string, customer_id string, payment_day date, "
        "days_to_chargeback int, chargeback_day date",
    ),
}


@dataclass(frozen=True)
class Changes:
    """Days of the facts that a run rewrote."""

    payments: tuple[str, ...] = ()
    refunds: tuple[str, ...] = ()
    chargebacks: tuple[str, ...] = ()

    @property
    def days(self) -> list[str]:
        return sorted({*self.payments, *self.refunds, *self.chargebacks})


@dataclass
class JobResult:
    rows_read: int = 0
    rows_written: int = 0
    rows_quarantined: int = 0
    partitions: list[str] = field(default_factory=list)
    details: dict = field(default_factory=dict)
    by_day: dict[str, dict] = field(default_factory=dict)  # the same figures for each day that came in


Around = Callable[[str, Callable[[], JobResult]], JobResult]


def plainly(task: str, work: Callable[[], JobResult]) -> JobResult:
    """Run a task without a log; the jobs of a run go through a function of this form."""
    return work()


def at_once(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """Jobs that do not depend on each other, so that small ones fill the cluster together."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [job.result() for job in started]


def _iso(days: Iterable[dt.date | str]) -> list[str]:
    return sorted({str(day) for day in days})


def _stored_days(spark: SparkSession, path: str, column: str) -> list[str]:
    """Partition values of a table, from the directory names."""
    return [n.partition("=")[2] for n in children(spark, path) if n.startswith(f"{column}=")]


def _days_from(day: str, count: int) -> list[str]:
    start = dt.date.fromisoformat(day)
    return [str(start + dt.timedelta(days=i)) for i in range(count)]


# ---------------------------------------------------------------------- bronze
def land_to_bronze(spark: SparkSession, lake: Lake, entity: str, days: Iterable[dt.date | str]) -> JobResult:
    """Copy the landed days to bronze, replacing exactly those days (also when a day came empty)."""
    use_utc(spark)
    contract, days = CONTRACTS[entity], _iso(days)
    if not days:
        return JobResult()
    path = lake.path("bronze", entity)
    feed = read_feed(spark, lake.landing, contract, days)
    overwrite_partitions(feed, path, "ingest_date", expected=days, rebalance=False)
    written = on_days(lake.bronze(spark, entity), days, "ingest_date")
    # All names go to a table of their own; the driver gets a bounded list of a day's.
    profiles = lake.path("profile", entity)
    overwrite_partitions(profile(written, contract), profiles, "ingest_date", expected=days)
    stored = on_days(read_table(spark, profiles, PROFILE_SCHEMA), days, "ingest_date")
    unknown_names = stored.where(F.col("kind") == "unknown").groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n"))
    names_of_day = {str(r["ingest_date"]): r["n"] for r in unknown_names.collect()}
    found: dict[str, dict[str, dict[str, int]]] = {}
    for row in listed(stored).collect():
        found.setdefault(str(row["ingest_date"]), {}).setdefault(row["kind"], {})[row["name"]] = row["rows"]

    def figures(day: str) -> dict:
        of_day = found.get(day, {})
        lines = sum(of_day.get("lines", {}).values())
        return {
            "rows_read": lines, "rows_written": lines, "corrupt_lines": sum(of_day.get("corrupt", {}).values()),
            "unknown_columns": sorted(of_day.get("unknown", {})), "unknown_names": names_of_day.get(day, 0),
            "missing_columns": sorted(name for name, n in of_day.get("absent", {}).items() if n == lines),
        }

    by_day = {day: figures(day) for day in days}
    kinds = (("unknown_columns", "unknown_columns"), ("missing_required_columns", "missing_columns"))
    events = [
        {"ingest_date": day, "entity": entity, "kind": kind, "columns": by_day[day][names]}
        for day in days for kind, names in kinds if by_day[day][names]
    ]

    def total(name: str) -> int:
        return sum(of_day[name] for of_day in by_day.values())

    def named(names: str) -> list[str]:
        return sorted({name for of_day in by_day.values() for name in of_day[names]})

    return JobResult(
        rows_read=total("rows_read"),
        rows_written=total("rows_written"),
        partitions=[f"ingest_date={day}" for day in days],
        details={
            "corrupt_lines": total("corrupt_lines"),
            "contract_version": max((int(v) for of_day in found.values() for v in of_day.get("version", {})), default=1),
            "unknown_columns": named("unknown_columns"),
            "missing_columns": named("missing_columns"),
            "schema_events": events,
        },
        by_day=by_day,
    )


# ---------------------------------------------------------------------- silver
def bronze_to_silver(
    spark: SparkSession, lake: Lake, entity: str, days: Iterable[dt.date | str], late_days: int = LATE_DATA_DAYS,
) -> JobResult:
    """Validate the days, quarantine what fails, merge the rest into silver.

    The validated rows are written once to the shared folder: quarantine, figures and merge
    read that copy, by column, instead of repeating the joins.
    """
    use_utc(spark)
    days = _iso(days)
    if not days:
        return JobResult()
    return silver_batch(spark, lake, entity, on_days(lake.bronze(spark, entity), days, "ingest_date"), days, late_days)


def silver_batch(
    spark: SparkSession, lake: Lake, entity: str, bronze: DataFrame, days: Sequence[str],
    late_days: int = LATE_DATA_DAYS, quarantine_path: str | None = None,
) -> JobResult:
    """Bronze rows of ``days`` into silver.  With ``quarantine_path`` what fails goes there,
    otherwise it replaces the quarantine partitions of the days."""
    contract = CONTRACTS[entity]
    merchants = payments = None
    if entity == "payments" and lake.has_silver(spark, "merchants"):
        merchants = lake.silver(spark, "merchants")
    if contract.parent_days is not None and lake.has_silver(spark, "payments"):
        oldest = F.date_sub(F.lit(min(days)).cast("date"), contract.parent_days)
        payments = lake.silver(spark, "payments").where(F.col("dt") >= oldest)
    checks = validate(readable(bronze), contract, merchants=merchants, payments=payments, late_days=late_days)
    checked = staged(sealed(checks), f"validated-{entity}")

    figures = _silver_figures(checked, malformed(bronze), contract)
    out = set_aside(checked).unionByName(rejected_lines(bronze))
    out = out.withColumn("ingest_date", F.col("ingest_date").cast("date"))

    def set_apart() -> None:
        if quarantine_path:
            out.write.mode("overwrite").parquet(quarantine_path)
        else:
            overwrite_partitions(out, lake.path("quarantine", entity), "ingest_date", expected=days)

    valid = accepted(checked, contract)
    batch = latest(valid, contract)

    def merge() -> list[str]:
        if not figures.valid:
            return []
        if contract.event_date:
            return _merge_fact(spark, lake, contract, valid, batch, figures.dts)
        current = current_state_upsert(lake.silver(spark, entity), batch, contract.business_key, recency(contract))
        write_version(current, lake.path("silver", entity))
        return ["current"]

    def count_kept() -> dict[str, tuple[int, int]]:
        """Rows and late rows of the batch by day, counted over the staged rows: a stage that runs twice counts once."""
        if not figures.valid:
            return {}
        late = F.col("dt") < F.col("_ingest_date").cast("date") if contract.event_date else F.lit(False)
        kept = batch.groupBy("_ingest_date").agg(F.count(F.lit(1)).alias("rows"), F.count_if(late).alias("late"))
        return {str(r["_ingest_date"]): (r["rows"], r["late"]) for r in kept.collect()}

    _, partitions, kept = at_once(spark, set_apart, merge, count_kept)
    by_day = figures.by_day(days, kept, bool(contract.event_date))

    def total(name: str) -> int:
        return sum(day[name] for day in by_day.values())

    details = {"duplicates_removed": total("duplicates_removed"), "quarantine_reasons": figures.reasons()}
    if contract.event_date:
        details["late_rows"] = total("late_rows")
    return JobResult(total("rows_read"), total("rows_written"), total("rows_quarantined"), partitions, details, by_day)


@dataclass
class _Figures:
    """Counts of a batch: rows by day and set of reasons, unreadable lines by day, event days of what is valid."""

    rows: dict[tuple[str, tuple[str, ...]], int]
    corrupt: dict[str, int]
    dts: list[str]

    @property
    def valid(self) -> int:
        return sum(n for (_, reasons), n in self.rows.items() if not reasons)

    def reasons(self, day: str | None = None) -> dict[str, int]:
        found: dict[str, int] = {}
        for (of, reasons), n in self.rows.items():
            for reason in reasons if day in (None, of) else ():
                found[reason] = found.get(reason, 0) + n
        corrupt = sum(n for of, n in self.corrupt.items() if day in (None, of))
        return found | ({MALFORMED: corrupt} if corrupt else {})

    def by_day(self, days: Iterable[str], kept: dict[str, tuple[int, int]], dated: bool) -> dict[str, dict]:
        result = {}
        for day in sorted({*days, *self.corrupt, *(of for of, _ in self.rows)}):
            valid = sum(n for (of, reasons), n in self.rows.items() if of == day and not reasons)
            failed = sum(n for (of, reasons), n in self.rows.items() if of == day and reasons)
            corrupt, (rows, late) = self.corrupt.get(day, 0), kept.get(day, (0, 0))
            result[day] = {
                "rows_read": valid + failed + corrupt, "rows_written": rows, "rows_quarantined": failed + corrupt,
                "duplicates_removed": valid - rows, "quarantine_reasons": self.reasons(day),
            } | ({"late_rows": late} if dated else {})
        return result


def _silver_figures(checked: DataFrame, unreadable: DataFrame, contract: Contract) -> _Figures:
    """One pass over the reasons and dates of the staged rows; a row per day and set of reasons, and per event day."""
    came = F.col("_ingest_date").cast("string").alias("came")
    day = F.col("dt").cast("string") if contract.event_date else F.lit(None).cast("string")
    sets = checked.select(came, F.when(F.size("_reasons") == 0, day).alias("dt"), "_reasons")
    found = sets.groupingSets([["came", "_reasons"], ["dt"]], "came", "_reasons", "dt").agg(
        F.grouping("dt").alias("of_day"), F.count(F.lit(1)).alias("n")).collect()
    corrupt = unreadable.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n")).collect()
    return _Figures(
        {(r["came"], tuple(r["_reasons"])): r["n"] for r in found if r["of_day"]},
        {str(r["ingest_date"]): r["n"] for r in corrupt},
        sorted(r["dt"] for r in found if not r["of_day"] and r["dt"]),
    )


def places(lake: Lake, entity: str) -> KeyIndex:
    """The event day under which each business key of a fact is stored."""
    return KeyIndex(lake.path("index", entity), CONTRACTS[entity].business_key[0])


def references(lake: Lake, entity: str) -> KeyIndex:
    """The event days of the refunds or chargebacks that name a payment."""
    return KeyIndex(lake.path("index", f"{entity}_by_payment"), "payment_id")


def _indexed(spark: SparkSession, lake: Lake, entity: str) -> KeyIndex:
    """The index of a fact; a table that was written without one is read once, its keys and days alone."""
    index = places(lake, entity)
    if not index.is_built(spark) and lake.has_silver(spark, entity):
        index.record(lake.silver(spark, entity).select(index.key, "dt"))
    return index


def _merge_fact(
    spark: SparkSession, lake: Lake, contract: Contract, valid: DataFrame, batch: DataFrame, dts: list[str],
) -> list[str]:
    """Rewrite the event days the batch touches, and those a key of the batch moved away from.

    A key that changed its event date must not stay behind under the old one, however long ago that is:
    the keys of the batch are looked up in the index of keys.  Of the table itself only the days that are
    rewritten are read.  The index follows the table: after a failure between the two the repeated job finds
    the keys where the table was before, which are days that it rewrites anyway.
    """
    path = lake.path("silver", contract.entity)
    existing = lake.silver(spark, contract.entity)
    index = _indexed(spark, lake, contract.entity)
    moved = partitions_of_moved_keys(index.newest(valid), valid, contract.business_key)
    touched = sorted(set(dts) | {str(row["dt"]) for row in moved.collect()})
    merged = partition_upsert(existing, batch, contract.business_key, recency(contract), touched)
    overwrite_partitions(merged, path, "dt", expected=touched)
    arrived = on_days(lake.silver(spark, contract.entity), touched).where(
        F.col("_ingest_date").isin(sorted({row["_ingest_date"] for row in valid.select("_ingest_date").distinct().collect()})))
    index.record(arrived.select(index.key, "dt"))
    if contract.parent_days is not None:
        references(lake, contract.entity).record(arrived.select("payment_id", "dt"))
    return [f"dt={day}" for day in touched]


def revise_children(spark: SparkSession, lake: Lake, entity: str, days: Iterable[dt.date | str], payment_days: Iterable[str]) -> list[str]:
    """Refunds or chargebacks that came before their payment, now that payments of ``days`` have arrived.

    ``payment_days`` are the event days that the payments' merge rewrote.  The children that name an arrived
    payment are found in the index by payment; only their days are read.  One whose payment is in its window
    becomes found, or goes to the quarantine of the day it came in if it exceeds the payment.  Returns the
    children's days that hold such a payment, whose facts depend on it.
    """
    contract, days = CONTRACTS[entity], _iso(days)
    index = references(lake, entity)
    if not days or not index.is_built(spark):
        return []
    arrived = on_days(lake.silver(spark, "payments"), payment_days).where(F.col("_ingest_date").isin(days))
    arrived = staged(arrived.select("payment_id", "amount", "dt"), "arrived-payments")
    touched = _iso(row["dt"] for row in index.every(arrived).select("dt").distinct().collect())
    if not touched:
        return []
    current = on_days(lake.silver(spark, entity), touched)
    waiting = staged(with_arrived_parents(current.where(~F.col("payment_found")), arrived, contract.parent_days), f"waiting-{entity}")
    changed = _iso(row["dt"] for row in waiting.where("payment_found").select("dt").distinct().collect())
    if changed:
        over = waiting.where(exceeding())
        ingested = _iso(row["_ingest_date"] for row in over.select("_ingest_date").distinct().collect())
        if ingested:
            _set_aside_again(spark, lake, contract, over, arrived, ingested)
        kept = on_days(current, changed).where("payment_found").unionByName(
            on_days(waiting, changed).where(~exceeding()).drop("_parent_amount"))
        overwrite_partitions(kept, lake.path("silver", entity), "dt", expected=changed)
    return touched


def _set_aside_again(
    spark: SparkSession, lake: Lake, contract: Contract, over: DataFrame, arrived: DataFrame, ingested: list[str],
) -> None:
    """Add rows of silver to the quarantine of the days that they came in, in the form they were received."""
    key = contract.business_key
    bronze = on_days(lake.bronze(spark, contract.entity), ingested, "ingest_date")
    sent = readable(bronze).join(over.select(*key, F.col("_ingest_date").cast("date").alias("ingest_date")), [*key, "ingest_date"], "left_semi")
    failed = set_aside(sealed(validate(sent.select(bronze.columns), contract, payments=arrived)))
    path = lake.path("quarantine", contract.entity)
    before = on_days(read_table(spark, path, QUARANTINE_SCHEMA), ingested, "ingest_date")
    both = before.unionByName(failed.withColumn("ingest_date", F.col("ingest_date").cast("date")))
    # Repeating the work adds no row twice.
    overwrite_partitions(staged(both.dropDuplicates(["_raw", "_source_file", "ingest_date"]), "quarantined-again"), path, "ingest_date")


# -------------------------------------------------------------------- features
def features_after(dts: Iterable[str]) -> list[str]:
    """Event days whose frames see a change on ``dts``: each one and the seven after it."""
    return sorted({day for first in dts for day in _days_from(first, FRAME_DAYS + 1)})


def silver_to_features(spark: SparkSession, lake: Lake, dts: Iterable[dt.date | str]) -> JobResult:
    """Recompute risk features and merchant figures of the given event days."""
    use_utc(spark)
    dts = _iso(dts)
    payments = lake.silver(spark, "payments")
    merchants, customers = lake.silver(spark, "merchants"), lake.silver(spark, "customers")
    written = {"payment_features": 0, "merchant_daily": 0}

    def store(name: str, table: DataFrame, span: list[str]) -> None:
        path = lake.path("silver", name)
        overwrite_partitions(table, path, "dt", expected=span)
        # Answered from the Parquet footers.
        written[name] += on_days(read_table(spark, path, table.schema), span).count()

    for first, last in _spans(dts):
        span = [d for d in dts if first <= d <= last]
        at_once(
            spark,
            lambda: store("payment_features", payment_features(payments, merchants, customers, first, last), span),
            lambda: store("merchant_daily", merchant_daily(payments, merchants, first, last), span),
        )
    read = written.get("payment_features", 0)
    return JobResult(read, sum(written.values()), 0, [f"dt={day}" for day in dts], written)


def _spans(dts: list[str]) -> list[tuple[str, str]]:
    """Runs of days without a gap longer than the frame; a gap would be read for nothing."""
    spans: list[tuple[str, str]] = []
    for day in dts:
        if spans and day in _days_from(spans[-1][1], 2):
            spans[-1] = (spans[-1][0], day)
        else:
            spans.append((day, day))
    return spans


def features(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_table(spark, lake.path("silver", "payment_features"), FEATURES_SCHEMA).select(*FEATURE_COLUMNS)


# ------------------------------------------------------------------------ gold
def fct_payments_of(spark: SparkSession, lake: Lake, dts: Iterable[str] | None = None) -> DataFrame:
    """The payments fact, of all days or of some, whose partitions alone are then read."""
    payments, scored = lake.silver(spark, "payments"), features(spark, lake)
    if dts is not None:
        payments, scored = on_days(payments, dts), on_days(scored, dts)
    return marts.fct_payments(payments, lake.silver(spark, "merchants"), lake.silver(spark, "customers"), scored)


def refresh_fct_payments(
    spark: SparkSession, lake: Lake, dts: Iterable[dt.date | str] | None = None,
) -> list[str]:
    """Replace days of the stored fact; ``dts=None`` rebuilds all of it.  Returns the days rewritten.

    ``dts`` are the event days whose payments or features changed.  The merge into silver names every day
    that a payment came to or left, so no other day of the fact can hold one of their payments, and none
    is read.
    """
    use_utc(spark)
    path = lake.path("marts", "fct_payments")
    if dts is None:
        known = _stored_days(spark, path, "transaction_day")
        overwrite_partitions(fct_payments_of(spark, lake), path, "transaction_day", expected=known)
        return _stored_days(spark, path, "transaction_day")
    dts = _iso(dts)
    overwrite_partitions(fct_payments_of(spark, lake, dts), path, "transaction_day", expected=dts)
    return dts


def fct_children_of(spark: SparkSession, lake: Lake, entity: str, dts: Iterable[str] | None = None) -> DataFrame:
    """The fact of refunds or chargebacks, of all days or of some.

    For some days the payments that they name are found in the index, and only those payments' days are read.
    """
    _, build, _ = CHILD_FACTS[entity]
    rows, payments = lake.silver(spark, entity), lake.silver(spark, "payments")
    if dts is not None:
        rows = on_days(rows, dts)
        named = _indexed(spark, lake, "payments").newest(rows)
        payments = on_days(payments, _iso(r["dt"] for r in named.select("dt").distinct().collect()))
    return build(rows, payments)


def stored_fact(spark: SparkSession, lake: Lake, entity: str) -> DataFrame:
    """The stored fact of payments, refunds or chargebacks."""
    schema = FCT_PAYMENTS_SCHEMA if entity == "payments" else CHILD_FACTS[entity][2]
    return read_table(spark, lake.path("marts", f"fct_{entity}"), schema)


def refresh_fct_children(spark: SparkSession, lake: Lake, entity: str, dts: Iterable[str] | None = None) -> None:
    """Replace days of the stored fact of refunds or chargebacks; all of it without ``dts``."""
    use_utc(spark)
    path, (day, *_) = lake.path("marts", f"fct_{entity}"), CHILD_FACTS[entity]
    expected = _stored_days(spark, path, day) if dts is None else _iso(dts)
    if dts is None or expected:
        overwrite_partitions(fct_children_of(spark, lake, entity, None if dts is None else expected), path, day, expected=expected)


def refresh_indicators(spark: SparkSession, lake: Lake, dts: Iterable[str] | None = None) -> None:
    """Replace days of the stored daily indicators; a day's figures come from that day of the three facts."""
    use_utc(spark)
    path = lake.path("marts", "indicadores_financieros")
    expected = _stored_days(spark, path, "fecha") if dts is None else _iso(dts)
    if dts is not None and not expected:
        return

    def fact(entity: str, day: str) -> DataFrame:
        rows = stored_fact(spark, lake, entity)
        return rows if dts is None else on_days(rows, expected, day)

    rows = gold.indicadores_financieros(
        fact("payments", "transaction_day"), fact("refunds", "refund_day"), fact("chargebacks", "chargeback_day"))
    overwrite_partitions(rows, path, "fecha", expected=expected)


def refresh_facts(spark: SparkSession, lake: Lake, changed: Changes | None = None) -> None:
    """The stored facts of refunds and chargebacks, then the indicators, of the changed days or of all."""
    at_once(
        spark,
        lambda: refresh_fct_children(spark, lake, "refunds", changed and changed.refunds),
        lambda: refresh_fct_children(spark, lake, "chargebacks", changed and changed.chargebacks),
    )
    refresh_indicators(spark, lake, changed and changed.days)


def mart_tables(spark: SparkSession, lake: Lake, stored: bool = False) -> dict[str, DataFrame]:
    """Every mart and published dataset by name, as the data tests and the publication want them.

    ``stored`` reads the facts and indicators that ``refresh_facts`` keeps; else they are made of all silver
    rows, staged once so that no test repeats it.
    """
    payments = stored_fact(spark, lake, "payments")
    customers = marts.dim_customers(lake.silver(spark, "customers"))
    if stored:
        refunds, chargebacks = stored_fact(spark, lake, "refunds"), stored_fact(spark, lake, "chargebacks")
        indicators = read_table(
            spark, lake.path("marts", "indicadores_financieros"), partition_last(gold.GOLD_SCHEMAS["indicadores_financieros"], "fecha"))
    else:
        refunds, chargebacks = at_once(
            spark,
            lambda: staged(fct_children_of(spark, lake, "refunds"), "fct-refunds"),
            lambda: staged(fct_children_of(spark, lake, "chargebacks"), "fct-chargebacks"),
        )
        indicators = staged(gold.indicadores_financieros(payments, refunds, chargebacks), "indicadores")
    return {
        "dim_customers": customers,
        "dim_merchants": marts.dim_merchants(lake.silver(spark, "merchants")),
        "fct_payments": payments,
        "fct_refunds": refunds,
        "fct_chargebacks": chargebacks,
        "clientes_gold": gold.clientes_gold(customers),
        "pagos_gold": gold.pagos_gold(payments),
        "contracargos_gold": gold.contracargos_gold(chargebacks),
        "indicadores_financieros": indicators,
    }


class DataTestFailure(RuntimeError):
    """Tests of severity ``error`` that failed; nothing was published."""

    def __init__(self, failures: dict[str, int]):
        super().__init__(f"data tests failed: {failures}")
        self.failures = failures


def run_data_tests(tables: dict[str, DataFrame], checks: Sequence[Check] | None = None) -> dict[str, int]:
    """Failures of the tests that only warn; raises if one that does not has any.  A row per test is collected."""
    found = run_checks(tables, mart_checks() if checks is None else checks, RENAMED).where("failures > 0").collect()
    errors = {r["test"]: r["failures"] for r in found if r["severity"] == "error"}
    if errors:
        raise DataTestFailure(errors)
    return {r["test"]: r["failures"] for r in found}


def publish(
    spark: SparkSession, lake: Lake, run_id: str, days: Iterable[dt.date | str], kind: str,
    quality: dict | None = None, changed: Changes | None = None, checks: Sequence[Check] | None = None,
    around: Around = plainly,
) -> JobResult:
    """Refresh and test the marts, write the published datasets, then announce them all in one record.

    A failed test, or a crash at any moment, leaves the earlier publication as it was; ``checks`` replaces the
    tests of the marts.  Datasets by day are written for the ``changed`` days (all without it), the others anew.
    """
    with owned_scratch(spark):
        warnings: dict[str, int] = {}

        def build() -> JobResult:
            refresh_facts(spark, lake, changed)
            tables = mart_tables(spark, lake, stored=True)
            warnings.update(run_data_tests(tables, checks))
            return JobResult(details={"test_warnings": warnings})

        around("dbt.build", build)
        return around("publish", lambda: announce(spark, lake, run_id, days, kind, quality, changed, warnings))


def announce(
    spark: SparkSession, lake: Lake, run_id: str, days: Iterable[dt.date | str], kind: str, quality: dict | None = None,
    changed: Changes | None = None, warnings: dict | None = None,
) -> JobResult:
    """Publish the marts as they are."""
    tables = mart_tables(spark, lake, stored=True)
    due = {} if changed is None else {
        "pagos_gold": changed.payments, "contracargos_gold": changed.chargebacks, "indicadores_financieros": changed.days}
    fresh = draft(spark, lake, uuid.uuid4().hex[:12])

    def store(name: str) -> Callable[[], None]:
        return lambda: fresh.write(name, tables[name], None if changed is None else _iso(due.get(name, ())))

    at_once(spark, *[store(name) for name in gold.GOLD_DATASETS])
    record = fresh.announce(run_id=run_id, days=_iso(days), kind=kind, quality=quality, warnings=warnings)
    drop_unpublished(spark, lake)
    return JobResult(rows_written=sum(record["datasets"].values()), details=record["datasets"])


# ------------------------------------------------------------------- all layers
def quality_of(results: Iterable[JobResult]) -> dict:
    quality = {"quarantined": 0, "duplicates_removed": 0, "late_rows": 0, "quarantine_by_reason": {}}
    for result in results:
        quality["quarantined"] += result.rows_quarantined
        for name in ("duplicates_removed", "late_rows"):
            quality[name] += result.details.get(name, 0)
        for reason, n in result.details.get("quarantine_reasons", {}).items():
            quality["quarantine_by_reason"][reason] = quality["quarantine_by_reason"].get(reason, 0) + n
    return quality


def refresh_silver(
    spark: SparkSession, lake: Lake, days_of: Callable[[str], Iterable], entities: Sequence[str] = ENTITIES,
    after_payments: Callable[[JobResult], object] | None = None, around: Around = plainly,
) -> dict[str, JobResult]:
    """Bronze and silver of the feeds, for the days ``days_of(entity)``.

    Dimensions come before payments, payments before what refers to them.  Work that needs
    only the payments runs beside the refunds and chargebacks.
    """
    def bronze(entity: str) -> Callable[[], JobResult]:
        return lambda: around(f"bronze.{entity}", lambda: land_to_bronze(spark, lake, entity, days_of(entity)))

    def silver(entity: str) -> Callable[[], JobResult]:
        return lambda: around(f"silver.{entity}", lambda: bronze_to_silver(spark, lake, entity, days_of(entity)))

    revised: dict[str, JobResult] = {}

    def children_of(entity: str, paid: JobResult) -> Callable[[], JobResult | None]:
        """Earlier rows meet the payments that have arrived, then the feed's own days are merged."""
        def work() -> JobResult | None:
            if paid.partitions:
                met = revise_children(
                    spark, lake, entity, days_of("payments"), [p.partition("=")[2] for p in paid.partitions])
                if met:
                    revised[entity] = JobResult(partitions=[f"dt={day}" for day in met])
            return silver(entity)() if entity in entities else None

        return work

    landed = at_once(spark, *[bronze(entity) for entity in entities])
    results = {f"bronze.{entity}": result for entity, result in zip(entities, landed)}
    for step in (("customers", "merchants"), ("payments",), ("refunds", "chargebacks")):
        due = [entity for entity in step if entity in entities]
        jobs = [silver(entity) for entity in due]
        if step == ("refunds", "chargebacks"):
            paid = results.get("silver.payments", JobResult())
            jobs = [children_of(entity, paid) for entity in step]
            due = list(step)
            if after_payments:
                jobs.append(lambda: after_payments(paid))
        if jobs:
            merged = at_once(spark, *jobs)
            results |= {f"silver.{entity}": result for entity, result in zip(due, merged) if entity in entities}
    return results | {f"revised.{entity}": result for entity, result in revised.items()}


def changes_of(results: dict[str, JobResult], payment_days: Iterable[str]) -> Changes:
    """The days of the facts that the jobs of a run have touched."""
    def touched(entity: str) -> tuple[str, ...]:
        names = (f"silver.{entity}", f"revised.{entity}")
        return tuple(_iso(p.partition("=")[2] for n in names if n in results for p in results[n].partitions))

    return Changes(tuple(_iso(payment_days)), touched("refunds"), touched("chargebacks"))


def refresh_days(
    spark: SparkSession, lake: Lake, days: Iterable[dt.date | str], run_id: str, kind: str = "incremental",
    entities: Sequence[str] = ENTITIES, checks: Sequence[Check] | None = None,
    days_of: Callable[[str], Iterable] | None = None, around: Around = plainly,
) -> dict[str, JobResult]:
    """Landing to gold for the given days, all of them as one batch per layer and feed.

    ``entities`` names the feeds that are due; a due feed that is missing is an error, unless ``days_of`` says
    which of the days a feed has.  Every task is run through ``around``, which may log it.
    """
    days = _iso(days)
    done: dict = {}

    def score(paid: JobResult) -> None:
        scored = features_after(p.partition("=")[2] for p in paid.partitions)
        done["features"] = around("features", lambda: silver_to_features(spark, lake, scored))
        done["changed"] = refresh_fct_payments(spark, lake, scored) if scored else []

    with owned_scratch(spark):
        results = refresh_silver(spark, lake, days_of or (lambda _: days), entities, after_payments=score, around=around)
        results["features"] = done["features"]
        changed = changes_of(results, done["changed"])
        quality = quality_of(r for name, r in results.items() if name.startswith("silver."))
        results["publish"] = publish(spark, lake, run_id, days, kind, quality, changed, checks, around)
    return results
