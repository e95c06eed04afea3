"""Five days of small feeds from files to gold, in several ways that must agree."""

import datetime as dt
from pathlib import Path

import pytest
from conftest import deliver, record, rows
from pyspark.sql import functions as F

from paylode.operators.checks import mart_checks, run_checks
from paylode.plans import gold, marts
from paylode.plans.jobs import (
    FCT_PAYMENTS_SCHEMA,
    bronze_to_silver,
    fct_payments_of,
    land_to_bronze,
    mart_tables,
    DataTestFailure,
    overwrite_partitions,
    publish,
    read_gold,
    refresh_days,
    refresh_fct_payments,
)
from paylode.contracts import ENTITIES
from paylode.plans.publication import published_record
from paylode.session import clustered, scratch_path
from paylode.sources.lake import Lake, read_table
from paylode.streaming.landing_stream import merge_stream

DAYS = [f"2026-09-0{i}" for i in range(1, 6)]


def paid(name, when, **values):
    return record("payments", when, **({"payment_id": name, "customer_id": "C1", "merchant_id": "M0001",
                                        "status": "approved", "amount": 1000.0} | values))


def write_feeds(lake):
    for n, day in enumerate(DAYS):
        midnight = f"{day}T00:00:00"
        deliver(lake, "customers", day, *[
            record("customers", midnight, customer_id=f"C{i}", risk_segment="low" if n < 2 else "high") for i in range(1, 5)])
        deliver(lake, "merchants", day, *[record("merchants", midnight, merchant_id=f"M{i:04d}") for i in range(1, 4)])
        extra = {"currency": "USD", "channel": "web"} if n >= 2 else {}
        payments = [
            paid(f"P{n}-{i}", f"{day}T{i % 24:02d}:00:00", customer_id=f"C{1 + i % 4}", merchant_id=f"M{1 + i % 3:04d}",
                 amount=100.0 + i, status="pending" if i % 10 == 0 else "approved", **(extra if i % 2 else {}))
            for i in range(60)]
        if n:  # yesterday's pending payments are resolved, and one payment is late
            before = DAYS[n - 1]
            payments += [paid(f"P{n - 1}-{i}", f"{before}T{i % 24:02d}:00:00", customer_id=f"C{1 + i % 4}",
                              merchant_id=f"M{1 + i % 3:04d}", amount=100.0 + i, updated_at=f"{day}T01:00:00")
                         for i in range(0, 60, 10)]
            payments.append(paid(f"L{n}", f"{before}T23:30:00", amount=9000.0, updated_at=f"{day}T02:00:00"))
        payments.append(paid(f"BAD{n}", f"{day}T01:00:00", amount=-1))
        deliver(lake, "payments", day, *payments)
        deliver(lake, "refunds", day, *[
            record("refunds", f"{day}T23:00:00", refund_id=f"R{n}-{i}", payment_id=f"P{n}-{i}", amount=amount)
            for i, amount in ((1, 50.0), (2, 5000.0), (3, 103.0))])
        deliver(lake, "chargebacks", day, record(
            "chargebacks", f"{day}T22:00:00", chargeback_id=f"B{n}", payment_id=f"P{max(n - 2, 0)}-5", amount=10.0))


@pytest.fixture(scope="module")
def feeds(tmp_path_factory):
    root = tmp_path_factory.mktemp("feeds")
    lake = Lake(str(root / "daily"), str(root / "landing"))
    write_feeds(lake)
    return lake


@pytest.fixture(scope="module")
def daily(spark, feeds):
    for i, day in enumerate(DAYS):
        refresh_days(spark, feeds, [day], f"R{i}")
    return feeds


def published(spark, lake):
    return {
        name: rows(read_gold(spark, lake, name), *read_gold(spark, lake, name).columns) for name in gold.GOLD_DATASETS
    }


def close(a, b):
    def flat(value):
        return round(value, 6) if isinstance(value, float) else value
    return {k: [tuple(map(flat, r)) for r in v] for k, v in a.items()} == {
        k: [tuple(map(flat, r)) for r in v] for k, v in b.items()}


def test_day_by_day_equals_one_batch(spark, daily, tmp_path):
    other = Lake(str(tmp_path / "batch"), daily.landing)
    results = refresh_days(spark, other, DAYS, "R", "backfill")
    assert results["silver.payments"].details["late_rows"] == 4 * 7  # resolved and late ones of four days
    a, b = published(spark, daily), published(spark, other)
    assert len(a["pagos_gold"]) == 304 and len(a["indicadores_financieros"]) == 5
    # A day of its own sees the customer segment of that day only in rows refreshed then.
    assert close(a, b)


def test_late_payments_have_features(spark, daily):
    fact = read_table(spark, daily.path("marts", "fct_payments"), FCT_PAYMENTS_SCHEMA)
    late = fact.where(F.col("payment_id").startswith("L"))
    assert rows(late, "flag_amount_spike") == [(True,)] * 4


def test_the_manifest_counts_what_is_published(spark, daily):
    manifest = published_record(spark, daily)
    counts = {name: len(found) for name, found in published(spark, daily).items()}
    assert manifest["datasets"] == counts and manifest["run_id"] == "R4" and manifest["dates"] == [DAYS[-1]]
    assert dt.datetime.fromisoformat(manifest["published_at"]).tzinfo is not None
    assert manifest["quality"]["quarantined"] == 2
    assert manifest["quality"]["quarantine_by_reason"] == {"amount:below_min": 1, "amount:exceeds_payment": 1}


def test_data_tests_pass_and_columns_are_published(spark, daily):
    found = {r["test"]: (r["severity"], r["failures"]) for r in run_checks(mart_tables(spark, daily), mart_checks()).collect()}
    assert len(found) == 26
    assert {t: f for t, f in found.items() if f[1]} == {}
    assert found["relationships_fct_refunds_payment_id"][0] == "warn"
    datasets = {name: read_gold(spark, daily, name) for name in gold.GOLD_DATASETS}
    assert gold.missing_columns(datasets) == dict.fromkeys(gold.REQUIRED_COLUMNS, [])
    assert gold.missing_columns({"pagos_gold": datasets["pagos_gold"].drop("monto")})["pagos_gold"] == ["monto"]


def test_data_tests_find_what_is_wrong(spark, daily):
    tables = mart_tables(spark, daily)
    twice = tables["fct_payments"].unionByName(tables["fct_payments"].limit(3)).withColumn(
        "status", F.when(F.col("payment_id") == "P0-1", "lost").otherwise(F.col("status")))
    tables |= {"fct_payments": twice, "dim_merchants": tables["dim_merchants"].where("merchant_id <> 'M0001'")}
    found = {r["test"]: r["failures"] for r in run_checks(tables, mart_checks()).collect()}
    assert found["unique_fct_payments_payment_id"] == 3
    assert found["accepted_values_fct_payments_status"] >= 1
    assert found["relationships_fct_payments_merchant_id"] > 100


def test_rerun_and_full_refresh_change_nothing(spark, daily):
    before = published(spark, daily)
    refresh_days(spark, daily, [DAYS[2]], "again", "date")
    assert close(published(spark, daily), before)
    refresh_fct_payments(spark, daily)
    publish(spark, daily, "full", DAYS, "date")
    assert close(published(spark, daily), before)


def test_a_payment_corrected_weeks_later_is_published_once(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), str(tmp_path / "landing"))
    old, new = "2026-09-01", "2026-10-03"
    for entity, row in (("customers", {"customer_id": "C1"}), ("merchants", {"merchant_id": "M0001"})):
        deliver(lake, entity, old, record(entity, f"{old}T00:00:00", **row))
    deliver(lake, "payments", old, paid("moved", f"{old}T10:00:00", amount=31.0), paid("other", f"{old}T11:00:00", amount=8.0))
    refresh_days(spark, lake, [old], "first", entities=("customers", "merchants", "payments"))
    deliver(lake, "payments", new, paid("moved", f"{new}T10:00:00", amount=31.0, updated_at=f"{new}T12:00:00"))
    refresh_days(spark, lake, [new], "second", entities=("payments",))
    day = F.col("fecha").cast("string")
    assert rows(read_gold(spark, lake, "pagos_gold"), "id_pago", day) == [("moved", new), ("other", old)]
    assert rows(read_gold(spark, lake, "indicadores_financieros"), day, "pagos", "tpv_cop") == [(old, 1, 8.0), (new, 1, 31.0)]
    assert rows(read_table(spark, lake.path("silver", "payment_features"), "payment_id string, dt date"),
                "payment_id", F.col("dt").cast("string")) == [("moved", new), ("other", old)]


def test_a_failed_data_test_leaves_the_publication(spark, daily):
    before = published(spark, daily)
    path = daily.path("marts", "fct_payments")
    fact = read_table(spark, path, FCT_PAYMENTS_SCHEMA).where(F.col("transaction_day") == DAYS[1])
    overwrite_partitions(fact.union(fact.limit(1)), path, "transaction_day")
    with pytest.raises(DataTestFailure) as caught:
        publish(spark, daily, "broken", DAYS, "date")
    assert set(caught.value.failures) == {"unique_fct_payments_payment_id", "unique_pagos_gold_id_pago"}
    assert published(spark, daily) == before
    refresh_fct_payments(spark, daily, [DAYS[1]])
    publish(spark, daily, "mended", DAYS, "date")
    assert close(published(spark, daily), before)


def test_a_refresh_leaves_nothing_staged(spark, daily):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = sorted(p.name for p in shared.iterdir())
    refresh_days(spark, daily, [DAYS[4]], "again", "date")
    assert sorted(p.name for p in shared.iterdir()) == before


def scans(df):
    """``(folder, partition filters)`` of every file scan, from the plan's nodes: its text shortens long paths."""
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves()
    nodes = [leaves.apply(i) for i in range(leaves.size())]
    return [(n.relation().location().rootPaths().head().toString(), n.partitionFilters().mkString(" "))
            for n in nodes if n.nodeName().startswith("Scan parquet")]


def test_a_refresh_of_the_fact_reads_only_its_days(spark, daily):
    read = {Path(folder).name: filters for folder, filters in scans(fct_payments_of(spark, daily, [DAYS[2]]))}
    assert all("dt" in read[name] and (DAYS[2] in read[name] or str((dt.date(2026, 9, 3) - dt.date(1970, 1, 1)).days) in read[name])
               for name in ("payments", "payment_features"))


def test_a_snapshot_ends_with_its_day(spark, daily):
    pagos = read_gold(spark, daily, "pagos_gold")
    assert gold.snapshot_as_of(pagos, DAYS[1]).agg(F.max("fecha")).first()[0] == dt.date(2026, 9, 2)


def test_the_fact_read_is_pruned_and_pushed_down(spark, daily):
    df = daily.silver(spark, "payments").where("dt = DATE'2026-09-03' AND status = 'approved'").select("amount")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "EqualTo(status,approved)" in plan
    assert "ReadSchema: struct<amount:double,status:string>" in plan


def test_stream_equals_batch(spark, feeds, daily, tmp_path):
    other = Lake(str(tmp_path / "stream"), feeds.landing)
    columns = ("payment_id", "status", "amount", "currency", "dt")
    for entity in ("merchants", "payments"):
        query = merge_stream(spark, other, entity, scratch_path(spark, "stream"), files_per_batch=2)
        assert query.awaitTermination(240) and query.exception() is None
    assert rows(other.silver(spark, "payments"), *columns) == rows(daily.silver(spark, "payments"), *columns)
    failed = spark.read.parquet(other.path("quarantine_stream", "payments"))
    assert failed.count() == 5


def test_children_of_later_payments_are_kept(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), str(tmp_path / "landing"))
    deliver(lake, "chargebacks", DAYS[0], record(
        "chargebacks", f"{DAYS[0]}T00:00:00", chargeback_id="B1", payment_id="P1", amount=5.0))
    land_to_bronze(spark, lake, "chargebacks", [DAYS[0]])
    bronze_to_silver(spark, lake, "chargebacks", [DAYS[0]])
    fact = mart_tables(spark, lake)["fct_chargebacks"]
    assert rows(fact, "chargeback_id", "payment_found", "amount_cop", "days_to_chargeback") == [
        ("B1", False, 5.0, None)]
    assert set(ENTITIES) == {"customers", "merchants", "payments", "refunds", "chargebacks"}


PAYMENT = ("payment_id string, customer_id string, merchant_id string, amount double, currency string, payment_method string, "
           "channel string, status string, transaction_date timestamp, updated_at timestamp, dt date")


def a_fact(spark, paid_rows, payments_of=lambda df: df):
    at = dt.datetime(2026, 9, 1, 12)
    payments = payments_of(spark.createDataFrame(
        [(pid, customer, "M1", 2.0, "USD", "card", "web", "approved", at, at, dt.date.fromisoformat(day))
         for pid, customer, day in paid_rows], PAYMENT))
    merchants = spark.createDataFrame([("M1", "food")], "merchant_id string, category string")
    customers = spark.createDataFrame([("C1", "low"), ("C2", "high"), ("C2", "medium")], "customer_id string, risk_segment string")
    scored = spark.createDataFrame([("P1", dt.date(2026, 9, 1), True, None), ("P2", dt.date(2026, 9, 2), True, True)],
                                   "payment_id string, dt date, high_velocity boolean, amount_spike boolean")
    return marts.fct_payments(payments, merchants, customers, scored)


def test_the_fact_of_repeated_ids_and_customers(spark):
    """Each payment meets its own customer and the flags of its own day, also where an id comes twice."""
    fact = a_fact(spark, [("P1", "C1", DAYS[0]), ("P1", "C2", DAYS[0]), ("P1", "C1", DAYS[1]), ("P2", "C1", DAYS[0]),
                          ("P2", "C1", DAYS[0]), ("P3", None, DAYS[0]), ("P4", "C9", DAYS[0])])
    found = rows(fact, "payment_id", "customer_id", F.col("transaction_day").cast("string"), "risk_segment", "flag_high_velocity")
    assert sorted(map(str, found)) == sorted(map(str, [
        ("P1", "C1", DAYS[0], "low", True), ("P1", "C2", DAYS[0], "high", True), ("P1", "C2", DAYS[0], "medium", True),
        ("P1", "C1", DAYS[1], "low", False), ("P2", "C1", DAYS[0], "low", False), ("P2", "C1", DAYS[0], "low", False),
        ("P3", None, DAYS[0], None, False), ("P4", "C9", DAYS[0], None, False)]))


def test_payments_stored_by_payment_are_not_shuffled_again(spark):
    """Neither for the fact nor to store it in the same way nor for a join by payment; the catalog keeps nothing."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = a_fact(spark, [(f"P{i}", "C1", DAYS[0]) for i in range(9)], lambda df: clustered(df, "paid", "payment_id"))
        fact = fact.drop("merchant_category")
        plan = fact._jdf.queryExecution().executedPlan().toString().splitlines()
        stored = clustered(fact, "mart", "payment_id")
        again = stored.join(clustered(stored.select("payment_id"), "ids", "payment_id"), "payment_id")
        joined = again._jdf.queryExecution().executedPlan().toString()
        assert again.count() == 9 and "Exchange" not in joined
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    by = [line.split("hashpartitioning(")[1].split("#")[0] for line in plan if "Exchange hashpartitioning" in line]
    # The flags, the ids to their customers and back, the dimensions; the payments only to the merchants, the last join.
    assert sorted(by) == sorted(["_flagged_id", "customer_id", "customer_id", "_segment_id", "merchant_id", "merchant_id"])
    assert spark.catalog.listTables() == []


def test_payments_are_stored_by_payment_without_a_shuffle_whatever_the_merchants(spark):
    """Merchants too many to be broadcast meet ids, not whole payments; null, unknown and repeated ones count as ever."""
    at, day = dt.datetime(2026, 9, 1, 12), dt.date(2026, 9, 1)
    who = [("P1", "C1", "M1"), ("P1", "C1", "M2"), ("P2", None, "M1"), ("P3", "C1", None), ("P4", "C9", "M9"), ("P5", "C2", "M2"),
           ("P6", None, None), ("P6", None, None)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        payments = clustered(spark.createDataFrame(
            [(*ids, 2.0, "USD", "card", "web", "approved", at, at, day) for ids in who], PAYMENT), "paid", "payment_id")
        merchants = spark.createDataFrame(
            [("M1", "food"), ("M2", "retail"), ("M2", "services"), (None, "none")], "merchant_id string, category string")
        customers = spark.createDataFrame(
            [("C1", "low"), ("C2", "high"), ("C2", "medium"), (None, "none")], "customer_id string, risk_segment string")
        scored = spark.createDataFrame([("P1", day, True, None)], "payment_id string, dt date, high_velocity boolean, amount_spike boolean")
        fact = marts.fct_payments(payments, merchants, customers, scored)
        dealt = fact.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "payment_id")
        plans = [df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for df in (fact, dealt)]
        assert plans[0] == plans[1]
        found = rows(fact, "payment_id", "customer_id", "merchant_id", "merchant_category", "risk_segment")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == sorted([
        ("P1", "C1", "M1", "food", "low"), ("P1", "C1", "M2", "retail", "low"), ("P1", "C1", "M2", "services", "low"),
        ("P2", None, "M1", "food", None), ("P3", "C1", None, None, "low"), ("P4", "C9", "M9", None, None),
        *[("P5", "C2", "M2", c, s) for c in ("retail", "services") for s in ("high", "medium")],
        ("P6", None, None, None, None), ("P6", None, None, None, None)], key=repr)
