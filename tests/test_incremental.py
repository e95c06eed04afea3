"""The index of keys, children that come before their parents, and facts and figures by day."""

import datetime as dt

import pytest
from conftest import deliver, record, rows
from pyspark.sql import functions as F
from test_gold import scans

from paylode.plans import jobs
from paylode.plans.jobs import (
    Changes,
    bronze_to_silver,
    fct_children_of,
    land_to_bronze,
    mart_tables,
    places,
    read_gold,
    references,
    refresh_days,
    refresh_facts,
)
from paylode.sources.key_index import KeyIndex
from paylode.sources.lake import read_table

D = [f"2031-03-0{i}" for i in range(1, 8)]
ALL = ("customers", "merchants", "payments", "refunds", "chargebacks")


def day(text):
    return dt.date.fromisoformat(text)


def paid(name, on, **values):
    return record("payments", f"{on}T10:00:00", payment_id=name, amount=100.0, **values)


def refund(name, payment, on, amount=40.0):
    return record("refunds", f"{on}T12:00:00", refund_id=name, payment_id=payment, amount=amount)


def run(spark, lake, on, entities=ALL):
    return refresh_days(spark, lake, [on], f"R{on}", entities=entities)


@pytest.fixture
def shop(lake):
    deliver(lake, "merchants", D[0], record("merchants"))
    deliver(lake, "customers", D[0], record("customers"))
    return lake


def test_the_index_tells_the_newest_place_and_every_place(spark, tmp_path):
    index = KeyIndex(str(tmp_path / "index"), "payment_id")
    asked = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("never",)], "payment_id string")
    assert index.newest(asked).count() == 0 and not index.is_built(spark)
    index.compact(spark)
    for places_ in ([("a", D[0]), ("b", D[0]), ("c", D[1])], [("a", D[2])], [("a", D[2]), ("a", D[2])]):
        index.record(spark.createDataFrame(places_, "payment_id string, dt string"))
    newest = [("a", day(D[2])), ("b", day(D[0]))]
    for _ in range(2):
        assert rows(index.newest(asked), "payment_id", "dt") == newest
        index.compact(spark)
        assert index.rows(spark).count() == 3
    index.record(spark.createDataFrame([("b", D[4])], "payment_id string, dt string"))
    assert rows(index.every(asked), "payment_id", "dt") == [*newest[:1], ("b", day(D[0])), ("b", day(D[4]))]


def test_the_index_of_few_keys_is_small(spark, tmp_path):
    index = KeyIndex(str(tmp_path / "index"), "payment_id")
    index.record(spark.createDataFrame([(f"P{k}", dt.date(2031, 3, 1 + k % 9)) for k in range(400)], "payment_id string, dt date"))
    sizes = [file.stat().st_size for file in (tmp_path / "index").rglob("*.parquet")]
    assert len(sizes) == 4 and max(sizes) < 100_000
    assert index.newest(spark.createDataFrame([("P7",), ("P400",)], "payment_id string")).collect() == [("P7", dt.date(2031, 3, 8))]


def test_a_lookup_shuffles_the_keys_and_not_the_index(spark, tmp_path):
    index = KeyIndex(str(tmp_path / "index"), "payment_id")
    index.record(spark.range(2000).select(F.col("id").cast("string").alias("payment_id"), F.lit(D[0]).alias("dt")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = index.newest(spark.range(0, 4000, 2).select(F.col("id").cast("string").alias("payment_id")))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")
    assert "Bucketed: true" in plan
    above, _, below = plan.partition("FileScan")
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line)
    indent = lambda line: len(line) - len(line.lstrip(" :+-"))
    depth, path = indent(lines[at]), []
    for line in reversed(lines[:at]):
        if indent(line) < depth:
            depth = indent(line)
            path.append(line)
    assert not any("Exchange" in line for line in path), path


def test_a_merge_reads_only_the_days_that_it_rewrites(spark, shop, monkeypatch):
    for n in range(3):
        deliver(shop, "payments", D[n], paid(f"P{n}", D[n]))
    for entity in ("refunds", "chargebacks"):
        deliver(shop, entity, D[0])
    run(spark, shop, D[0])
    refresh_days(spark, shop, D[1:3], "R", entities=("payments",))
    deliver(shop, "payments", D[5], paid("P5", D[5]), paid("P1", D[5], updated_at=f"{D[5]}T11:00:00"))
    seen = []
    overwrite = jobs.overwrite_partitions

    def watched(df, path, *args, **kwargs):
        if path.endswith("silver/payments"):
            seen.extend(filters for folder, filters in scans(df) if folder.endswith("silver/payments"))
        return overwrite(df, path, *args, **kwargs)

    monkeypatch.setattr(jobs, "overwrite_partitions", watched)
    result = run(spark, shop, D[5], ("payments",))
    assert result["silver.payments"].partitions == [f"dt={D[1]}", f"dt={D[5]}"]
    assert seen and all("dt" in filters for filters in seen)
    assert rows(shop.silver(spark, "payments"), "payment_id", "dt") == [
        ("P0", day(D[0])), ("P1", day(D[5])), ("P2", day(D[2])), ("P5", day(D[5]))]
    asked = spark.createDataFrame([("P1",)], "payment_id string")
    assert rows(places(shop, "payments").newest(asked), "dt") == [(day(D[5]),)]


def test_a_table_without_an_index_gets_one(spark, shop):
    deliver(shop, "payments", D[0], paid("P1", D[0]))
    for entity in ("merchants", "payments"):
        land_to_bronze(spark, shop, entity, [D[0]])
        bronze_to_silver(spark, shop, entity, [D[0]])
    from paylode.sources.files import remove

    remove(spark, shop.path("index"))
    deliver(shop, "payments", D[5], paid("P1", D[5]))
    land_to_bronze(spark, shop, "payments", [D[5]])
    assert bronze_to_silver(spark, shop, "payments", [D[5]]).partitions == [f"dt={D[0]}", f"dt={D[5]}"]
    assert rows(shop.silver(spark, "payments"), "payment_id", "dt") == [("P1", day(D[5]))]


def test_refunds_meet_payments_that_come_later(spark, shop):
    deliver(shop, "payments", D[0], paid("P0", D[0]))
    deliver(shop, "refunds", D[0], refund("R1", "P1", D[0]), refund("R2", "P1", D[0], 400.0), refund("R3", "P404", D[0]), refund("R4", "OLD", D[0]))
    deliver(shop, "chargebacks", D[0], record("chargebacks", f"{D[0]}T12:00:00", chargeback_id="B1", payment_id="P1", amount=5.0))
    run(spark, shop, D[0])
    assert rows(shop.silver(spark, "refunds"), "refund_id", "payment_found") == [(f"R{i}", False) for i in (1, 2, 3, 4)]
    for _ in range(2):  # again: nothing changes, no row is set aside twice
        deliver(shop, "payments", D[2], paid("P1", D[0], currency="USD", updated_at=f"{D[2]}T01:00:00"))
        result = run(spark, shop, D[2], ("payments",))
        assert result["revised.refunds"].partitions == [f"dt={D[0]}"]
        assert rows(shop.silver(spark, "refunds"), "refund_id", "payment_found") == [("R1", True), ("R3", False), ("R4", False)]
        failed = read_table(spark, shop.path("quarantine", "refunds"), jobs.QUARANTINE_SCHEMA)
        assert [(r["_reasons"], str(r["ingest_date"])) for r in failed.collect()] == [(["amount:exceeds_payment"], D[0])]
    whole = mart_tables(spark, shop)
    for entity in ("refunds", "chargebacks"):
        fact = jobs.stored_fact(spark, shop, entity)
        assert rows(fact, *fact.columns) == rows(whole[f"fct_{entity}"], *fact.columns)
    assert rows(jobs.stored_fact(spark, shop, "refunds"), "refund_id", "amount_cop", "payment_day")[0] == ("R1", 160_000.0, day(D[0]))
    assert rows(read_gold(spark, shop, "contracargos_gold"), "id_contracargo", "dias_hasta_contracargo") == [("B1", 0)]
    # The day's feed again, now after its payment: the same rows fail.
    bronze_to_silver(spark, shop, "refunds", [D[0]])
    assert rows(shop.silver(spark, "refunds"), "refund_id", "payment_found") == [("R1", True), ("R3", False), ("R4", False)]


def test_facts_by_day_read_their_days_and_their_payments_days(spark, shop):
    for n in range(4):
        deliver(shop, "payments", D[n], paid(f"P{n}", D[n]))
        deliver(shop, "refunds", D[n], refund(f"R{n}", f"P{max(0, n - 1)}", D[n]))
        deliver(shop, "chargebacks", D[n])
    run(spark, shop, D[0])
    refresh_days(spark, shop, D[1:4], "R", entities=("payments", "refunds"))
    plan = dict((folder.rsplit("/", 1)[-1], filters) for folder, filters in scans(fct_children_of(spark, shop, "refunds", [D[3]])))
    number = lambda text: str((day(text) - dt.date(1970, 1, 1)).days)
    assert all(x in plan["refunds"] for x in ("dt",)) and (D[3] in plan["refunds"] or number(D[3]) in plan["refunds"])
    assert (D[2] in plan["payments"] or number(D[2]) in plan["payments"]) and D[0] not in plan["payments"]
    before = rows(read_gold(spark, shop, "indicadores_financieros"), "fecha", "pagos", "devoluciones", "tasa_devolucion")
    refresh_facts(spark, shop)
    again = read_table(spark, shop.path("marts", "indicadores_financieros"), jobs.partition_last(jobs.gold.GOLD_SCHEMAS["indicadores_financieros"], "fecha"))
    assert rows(again, "fecha", "pagos", "devoluciones", "tasa_devolucion") == before and len(before) == 4
    refresh_facts(spark, shop, Changes())
    assert references(shop, "refunds").is_built(spark)
