"""Runs that choose their days, the log and watermark they leave, and what is published when something breaks."""

import datetime as dt
import json
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from conftest import deliver, record, rows
from pyspark.sql import functions as F

from paylode.operators import audit
from paylode.operators.incremental import advanced_watermark
from paylode.plans import gold, publication, runs
from paylode.plans.publication import publish_as_of, published_record, read_gold
from paylode.sources.control import VersionedRecord

D = [f"2031-03-0{i}" for i in range(1, 8)]


def land(lake, *days, skip=()):
    for on in days:
        n = D.index(on)
        at = f"{on}T10:00:00"
        feeds = {
            "merchants": [record("merchants", at)],
            "customers": [record("customers", at)],
            "payments": [record("payments", at, payment_id=f"P{n}-{i}", amount=100.0, status="approved") for i in range(3)]
            + [record("payments", at, payment_id=f"P{n}-0", amount=100.0, status="approved"),
               record("payments", at, payment_id=f"BAD{n}", amount=-1.0), "{cut", record("payments", at, payment_id=f"X{n}", promo="x")],
            "refunds": [record("refunds", f"{on}T12:00:00", refund_id=f"R{n}", payment_id=f"P{n}-1", amount=40.0)],
            "chargebacks": [record("chargebacks", f"{on}T13:00:00", chargeback_id=f"B{n}", payment_id=f"P{n}-2", amount=4.0)],
        }
        for entity, records in feeds.items():
            if entity not in skip:
                deliver(lake, entity, on, *records)


def published(spark, lake, of="current"):
    return {n: rows(t, *t.columns) for n in gold.GOLD_DATASETS for t in [read_gold(spark, lake, n, of)]}


def files(lake):
    return {str(p): p.stat().st_mtime_ns for p in Path(lake.path("gold")).rglob("*.parquet")}


def test_a_record_is_written_once_per_version(spark, tmp_path):
    log = VersionedRecord(str(tmp_path / "a" / "b"))
    assert log.newest(spark) == (0, None)
    assert log.put(spark, 1, {"a": "ñ"}) and not log.put(spark, 1, {"a": "other"}) and log.put(spark, 2, {"a": "y"})
    assert log.newest(spark) == (2, {"a": "y"}) and log.at(spark, 1) == {"a": "ñ"}
    assert log.versions(spark) == [1, 2] and not list(Path(log.path).glob("*.tmp"))


def test_the_watermark_never_goes_back(spark, lake):
    assert runs.watermark(spark, lake) is None and runs.watermark_log(spark, lake).count() == 0
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda day: runs.advance(spark, lake, day, "r"), [D[2], D[0], D[4], D[1]]))
    assert runs.watermark(spark, lake) == D[4]
    assert runs.advance(spark, lake, D[3], "r") == D[4]
    log = runs.watermark_log(spark, lake)
    assert rows(advanced_watermark(log), "name", "value") == [("ingest_date", D[4])]
    values = [r["value"] for r in log.orderBy("updated_at").collect()]
    assert values == sorted(set(values))


def test_runs_take_what_has_landed_and_log_it(spark, lake):
    land(lake, D[0], D[1])
    first = runs.run_incremental(spark, lake)
    assert runs.watermark(spark, lake) == D[1] and runs.run_incremental(spark, lake) is None
    land(lake, D[2])
    second = runs.run_incremental(spark, lake)
    before = published(spark, lake)
    again = runs.backfill(spark, lake, D[0], D[1])
    same_day = runs.run_days(spark, lake, [D[1]])
    assert runs.watermark(spark, lake) == D[2] and published(spark, lake) == before
    with pytest.raises(runs.RunFailed, match="nothing has landed"):
        runs.backfill(spark, lake, "2030-01-01", "2030-01-02")
    log, tasks = runs.runs(spark, lake), runs.task_runs(spark, lake)
    assert rows(log, "run_id", "kind", "dates", "status") == sorted([
        (first, "incremental", json.dumps(D[:2]), "success"), (second, "incremental", json.dumps(D[2:3]), "success"),
        (again, "backfill", json.dumps(D[:2]), "success"), (same_day, "date", json.dumps(D[1:2]), "success")])
    states = audit.stage_status(log, tasks).where(F.col("run_id") == first)
    assert rows(states, "stage", "status", "done") == sorted([
        ("bronze", "ok", 10), ("silver", "ok", 10), ("features", "ok", 2), ("dbt", "ok", 1), ("publish", "ok", 1)])
    silver = tasks.where((F.col("run_id") == first) & (F.col("task") == "silver.payments"))
    found = audit.with_details(silver)
    assert rows(found, "ingest_date", "rows_read", "rows_written", "rows_quarantined", "_d.duplicates_removed", "_d.late_rows") == [
        (day, 7, 4, 2, 1, 0) for day in D[:2]]
    reasons = {"amount:below_min": 1, "record:malformed_json": 1}
    assert [r[0] for r in found.select("_d.quarantine_reasons").collect()] == [reasons, reasons]
    quality = published_record(spark, lake)
    assert quality["run_id"] == same_day and quality["quality"]["quarantined"] == 2 and quality["quality"]["duplicates_removed"] == 1
    drift = runs.schema_events(spark, lake)
    assert set(rows(drift, "ingest_date", "entity", "kind", "columns")) == {
        (day, "payments", "unknown_columns", '["promo"]') for day in D[:3]}


def test_a_failed_run_leaves_watermark_and_publication(spark, lake, monkeypatch):
    land(lake, D[0])
    runs.run_incremental(spark, lake)
    before, record_before = published(spark, lake), published_record(spark, lake)
    land(lake, D[1], skip=("refunds",))
    with pytest.raises(runs.RunFailed, match="no refunds feed"):
        runs.run_incremental(spark, lake)
    failed = runs.task_runs(spark, lake).where("status = 'failed'")
    assert rows(failed, "task", "ingest_date", "attempt") == [("bronze.refunds", D[1], 1)]
    assert runs.watermark(spark, lake) == D[0] and published(spark, lake) == before
    land(lake, D[2])
    deliver(lake, "refunds", D[1])

    write = publication.Draft.write

    def broken(self, name, *args):
        if name == "indicadores_financieros":
            raise OSError("disk")
        return write(self, name, *args)

    monkeypatch.setattr(publication.Draft, "write", broken)
    with pytest.raises(runs.RunFailed, match="disk"):
        runs.run_incremental(spark, lake)
    assert published_record(spark, lake) == record_before and published(spark, lake) == before
    monkeypatch.setattr(publication.Draft, "write", write)
    runs.run_incremental(spark, lake)  # the lease was given back, the same days are due
    assert runs.watermark(spark, lake) == D[2]
    assert [r[0] for r in rows(read_gold(spark, lake, "indicadores_financieros"), F.col("fecha").cast("string"))] == D[:3]
    assert rows(runs.runs(spark, lake).groupBy("status").count(), "status", "count") == [("failed", 2), ("success", 2)]
    stale = {p.parent.name for p in Path(lake.path("gold", "clientes_gold")).glob("version=*/*.parquet")}
    assert stale == {f"version={part['version']}" for n in (1, 2) for part in
                     publication.channel(lake).at(spark, n)["parts"]["clientes_gold"].values()}


def test_only_one_run_works_on_a_lake(spark, lake):
    land(lake, D[0])
    with runs.exclusive(spark, lake, "other") as prolong:
        with pytest.raises(runs.LakeBusy, match="other"):
            runs.run_incremental(spark, lake)
        prolong()
    assert runs.watermark(spark, lake) is None
    with ThreadPoolExecutor(2) as pool:
        started = [pool.submit(runs.run_incremental, spark, lake) for _ in range(2)]
    busy = [s.exception() for s in started if s.exception()]
    took = [s.result() for s in started if not s.exception() and s.result()]
    assert len(took) == 1 and all(isinstance(e, runs.LakeBusy) for e in busy)
    # A run that was killed holds the lake no longer than its lease.
    VersionedRecord(lake.path("control", "lease")).put(
        spark, VersionedRecord(lake.path("control", "lease")).newest(spark)[0] + 1,
        {"run_id": "killed", "held_until": (dt.datetime.now(dt.UTC) - dt.timedelta(seconds=1)).isoformat()})
    assert runs.run_incremental(spark, lake) is None
    # One that lost it notices before its next task.
    with pytest.raises(runs.LakeBusy, match="taken"):
        with runs.exclusive(spark, lake, "slow", hours=0) as prolong:
            with runs.exclusive(spark, lake, "next", hours=1):
                prolong()


def test_a_publication_names_unchanged_days_again_and_an_earlier_day_stays(spark, lake):
    with pytest.raises(LookupError):
        publish_as_of(spark, lake, D[0], "month")
    land(lake, D[0], D[1], D[2])
    runs.run_incremental(spark, lake)
    now, written = published(spark, lake), files(lake)
    earlier = publish_as_of(spark, lake, D[1], "month")
    assert published(spark, lake) == now and files(lake) == written
    then = published(spark, lake, "month")
    assert earlier["kind"] == "as_of" and earlier["datasets"] == {name: len(found) for name, found in then.items()}
    assert earlier["datasets"]["pagos_gold"] == 8 and earlier["datasets"]["indicadores_financieros"] == 2
    with pytest.raises(ValueError):
        publish_as_of(spark, lake, D[1], "current")

    late = publication.draft(spark, lake, "late")
    late.parts = published_record(spark, lake)["parts"]
    land(lake, D[6])
    runs.run_incremental(spark, lake)
    with pytest.raises(publication.PublicationConflict):
        late.announce(run_id="late", days=[], kind="date")
    after = files(lake)
    kept = {path for path in written if "clientes_gold" not in path}
    assert kept and all(after.get(path) == written[path] for path in kept)
    assert {Path(path).parent.name for path in set(after) - set(written) if "pagos_gold" in path} == {f"fecha={D[6]}"}
    plan = read_gold(spark, lake, "pagos_gold").where(F.col("fecha") == D[6])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fecha" in plan
    # Versions that only the other name refers to stay when old publications go.
    publication.drop_unpublished(spark, lake, keep=1)
    assert published(spark, lake, "month") == then and published(spark, lake)["pagos_gold"] != now["pagos_gold"]
