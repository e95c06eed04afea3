"""Queries over files: the given tables written as landing feeds, then taken through every layer.

The feeds and tables are written below the shared folder of the session.  Queries that only
read share one lake per session and data folder; those that change a lake get their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paylode.contracts import CONTRACTS, ENTITIES, PAYMENTS
from paylode.operators.validate import malformed, quarantine, validate
from paylode.plans import gold
from paylode.operators.audit import with_details
from paylode.operators.checks import mart_checks
from paylode.plans.jobs import (
    FCT_PAYMENTS_SCHEMA,
    QUARANTINE_SCHEMA,
    at_once,
    bronze_to_silver,
    features,
    features_after,
    land_to_bronze,
    publish,
    quality_of,
    read_gold,
    refresh_fct_payments,
    refresh_silver,
    silver_to_features,
)
from paylode.plans.publication import channel
from paylode.plans.jobs import changes_of, refresh_facts, stored_fact
from paylode.session import scratch_path
from paylode.sources.lake import Lake, on_days, read_table
from paylode.sources.landing import drift, ingest_counts, landed_days, landing_completeness, read_feed
from paylode.plans import runs
from paylode.plans.publication import publish_as_of
from paylode.streaming.landing_stream import merge_stream
from testbed import adapters as src
from testbed.oracle import day, moment, sql
from testbed.queries import _comparable, comparable_kpis
from testbed.registry import query

V2_FROM = "2024-01-15"


# ------------------------------------------------------------- writing the feeds
def _payment_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions of the feed, with resends, resolutions, extra members and cut-off lines."""
    once = src.payment_feed(spark, sf)
    resolved = once.where((F.col("status") == "pending") & (F.col("k") >= 30)).select(
        *[c for c in once.columns if c not in ("status", "updated_at", "ingest_date")],
        F.lit("approved").alias("status"),
        F.date_format(F.col("ts") + F.expr("INTERVAL 1 DAY"), src.ISO).alias("updated_at"),
        F.date_add("ingest_date", 1).alias("ingest_date"),
    )
    rows = once.unionByName(once.where(F.col("k") == 60)).unionByName(resolved)
    second = F.col("ingest_date") >= F.lit(V2_FROM).cast("date")
    members = [
        F.when(second, F.col(n)).alias(n) if n in ("currency", "channel") else F.col(n) for n in PAYMENTS.names
    ]
    promo = F.when(F.col("event_type") == "purchase", F.concat(F.lit("PROMO"), F.col("k").cast("string")))
    campaign = F.when((F.col("event_type") == "view") & (F.col("k") > 95), F.col("k"))
    line = F.to_json(F.struct(*members, promo.alias("promo_code"), campaign.alias("campaign")))
    cut_off = (F.col("event_type") == "error") & (F.col("k") == 50)
    return rows.select(
        F.when(cut_off, F.left(line, F.lit(40))).otherwise(line).alias("value"), "ingest_date",
    )


def _lines(df: DataFrame, names: list[str]) -> DataFrame:
    members = [
        F.date_format(n, src.ISO).alias(n) if dict(df.dtypes)[n] == "timestamp" else F.col(n) for n in names
    ]
    return df.select(F.to_json(F.struct(*members)).alias("value"), "ingest_date")


def _customer_lines(spark, sf):
    everyone = src.customers(spark, sf)
    first = everyone.withColumn("risk_segment", F.lit("low")).withColumn("ingest_date", F.lit("2024-01-01"))
    changed = everyone.where(F.col("risk_segment") != "low").withColumn("ingest_date", F.lit("2024-01-10"))
    both = first.unionByName(changed).withColumn("updated_at", F.col("ingest_date").cast("timestamp"))
    return _lines(both, CONTRACTS["customers"].names)


def _merchant_lines(spark, sf):
    return _lines(
        src.known_merchants(spark, sf).withColumn("ingest_date", F.lit("2024-01-01")), CONTRACTS["merchants"].names)


def _child_lines(spark, sf, entity, prefix, of_type, from_k, days):
    rows = src.events(spark, sf).where((F.col("event_type") == of_type) & (F.col("k") >= from_k))
    when = F.col("ts") + F.expr(f"INTERVAL {days} DAY")
    reason = F.when(F.col("k") < 85, "fraud").when(F.col("k") < 90, "duplicate").otherwise("other")
    rows = rows.select(
        src._tag(prefix, "event_id").alias(f"{entity}_id"),
        src._tag("E", "event_id").alias("payment_id"),
        F.when(F.col("k") == 88, F.col("value") * 2 + 1).otherwise(F.col("value")).alias("amount"),
        reason.alias("reason"),
        when.alias(f"{entity}_date"),
        when.alias("updated_at"),
        F.to_date(when).alias("ingest_date"),
    )
    return _lines(rows, CONTRACTS[f"{entity}s"].names)


def land_all(spark: SparkSession, sf: str) -> Lake:
    """All five feeds as JSON lines, one folder per feed and day."""
    root = scratch_path(spark, "lake")
    lake = Lake(root=f"{root}/lake", landing=f"{root}/landing")
    feeds = {
        "customers": _customer_lines(spark, sf),
        "merchants": _merchant_lines(spark, sf),
        "payments": _payment_lines(spark, sf),
        "refunds": _child_lines(spark, sf, "refund", "R", "purchase", 50, 3),
        "chargebacks": _child_lines(spark, sf, "chargeback", "B", "click", 80, 5),
    }

    def land(entity: str, lines: DataFrame):
        return lambda: lines.hint("rebalance", "ingest_date").write.partitionBy("ingest_date").text(f"{lake.landing}/{entity}")

    at_once(spark, *[land(entity, lines) for entity, lines in feeds.items()])
    return lake


# ----------------------------------------------------------- shared, read-only lakes
_LAKES: dict[tuple, Lake] = {}


def _shared(spark: SparkSession, sf: str, stage: str, build) -> Lake:
    key = (spark.sparkContext.applicationId, sf, stage)
    if key not in _LAKES:
        _LAKES[key] = build(spark, sf)
    return _LAKES[key]


def landed(spark, sf) -> Lake:
    return _shared(spark, sf, "landing", land_all)


def feed_checks() -> list:
    """The made-up refunds are drawn apart from the payments, so a day's refunds can exceed what it took in."""
    return [check for check in mart_checks() if check.test != "rates_between_0_and_1"]


def build_lake(spark: SparkSession, sf: str, lake: Lake | None = None, before: str = "9999-12-31") -> Lake:
    """Landing to gold, all days earlier than ``before`` in one batch per feed and layer."""
    lake = lake or land_all(spark, sf)
    def score(paid) -> None:
        silver_to_features(spark, lake, features_after(p.partition("=")[2] for p in paid.partitions))
        refresh_fct_payments(spark, lake)

    def due(entity: str = "payments") -> list:
        return [day for day in landed_days(spark, lake.landing, entity) if str(day) < before]

    results = refresh_silver(spark, lake, due, after_payments=score)
    quality = quality_of(r for name, r in results.items() if name.startswith("silver."))
    publish(spark, lake, "R1", due(), "incremental", quality, checks=feed_checks())
    return lake


def built(spark, sf) -> Lake:
    return _shared(spark, sf, "gold", build_lake)


def _feed(spark, sf, entity="payments") -> DataFrame:
    lake = landed(spark, sf)
    return read_feed(spark, lake.landing, CONTRACTS[entity], landed_days(spark, lake.landing, entity))


# -------------------------------------------------------------------- landing, bronze
@query("json_lines_scan", sql("landed_lines", body=f"""
    SELECT CASE WHEN NOT cut_off THEN payment_id END AS payment_id, CASE WHEN NOT cut_off THEN amount END AS amount,
           CASE WHEN NOT cut_off THEN currency END AS currency, cut_off, {day("ingest_date")} AS ingest_date,
           COUNT(*) AS n FROM landed_lines GROUP BY ALL"""))
def json_lines_scan(spark, sf):
    return _feed(spark, sf).groupBy(
        "payment_id", "amount", "currency", F.col("_corrupt_record").isNotNull().alias("cut_off"), "ingest_date",
    ).agg(F.count(F.lit(1)).alias("n"))


@query("file_lineage", sql("landing_counts", body="SELECT * FROM landing_counts"))
def file_lineage(spark, sf):
    """Feed and day taken from the file name on each row."""
    origin = F.regexp_extract("_source_file", r"([^/]+)/ingest_date=", 1)
    day_of = F.regexp_extract("_source_file", r"ingest_date=([0-9-]+)", 1)
    result = None
    for entity in ENTITIES:
        counted = _feed(spark, sf, entity).groupBy(origin.alias("entity"), day_of.alias("ingest_date")).agg(
            F.count(F.lit(1)).alias("rows"))
        result = counted if result is None else result.unionByName(counted)
    return result


@query("ingest_counts", sql("landed_lines", body=f"""
    SELECT {day("ingest_date")} AS ingest_date, COUNT(*) AS rows_read,
           CAST(SUM(CASE WHEN cut_off THEN 1 ELSE 0 END) AS BIGINT) AS corrupt_lines,
           CAST(MAX(CASE WHEN NOT cut_off AND (currency IS NOT NULL OR channel IS NOT NULL) THEN 2 ELSE 1 END) AS BIGINT)
               AS contract_version FROM landed_lines GROUP BY 1"""))
def ingest_counts_query(spark, sf):
    return ingest_counts(_feed(spark, sf), PAYMENTS)


@query("schema_drift", sql("landed_lines", body=f"""
    SELECT ingest_date, 'unknown_columns' AS kind, concat_ws(',', MAX(campaign), MAX(promo)) AS columns FROM (
        SELECT {day("ingest_date")} AS ingest_date,
               CASE WHEN event_type = 'view' AND k > 95 AND NOT cut_off THEN 'campaign' END AS campaign,
               CASE WHEN event_type = 'purchase' AND NOT cut_off THEN 'promo_code' END AS promo FROM landed_lines)
    GROUP BY 1 HAVING MAX(campaign) IS NOT NULL OR MAX(promo) IS NOT NULL"""))
def schema_drift(spark, sf):
    return drift(_feed(spark, sf), PAYMENTS)


@query("landed_partitions", sql("landed_lines", body=f"""
    SELECT DISTINCT {day("ingest_date")} AS ingest_date FROM landed_lines"""))
def landed_partitions(spark, sf):
    days = [(d,) for d in landed_days(spark, landed(spark, sf).landing)]
    return spark.createDataFrame(days, "ingest_date date")


@query("landing_completeness", sql("landing_counts", body="""
    SELECT w.entity, d.ingest_date, c.rows IS NOT NULL AS present, c.rows
    FROM (VALUES ('customers'), ('merchants'), ('payments'), ('refunds'), ('chargebacks')) AS w(entity)
    JOIN (SELECT DISTINCT ingest_date FROM landing_counts WHERE entity = 'payments') d ON TRUE
    LEFT JOIN landing_counts c ON c.entity = w.entity AND c.ingest_date = d.ingest_date"""))
def landing_completeness_query(spark, sf):
    lake = landed(spark, sf)
    return landing_completeness(spark, lake.landing, landed_days(spark, lake.landing))


@query("malformed_json_split", sql("landed_lines", body=f"""
    SELECT {day("ingest_date")} AS ingest_date, COUNT(*) AS n FROM landed_lines WHERE cut_off GROUP BY 1"""))
def malformed_json_split(spark, sf):
    return malformed(_feed(spark, sf)).groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n"))


_QUARANTINE_ROWS = f"""
        SELECT reasons, {day("ingest_date")} AS ingest_date FROM landed_validated WHERE reasons <> ''
        UNION ALL SELECT 'record:malformed_json', {day("ingest_date")} FROM landed_lines WHERE cut_off"""
_QUARANTINE_SQL = f"""
    SELECT reasons, ingest_date, COUNT(*) AS n FROM ({_QUARANTINE_ROWS})
    GROUP BY 1, 2"""


@query("quarantine_union", sql("landed_validated", "landed_lines", body=_QUARANTINE_SQL))
def quarantine_union(spark, sf):
    feed = _feed(spark, sf)
    readable = feed.where(F.col("_corrupt_record").isNull())
    checked = validate(readable, PAYMENTS, merchants=src.known_merchants(spark, sf))
    return quarantine(checked, feed).groupBy(F.array_join("_reasons", ",").alias("reasons"), "ingest_date").agg(
        F.count(F.lit(1)).alias("n"))


@query("quarantine_table", sql("landed_validated", "landed_lines", body=_QUARANTINE_SQL))
def quarantine_table(spark, sf):
    table = read_table(spark, built(spark, sf).path("quarantine", "payments"), QUARANTINE_SCHEMA)
    return table.groupBy(F.array_join("_reasons", ",").alias("reasons"), "ingest_date").agg(
        F.count(F.lit(1)).alias("n"))


@query("single_partition_read", sql("landed_lines", body=f"""
    SELECT CASE WHEN NOT cut_off THEN payment_id END AS payment_id, {day("ingest_date")} AS ingest_date
    FROM landed_lines WHERE ingest_date = DATE '2024-01-12'"""))
def single_partition_read(spark, sf):
    bronze = on_days(built(spark, sf).bronze(spark, "payments"), ["2024-01-12"], "ingest_date")
    return bronze.select("payment_id", "ingest_date")


# ----------------------------------------------------------------------------- silver
_SILVER = ["payment_id", "customer_id", "merchant_id", "amount", "payment_method", "transaction_date", "status",
           "updated_at", "currency", "channel", "dt"]
_SILVER_SQL = f"""
    SELECT payment_id, customer_id, merchant_id, amount, payment_method,
           {moment("transaction_date")} AS transaction_date, status, {moment("updated_at")} AS updated_at, currency,
           channel, {day("dt")} AS dt FROM landed_payments"""


@query("silver_payments", sql("landed_payments", body=_SILVER_SQL))
def silver_payments(spark, sf):
    return built(spark, sf).silver(spark, "payments").select(*_SILVER)


@query("silver_customers", sql("landed_customers", body=f"""
    SELECT customer_id, document_type, document_number, city, {moment("created_at")} AS created_at, risk_segment,
           {moment("updated_at")} AS updated_at FROM landed_customers"""))
def silver_customers(spark, sf):
    return built(spark, sf).silver(spark, "customers").select(*CONTRACTS["customers"].names)


@query("silver_refunds", sql("landed_refunds", body=f"""
    SELECT refund_id, payment_id, amount, {moment("refund_date")} AS refund_date, {day("dt")} AS dt, payment_found
    FROM landed_refunds"""))
def silver_refunds(spark, sf):
    return built(spark, sf).silver(spark, "refunds").select(
        "refund_id", "payment_id", "amount", "refund_date", "dt", "payment_found")


@query("silver_chargebacks", sql("landed_chargebacks", body=f"""
    SELECT chargeback_id, payment_id, reason, amount, {moment("chargeback_date")} AS chargeback_date,
           {day("dt")} AS dt, payment_found FROM landed_chargebacks"""))
def silver_chargebacks(spark, sf):
    return built(spark, sf).silver(spark, "chargebacks").select(
        "chargeback_id", "payment_id", "reason", "amount", "chargeback_date", "dt", "payment_found")


@query("pruned_fact_read", sql("landed_payments", body=f"""
    SELECT {day("dt")} AS dt, status, COUNT(*) AS n FROM landed_payments
    WHERE dt BETWEEN DATE '2024-01-10' AND DATE '2024-01-17' AND status = 'approved' GROUP BY 1, 2"""))
def pruned_fact_read(spark, sf):
    rows = built(spark, sf).silver(spark, "payments")
    days = F.col("dt").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-17").cast("date"))
    return rows.where(days & (F.col("status") == "approved")).groupBy("dt", "status").agg(
        F.count(F.lit(1)).alias("n"))


@query("merge_schema_read", sql("landed_lines", body=f"""
    SELECT {day("ingest_date")} AS ingest_date, COUNT(*) AS rows,
           COUNT(CASE WHEN NOT cut_off THEN currency END) AS with_currency FROM landed_lines GROUP BY 1"""))
def merge_schema_read(spark, sf):
    """Files of both contract versions read by column name."""
    return built(spark, sf).bronze(spark, "payments").groupBy("ingest_date").agg(
        F.count(F.lit(1)).alias("rows"), F.count("currency").alias("with_currency"))


@query("volume_counts", sql("landed_lines", "landed_validated", "landed_payments", body="""
    SELECT (SELECT COUNT(*) FROM landed_lines) AS rows_read,
           (SELECT COUNT(*) FROM landed_validated WHERE reasons = '') - (SELECT COUNT(*) FROM landed_payments)
               AS duplicates_removed,
           (SELECT COUNT(*) FROM landed_payments) AS rows_written,
           (SELECT COUNT(*) FROM landed_validated WHERE reasons <> '')
               + (SELECT COUNT(*) FROM landed_lines WHERE cut_off) AS rows_quarantined,
           (SELECT COUNT(*) FROM landed_payments WHERE dt < ingest_date) AS late_rows"""))
def volume_counts(spark, sf):
    """The figures a job reports, from its own run."""
    lake = land_all(spark, sf)
    for entity in ("merchants", "payments"):
        days = landed_days(spark, lake.landing, entity)
        land_to_bronze(spark, lake, entity, days)
        result = bronze_to_silver(spark, lake, entity, days)
    figures = (result.rows_read, result.details["duplicates_removed"], result.rows_written,
               result.rows_quarantined, result.details["late_rows"])
    return spark.createDataFrame(
        [figures],
        "rows_read bigint, duplicates_removed bigint, rows_written bigint, rows_quarantined bigint, late_rows bigint")


@query("idempotent_reprocess", sql("landed_payments", body=_SILVER_SQL))
def idempotent_reprocess(spark, sf):
    """Days in pieces, out of order and some of them again: the same table."""
    lake = land_all(spark, sf)
    for entity in ("merchants", "payments"):
        days = landed_days(spark, lake.landing, entity)
        land_to_bronze(spark, lake, entity, days)
        half = len(days) // 2
        pieces = [days[half:], days[:half], days[half - 1: half + 3]] if half else [days]
        for piece in pieces:
            bronze_to_silver(spark, lake, entity, piece)
    return lake.silver(spark, "payments").select(*_SILVER)


@query("stream_upsert_equals_batch", sql("landed_payments", body=_SILVER_SQL))
def stream_upsert_equals_batch(spark, sf):
    """The payments feed as a stream of files, merged in several micro-batches."""
    lake = land_all(spark, sf)
    for entity, per_batch in (("merchants", None), ("payments", 20)):
        checkpoint = scratch_path(spark, f"stream-{entity}")
        merge_stream(spark, lake, entity, checkpoint, files_per_batch=per_batch).awaitTermination()
    return lake.silver(spark, "payments").select(*_SILVER)


# --------------------------------------------------------------------- features, gold
@query("silver_payment_features", sql("landed_features", body=f"""
    SELECT payment_id, category, risk_segment, txn_count_7d, ROUND(amount_7d, 2) AS amount_7d,
           ROUND(amount_7d, 2) / txn_count_7d AS avg_amount_7d, seconds_since_prev, high_velocity, amount_spike,
           {day("dt")} AS dt FROM landed_features"""))
def silver_payment_features(spark, sf):
    return _comparable(features(spark, built(spark, sf))).drop(
        "customer_id", "merchant_id", "amount", "transaction_date")


@query("landing_to_gold", sql("landed_kpis", body=f"SELECT * REPLACE ({day('fecha')} AS fecha) FROM landed_kpis"))
def landing_to_gold(spark, sf):
    """Files to daily financial indicators through every layer."""
    return comparable_kpis(read_gold(spark, built(spark, sf), "indicadores_financieros"))


@query("gold_export", sql("landed_fact", body=f"""
    SELECT payment_id AS id_pago, customer_id AS id_cliente, merchant_id AS id_comercio,
           merchant_category AS categoria_comercio, payment_method AS medio_pago, channel AS canal, status AS estado,
           currency AS moneda, amount AS monto, amount_cop AS monto_cop,
           {moment("transaction_date")} AS fecha_transaccion, {day("transaction_day")} AS fecha,
           flag_high_velocity AS alerta_velocidad, flag_amount_spike AS alerta_monto FROM landed_fact"""))
def gold_export(spark, sf):
    return read_gold(spark, built(spark, sf), "pagos_gold")


@query("incremental_gold_refresh", sql("landed_fact", body=f"""
    SELECT payment_id, status, amount_cop, {day("transaction_day")} AS transaction_day, flag_high_velocity,
           flag_amount_spike FROM landed_fact"""))
def incremental_gold_refresh(spark, sf):
    """The first half of the days, then the rest as an incremental run: the fact of a full refresh."""
    lake = land_all(spark, sf)

    def score(paid) -> None:
        scored = features_after(p.partition("=")[2] for p in paid.partitions)
        silver_to_features(spark, lake, scored)
        refresh_fct_payments(spark, lake, scored)

    for second in (False, True):
        def days_of(entity, second=second):
            return [d for d in landed_days(spark, lake.landing, entity) if (str(d) >= V2_FROM) == second]

        due = [entity for entity in ENTITIES if days_of(entity)]
        refresh_silver(spark, lake, days_of, due, after_payments=score)
    return read_table(spark, lake.path("marts", "fct_payments"), FCT_PAYMENTS_SCHEMA).select(
        "payment_id", "status", "amount_cop", "transaction_day", "flag_high_velocity", "flag_amount_spike")


def _incremental_lake(spark, sf) -> Lake:
    """The first half of the days, then the rest: only the days that a run touches are recomputed in any dataset."""
    lake = land_all(spark, sf)
    for second in (False, True):
        def days_of(entity, second=second):
            return [d for d in landed_days(spark, lake.landing, entity) if (str(d) >= V2_FROM) == second]

        scored: list = []

        def score(paid, scored=scored) -> None:
            scored += features_after(p.partition("=")[2] for p in paid.partitions)
            silver_to_features(spark, lake, scored)
            refresh_fct_payments(spark, lake, scored)

        due = [entity for entity in ENTITIES if days_of(entity)]
        results = refresh_silver(spark, lake, days_of, due, after_payments=score)
        publish(spark, lake, f"R{second}", days_of("payments"), "incremental", changed=changes_of(results, scored), checks=feed_checks())
    return lake


@query("incremental_kpis", sql("landed_kpis", body=f"SELECT * REPLACE ({day('fecha')} AS fecha) FROM landed_kpis"))
def incremental_kpis(spark, sf):
    return comparable_kpis(read_gold(spark, _shared(spark, sf, "incremental", _incremental_lake), "indicadores_financieros"))


@query("incremental_chargebacks_gold", sql("landed_chargebacks", "landed_payments", body=f"""
    SELECT chargeback_id AS id_contracargo, c.payment_id AS id_pago, merchant_id AS id_comercio, customer_id AS id_cliente,
           reason AS motivo, c.amount AS monto, {day("c.dt")} AS fecha, {day("p.dt")} AS fecha_pago,
           CAST(c.dt - p.dt AS BIGINT) AS dias_hasta_contracargo
    FROM landed_chargebacks c LEFT JOIN landed_payments p ON p.payment_id = c.payment_id"""))
def incremental_chargebacks_gold(spark, sf):
    return read_gold(spark, _shared(spark, sf, "incremental", _incremental_lake), "contracargos_gold")


MOVED_ON, MOVED_TO = "2024-03-20", "2024-03-18"


@query("moved_key_beyond_window", sql("landed_payments", body=f"""
    SELECT payment_id, CASE WHEN CAST(substr(payment_id, 2) AS BIGINT) % 17 = 7 THEN '{MOVED_TO}' ELSE {day("dt")} END AS dt
    FROM landed_payments"""))
def moved_key_beyond_window(spark, sf):
    """Payments whose date is corrected weeks later: they leave days far outside the window of late rows."""
    lake = land_all(spark, sf)
    for entity in ("merchants", "payments"):
        days = landed_days(spark, lake.landing, entity)
        land_to_bronze(spark, lake, entity, days)
        bronze_to_silver(spark, lake, entity, days)
    moved = lake.silver(spark, "payments").where(F.substring("payment_id", 2, 99).cast("long") % 17 == 7)
    when = F.lit(f"{MOVED_TO} 10:00:00").cast("timestamp")
    moved = moved.withColumns({"transaction_date": when, "updated_at": F.lit(f"{MOVED_ON} 01:00:00").cast("timestamp"),
                               "ingest_date": F.lit(MOVED_ON)})
    lines = _lines(moved.select(*CONTRACTS["payments"].names, "ingest_date"), CONTRACTS["payments"].names)
    lines.write.mode("append").partitionBy("ingest_date").text(f"{lake.landing}/payments")
    land_to_bronze(spark, lake, "payments", [MOVED_ON])
    bronze_to_silver(spark, lake, "payments", [MOVED_ON])
    return lake.silver(spark, "payments").select("payment_id", "dt")


LATE_BY = 2


@query("late_parent", sql("landed_refunds", "landed_payments", "landed_lines", body=f"""
    SELECT refund_id, r.payment_id, r.amount, p.payment_id IS NOT NULL AS payment_found, {day("p.dt")} AS payment_day
    FROM landed_refunds r LEFT JOIN landed_payments p ON p.payment_id = r.payment_id"""))
def late_parent(spark, sf):
    """All refunds come in first, their payments afterwards: silver, quarantine and fact as if in order."""
    lake = land_all(spark, sf)
    for entity in ("merchants", "refunds"):
        days = landed_days(spark, lake.landing, entity)
        land_to_bronze(spark, lake, entity, days)
        bronze_to_silver(spark, lake, entity, days)
    refresh_facts(spark, lake)
    results = refresh_silver(spark, lake, lambda entity: landed_days(spark, lake.landing, entity), ("payments",))
    refresh_facts(spark, lake, changes_of(results, []))
    fact = stored_fact(spark, lake, "refunds")
    found = lake.silver(spark, "refunds").select("refund_id", "payment_found")
    return fact.drop("payment_found").join(found, "refund_id").select("refund_id", "payment_id", "amount", "payment_found", "payment_day")


@query("publication_manifest", sql("landed_fact", "landed_chargebacks", "customers", "landed_kpis", body="""
    SELECT 'R1' AS run_id, 'incremental' AS kind, (SELECT COUNT(*) FROM customers) AS clientes_gold,
           (SELECT COUNT(*) FROM landed_fact) AS pagos_gold,
           (SELECT COUNT(*) FROM landed_chargebacks) AS contracargos_gold,
           (SELECT COUNT(*) FROM landed_kpis) AS indicadores_financieros"""))
def publication_manifest(spark, sf):
    manifest = spark.read.schema(
        "run_id string, kind string, datasets map<string,bigint>"
    ).json(channel(built(spark, sf)).path)
    return manifest.select("run_id", "kind", *[F.col("datasets")[n].alias(n) for n in gold.GOLD_DATASETS])


# ------------------------------------------------------------------------------ runs
V1_UNTIL = "2024-01-14"
AGAIN = ("2024-01-10", "2024-01-12")


def _run_lake(spark, sf) -> Lake:
    """Runs that choose their days: what landed by a day, the rest, nothing more, and some days again."""
    lake = land_all(spark, sf)
    options = {"checks": feed_checks(), "every_feed": False}
    runs.run_incremental(spark, lake, until=V1_UNTIL, **options)
    runs.run_incremental(spark, lake, **options)
    runs.run_incremental(spark, lake, **options)
    runs.backfill(spark, lake, *AGAIN, **options)
    return lake


_RUN_DAYS = f"""
    SELECT *, CASE WHEN ingest_date <= '{V1_UNTIL}' THEN 1 ELSE 2 END AS run FROM landing_counts
    UNION ALL SELECT *, 3 FROM landing_counts WHERE ingest_date BETWEEN '{AGAIN[0]}' AND '{AGAIN[1]}'"""


def _numbered_runs(spark, lake) -> DataFrame:
    """The runs in the order they began; a run takes seconds, so no two begin at once."""
    order = Window.orderBy("started_at")
    return runs.runs(spark, lake).withColumn("run", F.row_number().over(order).cast("long"))


@query("incremental_run_watermark", sql("landing_counts", body=f"""
    SELECT CAST(run AS BIGINT) AS run, CASE WHEN run = 3 THEN 'backfill' ELSE 'incremental' END AS kind, 'success' AS status,
           COUNT(DISTINCT ingest_date) AS days, MIN(ingest_date) AS first_day, MAX(ingest_date) AS last_day,
           CASE WHEN run < 3 THEN MAX(ingest_date) END AS moved_to FROM ({_RUN_DAYS}) GROUP BY run"""))
def incremental_run_watermark(spark, sf):
    """Which days each run took, and where it moved the watermark; a backfill does not move it."""
    lake = _shared(spark, sf, "runs", _run_lake)
    days = F.from_json("dates", "array<string>")
    moved = runs.watermark_log(spark, lake).select("run_id", F.col("value").alias("moved_to"))
    return _numbered_runs(spark, lake).join(moved, "run_id", "left").select(
        "run", "kind", "status", F.size(days).cast("long").alias("days"), F.array_min(days).alias("first_day"),
        F.array_max(days).alias("last_day"), "moved_to")


@query("run_log_of_a_run", sql("landing_counts", "landed_validated", "landed_lines", body=f"""
    SELECT CAST(r.run AS BIGINT) AS run, r.ingest_date, r.rows AS landed, r.rows AS read_by_silver,
           CAST(COALESCE(q.n, 0) AS BIGINT) AS quarantined, CAST(COALESCE(c.n, 0) AS BIGINT) AS corrupt_lines, w.n AS written_in_run
    FROM ({_RUN_DAYS}) r
    LEFT JOIN (SELECT ingest_date, COUNT(*) AS n FROM ({_QUARANTINE_ROWS}) GROUP BY 1) q ON q.ingest_date = r.ingest_date
    LEFT JOIN (SELECT {day("ingest_date")} AS ingest_date, COUNT(*) AS n FROM landed_lines WHERE cut_off GROUP BY 1) c
        ON c.ingest_date = r.ingest_date
    JOIN (SELECT d.run, COUNT(DISTINCT v.payment_id) AS n FROM landed_validated v
          JOIN ({_RUN_DAYS}) d ON d.entity = 'payments' AND d.ingest_date = {day("v.ingest_date")}
          WHERE v.reasons = '' GROUP BY 1) w ON w.run = r.run
    WHERE r.entity = 'payments'"""))
def run_log_of_a_run(spark, sf):
    """The figures that the payments' tasks of each run left in the log, by day."""
    lake = _shared(spark, sf, "runs", _run_lake)
    log = with_details(runs.task_runs(spark, lake)).where("status = 'success'")
    bronze = log.where("task = 'bronze.payments'").select(
        "run_id", "ingest_date", F.col("rows_read").alias("landed"), F.col("_d.corrupt_lines").alias("corrupt_lines"))
    silver = log.where("task = 'silver.payments'").select(
        "run_id", "ingest_date", F.col("rows_read").alias("read_by_silver"), F.col("rows_quarantined").alias("quarantined"),
        F.sum("rows_written").over(Window.partitionBy("run_id")).alias("written_in_run"))
    # A run logs every day it has; the payments feed has no file on some of them.
    return bronze.join(silver, ["run_id", "ingest_date"]).where("landed > 0").join(
        _numbered_runs(spark, lake).select("run_id", "run"), "run_id").drop("run_id")


AS_OF = "2024-01-15"


@query("publication_as_of", sql("landed_fact", "landed_chargebacks", "customers", "landed_kpis", body=f"""
    SELECT 'as_of' AS kind, (SELECT COUNT(*) FROM customers) AS clientes_gold,
           (SELECT COUNT(*) FROM landed_fact WHERE transaction_day <= DATE '{AS_OF}') AS pagos_gold,
           (SELECT COUNT(*) FROM landed_chargebacks WHERE dt <= DATE '{AS_OF}') AS contracargos_gold,
           (SELECT COUNT(*) FROM landed_kpis WHERE fecha <= DATE '{AS_OF}') AS indicadores_financieros,
           (SELECT CAST(SUM(pagos) AS BIGINT) FROM landed_kpis WHERE fecha <= DATE '{AS_OF}') AS pagos"""))
def publication_as_of(spark, sf):
    """The publication of an earlier day: the rows counted are read through its own record."""
    lake = built(spark, sf)
    record = publish_as_of(spark, lake, AS_OF, "earlier")
    counts = gold.row_counts({name: read_gold(spark, lake, name, "earlier") for name in gold.GOLD_DATASETS})
    totals = counts.groupBy().pivot("dataset", list(gold.GOLD_DATASETS)).agg(F.sum("rows"))
    paid = read_gold(spark, lake, "indicadores_financieros", "earlier").agg(F.sum("pagos").alias("pagos"))
    return totals.join(paid).withColumn("kind", F.lit(record["kind"]))


@query("check_published_columns", sql("landed_fact", "landed_chargebacks", "customers", "landed_kpis",
                                      body="\nUNION ALL ".join(
    f"SELECT '{dataset}' AS dataset, '{column}' AS column_name, COUNT({source}) AS filled FROM {part}"
    for dataset, part, names in (
        ("pagos_gold", "landed_fact", dict((p, s) for s, p in gold.PAGOS)),
        ("clientes_gold", "customers", dict((p, s) for s, p in gold.CLIENTES)),
        ("contracargos_gold", "landed_chargebacks", {
            "id_contracargo": "chargeback_id", "id_pago": "payment_id", "motivo": "reason", "monto": "amount",
            "dias_hasta_contracargo": "CASE WHEN payment_id IN (SELECT payment_id FROM landed_payments) THEN 1 END"}),
        ("indicadores_financieros", "landed_kpis", {}),
    )
    for column in gold.REQUIRED_COLUMNS[dataset]
    for source in [names.get(column, column)]
)))
def check_published_columns(spark, sf):
    """Columns a reader counts on: that they are there, and in how many rows they are filled."""
    lake = built(spark, sf)
    datasets = {name: read_gold(spark, lake, name) for name in gold.GOLD_DATASETS}
    result = None
    for name, missing in gold.missing_columns(datasets).items():
        if missing:
            raise ValueError(f"{name} lacks {missing}")
        columns = gold.REQUIRED_COLUMNS[name]
        filled = datasets[name].agg(*[F.count(c).alias(c) for c in columns])
        lines = filled.select(F.lit(name).alias("dataset"), F.inline(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in columns])))
        result = lines if result is None else result.unionByName(lines)
    return result
