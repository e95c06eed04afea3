"""Every operator over the given tables, each beside the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylode.contracts import CHARGEBACKS, LATE_DATA_DAYS, PAYMENTS, REFUNDS
from paylode.functions.rules import MALFORMED
from paylode.functions.records import fingerprint
from paylode.operators import audit, checks, features, incremental, upsert, validate
from paylode.plans import gold, marts
from paylode.session import clustered, staged
from testbed import adapters as src
from testbed.oracle import count_if, day, latest, moment, sql
from testbed.registry import query

ALWAYS = ("1900-01-01", "2100-01-01")


def _money(name: str):
    return F.round(F.col(name), 2).alias(name)


# ============================================================== contract rules
def _aligned(spark, sf):
    return validate.align(src.payment_feed(spark, sf), PAYMENTS)


def _reasoned(spark, sf):
    return validate.with_reasons(_aligned(spark, sf), PAYMENTS)


def _validated(spark, sf):
    return validate.validate(src.payment_feed(spark, sf), PAYMENTS, merchants=src.known_merchants(spark, sf))


@query("align_to_contract", sql("dated", body=f"""
    SELECT payment_id, customer_id, merchant_id, amount, payment_method, {moment("transaction_date")} AS transaction_date,
           status, {moment("updated_at")} AS updated_at, currency, channel, raw_amount, raw_date, raw_currency,
           {day("dt")} AS dt, {day("ingest_date")} AS _ingest_date FROM dated"""))
def align_to_contract(spark, sf):
    return _aligned(spark, sf).select(
        *PAYMENTS.names, F.col("_raw.amount").alias("raw_amount"), F.col("_raw.transaction_date").alias("raw_date"),
        F.col("_raw.currency").alias("raw_currency"), "dt", "_ingest_date",
    )


@query("tolerant_cast", sql("typed", body=f"""
    SELECT raw_amount, raw_date, amount, {moment("transaction_date")} AS transaction_date, COUNT(*) AS n
    FROM typed GROUP BY ALL"""))
def tolerant_cast(spark, sf):
    return _aligned(spark, sf).groupBy(
        F.col("_raw.amount").alias("raw_amount"), F.col("_raw.transaction_date").alias("raw_date"), "amount",
        "transaction_date",
    ).agg(F.count(F.lit(1)).alias("n"))


@query("version_defaults", sql("typed", body="""
    SELECT raw_currency, currency, channel, COUNT(*) AS n FROM typed GROUP BY 1, 2, 3"""))
def version_defaults(spark, sf):
    return _aligned(spark, sf).groupBy(F.col("_raw.currency").alias("raw_currency"), "currency", "channel").agg(
        F.count(F.lit(1)).alias("n"))


@query("event_date", sql("dated", body=f"""
    SELECT {day("dt")} AS dt, {day("ingest_date")} AS ingest_date, COUNT(*) AS n FROM dated GROUP BY 1, 2"""))
def event_date(spark, sf):
    return _aligned(spark, sf).groupBy("dt", F.col("_ingest_date").alias("ingest_date")).agg(
        F.count(F.lit(1)).alias("n"))


@query("raw_record_json", sql("validated", body="""
    SELECT payment_id, '{"payment_id":"' || payment_id || '"'
        || COALESCE(',"customer_id":"' || customer_id || '"', '') || ',"merchant_id":"' || merchant_id || '"'
        || ',"amount":"' || raw_amount || '","payment_method":"' || payment_method || '"'
        || ',"transaction_date":"' || raw_date || '","status":"' || status || '"'
        || ',"updated_at":"' || strftime(updated_at, '%Y-%m-%dT%H:%M:%S.%f') || '"'
        || COALESCE(',"currency":"' || raw_currency || '"', '') || COALESCE(',"channel":"' || channel || '"', '')
        || '}' AS raw, reasons FROM validated WHERE reasons <> ''"""))
def raw_record_json(spark, sf):
    return validate.rejected(_validated(spark, sf)).select(
        F.get_json_object("_raw", "$.payment_id").alias("payment_id"), F.col("_raw").alias("raw"),
        F.col("_reasons").alias("reasons"))


@query("validate_reasons", sql("validated", body="SELECT payment_id, reasons FROM validated"))
def validate_reasons(spark, sf):
    return _validated(spark, sf).select("payment_id", F.col("_reasons").alias("reasons"))


@query("reason_histogram", sql("validated", body="""
    SELECT reason, COUNT(*) AS rows FROM (SELECT UNNEST(string_split(reasons, ',')) AS reason FROM validated
    WHERE reasons <> '') GROUP BY reason"""))
def reason_histogram(spark, sf):
    return validate.reason_histogram(_validated(spark, sf))


for _rule, _sql in {
    "rule_missing": "trim(COALESCE(customer_id, '')) = ''",
    "rule_invalid_type": "amount IS NULL OR transaction_date IS NULL",
    "rule_not_allowed": "payment_method NOT IN ('card', 'pse', 'wallet', 'transfer') OR currency NOT IN ('COP', 'USD')",
    "rule_below_min": "amount < 0.01",
}.items():
    @query(_rule, sql("typed", body=f"SELECT payment_id FROM typed WHERE {_sql}"))
    def single_rule(spark, sf, suffix=":" + _rule.removeprefix("rule_")):
        return _reasoned(spark, sf).where(F.exists("_reasons", lambda r: r.endswith(suffix))).select("payment_id")


@query("valid_invalid_split", sql("validated", body="""
    SELECT CASE WHEN reasons = '' THEN 'valid' ELSE 'invalid' END AS side, COUNT(*) AS n FROM validated GROUP BY 1"""))
def valid_invalid_split(spark, sf):
    rows = _validated(spark, sf)
    valid = validate.accepted(rows, PAYMENTS).agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit("valid"))
    invalid = validate.rejected(rows).agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit("invalid"))
    return valid.unionByName(invalid)


@query("unknown_merchant", sql("reasoned", body="""
    SELECT payment_id, merchant_id FROM reasoned WHERE merchant_reason IS NOT NULL"""))
def unknown_merchant(spark, sf):
    rows = validate.check_merchant(_reasoned(spark, sf), src.known_merchants(spark, sf))
    return rows.where(F.array_contains("_reasons", "merchant_id:unknown")).select("payment_id", "merchant_id")


@query("late_out_of_window", sql("reasoned", body=f"""
    SELECT payment_id, {day("dt")} AS dt, {day("ingest_date")} AS ingest_date FROM reasoned
    WHERE late_reason IS NOT NULL"""))
def late_out_of_window(spark, sf):
    rows = validate.check_late(_reasoned(spark, sf))
    return rows.where(F.array_contains("_reasons", "late:out_of_window")).select(
        "payment_id", "dt", F.col("_ingest_date").alias("ingest_date"))


@query("late_payment_versions", sql("payment_versions", body=f"""
    SELECT {day("dt")} AS dt, COUNT(*) AS n FROM payment_versions WHERE dt < ingest_day - 7 GROUP BY 1"""))
def late_payment_versions(spark, sf):
    rows = src.payment_versions(spark, sf).withColumn("_reasons", F.array().cast("array<string>"))
    late = validate.check_late(rows).where(F.size("_reasons") > 0)
    return late.groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


def _refunds_checked(spark, sf, payments=None):
    payments = src.payments(spark, sf) if payments is None else payments
    return validate.check_parent(src.refund_versions(spark, sf), payments, REFUNDS.parent_days)


def _chargebacks_checked(spark, sf, payments=None):
    payments = src.payments(spark, sf) if payments is None else payments
    return validate.check_parent(src.chargeback_versions(spark, sf), payments, CHARGEBACKS.parent_days)


@query("refund_exceeds_payment", sql("refunds_checked", body="""
    SELECT refund_id, payment_id, amount FROM refunds_checked WHERE exceeds"""))
def refund_exceeds_payment(spark, sf):
    rows = _refunds_checked(spark, sf).where(F.array_contains("_reasons", "amount:exceeds_payment"))
    return rows.select("refund_id", "payment_id", "amount")


@query("payment_found_flag", sql("refunds_checked", body="""
    SELECT refund_id, payment_found FROM refunds_checked"""))
def payment_found_flag(spark, sf):
    return _refunds_checked(spark, sf).select("refund_id", "payment_found")


@query("chargeback_parent_check", sql("chargebacks_checked", body="""
    SELECT chargeback_id, payment_found, exceeds FROM chargebacks_checked"""))
def chargeback_parent_check(spark, sf):
    return _chargebacks_checked(spark, sf).select(
        "chargeback_id", "payment_found",
        F.array_contains("_reasons", "amount:exceeds_payment").alias("exceeds"))


@query("reason_union", sql("validated", body="""
    SELECT payment_id, reasons FROM validated WHERE merchant_reason IS NOT NULL OR late_reason IS NOT NULL"""))
def reason_union(spark, sf):
    """Adding a reason twice leaves one."""
    rows = validate.check_late(validate.check_merchant(_validated(spark, sf), src.known_merchants(spark, sf)))
    added = F.arrays_overlap("_reasons", F.array(F.lit("merchant_id:unknown"), F.lit("late:out_of_window")))
    return rows.where(added).select("payment_id", F.col("_reasons").alias("reasons"))


# ============================================================ dedup and upserts
@query("latest_per_key", sql("payments", body=f"""
    SELECT payment_id, customer_id, merchant_id, amount, status, {moment("updated_at")} AS updated_at FROM payments"""))
def latest_per_key(spark, sf):
    return src.payments(spark, sf).select("payment_id", "customer_id", "merchant_id", "amount", "status", "updated_at")


@query("duplicates_removed", sql("payments", "payment_versions", body="""
    SELECT (SELECT COUNT(*) FROM payment_versions) AS versions, (SELECT COUNT(*) FROM payments) AS kept,
           (SELECT COUNT(*) FROM payment_versions) - (SELECT COUNT(*) FROM payments) AS removed"""))
def duplicates_removed(spark, sf):
    """Keys and versions in one pass: the distinct keys are what dedup keeps."""
    return src.payment_versions(spark, sf).groupBy("payment_id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("versions"), F.count(F.lit(1)).alias("kept")
    ).withColumn("removed", F.col("versions") - F.col("kept"))


BATCH = "1999-01-01"


def _in_batch():
    return F.col("_ingest_date") >= BATCH


def _base_and_batch(spark, sf):
    """Versions that came before the day are the table, the others the new batch."""
    versions = src.payment_versions(spark, sf)
    base = upsert.latest_per_key(versions.where(~_in_batch()), ["payment_id"], src.NEWEST)
    return base, versions.where(_in_batch())


_ORDER = "updated_at DESC, l_partkey DESC, l_suppkey DESC"
_BASE = f"base AS ({latest(f'''(SELECT * FROM payment_versions WHERE ingest_day < DATE '{BATCH}')''', 'payment_id', _ORDER, '* EXCLUDE (rank_)')})"
_NEW = f"batch AS (SELECT * FROM payment_versions WHERE ingest_day >= DATE '{BATCH}')"


def _upsert_sql(body: str, more: str = "") -> str:
    return sql("payment_versions", body="@").replace("@", f", {_BASE}, {_NEW} {more}\n{body}")


@query("partition_upsert", _upsert_sql(f"""
    SELECT payment_id, amount, status, {day("dt")} AS dt FROM ({latest("both_", "payment_id", _ORDER)})""",
    """, both_ AS (SELECT * FROM base WHERE dt IN (SELECT dt FROM batch) UNION ALL SELECT * FROM batch)"""))
def partition_upsert(spark, sf):
    base, batch = _base_and_batch(spark, sf)
    touched = [row["dt"] for row in batch.select("dt").distinct().collect()]
    return upsert.partition_upsert(base, batch, ["payment_id"], src.NEWEST, touched).select(
        "payment_id", "amount", "status", "dt")


@query("affected_partitions", _upsert_sql(f"SELECT DISTINCT {day('dt')} AS dt FROM batch"))
def affected_partitions(spark, sf):
    return _base_and_batch(spark, sf)[1].select("dt").distinct()


@query("late_rows", _upsert_sql(f"""
    SELECT {count_if(f"dt < DATE '{BATCH}'")} AS late_rows, COUNT(*) AS rows
    FROM ({latest("batch", "payment_id", _ORDER)})"""))
def late_rows(spark, sf):
    batch = upsert.latest_per_key(_base_and_batch(spark, sf)[1], ["payment_id"], src.NEWEST)
    return batch.agg(
        F.count_if(F.col("dt") < F.lit(BATCH).cast("date")).alias("late_rows"), F.count(F.lit(1)).alias("rows"))


@query("moved_keys", sql("payment_versions", body=f"""
    SELECT DISTINCT {day("a.ingest_day")} AS ingest_day FROM payment_versions a
    JOIN payment_versions b ON a.payment_id = b.payment_id
    WHERE a.ingest_day < DATE '{BATCH}' AND b.ingest_day >= DATE '{BATCH}'"""))
def moved_keys(spark, sf):
    """Days under which a key of the batch is still stored, were the table kept by day of arrival."""
    versions = src.payment_versions(spark, sf).withColumn("ingest_day", F.col("_ingest_date").cast("date"))
    return upsert.partitions_of_moved_keys(
        versions.where(~_in_batch()), versions.where(_in_batch()), ["payment_id"], "ingest_day")


_STATE = """state_rows AS (
    SELECT 'C' || CAST(user_id AS VARCHAR) AS customer_id, event_type, k, ts, event_id FROM numbered)"""


@query("current_state_upsert", sql("numbered", body="@").replace("@", f""", {_STATE}
    SELECT customer_id, event_type, k, {moment("ts")} AS ts
    FROM ({latest("state_rows", "customer_id", "ts DESC, event_id DESC")})"""))
def current_state_upsert(spark, sf):
    """Each customer's newest event, merged from an old state and a later batch."""
    rows = src.events(spark, sf).select(src._tag("C", "user_id").alias("customer_id"), "event_type", "k", "ts", "event_id")
    early = F.col("ts") < F.lit("2024-01-20").cast("timestamp")
    state = upsert.latest_per_key(rows.where(early), ["customer_id"], ["ts", "event_id"])
    return upsert.current_state_upsert(state, rows.where(~early), ["customer_id"], ["ts", "event_id"]).drop("event_id")


@query("schema_evolution_union", sql("payment_versions", body="""
    SELECT COALESCE(CASE WHEN ingest_day >= DATE '1999-01-01' THEN currency END, 'none') AS currency,
           COALESCE(CASE WHEN ingest_day >= DATE '1999-01-01' THEN channel END, 'none') AS channel, COUNT(*) AS n
    FROM payment_versions GROUP BY 1, 2"""))
def schema_evolution_union(spark, sf):
    """Rows written before two columns existed, merged with rows that have them."""
    base = src.payment_versions(spark, sf).where(~_in_batch()).drop("currency", "channel")
    both = base.unionByName(src.payment_versions(spark, sf).where(_in_batch()), allowMissingColumns=True)
    return both.groupBy(
        F.coalesce("currency", F.lit("none")).alias("currency"), F.coalesce("channel", F.lit("none")).alias("channel")
    ).agg(F.count(F.lit(1)).alias("n"))


_TARGET = "1999-06-30"


@query("incremental_high_water", sql("fct_payments", body=f"""
    SELECT {day("MAX(transaction_day) - 7")} AS since FROM fct_payments WHERE transaction_day <= DATE '{_TARGET}'"""))
def incremental_high_water(spark, sf):
    target = _fct_payments(spark, sf).where(F.col("transaction_day") <= F.lit(_TARGET).cast("date"))
    return target.agg(F.date_sub(F.max("transaction_day"), LATE_DATA_DAYS).alias("since"))


@query("incremental_predicate", sql("payments", body=f"""
    SELECT {day("dt")} AS dt, COUNT(*) AS n FROM payments
    WHERE dt >= (SELECT MAX(dt) - 7 FROM payments WHERE dt <= DATE '{_TARGET}') GROUP BY 1"""))
def incremental_predicate(spark, sf):
    rows = src.payments(spark, sf)
    target = rows.where(F.col("dt") <= F.lit(_TARGET).cast("date"))
    return incremental.in_reprocess_window(rows, target, "dt", LATE_DATA_DAYS).groupBy("dt").agg(
        F.count(F.lit(1)).alias("n"))


_INCREMENTAL = f"""
    SELECT payment_id, status, amount_cop, {day("transaction_day")} AS transaction_day FROM (
        SELECT payment_id, 'old' AS status, amount_cop, transaction_day FROM fct_payments
        WHERE transaction_day <= DATE '{_TARGET}' AND payment_id NOT IN (SELECT payment_id FROM fresh)
        UNION ALL SELECT payment_id, status, amount_cop, transaction_day FROM fresh)"""
_FRESH = f"""fresh AS (SELECT * FROM fct_payments WHERE transaction_day >=
    (SELECT MAX(transaction_day) - 7 FROM fct_payments WHERE transaction_day <= DATE '{_TARGET}'))"""


@query("incremental_fact_delete_insert", sql("fct_payments", body="@").replace("@", f", {_FRESH}{_INCREMENTAL}"))
def incremental_fact_delete_insert(spark, sf):
    """The stored fact ends in June 1999; its last week and all later days are recomputed."""
    fact = clustered(_fct_payments(spark, sf), "mart", "payment_id")
    target = fact.where(F.col("transaction_day") <= F.lit(_TARGET).cast("date")).withColumn("status", F.lit("old"))
    fresh = incremental.in_reprocess_window(fact, target, "transaction_day", LATE_DATA_DAYS)
    columns = ["payment_id", "status", "amount_cop", "transaction_day"]
    return upsert.delete_insert(target.select(*columns), fresh.select(*columns), ["payment_id"])


@query("new_partitions_after_watermark", sql("feed", body=f"""
    SELECT DISTINCT {day("ingest_date")} AS ingest_date FROM feed WHERE ingest_date > DATE '2024-01-20'"""))
def new_partitions_after_watermark(spark, sf):
    return incremental.after_watermark(src.payment_feed(spark, sf), "2024-01-20")


@query("backfill_range", sql("feed", body=f"""
    SELECT DISTINCT {day("ingest_date")} AS ingest_date FROM feed
    WHERE ingest_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-11'"""))
def backfill_range(spark, sf):
    return incremental.between_days(src.payment_feed(spark, sf), "2024-01-05", "2024-01-11")


@query("watermark_advance", sql("numbered", body=f"""
    SELECT event_type AS name, {day("MAX(ts)")} AS value FROM numbered GROUP BY event_type"""))
def watermark_advance(spark, sf):
    log = src.events(spark, sf).select(F.col("event_type").alias("name"), F.to_date("ts").cast("string").alias("value"))
    return incremental.advanced_watermark(log)


# ==================================================================== features
def _features(spark, sf, first=ALWAYS[0], last=ALWAYS[1]):
    return features.payment_features(
        src.event_payments(spark, sf), src.merchants(spark, sf), src.customers(spark, sf), first, last)


_FEATURE_SQL = f"""
    SELECT payment_id, customer_id, merchant_id, category, risk_segment, amount,
           {moment("transaction_date")} AS transaction_date, txn_count_7d, ROUND(amount_7d, 2) AS amount_7d,
           ROUND(amount_7d, 2) / txn_count_7d AS avg_amount_7d, seconds_since_prev, high_velocity, amount_spike,
           {day("dt")} AS dt FROM event_features"""


def _comparable(rows: DataFrame) -> DataFrame:
    total = F.round("amount_7d", 2)
    return rows.withColumn("avg_amount_7d", total / F.col("txn_count_7d")).withColumn("amount_7d", total)


@query("payment_features_7d", sql("event_features", body=_FEATURE_SQL))
def payment_features_7d(spark, sf):
    return _comparable(_features(spark, sf))


@query("payment_features_bucketed", sql("event_features", body=_FEATURE_SQL))
def payment_features_bucketed(spark, sf):
    """The same from payments in another order and in other partitions: exact sums do not show it."""
    payments = src.event_payments(spark, sf).repartition(13, "amount")
    return _comparable(features.payment_features(
        payments, src.merchants(spark, sf), src.customers(spark, sf), *ALWAYS))


@query("payment_features_split", sql("event_features", body=_FEATURE_SQL))
def payment_features_split(spark, sf):
    """The same from two spans of days: each reads the seven days before it."""
    middle = ("2024-01-14", "2024-01-15")
    return _comparable(_features(spark, sf, last=middle[0]).unionByName(_features(spark, sf, first=middle[1])))


@query("payment_features_day", sql("event_features", body=_FEATURE_SQL + " WHERE dt = DATE '2024-01-15'"))
def payment_features_day(spark, sf):
    """One day: eight days are read, and the day filter comes after the frames."""
    return _comparable(_features(spark, sf, "2024-01-15", "2024-01-15"))


@query("high_velocity", sql("event_features", body="""
    SELECT customer_id, COUNT(*) AS n, MAX(txn_count_7d) AS most FROM event_features WHERE high_velocity GROUP BY 1"""))
def high_velocity(spark, sf):
    return _features(spark, sf).where("high_velocity").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("txn_count_7d").alias("most"))


@query("amount_spike", sql("event_features", body="""
    SELECT payment_id, customer_id, amount FROM event_features WHERE amount_spike"""))
def amount_spike(spark, sf):
    return _features(spark, sf).where("amount_spike").select("payment_id", "customer_id", "amount")


@query("seconds_since_prev", sql("event_features", body="""
    SELECT payment_id, seconds_since_prev FROM event_features"""))
def seconds_since_prev(spark, sf):
    return _features(spark, sf).select("payment_id", "seconds_since_prev")


_MERCHANT_SQL = f"""
    SELECT {day("p.dt")} AS dt, p.merchant_id, m.category, COUNT(*) AS approved_payments,
           ROUND(SUM(p.amount), 2) AS tpv, MAX(p.amount) AS max_ticket
    FROM payments p LEFT JOIN merchants m ON p.merchant_id = m.merchant_id
    WHERE p.status = 'approved' GROUP BY 1, 2, 3"""


def _merchant_daily(spark, sf, **options):
    return features.merchant_daily(
        src.payments(spark, sf), src.merchants(spark, sf), *ALWAYS, **options).withColumn("tpv", _money("tpv"))


@query("merchant_daily", sql("payments", "merchants", body=_MERCHANT_SQL))
def merchant_daily(spark, sf):
    return _merchant_daily(spark, sf)


@query("merchant_daily_salted", sql("payments", "merchants", body=_MERCHANT_SQL))
def merchant_daily_salted(spark, sf):
    return _merchant_daily(spark, sf, salts=features.SALT_BUCKETS)


# ======================================================================= marts
def _fct_payments(spark, sf, payments=None):
    payments = src.silver_payments(spark, sf) if payments is None else payments
    merchants, customers = src.merchants(spark, sf), src.customers(spark, sf)
    scored = features.payment_features(payments, merchants, customers, *ALWAYS)
    return marts.fct_payments(payments, merchants, customers, scored)


def _kept(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("_reasons") == 0)


def _refunds(spark, sf, payments=None):
    return _kept(_refunds_checked(spark, sf, payments))


def _chargebacks(spark, sf, payments=None):
    return _kept(_chargebacks_checked(spark, sf, payments))


def _fct_refunds(spark, sf, payments=None):
    payments = src.silver_payments(spark, sf) if payments is None else payments
    return marts.fct_refunds(_refunds(spark, sf, payments), payments)


def _fct_chargebacks(spark, sf, payments=None):
    payments = src.silver_payments(spark, sf) if payments is None else payments
    return marts.fct_chargebacks(_chargebacks(spark, sf, payments), payments)


def _facts(spark, sf):
    """Payments, refunds and chargebacks over one stored copy of the silver payments."""
    payments = src.silver_payments(spark, sf)
    return _fct_payments(spark, sf, payments), _fct_refunds(spark, sf, payments), _fct_chargebacks(spark, sf, payments)


def _kpis(spark, sf):
    return gold.indicadores_financieros(*_facts(spark, sf))


@query("stg_payments", sql("payments", body=f"""
    SELECT payment_id, customer_id, merchant_id, amount, COALESCE(currency, 'COP') AS currency, payment_method, channel,
           status, {moment("transaction_date")} AS transaction_date, {day("dt")} AS transaction_day,
           {moment("updated_at")} AS updated_at FROM payments"""))
def stg_payments(spark, sf):
    return marts.stg_payments(src.payments(spark, sf))


@query("stg_customers", sql("customers", body=f"""
    SELECT customer_id, document_type, document_number, city, risk_segment, {moment("created_at")} AS created_at,
           {moment("updated_at")} AS updated_at FROM customers"""))
def stg_customers(spark, sf):
    return marts.stg_customers(src.customers(spark, sf))


@query("stg_merchants", sql("merchants", body=f"""
    SELECT merchant_id, name AS merchant_name, category, city, status, {moment("updated_at")} AS updated_at
    FROM merchants"""))
def stg_merchants(spark, sf):
    return marts.stg_merchants(src.merchants(spark, sf))


@query("stg_refunds", sql("refunds", body=f"""
    SELECT refund_id, payment_id, amount, {moment("refund_date")} AS refund_date, {day("dt")} AS refund_day,
           payment_found FROM refunds"""))
def stg_refunds(spark, sf):
    return marts.stg_refunds(_refunds(spark, sf))


@query("stg_chargebacks", sql("chargebacks", body=f"""
    SELECT chargeback_id, payment_id, reason, amount, {moment("chargeback_date")} AS chargeback_date,
           {day("dt")} AS chargeback_day, payment_found FROM chargebacks"""))
def stg_chargebacks(spark, sf):
    return marts.stg_chargebacks(_chargebacks(spark, sf))


@query("stg_payment_features", sql("event_features", body="""
    SELECT payment_id, txn_count_7d, ROUND(amount_7d, 2) AS amount_7d,
           ROUND(amount_7d, 2) / txn_count_7d AS avg_amount_7d, seconds_since_prev, high_velocity, amount_spike
    FROM event_features"""))
def stg_payment_features(spark, sf):
    return _comparable(marts.stg_payment_features(_features(spark, sf)))


@query("dim_customers", sql("customers", body=f"""
    SELECT customer_id, document_type, document_number, city, risk_segment, {moment("created_at")} AS created_at,
           {moment("updated_at")} AS updated_at FROM customers"""))
def dim_customers(spark, sf):
    return marts.dim_customers(src.customers(spark, sf))


@query("dim_merchants", sql("merchants", body=f"""
    SELECT merchant_id, name AS merchant_name, category, city, status, {moment("updated_at")} AS updated_at
    FROM merchants"""))
def dim_merchants(spark, sf):
    return marts.dim_merchants(src.merchants(spark, sf))


@query("currency_normalisation", sql("payments", body="""
    SELECT payment_id, currency, amount, CASE WHEN currency = 'USD' THEN amount * 4000 ELSE amount END AS amount_cop
    FROM payments"""))
def currency_normalisation(spark, sf):
    return src.payments(spark, sf).select(
        "payment_id", "currency", "amount", marts.in_cop(F.col("amount"), F.col("currency")).alias("amount_cop"))


@query("flag_default", sql("fct_payments", body="""
    SELECT status, flag_high_velocity, flag_amount_spike, COUNT(*) AS n FROM fct_payments GROUP BY 1, 2, 3"""))
def flag_default(spark, sf):
    return _fct_payments(spark, sf).groupBy("status", "flag_high_velocity", "flag_amount_spike").agg(
        F.count(F.lit(1)).alias("n"))


@query("fct_payments", sql("fct_payments", body=f"""
    SELECT * REPLACE ({moment("transaction_date")} AS transaction_date, {day("transaction_day")} AS transaction_day,
                      {moment("updated_at")} AS updated_at) FROM fct_payments"""))
def fct_payments(spark, sf):
    return _fct_payments(spark, sf)


@query("fct_refunds", sql("fct_refunds", body=f"""
    SELECT * REPLACE ({moment("refund_date")} AS refund_date, {day("refund_day")} AS refund_day,
                      {day("payment_day")} AS payment_day) FROM fct_refunds"""))
def fct_refunds(spark, sf):
    return _fct_refunds(spark, sf)


@query("fct_chargebacks", sql("fct_chargebacks", body=f"""
    SELECT * REPLACE ({moment("chargeback_date")} AS chargeback_date, {day("chargeback_day")} AS chargeback_day,
                      {day("payment_day")} AS payment_day) FROM fct_chargebacks"""))
def fct_chargebacks(spark, sf):
    return _fct_chargebacks(spark, sf)


# ======================================================================== gold
@query("gold_payments", sql("fct_payments", body=f"""
    SELECT payment_id AS id_pago, customer_id AS id_cliente, merchant_id AS id_comercio,
           merchant_category AS categoria_comercio, payment_method AS medio_pago, channel AS canal, status AS estado,
           currency AS moneda, amount AS monto, amount_cop AS monto_cop,
           {moment("transaction_date")} AS fecha_transaccion, {day("transaction_day")} AS fecha,
           flag_high_velocity AS alerta_velocidad, flag_amount_spike AS alerta_monto FROM fct_payments"""))
def gold_payments(spark, sf):
    return gold.pagos_gold(_fct_payments(spark, sf))


@query("gold_customers", sql("customers", body=f"""
    SELECT customer_id AS id_cliente, document_type AS tipo_documento, document_number AS numero_documento,
           city AS ciudad, risk_segment AS segmento_riesgo, {day("created_at")} AS fecha_vinculacion,
           {moment("updated_at")} AS actualizado_en FROM customers"""))
def gold_customers(spark, sf):
    return gold.clientes_gold(marts.dim_customers(src.customers(spark, sf)))


@query("gold_chargebacks", sql("fct_chargebacks", body=f"""
    SELECT chargeback_id AS id_contracargo, payment_id AS id_pago, merchant_id AS id_comercio,
           customer_id AS id_cliente, reason AS motivo, amount AS monto, {day("chargeback_day")} AS fecha,
           {day("payment_day")} AS fecha_pago, days_to_chargeback AS dias_hasta_contracargo FROM fct_chargebacks"""))
def gold_chargebacks(spark, sf):
    return gold.contracargos_gold(_fct_chargebacks(spark, sf))


@query("daily_payment_kpis", sql("daily_payments", body=f"""
    SELECT * REPLACE ({day("fecha")} AS fecha) FROM daily_payments"""))
def daily_payment_kpis(spark, sf):
    return gold.daily_payments(_fct_payments(spark, sf)).withColumn("tpv_cop", _money("tpv_cop"))


@query("daily_refund_kpis", sql("daily_refunds", body=f"""
    SELECT * REPLACE ({day("fecha")} AS fecha) FROM daily_refunds"""))
def daily_refund_kpis(spark, sf):
    return gold.daily_refunds(_fct_refunds(spark, sf)).withColumn("devoluciones_cop", _money("devoluciones_cop"))


@query("daily_chargeback_kpis", sql("daily_chargebacks", body=f"""
    SELECT * REPLACE ({day("fecha")} AS fecha) FROM daily_chargebacks"""))
def daily_chargeback_kpis(spark, sf):
    return gold.daily_chargebacks(_fct_chargebacks(spark, sf)).withColumn("contracargos_cop", _money("contracargos_cop"))


def comparable_kpis(kpis: DataFrame) -> DataFrame:
    """Sums to the cent and rates to six places, so that the order of adding does not show."""
    return (
        kpis.withColumn("tpv_cop", _money("tpv_cop"))
        .withColumn("ticket_promedio_cop", F.try_divide(F.col("tpv_cop"), F.col("pagos_aprobados")))
        .withColumn("devoluciones_cop", _money("devoluciones_cop"))
        .withColumn("tasa_devolucion", F.round("tasa_devolucion", 6))
        .withColumn("tasa_contracargos", F.round("tasa_contracargos", 6))
    )


@query("daily_financial_kpis", sql("indicadores", body=f"""
    SELECT * REPLACE ({day("fecha")} AS fecha, ROUND(tasa_devolucion, 6) AS tasa_devolucion,
                      ROUND(tasa_contracargos, 6) AS tasa_contracargos) FROM indicadores"""))
def daily_financial_kpis(spark, sf):
    return comparable_kpis(_kpis(spark, sf))


@query("gold_row_counts", sql("fct_payments", "fct_chargebacks", "customers", "indicadores", body="""
    SELECT 'clientes_gold' AS dataset, COUNT(*) AS rows FROM customers
    UNION ALL SELECT 'pagos_gold', COUNT(*) FROM fct_payments
    UNION ALL SELECT 'contracargos_gold', COUNT(*) FROM fct_chargebacks
    UNION ALL SELECT 'indicadores_financieros', COUNT(*) FROM indicadores"""))
def gold_row_counts(spark, sf):
    payments, refunds, chargebacks = _facts(spark, sf)
    return gold.row_counts({
        "clientes_gold": gold.clientes_gold(marts.dim_customers(src.customers(spark, sf))),
        "pagos_gold": gold.pagos_gold(payments),
        "contracargos_gold": gold.contracargos_gold(chargebacks),
        "indicadores_financieros": gold.indicadores_financieros(payments, refunds, chargebacks),
    })


@query("snapshot_as_of", sql("indicadores", body=f"""
    SELECT {day("fecha")} AS fecha, pagos, pagos_aprobados FROM indicadores WHERE fecha <= DATE '1997-12-31'"""))
def snapshot_as_of(spark, sf):
    return gold.snapshot_as_of(_kpis(spark, sf), "1997-12-31").select("fecha", "pagos", "pagos_aprobados")


# ================================================================== data tests
def _tables(spark, sf):
    # The marts are stored tables; the tests read each several times.
    payments, *children = _facts(spark, sf)
    # Still dealt by payment after its joins, so that storing it by payment costs no shuffle.
    payments = clustered(payments, "mart", "payment_id")
    refunds, chargebacks = [staged(fact, "mart") for fact in children]
    dim_customers = marts.dim_customers(src.customers(spark, sf))
    return {
        "dim_customers": dim_customers,
        "dim_merchants": marts.dim_merchants(src.known_merchants(spark, sf)),
        "fct_payments": payments,
        "fct_refunds": refunds,
        "fct_chargebacks": chargebacks,
        "clientes_gold": gold.clientes_gold(dim_customers),
        "pagos_gold": gold.pagos_gold(payments),
        "contracargos_gold": gold.contracargos_gold(chargebacks),
        "indicadores_financieros": gold.indicadores_financieros(payments, refunds, chargebacks),
    }


_TEST_KEYS = {
    "dim_customers": ("customers", "customer_id"), "dim_merchants": ("known", "merchant_id"),
    "fct_payments": ("fct_payments", "payment_id"), "fct_refunds": ("fct_refunds", "refund_id"),
    "fct_chargebacks": ("fct_chargebacks", "chargeback_id"), "clientes_gold": ("customers", "customer_id"),
    "pagos_gold": ("fct_payments", "payment_id"), "contracargos_gold": ("fct_chargebacks", "chargeback_id"),
    "indicadores_financieros": ("indicadores", "fecha"),
}
_NEEDED = ("customers", "known", "fct_payments", "fct_refunds", "fct_chargebacks", "indicadores")


def _line(test: str, failing: str, severity: str = "error") -> str:
    return f"SELECT '{test}' AS test, '{severity}' AS severity, (SELECT COUNT(*) FROM {failing}) AS failures"


_UNIQUE = [
    _line(f"unique_{name}_{checks.KEYS[name]}",
          f"(SELECT {key} FROM {part} WHERE {key} IS NOT NULL GROUP BY {key} HAVING COUNT(*) > 1)")
    for name, (part, key) in _TEST_KEYS.items()
]
_NOT_NULL = [
    _line(f"not_null_{name}_{checks.KEYS[name]}", f"{part} WHERE {key} IS NULL")
    for name, (part, key) in _TEST_KEYS.items()
] + [_line("not_null_fct_payments_amount", "fct_payments WHERE amount IS NULL")]
_ACCEPTED = [
    _line("accepted_values_dim_customers_risk_segment", "customers WHERE risk_segment NOT IN ('low', 'medium', 'high')"),
    _line("accepted_values_fct_payments_status",
          "fct_payments WHERE status NOT IN ('pending', 'approved', 'declined')"),
]
_RELATIONS = [
    _line("relationships_fct_payments_merchant_id",
          "fct_payments WHERE merchant_id NOT IN (SELECT merchant_id FROM known)"),
    _line("relationships_fct_refunds_payment_id",
          "fct_refunds WHERE payment_id NOT IN (SELECT payment_id FROM fct_payments)", "warn"),
]
_FUTURE = [_line("no_future_payments", "fct_payments WHERE updated_at < transaction_date")]
_RATES = [_line("rates_between_0_and_1", """indicadores WHERE tasa_aprobacion NOT BETWEEN 0 AND 1
    OR tasa_devolucion NOT BETWEEN 0 AND 1 OR tasa_contracargos NOT BETWEEN 0 AND 1""")]
_REFUND_LE = [_line("refund_not_exceeding_payment", "fct_refunds WHERE amount > payment_amount")]


def _check_query(name: str, lines: list[str], *prefixes: str) -> None:
    @query(name, sql(*_NEEDED, body="\nUNION ALL ".join(lines)))
    def some_checks(spark, sf):
        chosen = [c for c in checks.mart_checks() if c.test.startswith(prefixes)]
        return checks.run_checks(_tables(spark, sf), chosen)


_check_query("check_unique", _UNIQUE, "unique_")
_check_query("check_not_null", _NOT_NULL, "not_null_")
_check_query("check_accepted_values", _ACCEPTED, "accepted_values_")
_check_query("check_relationships", _RELATIONS, "relationships_")
_check_query("check_update_after_transaction", _FUTURE, "no_future_payments")
_check_query("check_rates", _RATES, "rates_between")
_check_query("check_refund_le_payment", _REFUND_LE, "refund_not_exceeding")
_check_query("data_tests", _UNIQUE + _NOT_NULL + _ACCEPTED + _RELATIONS + _FUTURE + _RATES + _REFUND_LE, "")


@query("orphan_refunds", sql("refund_versions", "payments", body="""
    SELECT refund_id, payment_id FROM refund_versions WHERE payment_id NOT IN
        (SELECT payment_id FROM payments WHERE status <> 'declined')"""))
def orphan_refunds(spark, sf):
    live = src.payments(spark, sf).where(F.col("status") != "declined")
    return checks.orphans(src.refund_versions(spark, sf), "payment_id", live, "payment_id").select(
        "refund_id", "payment_id")


# ===================================================================== run log
def _now():
    return F.lit(src.LOG_NOW).cast("timestamp")


@query("run_quality", sql("task_runs", body="""
    SELECT run_id, CAST(SUM(rows_quarantined) AS BIGINT) AS quarantined, CAST(SUM(k) AS BIGINT) AS duplicates_removed,
           CAST(SUM(k * 2) AS BIGINT) AS late_rows,
           COALESCE(CAST(SUM(CASE WHEN k > 0 THEN k END) AS BIGINT), 0) AS below_min, 0 AS other_reasons
    FROM task_runs WHERE status = 'success' AND stage = 'silver' GROUP BY run_id"""))
def run_quality(spark, sf):
    reasons = F.col("quarantine_by_reason")
    return audit.run_quality(src.task_runs(spark, sf)).select(
        "run_id", "quarantined", "duplicates_removed", "late_rows",
        F.coalesce(reasons["amount:below_min"], F.lit(0)).alias("below_min"),
        F.coalesce(reasons["x:y"], F.lit(0)).alias("other_reasons"))


@query("entity_quality", sql("task_runs", body="""
    SELECT run_id, CASE WHEN task = 'silver.refunds' THEN 'refunds' ELSE 'payments' END AS entity,
           CAST(SUM(CASE WHEN stage = 'silver' THEN k ELSE 0 END) AS BIGINT) AS quarantined,
           CAST(SUM(CASE WHEN stage = 'silver' THEN k ELSE 0 END) AS BIGINT) AS duplicates_removed,
           CAST(SUM(CASE WHEN stage = 'silver' THEN k * 2 ELSE 0 END) AS BIGINT) AS late_rows,
           CAST(SUM(CASE WHEN stage = 'bronze' AND k > 50 THEN 1 ELSE 0 END) AS BIGINT) AS corrupt_lines,
           concat_ws(',', MAX(CASE WHEN stage = 'bronze' AND k > 40 AND k <= 60 THEN 'campaign' END),
                     MAX(CASE WHEN stage = 'bronze' AND k > 60 THEN 'promo_code' END)) AS unknown_columns
    FROM task_runs WHERE status = 'success' AND stage IN ('bronze', 'silver') GROUP BY 1, 2"""))
def entity_quality(spark, sf):
    return audit.entity_quality(src.task_runs(spark, sf))


@query("task_totals", sql("task_runs", body=f"""
    SELECT run_id, task, COUNT(*) AS n, ROUND(SUM(duration_s), 2) AS secs, CAST(SUM(rows_read) AS BIGINT) AS rows_read,
           CAST(SUM(rows_written) AS BIGINT) AS rows_written, CAST(SUM(rows_quarantined) AS BIGINT) AS rows_quarantined,
           {count_if("status = 'failed'")} AS fails, {moment("MIN(started_at)")} AS first_start
    FROM task_runs GROUP BY run_id, task"""))
def task_totals(spark, sf):
    return audit.task_totals(src.task_runs(spark, sf)).withColumn("secs", F.round("secs", 2))


@query("latest_runs", sql("runs", body=f"""
    SELECT run_id, status, {moment("started_at")} AS started_at FROM runs ORDER BY started_at DESC, run_id LIMIT 10"""))
def latest_runs(spark, sf):
    return audit.latest_runs(src.runs(spark, sf), 10).select("run_id", "status", "started_at")


@query("last_attempt", sql("units", body="""
    SELECT run_id, task, ingest_date, stage, attempts, CAST(failed_attempts AS BIGINT) AS failed_attempts,
           CAST(running_attempts AS BIGINT) AS running_attempts, ROUND(seconds_, 2) AS seconds, status,
           CAST(rows_read AS BIGINT) AS rows_read, CAST(rows_written AS BIGINT) AS rows_written FROM units"""))
def last_attempt(spark, sf):
    return audit.last_attempts(src.task_runs(spark, sf), _now()).withColumn("seconds", F.round("seconds", 2)).drop(
        "rows_quarantined", "error")


@query("run_summary", sql("summaries", body=f"""
    SELECT run_id, status, CAST(failures AS BIGINT) AS retries,
           ROUND(COALESCE(epoch(finished_at), CASE WHEN status = 'running' THEN epoch(TIMESTAMP '2024-01-31 00:00:00')
                 ELSE last_ END) - epoch(started_at), 1) AS duration_s,
           ROUND(COALESCE(bronze_s, 0), 2) AS bronze_seconds, ROUND(COALESCE(silver_s, 0), 2) AS silver_seconds,
           ROUND(COALESCE(features_s, 0), 2) AS features_seconds, CAST(0 AS DOUBLE) AS dbt_seconds,
           ROUND(COALESCE(publish_s, 0), 2) AS publish_seconds FROM summaries"""))
def run_summary(spark, sf):
    return audit.run_summary(src.runs(spark, sf), src.task_runs(spark, sf), _now()).drop(
        "kind", "dates", "started_at", "finished_at")


@query("stage_status", sql("stages", body="""
    SELECT run_id, stage, CASE
        WHEN failed > 0 AND run_status <> 'running' THEN 'failed'
        WHEN running > 0 THEN 'running'
        WHEN failed > 0 THEN 'retrying'
        WHEN expected = 0 AND units = 0 THEN 'skipped'
        WHEN units > 0 AND done >= expected THEN CASE WHEN retries > 0 THEN 'retried' ELSE 'ok' END
        WHEN run_status = 'running' AND units > 0 THEN 'running'
        WHEN run_status IN ('failed', 'interrupted') THEN 'skipped' ELSE 'waiting' END AS status,
        CAST(done AS BIGINT) AS done, CAST(expected AS BIGINT) AS expected, CAST(retries AS BIGINT) AS retries,
        CAST(rows_read AS BIGINT) AS rows_read FROM stages"""))
def stage_status(spark, sf):
    return audit.stage_status(src.runs(spark, sf), src.task_runs(spark, sf), _now()).select(
        "run_id", "stage", "status", "done", "expected", "retries", "rows_read")


@query("stage_flow", sql("stages", body="""
    SELECT run_id, CAST(SUM(CASE WHEN stage = 'bronze' THEN rows_read ELSE 0 END) AS BIGINT) AS landed,
           CAST(SUM(CASE WHEN stage = 'silver' THEN rows_read ELSE 0 END) AS BIGINT) AS bronze,
           CAST(SUM(CASE WHEN stage = 'features' THEN rows_read ELSE 0 END) AS BIGINT) AS scored,
           CAST(SUM(CASE WHEN stage = 'silver' THEN rows_written ELSE 0 END) AS BIGINT) AS silver,
           CAST(SUM(CASE WHEN stage = 'publish' THEN rows_written ELSE 0 END) AS BIGINT) AS published
    FROM stages GROUP BY run_id"""))
def stage_flow(spark, sf):
    return audit.stage_flow(audit.stage_status(src.runs(spark, sf), src.task_runs(spark, sf), _now()))


@query("task_stage_mapping", sql("task_runs", body="SELECT task, stage, COUNT(*) AS n FROM task_runs GROUP BY 1, 2"))
def task_stage_mapping(spark, sf):
    return src.task_runs(spark, sf).groupBy("task", audit.stage_of(F.col("task")).alias("stage")).agg(
        F.count(F.lit(1)).alias("n"))


@query("schema_events_in_run", sql("runs", "task_runs", "numbered", body=f"""
    SELECT r.run_id, {day("e.ts")} AS ingest_date, 'payments' AS entity, 'unknown_columns' AS kind,
           '["c' || CAST(e.k AS VARCHAR) || '"]' AS columns, {moment("e.ts")} AS detected_at
    FROM (SELECT run_id, started_at, COALESCE(finished_at,
                 LEAST(GREATEST(started_at, sign) + INTERVAL 30 MINUTE, GREATEST(started_at, TIMESTAMP '2024-01-31 00:00:00')))
                 AS until_
          FROM runs LEFT JOIN (
              SELECT run_id AS of_run, MAX(started_at + to_microseconds(CAST(ROUND(COALESCE(duration_s, 0) * 1e6) AS BIGINT)))
                  AS sign FROM task_runs GROUP BY 1) ON of_run = run_id) r
    JOIN numbered e ON e.event_type = 'error' AND e.ts BETWEEN r.started_at AND r.until_"""))
def schema_events_in_run(spark, sf):
    return audit.events_in_runs(src.schema_events(spark, sf), src.runs(spark, sf), src.task_runs(spark, sf), _now())


# ================================================================= fingerprint
@query("row_fingerprint", sql("feed", body="""
    SELECT payment_id, sha256('{' || concat_ws(',', '"amount":"' || amount || '"', '"channel":"' || channel || '"',
        '"currency":"' || currency || '"', '"customer_id":"' || customer_id || '"',
        '"merchant_id":"' || merchant_id || '"', '"payment_id":"' || payment_id || '"',
        '"payment_method":"' || payment_method || '"', '"status":"' || status || '"',
        '"transaction_date":"' || transaction_date || '"', '"updated_at":"' || updated_at || '"') || '}') AS row_hash
    FROM feed"""))
def row_fingerprint(spark, sf):
    fields = F.map_from_arrays(F.array(*[F.lit(n) for n in PAYMENTS.names]), F.array(*[F.col(n) for n in PAYMENTS.names]))
    return src.payment_feed(spark, sf).select("payment_id", fingerprint(fields).alias("row_hash"))
