"""The given tables seen as payment feeds.

Two worlds, both over whole tables:

* ``shop``: order lines joined with their orders are payment versions (a line repeated for an
  order is a resend); returned lines are refunds, deeply discounted ones also chargebacks.
* ``feed``: events are payments sent as text, with the defects a feed has.  Which rows are
  defective follows from the number in ``props``.

``oracle.py`` says the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylode.operators.upsert import latest_per_key
from paylode.session import clustered, use_utc

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its times have no zone and are read as UTC."""
    df = use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    for column, kind in df.dtypes:
        if kind == "timestamp_ntz":
            df = df.withColumn(column, F.col(column).cast("timestamp"))
    return df


def _pick(column: str | Column, pairs: dict, other=None) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    chosen = F.lit(other)
    for value, result in pairs.items():
        chosen = F.when(column == value, F.lit(result)).otherwise(chosen)
    return chosen


def _tag(letter: str, *columns: str) -> Column:
    return F.concat(F.lit(letter), F.concat_ws("-", *[F.col(c).cast("string") for c in columns]))


# ------------------------------------------------------------------ dimensions
def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    category = _pick(
        "n_regionkey", {0: "retail", 1: "food", 2: "transport", 3: "marketplace", 4: "services"}
    )
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select(
            _tag("M", "s_suppkey").alias("merchant_id"),
            F.col("s_name").alias("name"),
            category.alias("category"),
            F.col("n_name").alias("city"),
            F.when(F.col("s_acctbal") < 0, "suspended").otherwise("active").alias("status"),
            F.lit("1995-01-01").cast("timestamp").alias("updated_at"),
            F.col("s_acctbal").alias("_balance"),
        )
    )


def known_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in debt were never onboarded as merchants."""
    return merchants(spark, sf_dir).where(F.col("_balance") >= 0)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    document = _pick(
        "c_mktsegment", {"AUTOMOBILE": "CC", "BUILDING": "CE", "FURNITURE": "NIT", "MACHINERY": "PP"}, "CC"
    )
    segment = (
        F.when(F.col("c_acctbal") < 0, "high").when(F.col("c_acctbal") < 5000, "medium").otherwise("low")
    )
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            _tag("C", "c_custkey").alias("customer_id"),
            document.alias("document_type"),
            F.col("c_custkey").cast("string").alias("document_number"),
            F.col("n_name").alias("city"),
            segment.alias("risk_segment"),
            F.lit("1995-01-01").cast("timestamp").alias("created_at"),
            F.lit("1995-01-01").cast("timestamp").alias("updated_at"),
        )
    )


# ------------------------------------------------------------------------ shop
def payment_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    method = _pick(
        "o_orderpriority", {"1-URGENT": "card", "2-HIGH": "pse", "3-MEDIUM": "wallet", "4-NOT SPECIFIED": "transfer"},
        "card",
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            _tag("P", "l_orderkey", "l_linenumber").alias("payment_id"),
            _tag("C", "o_custkey").alias("customer_id"),
            _tag("M", "l_suppkey").alias("merchant_id"),
            F.col("l_extendedprice").alias("amount"),
            method.alias("payment_method"),
            F.col("o_orderdate").alias("transaction_date"),
            _pick("l_returnflag", {"A": "approved", "N": "pending"}, "declined").alias("status"),
            F.col("l_shipdate").alias("updated_at"),
            F.when(F.col("l_tax") >= 0.07, "USD").when(F.col("l_tax") >= 0.01, "COP").alias("currency"),
            _pick("o_orderstatus", {"F": "app", "O": "web"}, "pos").alias("channel"),
            F.to_date("o_orderdate").alias("dt"),
            F.to_date("l_shipdate").cast("string").alias("_ingest_date"),
            "l_partkey",
            "l_suppkey",
            "l_orderkey",
            "l_linenumber",
        )
    )


NEWEST = ("updated_at", "l_partkey", "l_suppkey")
# What payment_id is made of.  Rows are already placed by order after a shuffled join with
# the orders, so dedup by these needs no second shuffle.
KEY = ("l_orderkey", "l_linenumber")


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver payments: the latest version of each, ties settled by part and supplier."""
    rows = latest_per_key(payment_versions(spark, sf_dir), KEY, NEWEST)
    return rows.drop("l_partkey", "l_suppkey", *KEY)


def silver_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stored table, for queries that read it more than once, mostly to join it by payment."""
    return clustered(payments(spark, sf_dir), "silver-payments", "payment_id")


def _children(spark: SparkSession, sf_dir: str, prefix: str, entity: str, day: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R").select(
        _tag(prefix, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias(f"{entity}_id"),
        _tag("P", "l_orderkey", "l_linenumber").alias("payment_id"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_shipdate").alias(day),
        F.col("l_shipdate").alias("updated_at"),
        F.to_date("l_shipdate").alias("dt"),
        F.to_date("l_shipdate").cast("string").alias("_ingest_date"),
        F.array().cast("array<string>").alias("_reasons"),
        "l_discount",
        "l_linenumber",
        "l_quantity",
    )


def refund_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Before the check against the payment; ``_reasons`` is still empty."""
    return _children(spark, sf_dir, "R", "refund", "refund_date")


def chargeback_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = _pick("l_linenumber", {1: "fraud", 2: "not_received", 3: "duplicate", 4: "not_as_described"}, "other")
    rows = _children(spark, sf_dir, "B", "chargeback", "chargeback_date")
    return rows.where(F.col("l_discount") >= 0.09).withColumn("reason", reason)


# ------------------------------------------------------------------------ feed
def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def _method() -> Column:
    wrong = F.when(F.col("k") < 10, "crypto").otherwise("card")
    return F.when(F.col("event_type") == "error", wrong).otherwise(
        _pick("event_type", {"view": "card", "click": "pse", "purchase": "wallet", "signup": "transfer"})
    )


def _status() -> Column:
    return _pick("event_type", {"error": "declined", "signup": "pending"}, "approved")


def payment_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as bronze payments: all text, with lineage."""
    k, value = F.col("k"), F.col("value").cast("string")
    moment = F.date_format("ts", ISO)
    late = F.when(k == 91, 10).when(k.between(85, 90), 2).otherwise(0)
    return events(spark, sf_dir).select(
        _tag("E", "event_id").alias("payment_id"),
        F.when(k == 97, "  ").when(k != 96, _tag("C", "user_id")).alias("customer_id"),
        _tag("M", "k").alias("merchant_id"),
        F.when(k == 99, "mil pesos").when(k == 98, F.concat(F.lit("-"), value)).when(k == 95, "NaN")
        .otherwise(value).alias("amount"),
        _method().alias("payment_method"),
        F.when(k == 94, F.date_format("ts", "HH:mm:ss")).otherwise(moment).alias("transaction_date"),
        _status().alias("status"),
        moment.alias("updated_at"),
        F.when(k < 20, "USD").when(k < 30, F.lit(None)).when(k == 93, "EUR").when(k == 92, "").otherwise("COP")
        .alias("currency"),
        _pick("event_type", {"view": "web", "click": "app", "purchase": "pos"}).alias("channel"),
        F.lit(None).cast("string").alias("_corrupt_record"),
        F.lit("events").alias("_source_file"),
        F.col("ts").alias("_ingested_at"),
        F.date_add(F.to_date("ts"), late).alias("ingest_date"),
        "k",
        "ts",
        "event_type",
    )


def event_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as clean silver payments, for the features."""
    return events(spark, sf_dir).select(
        _tag("E", "event_id").alias("payment_id"),
        _tag("C", "user_id").alias("customer_id"),
        _tag("M", "k").alias("merchant_id"),
        F.col("value").alias("amount"),
        F.col("ts").alias("transaction_date"),
        _status().alias("status"),
        F.to_date("ts").alias("dt"),
    )


# --------------------------------------------------------------------- run log
def _hour_run() -> Column:
    return F.concat(F.lit("R"), F.date_format("ts", "yyyyMMddHH"))


def task_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as task attempts: one run per hour, one unit per event type."""
    from pyspark.sql import Window

    k = F.col("k")
    unit = Window.partitionBy("run_id", "task").orderBy("ts", "event_id")
    status = F.when(k < 10, "failed").when(k < 12, "running").otherwise("success")
    in_silver = F.to_json(F.struct(
        k.cast("bigint").alias("duplicates_removed"), (k * 2).cast("bigint").alias("late_rows"),
        F.create_map(F.lit("amount:below_min"), k.cast("bigint"), F.lit("x:y"), F.lit(0).cast("bigint"))
        .alias("quarantine_reasons"),
    ))
    in_bronze = F.to_json(F.struct(
        F.when(k > 50, 1).otherwise(0).cast("bigint").alias("corrupt_lines"),
        F.when(k > 60, F.array(F.lit("promo_code"))).when(k > 40, F.array(F.lit("campaign")))
        .otherwise(F.array().cast("array<string>")).alias("unknown_columns"),
    ))
    task = _pick("event_type", {
        "view": "bronze.payments", "click": "silver.payments", "purchase": "silver.refunds", "signup": "features",
    }, "publish")
    return (
        events(spark, sf_dir)
        .withColumn("run_id", _hour_run())
        .withColumn("task", task)
        .select(
            "run_id",
            "task",
            F.to_date("ts").cast("string").alias("ingest_date"),
            F.row_number().over(unit).alias("attempt"),
            status.alias("status"),
            F.col("ts").alias("started_at"),
            F.when(status != "running", F.col("value")).alias("duration_s"),
            (k * 10).cast("bigint").alias("rows_read"),
            (k * 9).cast("bigint").alias("rows_written"),
            k.cast("bigint").alias("rows_quarantined"),
            F.when(F.col("task").startswith("silver."), in_silver)
            .when(F.col("task").startswith("bronze."), in_bronze).alias("details"),
            F.when(status == "failed", "RuntimeError").alias("error"),
        )
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = events(spark, sf_dir).groupBy(_hour_run().alias("run_id"), F.to_date("ts").alias("day")).agg(
        F.min("ts").alias("started_at"), F.max("ts").alias("_end"), F.max("k").alias("_max"), F.min("k").alias("_min"),
    )
    status = F.when(F.col("_max") == 99, "failed").when(F.col("_min") == 0, "running").otherwise("success")
    return hours.select(
        "run_id",
        F.lit("incremental").alias("kind"),
        F.to_json(F.array(F.col("day").cast("string"))).alias("dates"),
        status.alias("status"),
        "started_at",
        F.when(status != "running", F.col("_end")).alias("finished_at"),
        F.lit(None).cast("string").alias("error"),
    )


def schema_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).where(F.col("event_type") == "error").select(
        F.to_date("ts").cast("string").alias("ingest_date"),
        F.lit("payments").alias("entity"),
        F.lit("unknown_columns").alias("kind"),
        F.concat(F.lit('["c'), F.col("k").cast("string"), F.lit('"]')).alias("columns"),
        F.col("ts").alias("detected_at"),
    )


LOG_NOW = "2024-01-31 00:00:00"
