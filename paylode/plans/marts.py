"""Staging views, dimensions and facts over the silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylode.contracts import USD_COP


def in_cop(amount: Column, currency: Column, rate: float = USD_COP) -> Column:
    """Amount in pesos; an unknown currency (no payment found) leaves it as it is."""
    return F.when(currency == "USD", amount * F.lit(rate)).otherwise(amount)


def stg_payments(payments: DataFrame) -> DataFrame:
    return payments.select(
        "payment_id", "customer_id", "merchant_id", "amount",
        F.coalesce("currency", F.lit("COP")).alias("currency"),
        "payment_method", "channel", "status", "transaction_date",
        F.col("dt").cast("date").alias("transaction_day"),
        "updated_at",
    )


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", "document_type", "document_number", "city", "risk_segment", "created_at", "updated_at",
    )


def stg_merchants(merchants: DataFrame) -> DataFrame:
    return merchants.select(
        "merchant_id", F.col("name").alias("merchant_name"), "category", "city", "status", "updated_at",
    )


def stg_refunds(refunds: DataFrame) -> DataFrame:
    return refunds.select(
        "refund_id", "payment_id", "amount", "refund_date",
        F.col("dt").cast("date").alias("refund_day"), "payment_found",
    )


def stg_chargebacks(chargebacks: DataFrame) -> DataFrame:
    return chargebacks.select(
        "chargeback_id", "payment_id", "reason", "amount", "chargeback_date",
        F.col("dt").cast("date").alias("chargeback_day"), "payment_found",
    )


def stg_payment_features(features: DataFrame) -> DataFrame:
    return features.select(
        "payment_id", "txn_count_7d", "amount_7d", "avg_amount_7d", "seconds_since_prev",
        "high_velocity", "amount_spike",
    )


def dim_customers(customers: DataFrame) -> DataFrame:
    return stg_customers(customers)


def dim_merchants(merchants: DataFrame) -> DataFrame:
    return stg_merchants(merchants)


def flag(value: Column) -> Column:
    """False where no feature row exists (payment not approved)."""
    return F.coalesce(value, F.lit(False))


def fct_payments(
    payments: DataFrame, merchants: DataFrame, customers: DataFrame, features: DataFrame,
) -> DataFrame:
    """Star join: payments with merchant category, customer segment and risk flags.

    Whole payments are shuffled by payment_id alone, once, or not at all where they are stored by it.  The customers
    and the merchants meet ids only, where AQE splits a hot one, and what they know comes back by the id of the
    payment.  A payment that changed its day cannot meet features of the old one.  Silver holds no payment
    without an id.
    """
    flags = features.select(
        F.col("payment_id").alias("_flagged_id"),
        F.col("dt").cast("date").alias("_flagged_day"),
        flag(F.col("high_velocity")).alias("_velocity"),
        flag(F.col("amount_spike")).alias("_spike"),
    )
    categories = merchants.select("merchant_id", F.col("category").alias("merchant_category"))
    ids = payments.select("payment_id", "customer_id", "merchant_id").distinct()
    named = ids.join(customers.select("customer_id", "risk_segment"), "customer_id", "left").join(
        categories, "merchant_id", "left").select(
        F.col("payment_id").alias("_segment_id"), F.col("customer_id").alias("_segment_customer"),
        F.col("merchant_id").alias("_segment_merchant"), "risk_segment", "merchant_category")

    # Written without an equality, which would be one more key to shuffle by.
    def same(column: str, other: str) -> Column:
        return F.col(column).between(F.col(other), F.col(other)) | (F.col(column).isNull() & F.col(other).isNull())

    same_day = F.datediff("transaction_day", "_flagged_day") == 0
    same_names = same("customer_id", "_segment_customer") & same("merchant_id", "_segment_merchant")
    return (
        stg_payments(payments)
        .join(flags, (F.col("payment_id") == F.col("_flagged_id")) & same_day, "left")
        .join(named, (F.col("payment_id") == F.col("_segment_id")) & same_names, "left")
        .select(
            "payment_id", "customer_id", "merchant_id", "merchant_category", "risk_segment",
            "payment_method", "channel", "status", "currency", "amount",
            in_cop(F.col("amount"), F.col("currency")).alias("amount_cop"),
            "transaction_date", "transaction_day",
            flag(F.col("_velocity")).alias("flag_high_velocity"),
            flag(F.col("_spike")).alias("flag_amount_spike"),
            "updated_at",
        )
    )


def _parents(payments: DataFrame) -> DataFrame:
    return stg_payments(payments).select(
        "payment_id",
        F.col("currency").alias("_currency"),
        F.col("amount").alias("payment_amount"),
        F.col("transaction_day").alias("payment_day"),
        "merchant_id",
        "customer_id",
    )


def fct_refunds(refunds: DataFrame, payments: DataFrame) -> DataFrame:
    staged = stg_refunds(refunds)
    return staged.join(_parents(payments), "payment_id", "left").select(
        *staged.columns,
        in_cop(F.col("amount"), F.col("_currency")).alias("amount_cop"),
        "payment_amount",
        "payment_day",
    )


def fct_chargebacks(chargebacks: DataFrame, payments: DataFrame) -> DataFrame:
    staged = stg_chargebacks(chargebacks)
    return staged.join(_parents(payments), "payment_id", "left").select(
        *staged.columns,
        in_cop(F.col("amount"), F.col("_currency")).alias("amount_cop"),
        "merchant_id",
        "customer_id",
        "payment_day",
        F.datediff("chargeback_day", "payment_day").alias("days_to_chargeback"),
    )
