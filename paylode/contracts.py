"""What each feed promises to send: columns, types, rules, key and event date."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

SPARK_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}

LINEAGE = ("_ingest_date", "_ingested_at", "_source_file")


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    required: bool = False
    allowed: tuple[str, ...] = ()
    min: float | None = None
    since: int = 1
    default: str | None = None


@dataclass(frozen=True)
class Contract:
    """``event_date`` is None for a dimension, which keeps only its current state.

    ``parent_days`` is set for feeds that refer to an earlier payment: how many
    days before the ingest date that payment is searched.
    """

    entity: str
    version: int
    business_key: tuple[str, ...]
    order_by: str
    event_date: str | None
    columns: tuple[Column, ...]
    parent_days: int | None = None

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def required_names(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    def silver_schema(self) -> T.StructType:
        schema = T.StructType([T.StructField(c.name, SPARK_TYPES[c.type]) for c in self.columns])
        schema.add("_ingest_date", T.StringType())
        schema.add("_ingested_at", T.TimestampType())
        schema.add("_source_file", T.StringType())
        if self.parent_days is not None:
            schema.add("payment_found", T.BooleanType())
        if self.event_date:
            schema.add("dt", T.DateType())
        return schema

    def bronze_schema(self) -> T.StructType:
        schema = T.StructType([T.StructField(name, T.StringType()) for name in self.names])
        schema.add("_extra", T.MapType(T.StringType(), T.StringType()))
        schema.add("_absent", T.ArrayType(T.StringType()))
        schema.add("_corrupt_record", T.StringType())
        schema.add("_source_file", T.StringType())
        schema.add("_ingested_at", T.TimestampType())
        schema.add("_row_hash", T.StringType())
        schema.add("ingest_date", T.DateType())
        return schema


def _text(*names: str) -> tuple[Column, ...]:
    return tuple(Column(name, "string", required=True) for name in names)


def _one_of(name: str, *values: str) -> Column:
    return Column(name, "string", required=True, allowed=values)


def _time(name: str) -> Column:
    return Column(name, "timestamp", required=True)


# Feed columns, catalogues, lower bound of amounts, lookup windows.
_AMOUNT = Column("amount", "double", required=True, min=0.01)
DOCUMENT_TYPES = ("CC", "CE", "NIT", "PP")
RISK_SEGMENTS = ("low", "medium", "high")
MERCHANT_CATEGORIES = (
    "retail", "food", "transport", "marketplace", "services", "travel", "education", "health",
)
MERCHANT_STATUSES = ("active", "suspended", "closed")
PAYMENT_METHODS = ("card", "pse", "wallet", "transfer")
PAYMENT_STATUSES = ("pending", "approved", "declined")
CURRENCIES = ("COP", "USD")
CHANNELS = ("app", "web", "pos")
CHARGEBACK_REASONS = ("fraud", "not_received", "duplicate", "not_as_described", "other")

CUSTOMERS = Contract(
    entity="customers", version=1, business_key=("customer_id",), order_by="updated_at", event_date=None,
    columns=(
        *_text("customer_id"),
        _one_of("document_type", *DOCUMENT_TYPES),
        *_text("document_number", "city"),
        _time("created_at"),
        _one_of("risk_segment", *RISK_SEGMENTS),
        _time("updated_at"),
    ),
)

MERCHANTS = Contract(
    entity="merchants", version=1, business_key=("merchant_id",), order_by="updated_at", event_date=None,
    columns=(
        *_text("merchant_id", "name"),
        _one_of("category", *MERCHANT_CATEGORIES),
        *_text("city"),
        _one_of("status", *MERCHANT_STATUSES),
        _time("updated_at"),
    ),
)

PAYMENTS = Contract(
    entity="payments", version=2, business_key=("payment_id",), order_by="updated_at",
    event_date="transaction_date",
    columns=(
        *_text("payment_id", "customer_id", "merchant_id"),
        _AMOUNT,
        _one_of("payment_method", *PAYMENT_METHODS),
        _time("transaction_date"),
        _one_of("status", *PAYMENT_STATUSES),
        _time("updated_at"),
        Column("currency", "string", allowed=CURRENCIES, since=2, default="COP"),
        Column("channel", "string", allowed=CHANNELS, since=2),
    ),
)

REFUNDS = Contract(
    entity="refunds", version=1, business_key=("refund_id",), order_by="updated_at",
    event_date="refund_date", parent_days=30,
    columns=(*_text("refund_id", "payment_id"), _AMOUNT, _time("refund_date"), _time("updated_at")),
)

CHARGEBACKS = Contract(
    entity="chargebacks", version=1, business_key=("chargeback_id",), order_by="updated_at",
    event_date="chargeback_date", parent_days=60,
    columns=(
        *_text("chargeback_id", "payment_id"),
        _one_of("reason", *CHARGEBACK_REASONS),
        _AMOUNT,
        _time("chargeback_date"),
        _time("updated_at"),
    ),
)

# Dimensions come first: facts are checked against them.
CONTRACTS = {c.entity: c for c in (CUSTOMERS, MERCHANTS, PAYMENTS, REFUNDS, CHARGEBACKS)}
ENTITIES = tuple(CONTRACTS)

# Days a late row may still be merged, and the reference exchange rate.
LATE_DATA_DAYS = 7
USD_COP = 4000
