"""Contract rules as (reason, predicate) pairs and the reasons array built from them."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F

from paylode.contracts import Contract

MALFORMED = "record:malformed_json"
OUT_OF_WINDOW = "late:out_of_window"
UNKNOWN_MERCHANT = "merchant_id:unknown"
EXCEEDS_PAYMENT = "amount:exceeds_payment"


def rules(contract: Contract) -> Iterator[tuple[str, Column]]:
    """Over an aligned frame: ``_raw.<c>`` is the text received, ``<c>`` the typed value.

    A predicate that is NULL counts as not violated, so no NULL guards are needed.
    """
    for column in contract.columns:
        received, value = F.col(f"_raw.{column.name}"), F.col(column.name)
        blank = F.coalesce(F.trim(received) == "", F.lit(True))
        if column.required:
            yield f"{column.name}:missing", blank
        if column.type != "string":
            yield f"{column.name}:invalid_type", ~blank & value.isNull()
        if column.allowed:
            yield f"{column.name}:not_allowed", ~value.isin(*column.allowed)
        if column.min is not None:
            yield f"{column.name}:below_min", value < column.min


def listed(contract: Contract) -> Column:
    """Reasons of a record in contract order as one text, '' when it keeps the contract.

    Text, because it skips NULLs in generated code; filtering an array of NULLs would
    evaluate every rule outside it.  Reasons hold no comma.
    """
    return F.concat_ws(",", *[F.when(broken, F.lit(reason)) for reason, broken in rules(contract)])


def as_reasons(text: Column) -> Column:
    return F.when(text != "", F.split(text, ",")).otherwise(F.array().cast("array<string>"))


def also(reasons: Column, reason: str, broken: Column) -> Column:
    """``reasons`` plus one more where ``broken`` holds, without repeating it."""
    return F.when(broken, F.array_union(reasons, F.array(F.lit(reason)))).otherwise(reasons)
