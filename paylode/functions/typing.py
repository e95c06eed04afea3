"""Casts that turn a bad value into NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark also parses '2026' or '10:00:00' (as today) to a timestamp; an event time needs a whole date.
WHOLE_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}"


def tolerant_cast(raw: Column, type_name: str) -> Column:
    if type_name == "string":
        return raw
    if type_name == "timestamp":
        return F.when(raw.rlike(WHOLE_DATE), F.try_to_timestamp(raw))
    if type_name == "date":
        return F.when(raw.rlike(WHOLE_DATE), raw.try_cast("date"))
    if type_name == "double":
        number = raw.try_cast("double")
        return F.when(~F.isnan(number), number)
    return raw.try_cast("bigint")


def event_day(event_time: Column) -> Column:
    return F.to_date(event_time)


def epoch_seconds(event_time: Column) -> Column:
    """Whole seconds since 1970 in UTC, truncated."""
    return F.unix_seconds(event_time.cast("timestamp"))
