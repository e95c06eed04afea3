"""Whole-record helpers: canonical JSON, fingerprint, salt."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_members(line: Column) -> Column:
    """The members of a JSON object as a map of text; NULL when the line is not one object."""
    return F.from_json(line, "map<string,string>")


def last_values(members: Column) -> Column:
    """The map without repeated names: a name given twice in one object keeps its last value."""
    entries = F.map_entries(members)
    last_only = F.filter(
        entries,
        lambda entry, i: ~F.exists(
            F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == entry["key"]
        ),
    )
    repeated = F.size(F.array_distinct(F.map_keys(members))) < F.size(members)
    return F.when(repeated, F.map_from_entries(last_only)).otherwise(members)


def canonical_json(fields: Column) -> Column:
    """JSON text of a string map: keys sorted, NULL values left out.

    A column that is added but still empty therefore leaves the text unchanged.
    """
    present = F.map_filter(fields, lambda _, value: value.isNotNull())
    return F.to_json(F.map_from_entries(F.sort_array(F.map_entries(present))))


def fingerprint(fields: Column) -> Column:
    return F.sha2(canonical_json(fields), 256)


def salt(key: Column, buckets: int) -> Column:
    """A bucket number that is the same however often a task is retried."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
