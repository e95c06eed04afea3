"""Repeated lines or paragraphs by hashing.

A text is cut into units, each is normalised (A-Z in lower case, white space as one space) and hashed to 128
bits.  Digests are grouped over all documents; of equal units the one with the smallest id, and within it the
first, stays and all others go, with their offsets in the original text.  Every unit that is not blank counts;
``least_words`` lets units of fewer words stay.  Units can be lines, paragraphs or sentences.

Only ids, offsets and digests are shuffled, never texts.  A digest that a third of all documents have combines
before the shuffle, and in the join back the one row of its winner meets parts of its units in many tasks.

Defined results: null and empty texts have no units.  Rows without an id rank last.  Units of equal rank (the
same id and place, from repeated rows, or no id and the same place) stay together or go together.  Further
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylode.llm.common import ready, slices, text_md5
from paylode.session import settled, staged

LEAST_WORDS = 1
#: What stands between units.
LINES = "\n"
PARAGRAPHS = "\n[ \t]*\n\\s*"
SENTENCES = "(?<=[.!?])[ \t]+|\n"

_UNIT = "struct<position:int,start:int,end:int,digest:binary>"
_SCANNED = f"doc_id long, text_id binary, n_units long, units array<{_UNIT}>"
_UNIT_TYPE = pa.struct([("position", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("digest", pa.binary())])


def cut(text: str, between: re.Pattern) -> Iterator[tuple[int, int]]:
    """``[start, end)`` of the units, blank ones included."""
    start = 0
    for gap in between.finditer(text):
        yield start, gap.start()
        start = gap.end()
    yield start, len(text)


def _scan(between: str, least_words: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(between)
        for batch in batches:
            for part in slices(batch, "text"):
                counts, units = [], []
                for text in part.column("text").to_pylist():
                    n, own = 0, []
                    for position, (start, end) in enumerate(cut(text or "", pattern)):
                        words = text[start:end].encode().lower().split() if text else []
                        n += bool(words)
                        if words and len(words) >= least_words:
                            digest = hashlib.blake2b(b" ".join(words), digest_size=16).digest()
                            own.append({"position": position, "start": start, "end": end, "digest": digest})
                    counts.append(n)
                    units.append(own)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_id"), pa.array(counts, pa.int64()),
                     pa.array(units, pa.list_(_UNIT_TYPE))], names=["doc_id", "text_id", "n_units", "units"])

    return scan


def _removed(scanned: DataFrame) -> DataFrame:
    """``doc_id, text_id, spans``: the units to remove, of documents that have some."""
    units = scanned.select("doc_id", "text_id", F.inline("units")).withColumn(
        "rank", F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "position"))
    first = units.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("first")).where("n > 1")
    return units.join(first, "digest").where(~F.col("rank").eqNullSafe(F.col("first"))).groupBy("doc_id", "text_id").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_md5().alias("text_id"), "text")


def repeated_units(documents: DataFrame, between: str = LINES, least_words: int = LEAST_WORDS) -> DataFrame:
    """``doc_id, n_units, n_removed, removed_chars, spans``: a row per document, spans in its characters."""

    def found() -> DataFrame:
        scanned = staged(_texts(documents).mapInArrow(_scan(between, least_words), _SCANNED), "units")
        removed = _removed(scanned).select(F.col("doc_id").alias("of_doc"), F.col("text_id").alias("of_text"), "spans")
        same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_id") == F.col("of_text"))
        spans = F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>"))
        return scanned.select("doc_id", "text_id", "n_units").join(removed, same, "left").select(
            "doc_id", "n_units", F.size(spans).cast("long").alias("n_removed"),
            F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"]).alias("removed_chars"),
            spans.alias("spans"))

    return settled(ready(documents.sparkSession), "repeated-units", found)


def _without(text: str, spans: list[dict]) -> str:
    """The rest of a text; with a unit goes the line break behind it, or before it at the end."""
    pieces, last = [], 0
    for span in spans:
        pieces.append(text[last:span["start"]])
        last = span["end"] + 1 if text[span["end"]:span["end"] + 1] == "\n" else span["end"]
    rest = "".join([*pieces, text[last:]])
    ended = bool(spans) and spans[-1]["end"] == len(text)
    return rest[:-1] if ended and rest.endswith("\n") else rest


def without_repeated_units(documents: DataFrame, between: str = LINES, least_words: int = LEAST_WORDS) -> DataFrame:
    """The documents without the units to remove; all rows and columns stay, ``n_chars`` follows the new text."""

    def found() -> DataFrame:
        scanned = staged(_texts(documents).mapInArrow(_scan(between, least_words), _SCANNED), "units")
        return _removed(scanned).select(F.col("doc_id").alias("of_doc"), F.col("text_id").alias("of_text"), "spans")

    removed = settled(ready(documents.sparkSession), "units-to-remove", found)
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    rows = documents.select(row, F.col("doc_id").cast("long").alias("key_doc"), text_md5().alias("key_text"))
    rows = rows.join(
        removed, F.col("key_doc").eqNullSafe(F.col("of_doc")) & (F.col("key_text") == F.col("of_text")), "left")

    @F.udf("string", useArrow=True)
    def rest(text, spans):
        return text if text is None or not spans else _without(text, [dict(start=s["start"], end=s["end"]) for s in spans])

    rows = rows.withColumn("rest", rest(F.col("row.text"), "spans"))
    return rows.select(*[
        F.col("rest").alias(c) if c == "text" else F.length("rest").cast(t).alias(c) if c == "n_chars" else F.col(f"row.`{c}`")
        for c, t in documents.dtypes])
