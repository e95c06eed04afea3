"""URL filters: a blocked Bloom filter of listed keys, and an exact join behind it.

Two lists are held against every URL: rules (a host and the start of a path) and canonical URLs (host and path
without closing slashes).  A URL's possible keys are its canonical form and, for each of its host and parent
domains, the starts of its path of the lengths that rules have.  The filter passes keys that may be listed, a
small part; those go to a hash join with the list, which removes the false positives.  So most URLs are never
shuffled with a key.

Work is per different URL, so a URL that makes up a third of the rows is one.  Defined results: URLs that are
null or have no ``://`` have empty host and path, fit no rule and are not listed.  Repeated rows are judged
alike.  Of rules of equal length the one with the longer host wins, of equal rules the one that blocks.  Rules
with a null host or path are ignored.  Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylode.llm import bloom
from paylode.llm.common import ready
from paylode.session import staged

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: str = "url") -> Column:
    return F.translate(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path(url: str = "url") -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(host_: Column, path_: Column) -> Column:
    return F.concat(host_, F.regexp_replace(path_, "/+$", ""))


def _probe(shared):
    """Of each URL's keys, those that the filter passes."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            lists = batch.column("hashes")
            owner = np.repeat(np.arange(len(batch)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            hashes = lists.flatten().to_numpy()
            some = np.flatnonzero(bloom.passed(words, hashes))
            yield pa.RecordBatch.from_arrays(
                [batch.column("url").take(pa.array(owner[some])),
                 batch.column("keys").flatten().take(pa.array(some))], names=["url", "key"])

    return probe


def judge(pages: DataFrame, rules: DataFrame, listed: DataFrame) -> DataFrame:
    """``page_id, host, path, rule, verdict``.

    ``rules`` has ``host, path, verdict``, ``listed`` has ``url`` (canonical) of pages to block.  A rule's verdict
    comes first; a URL without a rule is blocked if its canonical form is listed.
    """
    spark = ready(pages.sparkSession)
    rules = rules.where("host is not null and path is not null").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    exact = rules.select(F.concat(F.lit("r:"), "host", "path").alias("key"), F.concat("host", "path").alias("rule"),
                         F.length("host").alias("host_length"), "verdict")
    urls_ = listed.where("url is not null").select(F.concat(F.lit("u:"), "url").alias("key")).distinct().select(
        "key", F.lit(None).cast("string").alias("rule"), F.lit(0).alias("host_length"), F.lit("block").alias("verdict"))
    exact = staged(exact.union(urls_), "url-keys")
    # Lengths of rules' paths: as many as a path can have characters, not as there are rules.
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect())
    shared = spark.sparkContext.broadcast(bloom.build(exact, "key"))

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url")
    parts = rows.where("url like '%://%'").select("url").distinct().select("url", host().alias("host"), path().alias("path"))
    names = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(names)), lambda i: F.array_join(F.slice(names, i, F.size(names)), "."))
    starts = F.filter(F.array(*[F.lit(n).cast("int") for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path"))
    keys = F.flatten(F.transform(parents, lambda h: F.transform(
        starts, lambda n: F.concat(F.lit("r:"), h, F.substring(F.col("path"), F.lit(1), n)))))
    own = F.array(F.concat(F.lit("u:"), canonical(F.col("host"), F.col("path"))))
    keyed = parts.select("url", F.concat(keys, own).alias("keys"))
    keyed = keyed.select("url", "keys", F.transform("keys", lambda k: F.xxhash64(k)).alias("hashes"))
    possible = keyed.mapInArrow(_probe(shared), "url string, key string")
    best = F.struct(F.length("rule").alias("length"), "host_length", "rule", "verdict")
    found = possible.join(exact, "key").groupBy("url").agg(
        F.max(F.when(F.col("rule").isNotNull(), best)).alias("best"), F.max(F.col("rule").isNull()).alias("listed"))
    found = found.select(F.col("url").alias("found_url"), F.col("best.rule").alias("rule"), F.coalesce(
        "best.verdict", F.when(F.col("listed"), F.lit("block"))).alias("verdict"))
    out = rows.join(found, F.col("url") == F.col("found_url"), "left")
    return out.select("page_id", host().alias("host"), path().alias("path"), "rule",
                      F.coalesce("verdict", F.lit("allow")).alias("verdict"))
