"""Mixing sources to target weights by balanced sampling with the cube method.

A source's target over its size is how often each of its documents is taken: the whole part for certain,
the rest as an inclusion probability.  The flight phase moves the probabilities of three documents at a
time along a direction that changes neither the number of documents nor the number of words, until one of
them is 0 or 1; the direction's sign is drawn so that each keeps its expectation.  Documents go from the
longest to the shortest.

The flight runs in blocks of about ``BLOCK`` documents of one source, chosen by a hash; a hot source has many
blocks.  Each block leaves two open documents at most, which form the blocks of the next level, until a
source has one block.  From that block ``RESERVED`` documents, spread over its sizes, wait until the flight is
over; they and the last two open ones are the landing problem, which is solved by trying every rounding and
taking the one nearest to the balance of words and documents.  Draws depend on keys only, so reruns agree.

Defined results: null and empty texts have size 0, and are never a reason to take words.  A null source is
a source of its own, the last in order.  A source of size 0 has target 0.  Repeated rows are drawn one by
one.  Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylode.llm.common import ready, text_md5
from paylode.session import settled, staged

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
BLOCK = 2_000
RESERVED = 12
EPSILON = 1e-9


def _step(p: np.ndarray, some: list[int], direction: tuple[float, ...], draw: float) -> None:
    """Move along the direction, or against it, as far as the probabilities allow."""
    up = down = np.inf
    for i, u in zip(some, direction):
        if u > 0:
            up, down = min(up, (1 - p[i]) / u), min(down, p[i] / u)
        elif u < 0:
            up, down = min(up, p[i] / -u), min(down, (1 - p[i]) / -u)
    far = up if draw * (up + down) < down else -down
    for i, u in zip(some, direction):
        value = p[i] + far * u
        p[i] = 0.0 if value < EPSILON else 1.0 if value > 1 - EPSILON else value


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator, land: bool) -> np.ndarray:
    """New probabilities of documents sorted by size: 0 or 1 but for two at most, and for none if ``land``."""
    p, open_ = p.astype(float).copy(), []
    wait = set(np.linspace(0, len(p) - 1, min(RESERVED, len(p))).astype(int).tolist()) if land else set()
    for i in range(len(p)):
        if i not in wait and EPSILON < p[i] < 1 - EPSILON:
            open_.append(i)
        while len(open_) == 3:
            a, b, c = (float(size[k]) for k in open_)
            direction = (b - c, c - a, a - b)
            _step(p, open_, direction if any(direction) else (1.0, -1.0, 0.0), rng.random())
            open_ = [k for k in open_ if EPSILON < p[k] < 1 - EPSILON]
    if land:
        last = np.array(sorted({*open_, *wait}), int)
        last = last[(p[last] > EPSILON) & (p[last] < 1 - EPSILON)]
        if len(last):
            p[last] = landing(p[last], size[last].astype(float))
    return p


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The rounding nearest to the balance: words first, then a document more or less."""
    choices = (np.arange(1 << len(p))[:, None] >> np.arange(len(p))) & 1
    words = np.abs(choices @ size - p @ size)
    documents = np.abs(choices.sum(axis=1) - p.sum())
    return choices[np.argmin(words + np.maximum(0, documents - 1) * 0.1 * size.mean())].astype(float)


_KEY = ["source", "doc_id", "digest", "nth"]
_UNIT = "source string, doc_id long, digest binary, nth int, size long, p double, n_blocks long, block long"


def _fly(level: int):
    def fly(block: pd.DataFrame) -> pd.DataFrame:
        order = np.lexsort((block["nth"], block["digest"].map(bytes), block["doc_id"].fillna(-1), -block["size"]))
        block = block.iloc[order]
        source = block["source"].iloc[0]
        seed = zlib.crc32(repr((level, source, int(block["block"].iloc[0]))).encode())
        p = flight(block["p"].to_numpy(), block["size"].to_numpy(), np.random.Generator(np.random.PCG64(seed)),
                   bool(block["n_blocks"].iloc[0] == 1))
        return block.assign(p=p)

    return fly


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target`` from ``source, size``: one row per source.

    Shares go by weight; a source stops at ``MOST`` times its size.  With the sources in the order of cap over
    weight the capped ones come first, so the level of the others follows from running sums.  Only the table
    of sources, a row each, is ordered as a whole.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    named = totals.withColumn("weight", weights[((F.row_number().over(by_name) - 1) % len(WEIGHTS))]).withColumn(
        "cap", F.col("source_size") * MOST)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    ranked = named.withColumn("rank", F.row_number().over(by_ratio)).withColumn(
        "level", (F.sum("source_size").over(everything) * SHARE - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / F.sum("weight").over(onward))
    fits = F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.col("rank"))
    level = F.min_by("level", fits).over(everything)
    return ranked.select(
        "source", "source_size", F.least("cap", F.coalesce(level, F.lit(float("inf"))) * F.col("weight")).alias("target"))


def _keyed(documents: DataFrame, *more) -> DataFrame:
    """Rows with a key that tells repeated rows apart."""
    rows = documents.select(
        F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"),
        text_md5().alias("digest"), *more)
    again = Window.partitionBy("source", "doc_id", "digest").orderBy(F.lit(0))
    return rows.withColumn("nth", F.row_number().over(again))


def draws(documents: DataFrame) -> DataFrame:
    """``source, doc_id, digest, nth, size, source_size, target, copies, taken``: a row per document."""
    return settled(ready(documents.sparkSession), "draws", lambda: _draws(documents))


def _draws(documents: DataFrame) -> DataFrame:
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    sized = staged(_keyed(documents, size.alias("size")), "sizes")
    aims = staged(targets(sized), "targets")
    aim = aims.withColumnRenamed("source", "aim_source")
    rows = sized.join(aim, sized["source"].eqNullSafe(aim["aim_source"])).drop("aim_source")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = rows.withColumn("sure", F.floor(ratio + EPSILON).cast("long")).withColumn(
        "p", F.greatest(F.lit(0.0), ratio - F.col("sure")))

    open_ = rows.where((F.col("p") > EPSILON) & (F.col("size") > 0)).select(*_KEY, "size", "p")
    drawn, level = None, 0
    while True:
        blocks = open_.groupBy(F.col("source").alias("block_source")).agg(
            F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("n_blocks"))
        dealt = open_.join(blocks, open_["source"].eqNullSafe(blocks["block_source"])).withColumn(
            "block", F.pmod(F.xxhash64("doc_id", "digest", "nth", F.lit(level)), "n_blocks"))
        flown = staged(dealt.select(*_KEY, "size", "p", "n_blocks", "block").groupBy("source", "block").applyInPandas(
            _fly(level), _UNIT), "flight")
        done = flown.where("p in (0, 1)").select(*_KEY, F.col("p").cast("long").alias("extra"))
        drawn = done if drawn is None else drawn.union(done)
        open_ = flown.where("p > 0 and p < 1").select(*_KEY, "size", "p")
        level += 1
        if open_.isEmpty():
            break
    picked = drawn.select(*[F.col(c).alias(f"_{c}") for c in _KEY], "extra")
    same = [rows[c].eqNullSafe(picked[f"_{c}"]) for c in _KEY]
    return rows.join(picked, same, "left").withColumn(
        "copies", F.col("sure") + F.coalesce("extra", F.lit(0))).select(
        *_KEY, "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(documents: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it is taken; all columns stay.

    Documents without a word have nothing that could be weighed and are left out.
    """
    chosen = draws(documents).where("size > 0 and copies > 0").select(
        *[F.col(c).alias(f"_{c}") for c in _KEY], "copies")
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    rows = _keyed(documents, row)
    rows = rows.join(chosen, [rows[c].eqNullSafe(chosen[f"_{c}"]) for c in _KEY])
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        *[F.col(f"row.`{c}`") for c in documents.columns])
