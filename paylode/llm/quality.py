"""Quality rules: statistics per document, and an isolation forest on them.

The base rules are fixed limits.  Documents that pass them are judged by how few random splits set them apart:
each tree draws a feature and a cut within its rows' range, again and again; a document that ends up alone after
few splits is anomalous.  Each of ``TREES`` trees grows on ``ROWS_PER_TREE`` documents of its own, drawn from all
passing ones by a hash of their id; every document goes through every tree.

The threshold comes from all labelled rows that pass the base rules: from a histogram of their scores by
label, that cut is taken which loses at most ``MOST_GOOD_LOST`` of the good ones and catches the most bad ones.
Without labels of both kinds no document is rejected by the forest.

Defined results: null and empty texts have no words and fail the base rules.  A null or missing label teaches
nothing; of several labels of an id the smallest counts.  Rows without an id are judged like others.
Repeated rows are judged alike.  Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylode.llm import hashing
from paylode.llm.common import hash_sample, ready, slices
from paylode.llm.hashing import U64, mix
from paylode.session import settled, staged

RUN = 8
TREES = 200
ROWS_PER_TREE = 256
MOST_GOOD_LOST = 0.005
BINS = 2_000

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
MARK = np.zeros(256, bool)
MARK[list(b"!?#*$%&|<>{}[]()=+^~@\\/_\"")] = True

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks",
           "n_adjacent")
_STATISTICS = "doc_id long, " + ", ".join(f"{name} long" for name in _COUNTS)

#: Shares that clean texts reach as well: only what goes beyond them sets a document apart.
USUAL_DUP_LINES = 0.3
USUAL_REPEATS = 0.2
USUAL_ADJACENT = 0.1
USUAL_UPPER = 0.15
USUAL_MARKS = 0.05
USUAL_WORD_LENGTH = (3.0, 10.0)


def _dup_lines(text: str) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and lines with a word."""
    lines = [line for line in text.split("\n") if line.strip("\t\n\x0b\x0c\r ")]
    return len(lines) - len(set(lines)), len(lines)


def counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The statistics of every text, as whole numbers."""
    buffer, at = hashing.buffer_of(texts)
    found = hashing.words(buffer, at)
    n = len(texts)

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags)))
        return total[at[1:]] - total[at[:-1]]

    n_words = np.bincount(found.doc, minlength=n)
    first, hashes = hashing.runs(found, RUN, "repeat")
    keys = mix(hashes ^ mix(found.doc[first].astype(U64) + U64(1)))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    cover = np.zeros(len(found.doc) + 1, np.int64)
    np.add.at(cover, first[twice], 1)
    np.add.at(cover, first[twice] + RUN, -1)
    covered = np.cumsum(cover[:-1]) > 0
    adjacent = found.doc[1:][(found.hash[1:] == found.hash[:-1]) & (found.doc[1:] == found.doc[:-1])]
    lines = [_dup_lines(t) if t else (0, 0) for t in texts.to_pylist()]
    return {
        "n_words": n_words,
        "word_chars": per_text(((buffer & 0xC0) != 0x80) & ~hashing.SPACE[buffer]),
        "n_symbols": per_text(SYMBOL[buffer]),
        "n_dup_lines": np.array([d for d, _ in lines], np.int64),
        "n_repeat_words": np.bincount(found.doc[covered], minlength=n),
        "n_lines": np.array([k for _, k in lines], np.int64),
        "n_upper": per_text(UPPER[buffer]),
        "n_marks": per_text(MARK[buffer]),
        "n_adjacent": np.bincount(adjacent, minlength=n),
    }


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            found = counts(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(found[c].astype(np.int64)) for c in _COUNTS)], names=["doc_id", *_COUNTS])


def statistics(documents: DataFrame) -> DataFrame:
    """The counts of every document, and ``base_failed``."""
    ready(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_measure, _STATISTICS)
    return rows.withColumn("base_failed", F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words"))


def features(rows: dict[str, np.ndarray]) -> np.ndarray:
    """How far each rule's share goes beyond what is usual; shares, so that length alone is no anomaly."""
    words, chars = np.maximum(rows["n_words"], 1), np.maximum(rows["word_chars"], 1)
    length, (short, long_) = rows["word_chars"] / words, USUAL_WORD_LENGTH
    return np.stack([
        rows["n_symbols"] / chars, np.maximum(0, rows["n_adjacent"] / words - USUAL_ADJACENT),
        np.maximum(0, rows["n_dup_lines"] / np.maximum(rows["n_lines"], 1) - USUAL_DUP_LINES),
        np.maximum(0, rows["n_repeat_words"] / words - USUAL_REPEATS),
        np.maximum(0, rows["n_upper"] / chars - USUAL_UPPER), np.maximum(0, rows["n_marks"] / chars - USUAL_MARKS),
        np.maximum(0, short - length) + np.maximum(0, length - long_)], axis=1)


class Tree(NamedTuple):
    feature: np.ndarray    # -1 in a leaf
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray      # expected path length in a leaf


def _expected(n: int) -> float:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def grow(rows: np.ndarray, rng: np.random.Generator) -> Tree:
    nodes: list[list] = []
    limit = int(np.ceil(np.log2(max(2, len(rows)))))

    def split(some: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([-1, 0.0, -1, -1, depth + _expected(len(some))])
        low, high = some.min(axis=0), some.max(axis=0)
        wide = np.flatnonzero(high > low)
        if depth < limit and len(wide):
            feature = int(rng.choice(wide))
            cut = float(rng.uniform(low[feature], high[feature]))
            below = some[:, feature] <= cut
            if below.any() and not below.all():
                nodes[me][:2] = feature, cut
                nodes[me][2] = split(some[below], depth + 1)
                nodes[me][3] = split(some[~below], depth + 1)
        return me

    split(rows, 0)
    f, c, left, right, d = zip(*nodes)
    return Tree(np.array(f), np.array(c), np.array(left), np.array(right), np.array(d))


class Forest(NamedTuple):
    trees: list[Tree]
    scale: float


def plant(sample: np.ndarray, trees: int = TREES, rows_per_tree: int = ROWS_PER_TREE) -> Forest:
    """Trees of rows of their own, in the sample's order; a sample that is too small for that is drawn from again."""
    rng = np.random.Generator(np.random.PCG64(23))
    size = min(rows_per_tree, len(sample))

    def rows_of(tree: int) -> np.ndarray:
        if len(sample) >= trees * size:
            return sample[tree * size:(tree + 1) * size]
        return sample[rng.choice(len(sample), size, replace=False)]

    grown = [grow(rows_of(tree), rng) for tree in range(trees)] if size else []
    return Forest(grown, max(_expected(size), 1.0))


def anomaly(forest: Forest, rows: np.ndarray) -> np.ndarray:
    """0 to 1; the shorter the mean path, the higher."""
    if not forest.trees or not len(rows):
        return np.zeros(len(rows))
    total = np.zeros(len(rows))
    for tree in forest.trees:
        at = np.zeros(len(rows), np.int64)
        moving = np.flatnonzero(tree.feature[at] >= 0)
        while len(moving):
            node = at[moving]
            goes_left = rows[moving, tree.feature[node]] <= tree.cut[node]
            at[moving] = np.where(goes_left, tree.left[node], tree.right[node])
            moving = moving[tree.feature[at[moving]] >= 0]
        total += tree.depth[at]
    return np.exp2(-total / len(forest.trees) / forest.scale)


def _judge(shared):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {c: batch.column(c).to_numpy() for c in _COUNTS}
            scores = anomaly(shared.value, features(rows))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, "anomaly"])

    return judge


def _threshold(good: np.ndarray, bad: np.ndarray) -> float:
    """The lowest bin from which on at most ``MOST_GOOD_LOST`` of the good rows are lost; none without both kinds."""
    if not good.sum() or not bad.sum():
        return float("inf")
    lost = np.concatenate((np.cumsum(good[::-1])[::-1], [0])) / good.sum()
    return float(np.argmax(lost <= MOST_GOOD_LOST)) / BINS


def judged(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The statistics of every document with ``anomaly``, ``threshold`` and ``kept``."""
    return settled(ready(documents.sparkSession), "quality", lambda: _judged(documents, labels))


def _judged(documents: DataFrame, labels: DataFrame) -> DataFrame:
    spark = documents.sparkSession
    rows = staged(statistics(documents), "quality-statistics")
    passing = rows.where("not base_failed")
    sample = hash_sample(passing, TREES * ROWS_PER_TREE, passing.count(), "doc_id", *_COUNTS).select(*_COUNTS).toArrow()
    forest = plant(features({c: sample.column(c).to_numpy() for c in _COUNTS}))
    shared = spark.sparkContext.broadcast(forest)
    fields = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    scored = staged(rows.mapInArrow(_judge(shared), f"{fields}, anomaly double"), "quality-scores")
    marked = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    bins = scored.where("not base_failed").join(marked, "doc_id").groupBy(
        F.least(F.floor(F.col("anomaly") * BINS), F.lit(BINS - 1)).alias("bin")).agg(
        F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad")).collect()
    good, bad = np.zeros(BINS, np.int64), np.zeros(BINS, np.int64)
    for row in bins:  # a row per bin
        good[row["bin"]], bad[row["bin"]] = row["good"], row["bad"]
    threshold = _threshold(good, bad)
    return scored.withColumn("threshold", F.lit(threshold)).withColumn(
        "kept", ~F.col("base_failed") & (F.col("anomaly") < threshold))
