"""A blocked Bloom filter of a table's keys, to leave most rows out before a join.

It has 16 bits per key in blocks of 512 bits, of which a key sets eight, one per 64-bit word of its block, and
at most ``MOST_BYTES``: that is what the driver and the tasks hold, however long the list.  A longer list only
raises the share of false positives that the join behind the filter has to remove.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylode.llm import hashing
from paylode.llm.hashing import U64, mix

BITS_PER_KEY = 16
MOST_BYTES = 16 << 20
_WORDS = 8               # of 64 bits in a block
_LANES = hashing.constants("bloom", _WORDS)


def spots(hashes: np.ndarray, n_blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Each key's block, and the bits that it sets there, one per word."""
    mixed = mix(hashes.view(U64))
    block = (mixed >> U64(32)) % U64(n_blocks)
    return block.astype(np.int64), U64(1) << ((mixed[:, None] * _LANES) >> U64(58))


def passed(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each key may be in the filter."""
    block, bits = spots(hashes, len(words))
    return ((words[block] & bits) == bits).all(axis=1)


def _build(n_blocks: int):
    """Of a task's keys, the words of each block that they touch."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, bits = spots(batch.column("hash").to_numpy(), n_blocks)
            order = np.argsort(block, kind="stable")
            block, bits = block[order], bits[order]
            first = hashing.firsts(block)
            joined = np.bitwise_or.reduceat(bits, first, axis=0) if len(first) else bits
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[first]), *(pa.array(np.ascontiguousarray(joined[:, j]).view(np.int64)) for j in range(_WORDS))],
                names=["block", *(f"w{j}" for j in range(_WORDS))])

    return build


def build(keys: DataFrame, key: str, hashed: bool = False) -> np.ndarray:
    """The filter of a column: a row of eight words per block.  ``hashed`` columns are 64-bit hashes already."""
    n_blocks = max(1, min(MOST_BYTES // 64, -(-keys.count() * BITS_PER_KEY // 512)))
    names = [f"w{j}" for j in range(_WORDS)]
    rows = keys.select((F.col(key) if hashed else F.xxhash64(key)).alias("hash")).mapInArrow(
        _build(n_blocks), "block long, " + ", ".join(f"{n} long" for n in names))
    # At most a row per block.
    rows = rows.groupBy("block").agg(*[F.expr(f"bit_or({n})").alias(n) for n in names]).toArrow()
    words = np.zeros((n_blocks, _WORDS), U64)
    block = rows.column("block").to_numpy()
    for j, name in enumerate(names):
        words[block, j] = rows.column(name).to_numpy().astype(np.int64, copy=False).view(U64)
    return words


def may_be_in(keys: DataFrame, key: str, column: str) -> Column:
    """A condition on ``column``: true for every key of the table, false for most other values."""
    shared = keys.sparkSession.sparkContext.broadcast(build(keys, key))

    @F.pandas_udf("boolean")
    def probe(hashes: pd.Series) -> pd.Series:
        return pd.Series(passed(shared.value, hashes.to_numpy(np.int64)))

    return probe(F.xxhash64(column))
