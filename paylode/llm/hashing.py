"""Words and byte strings of many texts at once as 64-bit numbers, in numpy.

A text column's bytes lie in one buffer, so words are found and hashed for a whole slice of documents
without a Python loop over words.  A hash is a polynomial over random 64-bit values of the bytes, modulo
2**64, with a mixing step behind it.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: The words of all contracts: ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.Generator(np.random.PCG64(0x5EED))
VALUE = _rng.integers(1, 2**64, 256, dtype=U64) | U64(1)
VALUE_LOWER = VALUE[LOWER]
_BASE = 0x9E3779B97F4A7C15 & ~7 | 5
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    held = _powers.get(base)
    if held is None or len(held) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        factors = np.full(size, base, U64)
        factors[0] = 1
        held = _powers[base] = np.multiply.accumulate(factors)
    return held[:n]


def constants(name: str, n: int) -> np.ndarray:
    """``n`` odd 64-bit multipliers that depend on the name alone."""
    seed = int.from_bytes(name.encode(), "little")
    return np.random.Generator(np.random.PCG64(seed)).integers(1, 2**64, n, dtype=U64) | U64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit reaches every output bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary array, and where each value begins (one more entry for the end)."""
    if texts.null_count:
        texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    if at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def prefix_sums(buffer: np.ndarray, values: np.ndarray = VALUE) -> np.ndarray:
    sums = np.zeros(len(buffer) + 1, U64)
    np.cumsum(values[buffer] * _powers_of(_BASE, len(buffer)), out=sums[1:])
    return sums


def window_hashes(sums: np.ndarray, starts: np.ndarray | slice, ends: np.ndarray | slice) -> np.ndarray:
    """Unmixed hashes of ``[start, end)``, from prefix sums."""
    return (sums[ends] - sums[starts]) * _powers_of(_INVERSE, len(sums))[starts]


class Words(NamedTuple):
    doc: np.ndarray      # index of the text
    start: np.ndarray    # first byte, in the buffer
    end: np.ndarray      # byte after the last
    hash: np.ndarray


def bounds(buffer: np.ndarray, at: np.ndarray, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """First byte and byte after the last of every word of every text: bytes without a gap, which never reach into the next text."""
    solid = ~gaps[buffer]
    begins, finishes = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    finishes[:-1] &= ~solid[1:]
    inner = at[1:-1]
    edge = inner[(inner > 0) & (inner < len(buffer))]
    begins[edge] = solid[edge]
    finishes[edge - 1] = solid[edge - 1]
    return np.flatnonzero(begins), np.flatnonzero(finishes) + 1


def words(buffer: np.ndarray, at: np.ndarray, lower: bool = False, gaps: np.ndarray = SPACE) -> Words:
    """Every word of every text, in order."""
    if not len(buffer):
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(0, U64))
    start, end = bounds(buffer, at, gaps)
    hashes = mix(window_hashes(prefix_sums(buffer, VALUE_LOWER if lower else VALUE), start, end))
    return Words(np.searchsorted(at, start, "right") - 1, start, end, hashes)


def runs(found: Words, length: int, name: str) -> tuple[np.ndarray, np.ndarray]:
    """``(first word, hash)`` of every run of ``length`` words that lies within one text."""
    n = len(found.doc) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    factors = constants(name, length)
    total = found.hash[:n] * factors[0]
    for j in range(1, length):
        total += found.hash[j:j + n] * factors[j]
    first = np.flatnonzero(found.doc[:n] == found.doc[length - 1:])
    return first, mix(total[first])


def firsts(groups: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins in a sorted array."""
    if not len(groups):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
