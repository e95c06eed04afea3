"""Spelling variants: words one edit apart, found by Bloom-guided neighbourhoods.

Every word's neighbours are generated, not searched for: the words that a deletion, or another letter in one
place, makes of it.  (What an insertion makes has the word among its own deletions, and of two words that differ
in a letter the one with the smaller letter asks, so each pair is found once.)  Each generated word's hash is
probed against a broadcast blocked Bloom filter of the words of its length; only what passes is spelt out and
shuffled to an exact join with the vocabulary, which removes the false positives.

Bounds: the filters of all lengths have 16 bits a word and ``MOST_BYTES`` at most, whatever the vocabulary; a
larger one only sends more to the join.  A hash is a sum over letters, so a neighbour's hash is its word's, less
one letter's part; a word has up to 90 neighbours for each of its letters, taken in pieces of ``PIECE``.  Words
are counted in tasks before the shuffle, so frequent ones are a row per task.

Defined results: words are runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z in lower case.  Null and empty texts have
none.  Rows with one id are different documents; a null id counts as an empty one in the damage's hash.  Further
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylode.llm import hashing
from paylode.llm.common import ready, slices
from paylode.llm.hashing import U64, mix
from paylode.session import settled, staged

LEAST_LETTERS = 6
LEAST_COUNT = 5
RATIO = 5           # a form is at least so many times as frequent
DAMAGE = 199
BITS_PER_KEY = 16
MOST_BYTES = 32 << 20
PIECE = 1 << 19
_HELD = 200_000
_RUN = re.compile(rb"(?:[a-z]++|(?:\xc3[\x80-\xbf])++)++")
_VALUE = hashing.VALUE
_LANES = hashing.constants("spelling", 8)


def _unlettered(word: bytes, crc: int) -> bytes:
    text = word.decode()
    at = crc % len(text)
    return (text[:at] + text[at + 1:]).encode()


def _count(damage: int, least_letters: int):
    """Words of a task with their counts, a part of them at a time."""

    def packed(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for part in slices(batch, "text"):
                for doc, text in zip(part.column("doc").to_pylist(), part.column("text")):
                    if text.as_py() is None:
                        continue
                    prefix = zlib.crc32(f"{doc}:".encode())
                    runs = _RUN.finditer(text.as_buffer().to_pybytes().lower())
                    for word, n in Counter(m[0] for m in runs).items():
                        if len(word) >= least_letters:
                            crc = zlib.crc32(word, prefix)
                            if damage and crc % damage == 0:
                                word = _unlettered(word, crc)
                            counts[word] += n
                if len(counts) > _HELD:
                    yield packed(counts)
                    counts = Counter()
        yield packed(counts)

    return count


def vocabulary(documents: DataFrame, damage: int = 0, least_letters: int = LEAST_LETTERS,
               least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough; ``damage`` deletes a letter of one run in so many."""
    texts = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), "text")
    counted = texts.mapInArrow(_count(damage, least_letters), "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).select(F.col("word").cast("string").alias("word"), "n").where(
        (F.char_length("word") >= least_letters) & (F.col("n") >= least_count))


class Filters:
    """A blocked filter for each length of words, in one array of blocks of eight 64-bit words."""

    def __init__(self, sizes: dict[int, int]):
        wanted = {length: -(-n * BITS_PER_KEY // 512) for length, n in sizes.items()}
        share = min(1.0, MOST_BYTES / 64 / max(1, sum(wanted.values())))
        # Lengths beyond the bound of blocks share the last one.
        self.longest = max(sizes, default=0)
        self.blocks = np.zeros(self.longest + 2, np.int64)
        for length, n in wanted.items():
            self.blocks[length] = max(1, int(n * share))
        self.first = np.concatenate(([0], np.cumsum(self.blocks)))[:-1]
        self.n_blocks = int(self.blocks.sum())
        self.words = np.zeros((max(1, self.n_blocks), 8), U64)

    def place(self, hashes: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        return self.first[length] + ((hashes >> U64(32)) % self.blocks[length].astype(U64)).astype(np.int64)

    def passed(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """Which of the hashes may be of words of that length; most are out after one or two of the eight words."""
        if not 0 < length <= self.longest or not self.blocks[length]:
            return np.zeros(0, np.int64)
        left = np.arange(len(hashes))
        block = self.place(hashes, np.int64(length))
        for lane in range(8):
            bit = (hashes[left] * _LANES[lane]) >> U64(58)
            left = left[(self.words[block[left], lane] >> bit) & U64(1) == 1]
        return left


def _letters(words: list[str]) -> np.ndarray:
    """Words of one length as rows of code points; all are below 256."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def _parts(letters: np.ndarray) -> np.ndarray:
    return _VALUE[letters] * hashing._powers_of(hashing._BASE, letters.shape[1])


def word_hashes(words: list[str]) -> np.ndarray:
    out = np.zeros(len(words), U64)
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        out[at] = mix(_parts(_letters([words[i] for i in at])).sum(axis=1, dtype=U64))
    return out


def _set_bits(filters: Filters):
    """Of a task's words, the bits of each block that they set."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            hashes = word_hashes(words)
            block = filters.place(hashes, np.array([len(w) for w in words], np.int64)) if words else np.zeros(0, np.int64)
            order = np.argsort(block, kind="stable")
            bits = U64(1) << ((hashes[order][:, None] * _LANES) >> U64(58))
            first = hashing.firsts(block[order])
            joined = np.bitwise_or.reduceat(bits, first, axis=0) if len(first) else bits
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[order][first]), *(pa.array(np.ascontiguousarray(joined[:, j]).view(np.int64)) for j in range(8))],
                names=["block", *(f"w{j}" for j in range(8))])

    return build


def build_filters(words: DataFrame) -> Filters:
    """Filters of the column ``word``; the driver holds at most ``MOST_BYTES`` of blocks, and a size per length."""
    sizes = {r.length: r["count"] for r in words.groupBy(F.char_length("word").alias("length")).count().collect()}
    filters = Filters(sizes)
    names = [f"w{j}" for j in range(8)]
    rows = words.select("word").mapInArrow(_set_bits(filters), "block long, " + ", ".join(f"{n} long" for n in names))
    rows = rows.groupBy("block").agg(*[F.expr(f"bit_or({n})").alias(n) for n in names]).toArrow()
    block = rows.column("block").to_numpy()
    for j, name in enumerate(names):
        filters.words[block, j] = rows.column(name).to_numpy().astype(np.int64, copy=False).view(U64)
    return filters


def neighbours(words: list[str], filters: Filters, alphabet: np.ndarray) -> Iterator[tuple[int, str]]:
    """``(index, neighbour)`` for words of one length, of the deletions and larger letters that pass the filters."""
    letters = _letters(words)
    n, length = letters.shape
    parts = _parts(letters)
    total = parts.sum(axis=1, dtype=U64)
    ahead = np.cumsum(parts, axis=1, dtype=U64) - parts
    inverse = U64(hashing._INVERSE)
    powers = hashing._powers_of(hashing._BASE, length)
    step = max(1, PIECE // (n * max(1, len(alphabet))))
    for start in range(0, length, step):
        where = slice(start, min(length, start + step))
        own = letters[:, where]
        # Deleting any of equal neighbours makes the same word: the first stands for them.
        fresh = np.ones(own.shape, bool)
        lower = max(start, 1)
        fresh[:, lower - start:] = letters[:, lower:where.stop] != letters[:, lower - 1:where.stop - 1]
        row, column = np.nonzero(fresh)
        at = column + start
        hashes = mix(ahead[row, at] + (total[row] - ahead[row, at] - parts[row, at]) * inverse)
        for i in filters.passed(hashes, length - 1):
            word = words[row[i]]
            yield int(row[i]), word[:at[i]] + word[at[i] + 1:]
        larger = alphabet[None, None, :] > own[:, :, None]
        row, column, which = np.nonzero(larger)
        at, new = column + start, alphabet[which]
        hashes = mix(total[row] - parts[row, at] + _VALUE[new] * powers[at])
        for i in filters.passed(hashes, length):
            word = words[row[i]]
            yield int(row[i]), word[:at[i]] + chr(new[i]) + word[at[i] + 1:]


def _probe(shared):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, alphabet = shared.value
        for batch in batches:
            for start in range(0, len(batch), 4_096):
                part = batch.slice(start, 4_096)
                words = np.array(part.column("word").to_pylist(), object)
                counts = part.column("n").to_numpy()
                lengths = np.array([len(w) for w in words], np.int64)
                at, found = [], []
                for length in np.unique(lengths):
                    rows = np.flatnonzero(lengths == length)
                    # The letters of a piece are bounded too, not only its neighbours.
                    width = max(1, PIECE // int(length))
                    for k in range(0, len(rows), width):
                        own = rows[k:k + width]
                        for i, word in neighbours(list(words[own]), filters, alphabet):
                            at.append(own[i])
                            found.append(word)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words[at].tolist(), pa.string()), pa.array(counts[at]), pa.array(found, pa.string())],
                    names=["word", "n", "near"])

    return probe


def near_words(words: DataFrame) -> DataFrame:
    """``word, n, near, near_n``: both directions of every pair one edit apart, of a table of different words."""
    spark: SparkSession = words.sparkSession
    used = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).distinct()
    alphabet = np.array(sorted(ord(r.letter) for r in used.collect() if r.letter), np.uint8)  # 90 at most
    shared = spark.sparkContext.broadcast((build_filters(words), alphabet))
    asked = words.mapInArrow(_probe(shared), "word string, n long, near string")
    pairs = staged(asked.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near"), "near-words")
    shared.unpersist()
    return pairs.select("word", "n", "near", "near_n").union(pairs.select("near", "near_n", "word", "n"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``word, form``: forms grow at least ``RATIO``-fold, so doubling ends after a few rounds."""
    current = staged(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = current.select(F.col("word").alias("of"), F.col("root").alias("next"))
        if current.join(further, F.col("root") == F.col("of"), "left_semi").isEmpty():
            return current
        current = staged(current.join(further, F.col("root") == F.col("of"), "left").select(
            "word", F.coalesce("next", "root").alias("root")), "forms")


def variants(documents: DataFrame, damage: int = 0, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT,
             ratio: int = RATIO) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every word that is long and frequent enough."""

    def build() -> DataFrame:
        words = staged(vocabulary(documents, damage, least_letters, least_count), "vocabulary")
        best = near_words(words).groupBy("word", "n").agg(
            F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
        strong = -F.col("best.less") >= ratio * F.col("n")
        best = staged(best.select("word", "n_near", F.when(strong, F.col("best.near")).alias("form"),
                                  F.when(strong, -F.col("best.less")).alias("form_n")), "best-words")
        roots = _roots(best.where("form is not null"))
        return words.join(best, "word", "left").join(roots, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n",
            F.coalesce("root", "word").alias("root"))

    return settled(ready(documents.sparkSession), "spelling-variants", build)
