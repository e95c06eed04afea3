"""Language-model scores by a probabilistic suffix tree over words.

A state of the tree is a context: the last one to ``DEPTH`` words, of varying length.  A context is a candidate
if it makes up at least ``LEAST_SHARE`` of the training tokens.  It is kept if what follows it diverges from what
follows its parent (the context without its first word): the sum over its occurrences of the logarithm of the
two probabilities, each taken without that occurrence, must exceed ``DIVERGENCE``.  Ancestors of a kept context
stay, so the tree has no gaps.  A token is scored in the longest kept suffix of what precedes it.

A state's distribution is discounted by one and smoothed with its parent's: ``(n(w) - 1 + T * P(w | parent)) / n``
with T different followers, down to the root, ``(c + 1) / (N + V + 1)``.  The probabilities of all known words
and of one unknown add up to 1 in every state.  Followers seen once need no entry: theirs is ``T / n`` times the
parent's probability, like that of followers never seen.

Work: one scan of the texts for the words, one for each length of context and one to score.  A task adds up what
follows a context before the shuffle, which carries a row per context and task with its followers.  A context
with more than ``FOLLOWERS`` occurrences is dealt out by the follower's hash, so no group is unbounded.  Vocabulary
and followers cover all training documents and grow with them; they are joined, never collected.  What is
collected is bounded: candidates of one length, ``1 / LEAST_SHARE`` at most, and the ``HOT_ENTRIES`` and
``HOT_WORDS`` most frequent entries.  The scoring scan looks tokens up in those, excludes most others by a blocked
Bloom filter of at most 16 MB, and sends the rest to an exact join.

Words are 64-bit hashes of their lower-cased bytes.  Defined results: a null or empty text is its end alone.
Documents are rows: repeated rows count as often as they occur, and a null id is never held out.  Without any
training document every token has the probability 1.  Further columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylode.llm import bloom, hashing
from paylode.llm.common import ready, slices
from paylode.llm.hashing import U64, mix
from paylode.session import settled, staged

DEPTH = 3
LEAST_SHARE = 2.0 ** -18
LEAST_COUNT = 8          # in small tables
DIVERGENCE = 3.0         # natural logarithms, over all occurrences of a context
FOLLOWERS = 1 << 16
HOT_ENTRIES = 1 << 20
HOT_WORDS = 1 << 19
_TOGETHER = 1 << 20      # positions that a task adds up at once
_STEPS = hashing.constants("suffix-tree", DEPTH + 8)
_FOLLOWED = hashing.constants("followed-by", 2)
BEGIN, END = (int(x) for x in mix(hashing.constants("edges", 2)))
_HELD_OUT = 2


def held_out(column: str = "doc_id") -> Column:
    """Whether a document's hash leaves it out of the training."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 7 == _HELD_OUT, F.lit(False))


def symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' words, each text between ``BEGIN`` and ``END``, and where each text begins."""
    buffer, at = hashing.buffer_of(texts)
    found = hashing.words(buffer, at, lower=True)
    n = np.bincount(found.doc, minlength=len(texts)).astype(np.int64)
    begins = np.concatenate(([0], np.cumsum(n + 2)))
    out = np.empty(begins[-1], U64)
    out[begins[:-1]], out[begins[1:] - 1] = U64(BEGIN), U64(END)
    inner = np.arange(len(found.doc)) + 2 * found.doc + 1
    out[inner] = found.hash
    return out, begins


def longer(context: np.ndarray, symbol: np.ndarray, length: int) -> np.ndarray:
    """The hash of a context of ``length`` words from that of its last ``length - 1`` and the word before them."""
    return mix(context + symbol * _STEPS[length])


def entry_keys(context: np.ndarray, follower: np.ndarray) -> np.ndarray:
    return mix(context * _FOLLOWED[0] + follower * _FOLLOWED[1])


def word_keys(symbol: np.ndarray) -> np.ndarray:
    return entry_keys(np.zeros(1, U64), symbol)


def contexts_of(seq: np.ndarray, begins: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``seq`` that have ``length`` symbols of their text before them, and the hashes of those."""
    place = np.arange(len(seq)) - np.repeat(begins[:-1], np.diff(begins))
    at = np.flatnonzero(place >= length)
    context = np.zeros(len(at), U64)
    for k in range(1, length + 1):
        context = longer(context, seq[at - k], k)
    return at, context


class Index:
    """A sorted table of hashes with the beginnings of its buckets, which are as many as the table has rows or more."""

    def __init__(self, table: np.ndarray):
        bits = max(1, len(table).bit_length())
        self.shift = U64(64 - bits)
        self.begins = np.zeros((1 << bits) + 1, np.int32)
        np.cumsum(np.bincount((table >> self.shift).astype(np.int64), minlength=1 << bits), out=self.begins[1:])
        self.table = table

    def find(self, values: np.ndarray) -> np.ndarray:
        """Where each value is in the table; -1 if it is not there."""
        bucket = (values >> self.shift).astype(np.int64)
        at, end = self.begins[bucket], self.begins[bucket + 1]
        out = np.full(len(values), -1, np.int32)
        left = np.flatnonzero(at < end)
        while len(left):
            hit = self.table[at[left]] == values[left]
            out[left[hit]] = at[left[hit]]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < end[left]]
        return out


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0

    def packed():
        values, counts = np.unique(np.concatenate([np.zeros(0, U64), *held]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], names=["symbol", "n"])

    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            seq, begins = symbols(part.column("text"))
            held.append(seq)  # beginnings are counted as what precedes, not as tokens
            n += len(seq)
            if n > _TOGETHER:
                yield packed()
                held, n = [], 0
    yield packed()


_FOLLOWING = "context int, part int, followers binary, counts binary"


def _grouped(context: np.ndarray, part: np.ndarray, follower: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Rows of sorted arrays, one per context and part."""
    begin = np.flatnonzero(np.concatenate(([True], (context[1:] != context[:-1]) | (part[1:] != part[:-1])))) if len(context) else \
        np.zeros(0, np.int64)
    ends = np.append(begin[1:], len(context)) if len(begin) else begin
    offsets = np.concatenate((begin, ends[-1:])).astype(np.int32) if len(begin) else np.zeros(1, np.int32)
    blobs = [pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer((offsets * values.itemsize).tobytes()), pa.py_buffer(values.tobytes())])
             for values in (follower, counts.astype(np.uint32))]
    return pa.RecordBatch.from_arrays(
        [pa.array(context[begin].astype(np.int32)), pa.array(part[begin].astype(np.int32)), *blobs],
        names=["context", "part", "followers", "counts"])


def _follow(shared, length: int):
    """What follows the candidates of one length, added up over a task's texts."""

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, parts = shared.value
        index_of, held, n = Index(table), [], 0
        low = U64(max(1, len(table).bit_length()))  # bits of a follower that make room for the context's

        def packed():
            context = np.concatenate([np.zeros(0, np.int64), *(h[0] for h in held)])
            follower = np.concatenate([np.zeros(0, U64), *(h[1] for h in held)])
            order = np.argsort((context.astype(U64) << (U64(64) - low)) | (follower >> low))
            context, follower = context[order], follower[order]
            part = ((follower >> U64(40)).astype(np.int64) * parts[context]) >> 24  # grows with the follower
            new = np.ones(len(context), bool)
            new[1:] = (context[1:] != context[:-1]) | (follower[1:] != follower[:-1])
            first = np.flatnonzero(new)
            counts = np.diff(np.append(first, len(context)))
            return _grouped(context[first], part[first], follower[first], counts)

        for batch in batches:
            for piece in slices(batch, "text", 1 << 20):
                seq, begins = symbols(piece.column("text"))
                at, context = contexts_of(seq, begins, length)
                index = index_of.find(context)
                known = index >= 0
                held.append((index[known], seq[at[known]]))
                n += int(known.sum())
                if n > _TOGETHER:
                    yield packed()
                    held, n = [], 0
        yield packed()

    return follow


_ADDED = "context int, types long, n long, followers array<long>, counts array<long>"


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per context and part, of rows that come sorted by them; followers seen once are only counted."""
    key, blobs, out, size = None, [], [], 0

    def added():
        follower = np.frombuffer(b"".join(b for b, _ in blobs), U64)
        counts = np.frombuffer(b"".join(c for _, c in blobs), np.uint32).astype(np.int64)
        order = np.argsort(follower, kind="stable")
        first = hashing.firsts(follower[order])
        counts = np.add.reduceat(counts[order], first)
        again = counts > 1
        return key[0], len(first), int(counts.sum()), follower[order][first][again].view(np.int64), counts[again]

    def packed():
        columns = list(zip(*out)) or [[]] * 5
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          names=["context", "types", "n", "followers", "counts"])

    for batch in batches:
        for context, part, followers, counts in zip(*(batch.column(c).to_pylist() for c in ("context", "part", "followers", "counts"))):
            if (context, part) != key:
                if key is not None:
                    out.append(added())
                    size += len(out[-1][3])
                    if size > _TOGETHER or len(out) > 20_000:
                        yield packed()
                        out, size = [], 0
                key, blobs = (context, part), []
            blobs.append((followers, counts))
    if key is not None:
        out.append(added())
    yield packed()


@dataclass
class Level:
    """Candidates of one length, sorted by hash."""

    hashes: np.ndarray
    words: np.ndarray        # a row of symbols each, the earliest first
    counts: np.ndarray
    parents: np.ndarray      # places in the level before; -1 is the root
    types: np.ndarray | None = None
    kept: np.ndarray | None = None
    entries: DataFrame | None = None


@dataclass
class Tree:
    tokens: int = 0
    n_words: int = 0
    words: DataFrame | None = None      # symbol, n
    levels: list[Level] = field(default_factory=list)

    @property
    def floor(self) -> int:
        """Denominator of the root's probabilities."""
        return self.tokens + self.n_words + 1


def _level(words: np.ndarray, counts: np.ndarray, before: Level | None) -> Level:
    """Candidates from their symbols; all but the first symbol are a candidate of the level before."""
    n, length = words.shape
    hashes, parent = np.zeros(n, U64), np.full(n, -1)
    for k in range(1, length + 1):
        if k == length and before is not None:
            parent = Index(before.hashes).find(hashes)
        hashes = longer(hashes, words[:, length - k], k)
    order = np.argsort(hashes)
    return Level(hashes[order], words[order], counts[order], parent[order])


def _array(table: pa.Table, column: str, dtype=np.int64) -> np.ndarray:
    return np.ascontiguousarray(table.column(column).to_numpy()).astype(dtype, copy=False)


def _followers(texts: DataFrame, level: Level, length: int) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast((level.hashes, 1 + level.counts // FOLLOWERS))
    rows = texts.mapInArrow(_follow(shared, length), _FOLLOWING)
    rows = rows.repartition("context", "part").sortWithinPartitions("context", "part")
    added = staged(rows.mapInArrow(_add, _ADDED), "followers")
    shared.unpersist()
    return added


def _tested(level: Level, rows: DataFrame, tree: Tree, before: Level | None, divergence: float) -> None:
    """Sets the level's entries (``context, follower, n, p``), types, and which contexts pass the test of divergence."""
    spark = rows.sparkSession
    sums = rows.groupBy("context").agg(F.sum("types").alias("types"), F.sum(F.size("counts")).alias("again"))
    totals = sums.toArrow()
    place = _array(totals, "context")
    level.types = np.zeros(len(level.hashes), np.int64)
    level.types[place] = _array(totals, "types")
    again = np.zeros(len(level.hashes), np.int64)
    again[place] = _array(totals, "again")
    # At most 1 / LEAST_SHARE rows.
    known = F.broadcast(spark.createDataFrame(pa.table({
        "context": pa.array(np.arange(len(level.hashes)), pa.int32()), "total": level.counts, "types": level.types,
        "parent": pa.array(level.parents, pa.int32())})))
    each = rows.select("context", F.explode(F.arrays_zip("followers", "counts")).alias("e")).select(
        "context", F.col("e.followers").alias("follower"), F.col("e.counts").alias("n")).join(known, "context")
    if before is None:
        above = tree.words.select(F.col("symbol").alias("follower"), ((F.col("n") + 1) / F.lit(tree.floor)).alias("above"))
        each = each.join(above, "follower")
    else:
        above = before.entries.select(F.col("context").alias("parent"), "follower", F.col("p").alias("above"))
        each = each.join(above, ["parent", "follower"])
    p = (F.col("n") - 1 + F.col("types") * F.col("above")) / F.col("total")
    left = (F.col("n") - 2 + F.col("types") * F.col("above")) / ((F.col("total") - 1) * F.col("above"))
    more = F.log10(p / (F.col("types") * F.col("above") / F.col("total")))
    entries = staged(each.select("context", "follower", "n", p.alias("p"), more.alias("more"), (F.col("n") * F.log(left)).alias("gain")), "entries")
    gains = entries.groupBy("context").agg(F.sum("gain").alias("gain")).toArrow()
    gain = np.zeros(len(level.hashes))
    gain[_array(gains, "context")] = _array(gains, "gain", np.float64)
    once = level.types - again
    with np.errstate(divide="ignore", invalid="ignore"):
        gain += np.where(once > 0, once * np.log((level.types - 1) / (level.counts - 1)), 0.0)
    level.kept = gain > divergence
    level.entries = entries.drop("gain")


def train(documents: DataFrame, depth: int = DEPTH, divergence: float = DIVERGENCE, least_share: float = LEAST_SHARE) -> Tree:
    """The tree of all given documents; stages tables that the caller's scratch scope owns."""
    texts = documents.select(F.coalesce("text", F.lit("")).alias("text"))
    counted = texts.mapInArrow(_count_words, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n"))
    counted = staged(counted, "words")
    begin = int(np.int64(np.uint64(BEGIN).view(np.int64)))
    words = counted.where(F.col("symbol") != begin)
    totals = words.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("words")).first()
    tree = Tree(totals.tokens or 0, totals.words, words)
    least = max(LEAST_COUNT, int(np.ceil(tree.tokens * least_share)))
    end = int(np.uint64(END).view(np.int64))
    found = counted.where((F.col("n") >= least) & (F.col("symbol") != end)).toArrow()
    level, before = _level(_array(found, "symbol").view(U64)[:, None], _array(found, "n"), None), None
    for length in range(1, depth + 1):
        if not len(level.hashes):
            break
        rows = _followers(texts, level, length)
        _tested(level, rows, tree, before, divergence)
        tree.levels.append(level)
        more = level.entries.where((F.col("n") >= least) & (F.col("follower") != end)).select("context", "follower", "n").toArrow()
        symbols_ = np.column_stack((level.words[_array(more, "context")], _array(more, "follower").view(U64)))
        level, before = _level(symbols_, _array(more, "n"), level), level
    for shorter, level in reversed(list(zip(tree.levels, tree.levels[1:]))):
        shorter.kept[level.parents[level.kept]] = True
    return tree


def _keyed_entries(shared):
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, kept = shared.value
        for batch in batches:
            context = batch.column("context").to_numpy()
            own = kept[context]
            follower = batch.column("follower").to_numpy().view(U64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(entry_keys(hashes[context[own]], follower[own]).view(np.int64)),
                 pa.array(np.log10(batch.column("p").to_numpy()[own])), pa.array(batch.column("more").to_numpy()[own]),
                 pa.array(batch.column("n").to_numpy()[own])], names=["key", "value", "more", "n"])

    return keyed


def _keyed_words(floor: int):
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(word_keys(batch.column("symbol").to_numpy().view(U64)).view(np.int64)),
                 pa.array(np.log10((n + 1) / floor)), pa.array(np.log10(n + 1.0)), pa.array(n)], names=["key", "value", "more", "n"])

    return keyed


_KEYED = "key long, value double, more double, n long"


def most_frequent(rows: DataFrame, most: int) -> int:
    """The smallest count with at most ``most`` rows of it and above; counts over 1000 are taken in steps of a hundredth."""
    step = F.when(F.col("n") <= 1000, F.col("n")).otherwise(F.floor(F.log10("n") * 100) + 1000)
    bins = sorted(map(tuple, rows.groupBy(step.alias("step")).agg(F.count(F.lit(1)), F.min("n")).collect()), reverse=True)
    held, least = 0, 1 << 62
    for _, n, lowest in bins:
        if held + n > most:
            break
        held, least = held + n, lowest
    return least


def _hot(rows: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    least = most_frequent(rows, most)
    table = rows.where(F.col("n") >= least).toArrow()
    keys = _array(table, "key").view(U64)
    order = np.argsort(keys)
    return keys[order], _array(table, "value", np.float64)[order], least


#: What a rare entry adds to: the score alone (an entry of a state), the base alone, or both (a word).
_TO_SCORE, _TO_BASE, _TO_BOTH = range(3)
_ASKED = "array<struct<key:long,adds:tinyint>>"
_SCORED = f"row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, asked {_ASKED}"
_SCORED_NAMES = [f.split()[0] for f in _SCORED.split(", ")]
_ASKED_TYPE = pa.struct([("key", pa.int64()), ("adds", pa.int8())])


def _score(shared):
    """Sums of what the hot tables tell, and the keys of what may be among the others.

    An entry that is not hot only adds to what its token has without it: a state's entry to the value that its
    parent gives, a word to that of an unknown word.  As the parent of a state with an entry has one too, these
    additions may be made one by one, and a key without an entry adds nothing.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, (hot_keys, hot_values), (word_hot, word_values), cold, unknown = shared.value
        levels = [(Index(hashes), weights) for hashes, weights in levels]
        hot_keys, word_hot = Index(hot_keys), Index(word_hot)
        for batch in batches:
            for part in slices(batch, "text", 1 << 19):
                seq, begins = symbols(part.column("text"))
                place = np.arange(len(seq)) - np.repeat(begins[:-1], np.diff(begins))
                at = np.flatnonzero(place > 0)
                doc = np.repeat(np.arange(len(part)), np.diff(begins))[at]
                n = len(at)
                # The longest kept suffix: each level is entered from the one before.
                states, context, here = [], np.zeros(n, U64), np.arange(n)
                for length, (hashes, weights) in enumerate(levels, 1):
                    here = here[place[at[here]] >= length]
                    context = context.copy()
                    context[here] = longer(context[here], seq[at[here] - length], length)
                    index = hashes.find(context[here])
                    here, index = here[index >= 0], index[index >= 0]
                    states.append((here, context[here], weights[index]))
                value, open_, asked = np.zeros(n), np.ones(n, bool), []
                for own, context, weights in reversed(states):
                    left = open_[own]
                    own, context, weights = own[left], context[left], weights[left]
                    keys = entry_keys(context, seq[at[own]])
                    index = hot_keys.find(keys)
                    hit = index >= 0
                    value[own[hit]] += hot_values[index[hit]]
                    open_[own[hit]] = False
                    own, keys = own[~hit], keys[~hit]
                    value[own] += weights[~hit]
                    if len(cold) and len(keys):
                        maybe = bloom.passed(cold, keys.view(np.int64))
                        asked.append((own[maybe], keys[maybe], np.full(int(maybe.sum()), _TO_SCORE, np.int8)))
                keys = word_keys(seq[at])
                index = word_hot.find(keys)
                known = index >= 0
                word = np.where(known, word_values[index] if len(word_values) else unknown, unknown)
                value[open_] += word[open_]
                rare = np.flatnonzero(~known)
                asked.append((rare, keys[rare], np.where(open_[rare], _TO_BOTH, _TO_BASE).astype(np.int8)))
                who, keys, adds = (np.concatenate([a[k] for a in asked]) for k in range(3))
                order = np.argsort(doc[who], kind="stable")
                offsets = np.searchsorted(doc[who][order], np.arange(len(part) + 1)).astype(np.int32)
                asks = pa.StructArray.from_arrays([pa.array(keys[order].view(np.int64)), pa.array(adds[order])], fields=list(_ASKED_TYPE))
                sums = lambda x: pa.array(np.bincount(doc, x, minlength=len(part)).astype(float))
                yield pa.RecordBatch.from_arrays([
                    part.column("row"), part.column("doc_id"), part.column("held_out"),
                    pa.array(np.bincount(doc, minlength=len(part)).astype(np.int64)),
                    pa.array(np.bincount(doc[known], minlength=len(part)).astype(np.int64)), sums(word), sums(value),
                    pa.ListArray.from_arrays(pa.array(offsets), asks)], names=_SCORED_NAMES)

    return score


def score(documents: DataFrame, tree: Tree, held: Column | None = None,
          hot_entries: int = HOT_ENTRIES, hot_words: int = HOT_WORDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``; ``held`` marks what was left out."""
    spark = documents.sparkSession
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        (F.lit(False) if held is None else held).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    entries, levels = None, []
    for level in tree.levels:
        shared = spark.sparkContext.broadcast((level.hashes, level.kept))
        keyed = level.entries.mapInArrow(_keyed_entries(shared), _KEYED)
        entries = keyed if entries is None else entries.union(keyed)
        kept = level.kept
        levels.append((level.hashes[kept], np.log10(level.types[kept] / level.counts[kept])))
    words = staged(tree.words.mapInArrow(_keyed_words(tree.floor), _KEYED), "word-values")
    word_keys_, word_values, least_word = _hot(words, hot_words)
    keys, values, cold, lookup = np.zeros(0, U64), np.zeros(0), np.zeros((0, 8), U64), words.where(F.col("n") < least_word)
    if entries is not None:
        entries = staged(entries, "entry-values")
        keys, values, least = _hot(entries, hot_entries)
        others = entries.where(F.col("n") < least)
        if not others.isEmpty():
            cold, lookup = bloom.build(others, "key", hashed=True), lookup.union(others)
    unknown = float(-np.log10(tree.floor))
    shared = spark.sparkContext.broadcast((levels, (keys, values), (word_keys_, word_values), cold, unknown))
    scored = staged(rows.mapInArrow(_score(shared), _SCORED), "scored")
    shared.unpersist()
    found = scored.select("row", F.inline("asked")).join(lookup.select("key", "more"), "key")
    sums = found.groupBy("row").agg(
        F.sum(F.when(F.col("adds") != _TO_BASE, F.col("more"))).alias("more"),
        F.sum(F.when(F.col("adds") != _TO_SCORE, F.col("more"))).alias("more_base"),
        F.count(F.when(F.col("adds") != _TO_SCORE, 1)).alias("more_known"))
    return scored.drop("asked").join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(tree.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"))


def scored(documents: DataFrame, **settings) -> DataFrame:
    """``score`` of all documents by the tree of those that are not held out."""

    def build() -> DataFrame:
        return score(documents, train(documents.where(~held_out())), held_out(), **settings)

    return settled(ready(documents.sparkSession), "language-model-scores", build)
