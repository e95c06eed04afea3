"""Repeated passages, found on a distributed sparse suffix array with its common-prefix interval tree.

A byte is repeated if it lies in a string of ``length`` bytes that also starts anywhere else.  The work is
cut into independent pieces by anchors: of the ``length - GRAM + 1`` grams of each window the one with the
smallest hash is an anchor (the first of equal ones).  Equal windows choose equal anchors, so every repeat
has an anchor whose gram occurs at both places, and an anchor that occurs once can be forgotten.

For each anchor gram that repeats, the suffixes that start at its occurrences are sorted and the lengths
of their common prefixes scanned with a stack, which yields the interval tree: each interval is a set of
occurrences that share a prefix, longer than their neighbours do.  An interval's occurrences are then
tested to the left: sorted by what precedes them, those with the longest common extension make up a maximal
repeat, which cannot be prolonged on either side.  Repeats of at least ``length`` bytes mark all their
occurrences.

Skew: equal texts are one class that goes through once (a text that occurs twice is repeated as a whole).
Of equal surroundings of an anchor only one is cut out and compared; what it yields holds for all.  An anchor with more than ``hot`` different
surroundings leaves the suffix arrays: each of its windows is hashed (128 bits) and counted instead, which
spreads over all tasks; the result is the same.

Runs of words (``without_passages``) take the same way with words for bytes: grams, windows and common prefixes are
counted in whole words and what lies between them, so exactly the runs of ``words`` words that occur twice go, however
short their words, and a long text has an anchor in some twenty words.

Defined results: a null text is empty.  Repeated rows, with or without an id, are texts that occur twice.
Texts shorter than ``length`` lose nothing.  Empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylode.llm import bloom, hashing
from paylode.llm.common import merged_only, ready, slices, text_md5
from paylode.llm.hashing import U64
from paylode.session import settled, staged

LENGTH = 400
GRAM = 100
HOT = 20_000

_BLOCK = 4 << 20          # a longer text is searched for anchors in overlapping pieces
_INDEX = U64((1 << 24) - 1)


def anchors(buffer: np.ndarray, at: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """``(byte, gram's hash)`` of the anchors of all texts in a buffer."""
    chosen = [(np.zeros(0, np.int64), np.zeros(0, U64))]
    ends = at[1:]
    for begin in range(0, max(1, len(buffer)), _BLOCK):
        piece = buffer[begin:begin + _BLOCK + length - 1]
        if len(piece) < length:
            break
        sums = hashing.prefix_sums(piece)
        n = len(piece) - gram + 1
        hashes = hashing.window_hashes(sums, slice(0, n), slice(gram, gram + n))
        hashes = (hashes ^ (hashes >> U64(32))) * U64(0x9E3779B97F4A7C15)
        starts = np.arange(begin, begin + len(piece) - length + 1)
        inside = starts + length <= np.repeat(ends, np.diff(at))[begin:begin + len(starts)]
        where = _smallest(hashes, length - gram + 1, inside)
        chosen.append((where + begin, hashing.mix(hashes[where])))
    return _each_once(chosen)


def word_anchors(found: hashing.Words, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """``(word, gram's hash)`` of the anchors of all texts whose words are given; grams and windows are of words."""
    chosen = [(np.zeros(0, np.int64), np.zeros(0, U64))]
    for begin in range(0, max(1, len(found.doc)), _BLOCK):
        piece = hashing.Words(*(c[begin:begin + _BLOCK + length - 1] for c in found))
        if len(piece.doc) < length:
            break
        first, hashed = hashing.runs(piece, gram, "gram")
        hashes = np.zeros(len(piece.doc) - gram + 1, U64)  # of what reaches into the next text nothing is chosen
        hashes[first] = hashed
        inside = piece.doc[:len(piece.doc) - length + 1] == piece.doc[length - 1:]
        where = _smallest(hashes, length - gram + 1, inside)
        chosen.append((where + begin, hashes[where]))
    return _each_once(chosen)


def _words(buffer: np.ndarray, at: np.ndarray) -> hashing.Words:
    """The words of all texts in a buffer, hashed in pieces that end at a gap or with a text."""
    pieces, begin = [hashing.words(buffer[:0], at[:1])], 0
    while begin < len(buffer):
        end = begin + _BLOCK
        while end < len(buffer):
            gaps = np.flatnonzero(hashing.SPACE[buffer[end:end + _BLOCK]])
            text = int(at[np.searchsorted(at, end)])
            gap = end + int(gaps[0]) if len(gaps) else end + _BLOCK
            if len(gaps) or text <= gap:
                end = min(gap, text)
                break
            end = gap
        end = min(end, len(buffer))
        inner = at[(at > begin) & (at < end)] - begin
        found = hashing.words(buffer[begin:end], np.concatenate(([0], inner, [end - begin])))
        pieces.append(found._replace(start=found.start + begin, end=found.end + begin))
        begin = end
    start, end, hashes = (np.concatenate([getattr(p, c) for p in pieces]) for c in ("start", "end", "hash"))
    return hashing.Words(np.searchsorted(at, start, "right") - 1, start, end, hashes)


def _smallest(hashes: np.ndarray, width: int, inside: np.ndarray) -> np.ndarray:
    """Where the smallest hash of ``width`` neighbours is, the first of equal ones, for those windows that are inside a text."""
    ranked = (hashes & ~_INDEX) | np.arange(len(hashes), dtype=U64)
    flags = np.zeros(len(hashes), bool)
    flags[(_sliding_minimum(ranked, width)[inside] & _INDEX).astype(np.int64)] = True
    return np.flatnonzero(flags)


def _each_once(chosen: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    place, first = np.unique(np.concatenate([p for p, _ in chosen]), return_index=True)
    return place, np.concatenate([h for _, h in chosen])[first]


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours: suffix minima of blocks against prefix minima of the next."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, U64(2**64 - 1))
    padded[:len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def intervals(shared: list[int]) -> Iterator[tuple[int, int, int]]:
    """The interval tree of a sorted list: ``(first, last, common prefix)``, children before parents.

    ``shared[i]`` is what the entries ``i`` and ``i + 1`` have in common.
    """
    stack: list[tuple[int, int]] = []  # (first entry, common prefix)
    for i, depth in enumerate([*shared, -1]):
        first = i
        while stack and stack[-1][1] > depth:
            first, inner = stack.pop()
            yield first, i, inner
        if not stack or stack[-1][1] < depth:
            stack.append((first, depth))


def maximal_repeats(lefts: list[bytes], rights: list[bytes], length: int, width: int = 1) -> Iterator[tuple[int, int, int]]:
    """``(occurrence, bytes before, bytes after)``: parts of maximal repeats around one anchor.

    ``lefts`` are the bytes before each occurrence, last first; ``rights`` those from it on.  With a ``width``, each
    ``width`` bytes are one unit, and units are what is counted.
    """
    order = sorted(range(len(rights)), key=rights.__getitem__)
    shared = [_common(rights[a], rights[b]) // width for a, b in zip(order, order[1:])]
    for first, last, after in intervals(shared):
        members = order[first:last + 1]
        if len(members) > 2:
            members.sort(key=lefts.__getitem__)
        before = 0
        for k, member in enumerate(members):
            following = _common(lefts[member], lefts[members[k + 1]]) // width if k + 1 < len(members) else 0
            reach = max(before, following)
            if reach + after >= length:
                yield member, reach, after
            before = following


def longest_reach(lefts: list[bytes], rights: list[bytes], length: int, width: int = 1) -> dict[int, tuple[int, int]]:
    """For each occurrence the most bytes before and after that its repeats cover.

    All of them cover the anchor, so they are one span together.
    """
    reach: dict[int, tuple[int, int]] = {}
    for member, before, after in maximal_repeats(lefts, rights, length, width):
        held = reach.get(member, (0, 0))
        reach[member] = max(held[0], before), max(held[1], after)
    return reach


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            if end > out[-1][1]:
                out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


#: White space is what the contracts' words have between them.
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_WORD_AND_GAP = re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]+")
_GAP_AND_WORD = re.compile(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+")

# ``size`` is in bytes or words; ``first`` and ``last`` bound the bytes that those take.
_SCANNED = "digest binary, size long, first int, last int, grams array<long>, at array<int>"


def _scan(length: int, gram: int, by_words: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                buffer, at = hashing.buffer_of(part.column("text"))
                size, first, last = np.diff(at), np.zeros(len(part), np.int64), np.diff(at)
                if by_words:
                    found = _words(buffer, at)
                    place, hashes = word_anchors(found, length, gram)
                    owner, byte = found.doc[place], found.start[place]
                    begins = np.searchsorted(found.doc, np.arange(len(at)))
                    size, some = np.diff(begins), np.diff(begins) > 0
                    first[some] = found.start[begins[:-1][some]] - at[:-1][some]
                    last[some] = found.end[begins[1:][some] - 1] - at[:-1][some]
                else:
                    byte, hashes = anchors(buffer, at, length, gram)
                    owner = np.searchsorted(at, byte, "right") - 1
                offsets = pa.array(np.searchsorted(owner, np.arange(len(at))).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    part.column("digest"), pa.array(size), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)),
                    pa.ListArray.from_arrays(offsets, pa.array(hashes.view(np.int64))),
                    pa.ListArray.from_arrays(offsets, pa.array((byte - at[owner]).astype(np.int32)))],
                    names=["digest", "size", "first", "last", "grams", "at"])

    return scan


_NAMED = "text_id long, gram long, at int, before int, after int, around_a long, around_b long"
_SURROUNDED = "gram long, around_a long, around_b long, lead int, around binary"


def _around(data: bytes, spots: list[int], length: int, gram: int, by_words: bool) -> list[tuple[int, int]]:
    """What a window around each anchor can reach, in the text's bytes."""
    reach = length - gram
    if not by_words:
        return [(max(0, at - reach), min(len(data), at + length)) for at in spots]
    start, end = hashing.bounds(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    word = np.searchsorted(start, spots)
    return list(zip(start[np.maximum(word - reach, 0)].tolist(), end[np.minimum(word + length, len(end)) - 1].tolist()))


def _each_anchor(batches: Iterator[pa.RecordBatch], length: int, gram: int, by_words: bool) -> Iterator[tuple[list, list]]:
    """Slices of texts: their anchors, and the bytes before and after each that a window around it can reach."""
    for batch in batches:
        for part in slices(batch, "text", 1 << 18):
            rows, around = [], []
            for text_id, text, found in zip(*(part.column(c).to_pylist() for c in ("text_id", "text", "anchors"))):
                data = text.encode()
                spans = _around(data, [spot["at"] for spot in found], length, gram, by_words)
                for spot, (start, end) in zip(found, spans):
                    rows.append((text_id, spot, spot["at"] - start))
                    around.append(data[start:end])
            yield rows, around


def _name(length: int, gram: int, by_words: bool):
    """A 128-bit name of each anchor's surroundings, and how far they reach."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, around in _each_anchor(batches, length, gram, by_words):
            names = np.frombuffer(b"".join(
                hashlib.blake2b(data + lead.to_bytes(4, "little"), digest_size=16).digest()
                for (_, _, lead), data in zip(rows, around)), np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1]["gram"] for r in rows], pa.int64()),
                pa.array([r[1]["at"] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32()),
                pa.array([len(data) - r[2] for r, data in zip(rows, around)], pa.int32()),
                pa.array(names[0::2]), pa.array(names[1::2])],
                names=["text_id", "gram", "at", "before", "after", "around_a", "around_b"])

    return name


def _surroundings(length: int, gram: int, by_words: bool):
    """The bytes of chosen surroundings."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, around in _each_anchor(batches, length, gram, by_words):
            yield pa.RecordBatch.from_arrays([
                *(pa.array([r[1][c] for r in rows], pa.int64()) for c in ("gram", "around_a", "around_b")),
                pa.array([r[2] for r in rows], pa.int32()), pa.array(around, pa.binary())],
                names=["gram", "around_a", "around_b", "lead", "around"])

    return cut


_MARKED = "gram long, around_a long, around_b long, before int, after int"


def _halves(lead: int, around: bytes) -> tuple[list[bytes], list[bytes]]:
    """The words before an anchor, last first, with the gaps that follow them, and those from it on, with the gaps before them."""
    return _WORD_AND_GAP.findall(around, 0, lead)[::-1], _GAP_AND_WORD.findall(around, lead)


def _reach_by_words(group: list[tuple], length: int) -> dict[int, tuple[int, int]]:
    """``longest_reach`` over whole words, in bytes; each different word of the group is four bytes."""
    numbers: dict[bytes, bytes] = {}
    lefts, rights = [], []
    for _, _, lead, around in group:
        for half, packed in zip(_halves(lead, around), (lefts, rights)):
            packed.append(b"".join([numbers.setdefault(word, len(numbers).to_bytes(4)) for word in half]))
    reach = {}
    for member, (before, after) in longest_reach(lefts, rights, length, 4).items():
        left, right = _halves(*group[member][2:])
        reach[member] = sum(map(len, left[:before])), sum(map(len, right[:after]))
    return reach


def _mark(length: int, by_words: bool):
    """Spans around the anchors; a partition is sorted by gram and its groups are taken one after another."""

    def found(gram: int, group: list[tuple]) -> list[tuple]:
        if by_words:
            reach = _reach_by_words(group, length)
        else:
            lefts = [around[:lead][::-1] for _, _, lead, around in group]
            rights = [around[lead:] for _, _, lead, around in group]
            reach = longest_reach(lefts, rights, length)
        return [(gram, *group[member][:2], *span) for member, span in reach.items()]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          names=["gram", "around_a", "around_b", "before", "after"])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, group, rows = None, [], []
        for batch in batches:
            for gram, *member in zip(
                    *(batch.column(c).to_pylist() for c in ("gram", "around_a", "around_b", "lead", "around"))):
                if gram != current:
                    rows += found(current, group) if len(group) > 1 else ()
                    current, group = gram, []
                    if len(rows) > 20_000:
                        yield packed(rows)
                        rows = []
                group.append(member)
        rows += found(current, group) if len(group) > 1 else ()
        yield packed(rows)

    return mark


_WINDOWED = "gram long, around_a long, around_b long, before int, after int, hash_a long, hash_b long"


def _windows(length: int, by_words: bool):
    """Every window of a hot anchor's surroundings, as 128 bits of its bytes' hash."""

    def of(around: bytes, lead: int) -> list[tuple[int, int]]:
        if not by_words:
            return [(i, i + length) for i in range(max(0, min(lead + 1, len(around) - length + 1)))]
        at = [word.span() for word in _WORD.finditer(around)]
        return [(start, at[i + length - 1][1]) for i, (start, _) in enumerate(at[:max(0, len(at) - length + 1)]) if start <= lead]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), 64):
                part = batch.slice(begin, 64)
                owner, before, after, digests = [], [], [], []
                for k, (around, lead) in enumerate(zip(part.column("around").to_pylist(), part.column("lead").to_pylist())):
                    for start, end in of(around, lead):
                        owner.append(k)
                        before.append(lead - start)
                        after.append(end - lead)
                        digests.append(hashlib.blake2b(around[start:end], digest_size=16).digest())
                hashes = np.frombuffer(b"".join(digests), np.int64)
                rows = part.select(["gram", "around_a", "around_b"]).take(pa.array(owner, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(before, pa.int32()), pa.array(after, pa.int32()),
                     pa.array(hashes[0::2]), pa.array(hashes[1::2])],
                    names=["gram", "around_a", "around_b", "before", "after", "hash_a", "hash_b"])

    return cut


def _spans(documents: DataFrame, length: int, gram: int, hot: int, by_words: bool = False) -> tuple[DataFrame, DataFrame]:
    """``copied`` (texts that occur twice) and ``involved`` (texts with spans); ``length`` and ``gram`` in bytes or words."""
    texts = _texts(documents).drop("doc_id")
    scanned = staged(texts.mapInArrow(_scan(length, gram, by_words), _SCANNED), "anchors")
    classes = scanned.where(F.col("size") >= length).groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"), *(F.first(c).alias(c) for c in ("first", "last", "grams", "at")))
    classes = staged(classes.withColumn("text_id", F.monotonically_increasing_id()), "text-classes")
    spots = classes.select("text_id", F.explode(F.arrays_zip("grams", "at")).alias("s")).select(
        "text_id", F.col("s.grams").alias("gram"), F.col("s.at").alias("at"))
    twice = spots.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    asked = merged_only(spots).join(twice, "gram", "left_semi").groupBy("text_id").agg(
        F.collect_list(F.struct("gram", "at")).alias("anchors"))
    asked = staged(classes.select("text_id", "digest", "copies").join(merged_only(asked), "text_id"), "texts-asked-for")
    # Most texts have no repeats and stay where they are; equal texts meet before and after the shuffle.
    wanted = texts.select("digest", "text").where(bloom.may_be_in(asked, "digest", "digest"))
    involved = staged(wanted.join(asked, "digest").dropDuplicates(["digest"]), "texts-with-repeats")

    around = ["gram", "around_a", "around_b"]
    named = staged(involved.mapInArrow(_name(length, gram, by_words), _NAMED), "surroundings")
    distinct = named.groupBy(*around).agg(
        F.count(F.lit(1)).alias("n"), F.min("text_id").alias("text_id"), F.min_by("at", "text_id").alias("at"),
        F.min("before").alias("before"), F.min("after").alias("after"))
    distinct = staged(distinct, "distinct-surroundings")
    whole = distinct.where("n > 1").select(*around, "before", "after")
    heat = distinct.groupBy("gram").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    heat = staged(heat, "anchors-with-several")
    compared = distinct.join(heat, "gram").groupBy("text_id").agg(
        F.collect_list(F.struct("at", *around)).alias("anchors"))
    cut = merged_only(involved.select("text_id", "text")).join(compared, "text_id").mapInArrow(
        _surroundings(length, gram, by_words), _SURROUNDED)
    burning = heat.where(F.col("members") > hot).select("gram")
    if burning.isEmpty():
        mild, counted = cut, None
    else:
        cut = staged(cut, "cut-surroundings")
        mild = cut.join(burning, "gram", "left_anti")
        windows = cut.join(burning, "gram", "left_semi").mapInArrow(_windows(length, by_words), _WINDOWED)
        # At one place of the anchor: a window that two anchors of a periodic text reach is still one window.
        window = ["gram", "before", "hash_a", "hash_b"]
        seen = windows.groupBy(*window).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        counted = merged_only(windows).join(seen, window, "left_semi").select(*around, "before", "after")
    marked = mild.repartition("gram").sortWithinPartitions("gram").mapInArrow(_mark(length, by_words), _MARKED)
    spans = whole.union(marked) if counted is None else whole.union(marked).union(counted)
    spans = spans.where(F.col("before") + F.col("after") >= length).groupBy(*around).agg(
        F.max("before").alias("before"), F.max("after").alias("after"))
    spans = named.select("text_id", "at", *around).join(spans, around).groupBy("text_id").agg(F.collect_list(F.struct(
        (F.col("at") - F.col("before")).alias("start"), (F.col("at") + F.col("after")).alias("end"))).alias("spans"))
    return classes.where("copies > 1").select("digest", F.lit(True).alias("copied"), "first", "last"), \
        involved.select("text_id", "digest", "text", "copies").join(spans, "text_id")


_SPAN = "array<struct<start:int,end:int>>"
_CUT = f"digest binary, n_removed long, n_spans long, kept_sha256 string, spans {_SPAN}, kept_text string"


def _characters(data: bytes, spans: list[tuple[int, int]]) -> str:
    """The text without its spans; a character that a span only covers in part stays."""
    pieces, last = [], 0
    for start, end in spans:
        while start < end and data[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        pieces.append(data[last:start])
        last = end
    return b"".join([*pieces, data[last:]]).decode()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for digest, text, spans in zip(*(batch.column(c).to_pylist() for c in ("digest", "text", "spans"))):
            data, gone = text.encode(), merged([(s["start"], s["end"]) for s in spans])
            kept, last = hashlib.sha256(), 0
            for start, end in gone:
                kept.update(data[last:start])
                last = end
            kept.update(data[last:])
            rows.append((digest, sum(e - s for s, e in gone), len(gone), kept.hexdigest(),
                         [{"start": s, "end": e} for s, e in gone], _characters(data, gone)))
        columns = list(zip(*rows)) or [[]] * 6
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string(),
                 pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         names=["digest", "n_removed", "n_spans", "kept_sha256", "spans", "kept_text"])


def _with_changes(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """``rows`` with the columns of the few ``changes`` that have their digest; the other rows stay where they are."""
    may_be = bloom.may_be_in(changes, "digest", "digest")
    others = [F.lit(None).cast(kind).alias(name) for name, kind in changes.dtypes if name != "digest"]
    asked = rows.where(may_be).join(changes, "digest", "left")
    return asked.union(rows.where(~may_be).select(*rows.columns, *others).select(asked.columns))


def repeated_spans(documents: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, text``: a row per document, spans in its bytes.

    ``text`` is what is left, of whole characters.
    """
    return settled(ready(documents.sparkSession), "repeated-spans",
                   lambda: _repeated_spans(documents, length, gram, hot))


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(text_md5().alias("digest"), F.col("doc_id").cast("long").alias("doc_id"),
                            F.coalesce("text", F.lit("")).alias("text"))


def _repeated_spans(documents: DataFrame, length: int, gram: int, hot: int) -> DataFrame:
    copied, involved = _spans(documents, length, gram, hot)
    copied = copied.select("digest", "copied")
    changes = staged(copied.join(involved.mapInArrow(_cut, _CUT), "digest", "full"), "changed-texts")
    rows = _texts(documents).withColumn("n_bytes", F.octet_length("text").cast("long"))
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("end")))
    gone = F.col("copied")
    return _with_changes(rows, changes).select(
        "doc_id", "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(
            F.coalesce("kept_sha256", F.sha2(F.col("text").cast("binary"), 256))).alias("kept_sha256"),
        F.when(gone, whole).otherwise(F.coalesce("spans", F.array().cast(_SPAN))).alias("spans"),
        F.when(gone, F.lit("")).otherwise(F.coalesce("kept_text", "text")).alias("text"))


def _rewritten(documents: DataFrame, changes: DataFrame) -> DataFrame:
    """The documents with ``kept_text`` where their text's digest has one, and ``n_chars`` of it if that is there."""
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    out = _with_changes(documents.select(row, text_md5().alias("digest")), changes.select("digest", "kept_text"))
    text = F.when(F.col("row.text").isNotNull(), F.coalesce("kept_text", "row.text")).alias("text")
    return out.select(*[
        text if c == "text" else F.length(text).cast(t).alias(c) if c == "n_chars" else F.col(f"row.`{c}`").alias(c)
        for c, t in documents.dtypes])


def without_repeats(documents: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """The documents with repeated passages cut out of ``text``, and ``n_chars`` of the new text if it is there.

    All rows and columns stay; a null text stays null.  Characters are cut whole: one that a passage covers
    only in part stays.
    """
    def changed() -> DataFrame:
        copied, involved = _spans(documents, length, gram, hot)
        trimmed = involved.mapInArrow(_cut, _CUT).select("digest", "kept_text")
        return copied.join(trimmed, "digest", "full").select(
            "digest", F.when(F.col("copied"), F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"))

    return _rewritten(documents, settled(ready(documents.sparkSession), "changed-texts", changed))


def without_passages(documents: DataFrame, words: int = 51, gram: int | None = None, hot: int = HOT) -> DataFrame:
    """The documents without the runs of ``words`` words that also start anywhere else, byte for byte.

    Of texts that occur twice nothing stays between their first word and their last, if they have as many words.
    """
    gram = max(1, 2 * words // 5) if gram is None else gram

    def changed() -> DataFrame:
        copied, involved = _spans(documents, words, gram, hot, by_words=True)
        every = F.array(F.struct(F.col("first").alias("start"), F.col("last").alias("end"))).alias("spans")
        copies = _texts(documents).where(bloom.may_be_in(copied, "digest", "digest")).join(
            copied.select("digest", every), "digest").mapInArrow(_cut, _CUT).select("digest", "kept_text").dropDuplicates(["digest"])
        others = involved.where("copies = 1").mapInArrow(_cut, _CUT).select("digest", "kept_text")
        return copies.union(others)

    return _rewritten(documents, settled(ready(documents.sparkSession), "changed-texts", changed))
