"""Near-duplicate documents by min-max hashing.

Every document's set of five-word shingles is hashed once per permutation and both the smallest and the
largest value are kept, so 60 hash evaluations give a signature of 120 values.  24 bands of five values
(never both ends of one permutation) find a pair of similarity 0.85 with probability above 0.999999.

What happens to large groups: documents with the same set are one class, and only one text of it goes on
under a number of its own, so that neither missing nor repeated ids matter.
In each bucket the members are first compared with one hub, and those that are still apart with the one that has
the fewest shingles of its own, which is likest to the others.  Shingles that no other document of the buckets
still open has, a document shares with none: that bounds its overlap with any other, and one that has changed too
much to be similar to anything leaves its buckets at once.  What is left is compared exactly and completely, but
in blocks: a bucket's members are dealt into chunks of at most ``CHUNK_BYTES`` of shingles, and a task takes two
chunks and counts the shingles that their documents share as a product of matrices.  It hands on one link for each
document that it has joined to another, so no pair is ever a row, and a bucket of many documents that are almost
similar costs a row for each of them and chunk.  Buckets with the same members are compared once.

Defined results: null or empty text has an empty set and is linked with nothing.  Documents of one to four
words have their whole sequence as one shingle.  Repeated rows are one document with one component; different
texts under one id are different documents.  A component is named by its smallest id: null if no row of it
has one.  Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylode.llm import bloom, hashing
from paylode.llm.common import components, few_tasks, merged_only, ready, slices, text_md5
from paylode.llm.hashing import U64, mix
from paylode.session import settled, staged

WORDS = 5
PERMUTATIONS = 60
BANDS = 24
ROWS = 2 * PERMUTATIONS // BANDS
PAIRS_PER_TASK = 2_000
CHUNK_BYTES = 4 << 20
CHUNK = 8_192            # documents in a chunk at most, on average
TILE, TILE_SHINGLES, COLUMNS = 512, 1 << 18, 4_096  # what a product of matrices takes at once

_SIGNED = "doc_id long, text_id binary, n_shingles long, set_a long, set_b long, bands array<long>"


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Each text's shingles as sorted distinct 64-bit hashes."""
    buffer, at = hashing.buffer_of(texts)
    found = hashing.words(buffer, at, lower=True)
    first, hashes = hashing.runs(found, WORDS, "shingle")
    n_words = np.bincount(found.doc, minlength=len(texts))
    word_at = np.concatenate(([0], np.cumsum(n_words)))
    run_at = np.searchsorted(first, word_at)
    sets = []
    for i, n in enumerate(n_words):
        if n >= WORDS:
            sets.append(np.unique(hashes[run_at[i]:run_at[i + 1]]))
        elif n:
            some = found.hash[word_at[i]:word_at[i + 1]]
            sets.append(mix((some * hashing.constants(f"short{n}", int(n))).sum(keepdims=True, dtype=U64)))
        else:
            sets.append(np.zeros(0, U64))
    return sets


def signatures(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One row per set, ``values[starts[i]:starts[i + 1]]``: the smallest, then the largest under each permutation."""
    factors, shifts = hashing.constants("minmax-factor", PERMUTATIONS), hashing.constants("minmax-shift", PERMUTATIONS)
    out = np.empty((len(starts), 2 * PERMUTATIONS), U64)
    for k in range(PERMUTATIONS):
        permuted = values * factors[k] + shifts[k]
        out[:, k] = np.minimum.reduceat(permuted, starts)
        out[:, PERMUTATIONS + k] = np.maximum.reduceat(permuted, starts)
    return out


def band_keys(signed: np.ndarray) -> np.ndarray:
    """Band ``b`` joins columns ``b, b + BANDS, ...``; the key holds the band's number too."""
    total = np.arange(BANDS, dtype=U64) * U64(0x9E3779B97F4A7C15)
    total = np.broadcast_to(total, (len(signed), BANDS)).copy()
    for j, factor in enumerate(hashing.constants("bands", ROWS)):
        total += mix(signed[:, j * BANDS:(j + 1) * BANDS]) * factor
    return mix(total).view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            sets = shingle_sets(part.column("text"))
            sizes = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(sizes)
            digests = np.zeros((len(sets), 2), np.int64)
            offsets = np.zeros(len(sets) + 1, np.int32)
            keys = np.zeros((0, BANDS), np.int64)
            if len(full):
                values = np.concatenate([sets[i] for i in full])
                starts = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
                for j, salt in enumerate(hashing.constants("set", 2)):
                    digests[full, j] = np.add.reduceat(mix(values ^ salt), starts).view(np.int64)
                keys = band_keys(signatures(values, starts))
                offsets[1:] = np.cumsum((sizes > 0) * BANDS)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), part.column("text_id"), pa.array(sizes), pa.array(digests[:, 0]),
                 pa.array(digests[:, 1]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))],
                names=["doc_id", "text_id", "n_shingles", "set_a", "set_b", "bands"])


def _confirmed(percent: int):
    """Keeps the pairs whose sets meet the limit; pairs come with both texts."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub_text, hub = None, None
        for batch in batches:
            for part in slices(batch, "text_b", 1 << 19):
                others = shingle_sets(part.column("text_b"))
                keep = []
                for i, other in enumerate(others):
                    text = part.column("text_a")[i].as_py()
                    if text != hub_text:
                        hub_text, hub = text, shingle_sets(pa.array([text]))[0]
                    shared = len(np.intersect1d(hub, other, assume_unique=True))
                    keep.append(bool(shared) and 100 * shared >= percent * (len(hub) + len(other) - shared))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return confirm


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of ids whose texts are similar enough."""
    pairs = staged(pairs, "candidate-pairs")
    count = pairs.count()
    with_b = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    both = few_tasks(with_b, count, PAIRS_PER_TASK).join(
        texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    return few_tasks(both, count, PAIRS_PER_TASK).select("a", "b", "text_a", "text_b").mapInArrow(
        _confirmed(percent), "a long, b long")


def _list_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            sets = shingle_sets(part.column("text"))
            ids = np.repeat(part.column("id").to_numpy(), [len(s) for s in sets])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(np.concatenate(sets).view(np.int64))], names=["id", "shingle"])


def _own_shingles(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """``id, own``: how many of its shingles no other of the documents ``ids`` has, for those that have some."""
    listed = texts.join(ids, "id", "left_semi").mapInArrow(_list_shingles, "id long, shingle long")
    alone = listed.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id")).where("n = 1")
    return alone.groupBy("id").agg(F.count(F.lit(1)).alias("own"))


def _set_blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            sets = shingle_sets(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([x.tobytes() for x in sets], pa.binary())], names=["id", "shingles"])


def shared_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many values each set of ``a`` shares with each of ``b``."""
    values = [np.concatenate([np.zeros(0, U64), *sets]) for sets in (a, b)]
    common = np.intersect1d(*values)
    out = np.zeros((len(a), len(b)), np.float32)
    at = []
    for own, sets in zip(values, (a, b)):
        column = np.searchsorted(common, own)
        column[column == len(common)] = 0
        known = common[column] == own if len(common) else np.zeros(len(own), bool)
        at.append((np.repeat(np.arange(len(sets)), [len(x) for x in sets])[known], column[known]))
    for first in range(0, len(common), COLUMNS):
        sides = []
        for (row, column), sets in zip(at, (a, b)):
            here = (column >= first) & (column < first + COLUMNS)
            side = np.zeros((len(sets), min(COLUMNS, len(common) - first)), np.float32)
            side[row[here], column[here] - first] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def _tiles(members: list[int], sizes: list[int]) -> Iterator[list[int]]:
    tile, held = [], 0
    for k in members:
        if tile and (len(tile) >= TILE or held + sizes[k] > TILE_SHINGLES):
            yield tile
            tile, held = [], 0
        tile.append(k)
        held += sizes[k]
    if tile:
        yield tile


def block_links(sets: list[np.ndarray], components: np.ndarray, left: list[int], right: list[int] | None, percent: int) -> np.ndarray:
    """For each set the first one of those that similar sets join it to, of all pairs of ``left`` and ``right``.

    Without ``right`` the pairs are those of ``left``.  Sets of one component need no comparison.
    """
    sizes = [len(x) for x in sets]
    n = np.array(sizes)
    # Sets of one component are joined from the start.
    label = np.unique(components, return_index=True)[1][np.unique(components, return_inverse=True)[1]]
    own = label.copy()
    tiles = [list(_tiles(side, sizes)) for side in ((left,) if right is None else (left, right))]
    for i, a in enumerate(tiles[0]):
        for b in tiles[0][i:] if right is None else tiles[1]:
            if len(np.unique(label[a + b])) == 1:
                continue
            shared = shared_counts([sets[k] for k in a], [sets[k] for k in b])
            like = (shared > 0) & (100 * shared >= percent * (n[a][:, None] + n[b][None, :] - shared))
            row, column = np.nonzero(like & (label[a][:, None] != label[b][None, :]))
            row, column = np.array(a)[row], np.array(b)[column]
            while True:
                low = np.minimum(label[row], label[column])
                if (label[row] == low).all() and (label[column] == low).all():
                    break
                for side in (row, column):
                    np.minimum.at(label, label[side], low)
                label = label[label]
    return np.where(label == own, np.arange(len(sets)), label)


def _compare_blocks(percent: int):
    """Links of the pairs of chunks that rows, sorted by bucket and pair, belong to."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members = None, []

        def found():
            (_, low, high), ids = key, [m[1] for m in members]
            left = [k for k, m in enumerate(members) if m[0] == low]
            right = None if low == high else [k for k, m in enumerate(members) if m[0] == high]
            roots = block_links([np.frombuffer(m[3], U64) for m in members], np.array([m[2] for m in members]), left, right, percent)
            joined = [(ids[k], ids[r]) for k, r in enumerate(roots) if k != r]
            return pa.RecordBatch.from_arrays([pa.array([x[j] for x in joined], pa.int64()) for j in range(2)], names=["a", "b"])

        names = ("bucket", "low", "high", "chunk", "id", "component", "shingles")
        for batch in batches:
            for bucket, low, high, *member in zip(*(batch.column(c).to_pylist() for c in names)):
                if (bucket, low, high) != key:
                    if len(members) > 1:
                        yield found()
                    key, members = (bucket, low, high), []
                members.append(member)
        if len(members) > 1:
            yield found()

    return compare


def _exact_links(left: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` that join all similar documents of each bucket of ``bucket, id, n, component``."""
    sums = left.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"),
        F.array(F.expr("bit_xor(xxhash64(id))"), F.expr("bit_xor(xxhash64(id, 'again'))")).alias("members"))
    once = sums.groupBy("members", "size").agg(F.min("bucket").alias("bucket"), F.first("shingles").alias("shingles"))
    chunks = F.greatest(F.ceil(F.col("shingles") * 8 / CHUNK_BYTES), F.ceil(F.col("size") / CHUNK)).cast("int")
    dealt = left.join(once.select("bucket", chunks.alias("chunks")), "bucket").withColumn(
        "chunk", F.pmod(F.xxhash64("id", F.lit("chunk")), "chunks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    dealt = dealt.withColumn("other", other).select(
        "bucket", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "id", "component")
    blobs = texts.join(left.select("id").distinct(), "id", "left_semi").mapInArrow(_set_blobs, "id long, shingles binary")
    pairs = merged_only(dealt).join(staged(blobs, "open-sets"), "id").repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    return pairs.mapInArrow(_compare_blocks(percent), "a long, b long")


def near_duplicates(documents: DataFrame, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: documents linked when shared >= percent/100 of the union.

    The bands suit limits of 80 and more.  See the module's text for nulls, repeats and empty tables.
    """
    return settled(ready(documents.sparkSession), "near-duplicates", lambda: _near_duplicates(documents, percent))


_SET = ["n_shingles", "set_a", "set_b"]


def _near_duplicates(documents: DataFrame, percent: int) -> DataFrame:
    signed, classes, groups = _grouped(documents, percent)
    lowest = classes.join(groups, classes["id"] == groups["node"]).groupBy("component").agg(F.min("doc_id").alias("lowest"))
    named = classes.join(groups.join(lowest, "component"), classes["id"] == F.col("node"), "left").select(
        *_SET, F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("lowest")).alias("component_id"))
    out = signed.select("doc_id", *_SET).join(named, _SET, "left").withColumn(
        "component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _grouped(documents: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``signed`` (a row per document), ``classes`` (a row per set: its first row's ids) and ``groups`` of their numbers."""
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_md5().alias("text_id"), "text")
    signed = staged(documents.mapInArrow(_sign, _SIGNED), "minmax")
    classes = signed.where("n_shingles > 0").groupBy(*_SET).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_id")).alias("rank"),
        F.first("bands").alias("bands"))
    classes = staged(classes.select(
        *_SET, "rank", "rank.doc_id", "rank.text_id", "bands", F.monotonically_increasing_id().alias("id")), "set-classes")

    banded = classes.select("id", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(
        F.min("id").alias("hub"), F.min_by("n", "id").alias("hub_n"), F.max("id").alias("last"),
        F.count(F.lit(1)).alias("size")).where("hub != last").drop("last")
    buckets = staged(merged_only(banded).join(shared, "bucket"), "buckets")
    # Most documents have no candidate: their texts stay where they are.
    # Of a class only the first row's text goes on.
    ids = classes.join(buckets.select("id").distinct(), "id", "left_semi").select(
        "id", F.col("doc_id").alias("of_doc"), F.col("text_id").alias("of_text"), F.xxhash64("doc_id", "text_id").alias("both"))
    ids = staged(ids, "candidates")
    texts = documents.withColumn("both", F.xxhash64("doc_id", "text_id")).where(bloom.may_be_in(ids, "both", "both"))
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_id") == F.col("of_text"))
    texts = staged(texts.drop("both").join(ids, same).select("id", "text").dropDuplicates(["id"]), "candidate-texts")

    like_sizes = 100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")
    first = buckets.where((F.col("id") != F.col("hub")) & like_sizes)
    links = _verified(first.select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), texts, percent)
    groups = components(staged(links, "links"))

    def open_buckets(members: DataFrame) -> DataFrame:
        """Members of buckets with several components, with their ``component``."""
        named = members.join(groups.withColumnRenamed("node", "id"), "id", "left").withColumn(
            "component", F.coalesce("component", "id"))
        several = named.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y")
        return named.join(several.select("bucket"), "bucket", "left_semi")

    left = staged(open_buckets(buckets.select("bucket", "id", "n")), "open-buckets")
    own = _own_shingles(texts, left.select("id").distinct())
    # n minus own is the most that a document can share.
    left = left.drop("component").join(own, "id", "left").withColumn("most", F.col("n") - F.coalesce("own", F.lit(0))).where(
        100 * F.col("most") >= percent * F.col("n"))
    left = staged(left.select("bucket", "id", "n", "most"), "open-buckets")
    can_meet = like_sizes & (percent * (F.col("n") + F.col("hub_n")) <= (100 + percent) * F.least("most", "hub_most"))

    def hubs_of(members: DataFrame, *columns: str) -> DataFrame:
        return members.select("bucket", *[F.col(c).alias(f"hub_{c}") for c in columns])

    def joined(links: DataFrame) -> DataFrame:
        """The components with more links."""
        links = staged(links, "links")
        if links.isEmpty():
            return groups
        stars = groups.where("node != component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        return components(links.union(stars))

    # The member with the fewest shingles of its own is likest to the others: all meet it first.
    typical = left.groupBy("bucket").agg(F.max_by("id", F.struct(F.col("most") / F.col("n"), -F.col("id"))).alias("id"))
    met = left.join(hubs_of(left.join(typical, ["bucket", "id"]), "id", "n", "most"), "bucket").where(
        (F.col("id") != F.col("hub_id")) & can_meet)
    met = met.select(F.least("hub_id", "id").alias("a"), F.greatest("hub_id", "id").alias("b")).distinct()
    groups = joined(_verified(met, texts, percent))
    left = staged(open_buckets(left.select("bucket", "id", "n")), "open-buckets")
    groups = joined(_exact_links(left, texts, percent))
    return signed, classes.drop("bands"), groups


def keep_one(documents: DataFrame, percent: int = 80) -> DataFrame:
    """The documents without the near copies of an earlier one; all columns stay.

    Of each component the row with the smallest id stays, one without an id where no row has one; of different
    texts under that id one.  Repeated rows of one id leave one row.  Rows without a shingle are no copies: each
    without an id stays.
    """
    def first_rows() -> DataFrame:
        signed, classes, groups = _grouped(documents, percent)
        named = classes.join(groups, classes["id"] == groups["node"], "left").withColumn(
            "component", F.coalesce("component", "id"))
        first = named.groupBy("component").agg(F.min("rank").alias("rank"))
        return first.select("rank.doc_id", "rank.text_id", F.lit(False).alias("bare")).union(
            signed.where("n_shingles = 0").select("doc_id", "text_id", F.lit(True)).distinct())

    kept = settled(ready(documents.sparkSession), "first-rows", first_rows).select(
        F.col("doc_id").alias("of_doc"), F.col("text_id").alias("of_text"), "bare")
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    rows = documents.select(row, F.col("doc_id").cast("long").alias("key_doc"), text_md5().alias("key_text"))
    nameless = F.col("bare") & F.col("of_doc").isNull()
    same = F.col("key_doc").eqNullSafe(F.col("of_doc")) & (F.col("key_text") == F.col("of_text"))
    one = rows.join(kept.where(~nameless), same, "left_semi").dropDuplicates(["key_doc", "key_text"])
    bare = rows.where("key_doc is null").join(kept.where(nameless), F.col("key_text") == F.col("of_text"), "left_semi")
    return one.union(bare).select(*[F.col(f"row.`{c}`") for c in documents.columns])
