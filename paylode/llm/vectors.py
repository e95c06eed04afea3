"""Near-duplicate vectors by sorted projection passes.

Each pass projects all vectors on its own random hyperplanes and orders them by the concatenated signs;
near vectors agree in their first signs and stand near each other.  A sliding window compares every vector
with its ``WINDOW`` followers in that order, in double precision, and the pairs found in all passes are
united into components.

The hyperplanes go through the mean of a label's unit vectors, so that a direction that all of them share does
not give all the same signs; cosines are those of the vectors as they are.  The number of passes of a label
follows from its size and from what the mean takes away: two vectors of cosine ``threshold`` in a label of mean
cosine m have (threshold - m) / (1 - m) about the mean, which is the chance p of an equal sign, and meet in a
window if the first log2(size / window) signs agree.  The passes are as many as leave such a pair apart with
probability ``MISS`` at most, at every size, if the label has no further common direction; a label that fits a
window needs one.  (Above a mean cosine where (threshold - m) / (1 - m) is ``LEAST_COSINE`` the passes grow no
further: there most pairs of the label are near the threshold.)

The window bounds the work of a pass, not the result: within a component all its vectors are then compared
in blocks of about ``BLOCK``, of which only the numbers of links come out, so that a dense group larger than
the window still gets all its links.  Only a link between two components that no pass put within a window
of each other can be missed, as stated above.  Equal vectors are one class that is compared once and counted with its copies.

Order and comparison need no group in one task: a pass is a range partitioning over all labels, and the
first and last ``WINDOW`` rows of each partition are compared in a further, much smaller round.

Defined results: vectors are compared when labels and lengths are equal.  Null labels, null, empty and zero
vectors and those with null or non-finite components link with nothing.  Repeated rows are links of each
other and share a component.  A row without an id takes its class's component, null if no copy has an id.
Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylode.llm.common import components, ready
from paylode.session import settled, staged

WINDOW = 256
MISS = 0.001
LEAST_COSINE = 0.5
BITS = 63
BLOCK = 8_000
SLICE = 500
ROWS_PER_PARTITION = 50_000


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def _unit(matrix: np.ndarray) -> np.ndarray:
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest of each usable vector; null where it can have no links."""
    for batch in batches:
        digests, widths = [], []
        for label, vector in zip(batch.column("label").to_pylist(), batch.column("embedding")):
            values = None if label is None else vector.values
            usable = values is not None and len(values) and not values.null_count
            if usable:
                numbers = values.to_numpy(zero_copy_only=False).astype(float) + 0.0  # one zero, not two
                usable = bool(np.isfinite(numbers).all() and numbers.any())
            digests.append(hashlib.blake2b(numbers.tobytes(), digest_size=16).digest() if usable else None)
            widths.append(len(values) if usable else 0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), batch.column("embedding"),
             pa.array(digests, pa.binary()), pa.array(widths, pa.int32())],
            names=["vec_id", "label", "embedding", "digest", "width"])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number and sum of the unit vectors of a batch by label and width."""
    for batch in batches:
        widths, labels = batch.column("width").to_numpy(), batch.column("label").to_numpy()
        for width in np.unique(widths):
            of_width = widths == width
            unit = _unit(_matrix(batch.filter(pa.array(of_width)).column("embedding"), int(width)))
            found, place = np.unique(labels[of_width], return_inverse=True)
            sums = np.zeros((len(found), int(width)))
            np.add.at(sums, place, unit)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found), pa.array(np.full(len(found), width, np.int32)), pa.array(np.bincount(place)),
                 pa.array(list(sums), pa.list_(pa.float64()))],
                names=["label", "width", "n", "sums"])


def _centres(vectors: DataFrame, threshold: float, window: int) -> DataFrame:
    """``label, width, n, centre, passes`` of each label; sums are combined a coordinate at a time."""
    key = ["label", "width"]
    sums = vectors.select(*key, "embedding").mapInArrow(_sums, "label long, width int, n long, sums array<double>")
    sums = sums.select(*key, "n", F.posexplode("sums").alias("at", "value"))
    means = sums.groupBy(*key, "at").agg(F.sum("n").alias("n"), (F.sum("value") / F.sum("n")).alias("mean"))
    centres = means.groupBy(*key).agg(
        F.max("n").alias("n"), F.sum(F.col("mean") * F.col("mean")).alias("common"),
        F.array_sort(F.collect_list(F.struct("at", "mean"))).getField("mean").alias("centre"))
    about = F.greatest((threshold - F.col("common")) / F.greatest(1 - F.col("common"), F.lit(1e-9)), F.lit(LEAST_COSINE))
    equal_sign = 1 - F.acos(F.least(about, F.lit(1.0))) / math.pi
    meet = F.pow(equal_sign, F.log2(F.col("n") / window))
    passes = F.when(F.col("n") <= window, 1).otherwise(F.ceil(math.log(MISS) / F.log1p(-F.least(meet, F.lit(0.999)))))
    return centres.select(*key, "n", "centre", passes.cast("int").alias("passes"))


def _project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each pass of a vector, with the signs of its distance from the label's centre."""
    def normals(width: int, k: int) -> np.ndarray:
        return np.random.Generator(np.random.PCG64([7, width, k])).standard_normal((BITS, width))

    planes: dict[tuple[int, int], np.ndarray] = {}
    weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    for batch in batches:
        widths, passes = batch.column("width").to_numpy(), batch.column("passes").to_numpy()
        for width in np.unique(widths):
            for k in range(int(passes[widths == width].max())):
                if (int(width), k) not in planes:
                    planes[int(width), k] = normals(int(width), k)
            due = np.flatnonzero(widths == width)
            rows = batch.take(pa.array(due))
            about = _unit(_matrix(rows.column("embedding"), int(width))) - _matrix(rows.column("centre"), int(width))
            for k in range(int(passes[due].max())):
                here = np.flatnonzero(passes[due] > k)
                code = ((about[here] @ planes[int(width), k].T) > 0) @ weights
                of_pass = rows.take(pa.array(here))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(here), k, np.int32)), of_pass.column("label"), of_pass.column("width"),
                     pa.array(code), of_pass.column("id"), of_pass.column("embedding")],
                    names=["pass", "label", "width", "code", "id", "embedding"])


def _windows(threshold: float, window: int, edges: bool):
    """Links within the window of a sorted partition and, with ``edges``, its first and last rows."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first = None, True
        for batch in batches:
            for start in range(0, len(batch), 4096):
                fresh = batch.slice(start, 4096)
                n_held = 0 if held is None else len(held)
                both = fresh if held is None else pa.Table.from_batches([held, fresh]).combine_chunks().to_batches()[0]
                if edges and first:
                    yield _row_batch(both.slice(0, window))
                    first = False
                yield _links(both, n_held, threshold, window)
                held = both.slice(max(0, len(both) - window))
        if edges and held is not None:
            yield _row_batch(held)

    return compare


def _row_batch(rows: pa.RecordBatch) -> pa.RecordBatch:
    none = pa.nulls(len(rows), pa.int64())
    return pa.RecordBatch.from_arrays([*rows.columns, none, none], names=[*rows.schema.names, "a", "b"])


def _stars(one: np.ndarray, two: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First and other members of the groups of ``n`` places that the pairs connect."""
    names = np.arange(n)
    while len(one):
        lower, least = names.copy(), np.minimum(names[one], names[two])
        np.minimum.at(lower, one, least)
        np.minimum.at(lower, two, least)
        lower = lower[lower]
        if (lower == names).all():
            break
        names = lower
    other = np.flatnonzero(names != np.arange(n))
    return names[other], other


def _links(rows: pa.RecordBatch, known: int, threshold: float, window: int) -> pa.RecordBatch:
    """What links each row from ``known`` on with the ``window`` before it, by groups of equal pass, label, width.

    Rows that the links of one slice connect come out as pairs with the first of them: at most a pair per row,
    however dense the group.
    """
    keys = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in ("pass", "label", "width")])
    change = np.flatnonzero(np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)))) if len(rows) else []
    ids = rows.column("id").to_numpy()
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for start, end in zip(change, [*change[1:], len(rows)]):
        unit = _unit(_matrix(rows.column("embedding").slice(start, end - start), int(keys[2, start])))
        for at in range(max(start, known), end, 256):
            until = min(end, at + 256)
            low = max(start, at - window)
            near = unit[at - start:until - start] @ unit[low - start:until - start].T >= threshold
            i, j = np.nonzero(near)
            i += at - low
            keep = (j < i) & (i - j <= window)
            first, other = _stars(i[keep], j[keep], until - low)
            left.append(ids[low + first])
            right.append(ids[low + other])
    a, b = np.concatenate(left), np.concatenate(right)
    nulls = [pa.nulls(len(a), f.type) for f in rows.schema]
    return pa.RecordBatch.from_arrays(
        [*nulls, pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=[*rows.schema.names, "a", "b"])


def _block_counts(threshold: float):
    """Number of links of each member with the others of its pair of blocks, a group at a time."""

    def counted(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        group = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
        unit = _unit(_matrix(group.column("embedding"), group.column("width")[0].as_py()))
        blocks = group.column("block").to_numpy()
        copies = group.column("copies").to_numpy()
        x, y = group.column("x")[0].as_py(), group.column("y")[0].as_py()
        one, two = np.flatnonzero(blocks == x), np.flatnonzero(blocks == y)
        counts = np.zeros(len(group), np.int64)
        for at in range(0, len(one), SLICE):
            part = one[at:at + SLICE]
            near = (unit[part] @ unit[two].T) >= threshold
            if x == y:
                near[np.arange(len(part)), np.arange(at, at + len(part))] = False
            else:
                counts[two] += near.T @ copies[part]
            counts[part] += near @ copies[two]
        return pa.RecordBatch.from_arrays([group.column("id"), pa.array(counts)], names=["id", "links"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, group = None, []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("component", "x", "y")])
            starts = np.flatnonzero(np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)))) if len(batch) else []
            for start, end in zip(starts, [*starts[1:], len(batch)]):
                if tuple(keys[:, start]) != current:
                    if group:
                        yield counted(group)
                    current, group = tuple(keys[:, start]), []
                group.append(batch.slice(start, end - start))
        if group:
            yield counted(group)

    return count


def near_duplicate_vectors(
    embeddings: DataFrame, threshold: float = 0.93, window: int = WINDOW
) -> DataFrame:
    """``vec_id, n_links, component_id, kept``: a row per vector; see the module's text."""
    return settled(ready(embeddings.sparkSession), "near-duplicate-vectors",
                   lambda: _near_duplicate_vectors(embeddings, threshold, window))


def _near_duplicate_vectors(embeddings: DataFrame, threshold: float, window: int) -> DataFrame:
    kind = dict(embeddings.dtypes)["embedding"]
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    rows = rows.mapInArrow(_read, f"vec_id long, label long, embedding {kind}, digest binary, width int")
    rows = staged(rows, "vectors")
    same = ["label", "digest"]
    classes = rows.where("digest is not null").groupBy(*same).agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("width").alias("width"),
        F.first("embedding").alias("embedding"))
    classes = staged(classes, "vector-classes")
    named = classes.where("id is not null")

    order = ["pass", "label", "width", "code", "id"]
    layout = f"pass int, label long, width int, code long, id long, embedding {kind}"
    centres = staged(_centres(named, threshold, window), "vector-centres")
    todo = named.select("width", "label", "id", "embedding").join(centres.drop("n"), ["label", "width"]).mapInArrow(_project, layout)
    links, left = None, centres.agg(F.sum(F.col("n") * F.col("passes"))).first()[0]
    while left:
        parts = max(1, left // ROWS_PER_PARTITION)
        dealt = todo.repartitionByRange(parts, *order) if parts > 1 else todo.repartition(1)
        found = staged(dealt.sortWithinPartitions(*order).mapInArrow(
            _windows(threshold, window, parts > 1), layout + ", a long, b long"), "projection-pass")
        fresh = found.where("a is not null").select("a", "b")
        links = fresh if links is None else links.union(fresh)
        todo = found.where("a is null").drop("a", "b")
        left = todo.count() if parts > 1 else 0
    if links is None:
        groups = named.select(F.col("id").alias("node"), F.col("id").alias("component")).limit(0)
    else:
        groups = components(links)
    groups = staged(groups, "vector-groups")

    # Blocks of a component meet in pairs; a member goes to as many groups as its component has blocks.
    sizes = groups.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    members = named.join(groups, named["id"] == groups["node"]).join(sizes, "component").withColumn(
        "block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.select(
        "component", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "id", "copies",
        "width", "embedding")
    key = ["component", "x", "y"]
    counts = members.repartition(*key).sortWithinPartitions(*key).mapInArrow(
        _block_counts(threshold), "id long, links long").groupBy("id").agg(F.sum("links").alias("links"))

    known = classes.join(groups, classes["id"] == groups["node"], "left").join(counts, "id", "left").select(
        *same, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"))
    out = rows.select("vec_id", *same).join(known, same, "left")
    out = out.withColumn("component_id", F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id")))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
                      F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
