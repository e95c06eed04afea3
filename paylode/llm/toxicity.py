"""Toxicity as multiple-instance learning: a document is a bag of sentences and only bags have labels.

A sentence's score is logistic in its words and their first letters.  A document's is noisy-or: 1 minus the product of the
sentences' complements, so one offending sentence is enough and a long clean text stays clean.  The
likelihood of the documents' labels trains the sentences' weights, which then say where the offence is.

The model is fitted in one task on a bounded sample of labelled rows, ``MOST_POSITIVE`` and
``MOST_NEGATIVE`` documents of at most ``LONGEST`` bytes in the order of a hash of their id, weighted back to
the shares among all labelled documents of that length; it keeps at most ``MOST_FEATURES`` words.  So the sample's words and the
model, which goes to every task, have a fixed size bound.  Scoring reads every whole text.

Defined results: null and empty texts score 0, as does everything without a labelled row; with labels of one
kind only, every document scores that kind's value.  Labels that are null or have no document are ignored;
if an id has several labels, the larger counts.  Rows without an id are scored and count as held out.
Repeated rows score alike.  Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylode.llm import hashing
from paylode.llm.common import hash_sample, ready, slices
from paylode.llm.hashing import U64
from paylode.session import settled

MOST_POSITIVE = 3_000
MOST_NEGATIVE = 5_000
LONGEST = 64 << 10
MOST_FEATURES = 50_000
LEAST_RATIO = 20.0
EPOCHS = 30
RATE = 0.3
START_BIAS = -5.0

#: Bytes between words: what is neither an ASCII letter or digit nor part of a longer character.
GAPS = np.ones(256, bool)
GAPS[48:58] = GAPS[65:91] = GAPS[97:123] = GAPS[128:] = False
STOPS = np.zeros(256, bool)
STOPS[list(b".!?\n")] = True


#: Bytes of the beginnings of words that are features beside the whole word.
BEGINNINGS = (4, 5, 6)


class Model(NamedTuple):
    features: np.ndarray    # sorted hashes
    weights: np.ndarray
    bias: float
    constant: float | None  # the score of every document, where labels have one kind only
    cut: float = 0.5        # the noisy-or that becomes a score of one half


class Bags(NamedTuple):
    feature: np.ndarray     # hash of a word or of a word's beginning
    sentence: np.ndarray    # of each feature
    doc: np.ndarray         # of each sentence
    start: np.ndarray       # first byte of each sentence's first word, in the buffer
    end: np.ndarray         # byte after its last word


def bags(texts: pa.Array) -> Bags:
    """The features of the texts by sentence; a sentence without a word is none."""
    buffer, at = hashing.buffer_of(texts)
    found = hashing.words(buffer, at, lower=True, gaps=GAPS)
    stops = np.cumsum(STOPS[buffer])
    number = stops[found.start] if len(found.start) else found.start
    change = np.ones(len(number), bool)
    change[1:] = (number[1:] != number[:-1]) | (found.doc[1:] != found.doc[:-1])
    sentence = (np.cumsum(change) - 1).astype(np.int32)
    first = np.flatnonzero(change)
    last = np.concatenate((first[1:], [len(number)]))[:len(first)] - 1
    feature, owner = [found.hash], [sentence]
    sums = hashing.prefix_sums(buffer, hashing.VALUE_LOWER)
    for size, salt in zip(BEGINNINGS, hashing.constants("beginning", len(BEGINNINGS))):
        long_ = np.flatnonzero(found.end - found.start >= size)
        starts = found.start[long_]
        feature.append(hashing.mix(hashing.window_hashes(sums, starts, starts + size) ^ salt))
        owner.append(sentence[long_])
    return Bags(np.concatenate(feature), np.concatenate(owner), found.doc[first], found.start[first], found.end[last])


def many_bags(texts: pa.Array) -> Iterator[tuple[int, Bags]]:
    """The same for many texts, a slice at a time, each with the number of its first text.

    A text's bytes and features need far more room than what is learnt from them, so no two slices are held at once.
    """
    docs = 0
    for part in slices(pa.RecordBatch.from_arrays([texts], names=["text"]), "text"):
        yield docs, bags(part.column("text"))
        docs += len(part)


def sentence_logits(model: Model, found: Bags, sieve: np.ndarray | None = None) -> np.ndarray:
    """``sieve`` marks the first bits of the model's hashes, so that few features have to be searched."""
    total = np.full(len(found.doc), model.bias)
    if len(model.features) and len(found.doc):
        some, spot = _known(model.features, _sieve(model.features) if sieve is None else sieve, found.feature)
        total += np.bincount(found.sentence[some], weights=model.weights[spot], minlength=len(found.doc))
    return total


_SIEVE = U64(44)


def _sieve(features: np.ndarray) -> np.ndarray:
    marks = np.zeros(1 << 20, bool)
    marks[(features >> _SIEVE).astype(np.int64)] = True
    return marks


def _known(features: np.ndarray, sieve: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes are among the sorted features, and where."""
    some = np.flatnonzero(sieve[(hashes >> _SIEVE).astype(np.int32)])
    spot = np.minimum(np.searchsorted(features, hashes[some]), len(features) - 1)
    exact = features[spot] == hashes[some]
    return some[exact], spot[exact]


def noisy_or(logits: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    return -np.expm1(np.bincount(doc, weights=-np.logaddexp(0, logits), minlength=n))


class Tally(NamedTuple):
    hashes: np.ndarray      # sorted and different
    n: np.ndarray           # the documents that have each
    k: np.ndarray           # and the positive ones among them


def _tally(found: Bags, labels: np.ndarray) -> Tally:
    # By hash, and by document within a hash: a hash is of one kind, and those come by document.
    order = np.argsort(found.feature, kind="stable").astype(np.int32)
    hashes, doc = found.feature[order], found.doc[found.sentence[order]]
    first = hashing.firsts(hashes)
    fresh = np.ones(len(hashes), np.int32)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return Tally(hashes[first], *(np.add.reduceat(x, first, dtype=np.int32) if len(first) else fresh
                                  for x in (fresh, fresh * (labels[doc] == 1))))


def _sum(parts: list[Tally]) -> Tally:
    """One tally of several that have no document in common."""
    hashes = np.concatenate([p.hashes for p in parts])
    order = np.argsort(hashes, kind="stable").astype(np.int32)
    hashes = hashes[order]
    first = hashing.firsts(hashes)
    return Tally(hashes[first], *(np.add.reduceat(np.concatenate(x)[order], first, dtype=np.int32) if len(first) else order
                                  for x in (([p.n for p in parts], [p.k for p in parts]))))


def _tallies(texts: pa.Array, labels: np.ndarray) -> Tally:
    """Added up whenever the new ones have as many hashes as the sum, so that it stays in proportion to the different hashes."""
    total, fresh = _tally(bags(texts[:0]), labels), []
    for docs, found in many_bags(texts):
        fresh.append(_tally(found, labels[docs:]))
        if sum(len(t.hashes) for t in fresh) > max(len(total.hashes), MOST_FEATURES):
            total, fresh = _sum([total, *fresh]), []
    return _sum([total, *fresh])


def _vocabulary(tally: Tally, labels: np.ndarray) -> np.ndarray:
    """Hashes of the features whose documents differ from the others in their labels, the clearest if too many.

    The measure is the likelihood ratio of two shares of positive documents against one; a feature that only
    a few documents have cannot reach ``LEAST_RATIO``, and so cannot be learnt by heart.
    """
    total, positive = len(labels), int(labels.sum())

    def fit_of(k: np.ndarray, n: np.ndarray) -> np.ndarray:
        share = np.clip(k / np.maximum(n, 1), 1e-12, 1 - 1e-12)
        return k * np.log(share) + (n - k) * np.log(1 - share)

    ratio = np.zeros(len(tally.hashes))
    for some in (slice(i, i + MOST_FEATURES) for i in range(0, len(ratio), MOST_FEATURES)):
        n, k = tally.n[some], tally.k[some]
        ratio[some] = 2 * (fit_of(k, n) + fit_of(positive - k, total - n) - fit_of(np.array(positive), np.array(total)))
    clear = np.flatnonzero(ratio >= LEAST_RATIO)
    clear = np.sort(clear[np.argsort(-ratio[clear], kind="stable")[:MOST_FEATURES]])
    return tally.hashes[clear]


def _known_bags(texts: pa.Array, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in the vocabulary of all features that it has, their sentences, in order, and the document of each sentence."""
    sieve, sentences = _sieve(vocabulary), 0
    parts = [(np.zeros(0, np.int32),) * 3]
    for docs, found in many_bags(texts):
        known, feature = _known(vocabulary, sieve, found.feature)
        sentence = found.sentence[known]
        order = np.argsort(sentence, kind="stable")
        parts.append((feature[order].astype(np.int32), sentence[order] + np.int32(sentences), (found.doc + docs).astype(np.int32)))
        sentences += len(found.doc)
    feature, sentence, doc = map(np.concatenate, zip(*parts))
    return feature, sentence, doc


def fit(labels: np.ndarray, weights: np.ndarray, texts: pa.Array) -> Model:
    """Adagrad on the documents' log likelihood, in a fixed order, so that reruns agree.

    The texts are read twice, to count the documents of every feature and to find the chosen ones.
    """
    none = np.zeros(0, U64), np.zeros(0)
    if not len(labels) or labels.min() == labels.max():
        return Model(*none, START_BIAS, float(labels[0]) if len(labels) else 0.0)
    vocabulary = _vocabulary(_tallies(texts, labels), labels)
    if not len(vocabulary):
        return Model(*none, START_BIAS, None)
    feature, sentence, doc = _known_bags(texts, vocabulary)
    feature_at = np.searchsorted(doc[sentence], np.arange(len(labels) + 1, dtype=np.int32))
    sentence_at = np.searchsorted(doc, np.arange(len(labels) + 1, dtype=np.int32))
    w, b = np.zeros(len(vocabulary)), START_BIAS
    w_seen, b_seen = np.full(len(vocabulary), 1e-6), 1e-6
    rng = np.random.Generator(np.random.PCG64(11))
    for _ in range(EPOCHS):
        for some in np.array_split(rng.permutation(len(labels)), max(1, len(labels) // 256)):
            take = [np.arange(feature_at[d], feature_at[d + 1]) for d in some]
            f = feature[np.concatenate(take)]
            counts = sentence_at[some + 1] - sentence_at[some]
            first = np.concatenate(([0], np.cumsum(counts)))
            s = np.concatenate([sentence[t] - sentence_at[d] + first[k] for k, (d, t) in enumerate(zip(some, take))])
            owner = np.repeat(np.arange(len(some)), counts)
            z = b + np.bincount(s, weights=w[f], minlength=len(owner))
            p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
            clean = np.exp(np.bincount(owner, weights=-np.logaddexp(0, z), minlength=len(some)))
            pull = weights[some] * np.where(labels[some] == 1, -clean / np.maximum(1 - clean, 1e-9), 1.0) / len(some)
            g = pull[owner] * p
            g_w = np.bincount(f, weights=g[s], minlength=len(w)) + 1e-4 * w
            w_seen += g_w * g_w
            w -= RATE * g_w / np.sqrt(w_seen)
            b_seen += g.sum() ** 2
            b -= 0.1 * g.sum() / np.sqrt(b_seen)
    useful = np.abs(w) > 1e-2
    some = np.flatnonzero(useful[feature])
    logits = b + np.bincount(sentence[some], weights=w[feature[some]], minlength=len(doc))
    return Model(vocabulary[useful], w[useful], float(b), None, _cut(noisy_or(logits, doc, len(labels)), labels, weights))


def _cut(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """Where to tell the kinds apart: the best F1 on the sample, half way to the next lower score."""
    order = np.argsort(-scores, kind="stable")
    ranked, hit = scores[order], np.cumsum((weights * labels)[order])
    f1 = 2 * hit / (np.cumsum(weights[order]) + hit[-1])
    f1[:-1][ranked[:-1] == ranked[1:]] = 0
    best = int(np.argmax(f1))
    below = ranked[best + 1] if best + 1 < len(ranked) else 0.0
    return float(np.clip((ranked[best] + below) / 2, 0.05, 0.95))


def calibrated(scores: np.ndarray, cut: float) -> np.ndarray:
    """The same order, with the cut at one half."""
    return scores * (1 - cut) / (scores * (1 - cut) + (1 - scores) * cut)


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches(list(batches)).sort_by([("order", "ascending"), ("text", "ascending")])
    model = fit(rows.column("toxic").to_numpy(), rows.column("weight").to_numpy(), rows.column("text").combine_chunks())
    yield pa.RecordBatch.from_arrays(
        [pa.array([model.features.tobytes()]), pa.array([model.weights.tobytes()]), pa.array([model.bias]),
         pa.array([model.constant], pa.float64()), pa.array([model.cut])], names=["features", "weights", "bias", "constant", "cut"])


def document_scores(model: Model, found: Bags, n: int, sieve: np.ndarray | None = None) -> np.ndarray:
    if model.constant is not None:
        return np.full(n, model.constant)
    return np.clip(calibrated(noisy_or(sentence_logits(model, found, sieve), found.doc, n), model.cut), 0.0, 1.0)


def held_out(doc_id: str = "doc_id") -> Column:
    """A fifth of the ids: crc32 of the id as text is a multiple of 5."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(documents: DataFrame, labels: DataFrame) -> Model:
    """A model from labelled documents; give only the rows that may be learnt from."""
    spark = ready(documents.sparkSession)
    given = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"))
    texts = documents.select("doc_id", "text").where(F.octet_length(F.coalesce("text", F.lit(""))) <= LONGEST)
    # Only what can be learnt from is drawn and weighted.
    marked = settled(spark, "usable-labels", lambda: given.join(texts.select("doc_id"), "doc_id", "left_semi"))
    rows, total = [], {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    for kind, most in ((1, MOST_POSITIVE), (0, MOST_NEGATIVE)):
        if total.get(kind):
            chosen = hash_sample(marked.where(F.col("toxic") == kind), most, total[kind], "doc_id")
            rows.append(chosen.withColumn("order", F.xxhash64("doc_id")).withColumn(
                "weight", F.lit(max(1.0, total[kind] / most))))
    if not rows:
        return Model(np.zeros(0, U64), np.zeros(0), START_BIAS, 0.0)
    sample = rows[0] if len(rows) == 1 else rows[0].union(rows[1])
    # At most MOST_POSITIVE + MOST_NEGATIVE rows of four numbers.
    sample = texts.join(F.broadcast(sample), "doc_id").select("order", "toxic", "weight", "text").dropDuplicates(["order"])
    fitted = sample.repartition(1).mapInArrow(
        _train, "features binary, weights binary, bias double, constant double, cut double").first()
    if fitted is None:
        return Model(np.zeros(0, U64), np.zeros(0), START_BIAS, 0.0)
    return Model(np.frombuffer(fitted["features"], U64), np.frombuffer(fitted["weights"]), fitted["bias"], fitted["constant"],
                 fitted["cut"])


def _score(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        sieve = _sieve(model.features)
        for batch in batches:
            for part in slices(batch, "text"):
                scores = document_scores(model, bags(part.column("text")), len(part), sieve)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(scores)],
                    names=["doc_id", "held_out", "score"])

    return score


def score(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted``: a row per document."""
    spark = ready(documents.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    rows = rows.mapInArrow(_score(shared), "doc_id long, held_out boolean, score double")
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _locate(shared, least: float):
    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                found = bags(part.column("text"))
                buffer, at = hashing.buffer_of(part.column("text"))
                scores = 1 / (1 + np.exp(-sentence_logits(model, found)))
                bad = np.flatnonzero(scores >= least)
                doc, starts, ends = found.doc[bad], found.start[bad], found.end[bad]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(doc)), pa.array(starts - at[doc]), pa.array(ends - at[doc]),
                    pa.array([buffer[a:b].tobytes().decode() for a, b in zip(starts, ends)], pa.string()),
                    pa.array(scores[bad])], names=["doc_id", "start_byte", "end_byte", "sentence", "score"])

    return locate


def offending_sentences(documents: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """``doc_id, start_byte, end_byte, sentence, score`` of each sentence that scores ``least`` or more."""
    shared = ready(documents.sparkSession).sparkContext.broadcast(model)
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _locate(shared, least), "doc_id long, start_byte long, end_byte long, sentence string, score double")


def without_toxic(documents: DataFrame, model: Model) -> DataFrame:
    """The documents that are not predicted toxic; all rows and columns of the others stay.

    The text is scored beside its row, so nothing is joined or shuffled.
    """
    shared = ready(documents.sparkSession).sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        sieve = _sieve(fitted.features)
        for batch in batches:
            for part in slices(batch, "text"):
                scores = document_scores(fitted, bags(part.column("text")), len(part), sieve)
                yield part.filter(pa.array(scores < 0.5))

    return documents.mapInArrow(keep, documents.schema)
