import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents, prose

from paylode.llm import toxicity


def table(n=600, seed=2):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        sentences = [prose(1000 * seed + 10 * i + k, 8, "aeioustr") for k in range(rng.randint(1, 12))]
        bad = i % 4 == 0
        if bad:
            k = rng.randrange(len(sentences))
            sentences[k] += " " + rng.choice(["Vilefool", "vilekind!", "VILEST", "grrbah"])
        rows.append((i, ". ".join(sentences) + "."))
        labels.append((i, int(bad)))
    return rows, labels


@pytest.fixture(scope="module")
def learnt(spark):
    rows, labels = table()
    marked = spark.createDataFrame(labels + [(10**6, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    marked = marked.selectExpr("*", "'x' AS text", "1 AS weight").where(~toxicity.held_out())
    return rows, dict(labels), toxicity.train(documents(spark, rows, extra=True), marked)


def test_held_out_documents_are_told_apart(spark, learnt):
    rows, labels, model = learnt
    found = toxicity.score(documents(spark, rows, extra=True), model).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in found if r.held_out]
    assert len(held) > 60 and np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95


def test_the_sample_is_drawn_from_what_can_be_learnt_from(spark, monkeypatch):
    """Labels without a document, or with one that is too long, take no place in it."""
    monkeypatch.setattr(toxicity, "MOST_POSITIVE", 150)
    monkeypatch.setattr(toxicity, "MOST_NEGATIVE", 150)
    rows, labels = table()
    long_ = "tea " * (toxicity.LONGEST // 4 + 1)
    absent = [(10**6 + k, k % 2) for k in range(20_000)] + [(2 * 10**6 + k, k % 2) for k in range(40)]
    marked = spark.createDataFrame(labels + absent, "doc_id long, toxic int").where(~toxicity.held_out())
    model = toxicity.train(documents(spark, rows + [(2 * 10**6 + k, long_) for k in range(40)]), marked)
    found = toxicity.score(documents(spark, rows), model).where("held_out").collect()
    assert np.mean([r.predicted == dict(labels)[r.doc_id] for r in found]) > 0.95


def test_the_sample_has_its_full_size():
    assert (toxicity.MOST_POSITIVE, toxicity.MOST_NEGATIVE) == (3_000, 5_000)


def test_scores_are_noisy_or_of_the_sentences(learnt):
    rows, _, model = learnt
    texts = [t for _, t in rows[:40]] + ["", "no stop here", "...", None]
    found = toxicity.bags(pa.array(texts))
    fast = toxicity.noisy_or(toxicity.sentence_logits(model, found), found.doc, len(texts))
    for text, value in zip(texts, fast):
        clean = 1.0
        for sentence in (text or "").replace("!", ".").replace("?", ".").replace("\n", ".").split("."):
            one = toxicity.bags(pa.array([sentence]))
            if len(one.doc):
                clean *= 1 - 1 / (1 + np.exp(-toxicity.sentence_logits(model, one)[0]))
        assert value == pytest.approx(1 - clean, abs=1e-9)


def test_the_offending_sentence_is_located(spark, learnt):
    _, _, model = learnt
    text = "Ein schöner Tag. You vilefool of a man! tsar tea."
    found = toxicity.offending_sentences(documents(spark, [(1, text), (2, None), (3, "rest. tea")]), model).collect()
    assert [(r.doc_id, r.sentence) for r in found] == [(1, "You vilefool of a man")]
    assert text.encode()[found[0].start_byte:found[0].end_byte].decode() == found[0].sentence


def test_filter_keeps_clean_rows_and_all_columns(spark, learnt):
    _, _, model = learnt
    df = documents(spark, [(1, "vilekind vilefool."), (2, "tea rest."), (2, "tea rest."), (None, ""), (4, None)], extra=True)
    kept = toxicity.without_toxic(df, model)
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2", "2", "4", "None"]


def test_without_labels_of_both_kinds(spark):
    df = documents(spark, [(1, "some words."), (2, None)])
    for labels, value in (([], 0.0), ([(1, 1)], 1.0), ([(1, 0)], 0.0)):
        model = toxicity.train(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert [r.score for r in toxicity.score(df, model).collect()] == [value, value]
    assert toxicity.score(documents(spark, []), model).count() == 0


def test_long_text_and_reruns(spark, learnt):
    rows, labels, model = learnt
    marked = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int").where(~toxicity.held_out())
    again = toxicity.train(documents(spark, rows).repartition(5), marked)
    assert (again.features == model.features).all() and again.bias == model.bias and again.cut == model.cut
    long_ = prose(1, 60_000, "aeioustr")
    found = toxicity.score(documents(spark, [(1, long_), (2, long_ + ". vilefool vilest grrbah.")]), model).collect()
    assert found[0].score < found[1].score and found[1].predicted == 1


def test_features_are_counted_over_all_slices(monkeypatch):
    """The documents of every feature, however many slices and sums it comes from."""
    monkeypatch.setattr(toxicity, "MOST_FEATURES", 40)
    rows, labels = table(300)
    texts = pa.array([t for _, t in rows] + ["long " * 60_000, "", None] + [t for _, t in rows[:40]])
    labels = np.array([k for _, k in labels] + [1, 0, 1] + [0] * 40)
    n, k = Counter(), Counter()
    for text, label in zip(texts, labels):
        one = set(toxicity.bags(pa.array([text], pa.string())).feature.tolist())
        n.update(one)
        k.update(one if label else ())
    tally = toxicity._tallies(texts, labels)
    assert tally.hashes.tolist() == sorted(n)
    assert tally.n.tolist() == [n[h] for h in sorted(n)] and tally.k.tolist() == [k[h] for h in sorted(n)]


def test_the_fit_holds_few_features_at_once():
    """What it takes beside the texts is a small part of all their features."""
    rows, labels = table(400)
    texts = [" ".join([t] * 8) for _, t in rows] * 4
    kinds = [k for _, k in labels] * 4
    sample = pa.RecordBatch.from_pydict({"order": list(range(len(texts))), "toxic": kinds, "weight": [1.0] * len(texts), "text": texts})
    tracemalloc.start()
    model = next(toxicity._train(iter([sample])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(model.column("features")[0].as_py()) > 0
    assert peak < 8 * sum(map(len, texts))
