import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents, prose

from paylode.llm import quality


def by_force(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def table():
    line = prose(1, 12)
    good = [prose(k, 40 + k) + ".\n" + prose(k + 500, 25) for k in range(160)]
    junk = [" ".join(w + "***%%%"[k % 4:] for w in prose(k + 900, 50).split()) for k in range(25)]
    odd = [None, "", " \n\t", "one", f"{line}\n{line}\n {line}\n{line}", "Übung € 🙂 " * 30, " ".join(["spam"] * 200),
           prose(7, 30) + " " + prose(7, 30), "a\x0bb\x0cc\u00a0d\u2028e\x1cf " * 5, "same same\r\nsame same\r\n" * 9, prose(3, 20_000)]
    return good + junk + odd, len(good), len(junk)


def test_counts_are_those_of_brute_force(spark):
    texts, _, _ = table()
    rows = quality.statistics(documents(spark, list(enumerate(texts)), extra=True)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = by_force(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 20 or 100 * n[4] > 30 * n[0])


def test_junk_goes_and_good_documents_stay(spark):
    texts, good, junk = table()
    labels = [(k, 1) for k in range(0, good, 2)] + [(k, 0) for k in range(good, good + junk, 2)] + [(None, 0), (1, None), (9999, 0)]
    marked = spark.createDataFrame(labels, "doc_id long, quality int").selectExpr("*", "'x' AS anomaly", "1 AS n_words")
    df = documents(spark, list(enumerate(texts)), extra=True)
    rows = {r.doc_id: r for r in quality.judged(df, marked).collect()}
    assert all(not r.kept for r in rows.values() if r.base_failed)
    assert np.mean([rows[k].kept for k in range(good)]) >= 0.98
    assert not any(rows[k].kept for k in range(good, good + junk))
    again = {r.doc_id: r.anomaly for r in quality.judged(df.repartition(5), marked).collect()}
    assert again == {k: r.anomaly for k, r in rows.items()}


def test_without_labels_only_the_base_rules_decide(spark):
    texts, _, _ = table()
    df = documents(spark, [*enumerate(texts), (3, texts[3]), (None, texts[4])])
    rows = quality.judged(df, spark.createDataFrame([], "doc_id long, quality int")).collect()
    assert len(rows) == len(texts) + 2 and all(r.kept != r.base_failed for r in rows)
    assert quality.judged(documents(spark, []), spark.createDataFrame([], "doc_id long, quality int")).count() == 0


def test_outliers_have_short_paths():
    rng = np.random.default_rng(1)
    rows = np.concatenate([rng.normal(0, 1, (2000, 3)), [[9, 9, 9], [-8, 0, 7]]])
    scores = quality.anomaly(quality.plant(rows), rows)
    assert set(np.argsort(-scores)[:2]) == {2000, 2001} and 0 < scores.min() < scores.max() < 1
    assert (quality.anomaly(quality.plant(np.zeros((50, 3))), np.zeros((5, 3))) <= 1).all()


def test_the_threshold_loses_few_good_rows():
    good, bad = np.zeros(quality.BINS, int), np.zeros(quality.BINS, int)
    good[100], good[900], bad[950] = 999, 1, 50
    assert quality._threshold(good, bad) * quality.BINS == pytest.approx(101)
    assert quality._threshold(good, bad * 0) == float("inf")


def test_paths_are_those_of_a_plain_walk_and_trees_split_their_own_rows():
    rng = np.random.default_rng(5)
    sample = np.round(rng.random((900, 4)), 2)
    forest = quality.plant(sample, trees=3, rows_per_tree=300)
    expected = lambda n: 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n

    def leaf(tree, row):
        node, steps = 0, 0
        while tree.feature[node] >= 0:
            node, steps = (tree.left if row[tree.feature[node]] <= tree.cut[node] else tree.right)[node], steps + 1
        return node, steps

    for t, tree in enumerate(forest.trees):
        reached = [leaf(tree, row) for row in sample[300 * t:300 * (t + 1)]]
        for node, steps in set(reached):
            held = [n for n, _ in reached].count(node)
            assert tree.depth[node] == pytest.approx(steps + expected(held)) and steps <= 9
    rows = rng.random((50, 4)) * 1.4
    mean = [np.mean([tree.depth[leaf(tree, row)[0]] for tree in forest.trees]) for row in rows]
    assert quality.anomaly(forest, rows) == pytest.approx([2 ** (-m / expected(300)) for m in mean])
