import math
import random

import numpy as np
import pytest
from helpers import groups

from paylode.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def by_force(rows, threshold=0.93):
    usable = {k: np.array(v, np.float32).astype(float) for k, (_, v, label) in enumerate(rows)
              if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    unit = {k: v / np.linalg.norm(v) for k, v in usable.items()}
    links = [(a, b) for a in usable for b in usable if a < b and rows[a][2] == rows[b][2]
             and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold]
    degree = {k: sum(k in link for link in links) for k in range(len(rows))}
    ids = [r[0] for r in rows]
    lowest = groups(ids, [(ids[a], ids[b]) for a, b in links])
    return sorted((ids[k], degree[k], lowest[ids[k]]) for k in range(len(rows)))


def table():
    rng = np.random.default_rng(6)
    rows = []
    for _ in range(25):
        centre = rng.standard_normal(16)
        rows += [(centre + rng.standard_normal(16) * 0.12 * rng.random()).tolist() for _ in range(int(rng.integers(1, 8)))]
    dense = rng.standard_normal(16)
    rows += [(dense + rng.standard_normal(16) * 0.05).tolist() for _ in range(150)]
    rows += [rows[0], (np.array(rows[1]) * 1e20).tolist(), (np.array(rows[2]) * 1e-20).tolist(), [0.0] * 16, [], None,
             [None, *rows[3][1:]], [math.nan, *rows[3][1:]], [math.inf, *rows[3][1:]], rows[4][:8], rows[4][:8]]
    labels = [k % 2 if k < 30 else 1 for k in range(len(rows))]
    out = [(3 * k, v, labels[k]) for k, v in enumerate(rows)] + [(1, rows[0], None), (2, rows[0], None)]
    random.Random(2).shuffle(out)
    return out


@pytest.mark.parametrize("window,rows_per_task,block", [(64, 50_000, 1000), (8, 300, 20)])
def test_links_and_components_are_those_of_brute_force(spark, monkeypatch, window, rows_per_task, block):
    """Also where the dense group is wider than the window, a pass has many partitions and a group many blocks."""
    monkeypatch.setattr(vectors, "ROWS_PER_PARTITION", rows_per_task)
    monkeypatch.setattr(vectors, "BLOCK", block)
    rows = table()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS id", "'y' AS pass", "1 AS n_links")
    found = vectors.near_duplicate_vectors(df, window=window).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == by_force(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_repeated_rows_rows_without_id_and_an_empty_table(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(5, v, 1), (5, v, 1), (None, v, 1), (None, [3.0, 0.0, 0.0], 1), (9, [3.0, 0.0, 0.0], 2)]
    found = vectors.near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in found) == [
        ("5", 2, "5"), ("5", 2, "5"), ("9", 0, "9"), ("None", 0, "None"), ("None", 2, "5")]
    assert vectors.near_duplicate_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("common", [0.0, 0.7])
def test_isolated_pairs_are_found_whatever_direction_all_vectors_share(spark, common):
    """Pairs barely over the threshold among 12 000 others; found or not is held against brute force."""
    rng = np.random.default_rng(11)
    n, pairs, width = 12_000, 300, 64

    def units(k):
        drawn = rng.standard_normal((k, width))
        drawn[:, 0] = 0
        return drawn / np.linalg.norm(drawn, axis=1, keepdims=True)

    own = units(n)
    about = (0.931 - common) / (1 - common)
    other = units(pairs)
    other -= (other * own[:pairs]).sum(axis=1, keepdims=True) * own[:pairs]
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    own = np.concatenate([own, about * own[:pairs] + math.sqrt(1 - about * about) * other])
    every = math.sqrt(1 - common) * own
    every[:, 0] = math.sqrt(common)
    true = {k for a in range(0, len(every), 1000) for i, j in zip(*np.nonzero(every[a:a + 1000] @ every.T >= 0.93))
            for k in [i + a] if j != i + a}
    assert len(true) >= 2 * pairs
    rows = [(k, v.tolist(), 1) for k, v in enumerate(every)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = vectors.near_duplicate_vectors(df)
    linked = {r.vec_id for r in found.where("n_links > 0").collect()}
    assert linked <= true and len(linked) >= 0.99 * len(true)
