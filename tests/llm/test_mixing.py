from collections import defaultdict

import numpy as np
import pytest
from helpers import documents, prose

from paylode.llm import mixing


def targets_by_force(sizes):
    """Hand out by weight, stop at the cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, full, left = dict.fromkeys(names, 0.0), set(), 1.5 * sum(sizes.values())
    while left > 1e-9 and len(full) < len(names):
        total = sum(weight[s] for s in names if s not in full)
        share = {s: left * weight[s] / total for s in names if s not in full}
        left = 0.0
        for s, more in share.items():
            target[s] += more
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                full.add(s)
    return target


def table(spark, n=400, extra=False):
    rng = np.random.default_rng(4)
    rows = [(i, prose(i, int(rng.integers(1, 60)))) for i in range(n)] + [(n, None), (n + 1, ""), (n + 2, " \n")]
    return documents(spark, rows, sources=("b", "a", "ä", "a", "Z", None, "a"), extra=extra)


def test_targets_sizes_and_totals(spark):
    found = mixing.draws(table(spark)).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in found:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert r.taken == r.copies * r.size and 0 <= r.taken <= 2 * r.size
    expected = targets_by_force(sizes)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expected[r.source])
    for source, words in taken.items():
        assert abs(words - expected[source]) <= 0.01 * sizes[source]
    assert sum(r.taken for r in found) == pytest.approx(1.5 * sum(sizes.values()), rel=0.01)


def test_blocks_of_several_levels_keep_the_balance(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 20)
    found = mixing.draws(table(spark)).collect()
    totals = defaultdict(lambda: [0, 0.0])
    for r in found:
        totals[r.source][0] += r.taken
        totals[r.source][1] = r.target
    assert all(abs(t - aim) <= 0.03 * max(aim, 1) for t, aim in totals.values())


def test_reruns_and_other_partitionings_agree(spark):
    df = table(spark)
    once = {r.doc_id: r.taken for r in mixing.draws(df).collect()}
    assert once == {r.doc_id: r.taken for r in mixing.draws(df.repartition(7)).collect()}


def test_the_mix_has_each_document_as_often_as_it_is_taken(spark):
    df = table(spark, 60, extra=True)
    copies = {r.doc_id: r.copies for r in mixing.draws(df).collect() if r.size}
    rows = mixing.mixed(df)
    counts = defaultdict(int)
    for r in rows.collect():
        counts[r.doc_id] += 1
    assert rows.columns == df.columns and counts == {i: c for i, c in copies.items() if c}


def test_repeated_rows_are_drawn_one_by_one_and_an_empty_table_gives_nothing(spark):
    df = documents(spark, [(1, "a b c"), (1, "a b c"), (None, "d e"), (None, "d e"), (2, "f")], sources=("s",))
    found = mixing.draws(df).collect()
    assert len(found) == 5 and all(r.copies in (1, 2) for r in found)
    assert mixing.mixed(df).count() == sum(r.copies for r in found)
    assert mixing.draws(documents(spark, [])).count() == 0 and mixing.mixed(documents(spark, [])).count() == 0


def test_flight_keeps_both_totals_and_expectations():
    size = np.sort(np.random.default_rng(1).integers(1, 500, 300))[::-1]
    p = np.full(300, 0.37)
    mean = np.zeros(300)
    for seed in range(300):
        out = mixing.flight(p, size, np.random.default_rng(seed), land=False)
        assert ((out > 0) & (out < 1)).sum() <= 2
        assert out.sum() == pytest.approx(p.sum()) and out @ size == pytest.approx(p @ size)
        mean += out / 300
    assert abs(mean - 0.37).max() < 0.15
