import random

import numpy as np
import pytest
from helpers import documents, groups, joins_staged, prose

from paylode.llm import minhash
from paylode.llm.common import components


def sets_of(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def by_force(rows, percent):
    sets = {i: sets_of(t) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if sets[a] & sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {i: len(s) for i, s in sets.items()}, groups(ids, links)


def edited(text, share, seed):
    rng = random.Random(seed)
    return " ".join(f"x{rng.randrange(10**9)}" if rng.random() < share else w for w in text.split())


def near_table():
    base, other = prose(1, 220), prose(2, 90)
    rows = [base, base.upper(), base.replace(" ", "\n\t"), None, "", " \t\n", "one two", "ONE two", "one two three four five",
            "one two three four", "ünï Ünï x y z", "ünï ünï x y z"]
    rows += [edited(base, k / 1000, k) for k in range(0, 60)] + [edited(other, k / 2000, k) for k in range(40)]
    # A chain: each text is like the next, the first and the last are not.
    words = prose(3, 160).split()
    rows += [" ".join(words[k:k + 120]) for k in range(0, 40, 2)]
    return [(i * 3 + 1, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("percent", [80, 85])
def test_groups_and_sizes_are_those_of_brute_force(spark, percent):
    rows = near_table()
    random.Random(5).shuffle(rows)
    sizes, lowest = by_force(rows, percent)
    found = minhash.near_duplicates(documents(spark, rows, extra=True), percent).collect()
    assert {r.doc_id: r.n_shingles for r in found} == sizes
    assert {r.doc_id: r.component_id for r in found} == lowest
    assert all(r.kept == (r.doc_id == r.component_id) for r in found) and len(found) == len(rows)


@pytest.mark.parametrize("tile", [512, 3])
def test_blocks_join_what_is_similar(monkeypatch, tile):
    monkeypatch.setattr(minhash, "TILE", tile)
    monkeypatch.setattr(minhash, "COLUMNS", 16 if tile == 3 else 4096)
    rng = np.random.default_rng(tile)
    base = rng.integers(0, 2**63, 120, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.permutation(base)[:k], rng.integers(0, 2**63, 120 - k, dtype=np.uint64)]))
            for k in rng.integers(60, 121, 40)] + [np.zeros(0, np.uint64), base[:5]]
    shared = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert minhash.shared_counts(sets[:25], sets[20:]).tolist() == [row[20:] for row in shared[:25]]
    own = np.arange(len(sets))
    own[[3, 9, 30]] = 3
    everyone, half = list(range(len(sets))), list(range(20))
    for left, right in ((everyone, None), (half, everyone[20:])):
        pairs = [(a, b) for a in left for b in (right or left) if a != b]
        like = [(a, b) for a, b in pairs if shared[a][b] and 100 * shared[a][b] >= 80 * (len(sets[a]) + len(sets[b]) - shared[a][b])]
        found = minhash.block_links(sets, own, left, right, 80)
        same = [(i, j) for i, j in enumerate(own.tolist()) if i != j]
        assert groups(everyone, like + same) == groups(everyone, [(i, int(j)) for i, j in enumerate(found)] + same)
        assert len(set(groups(everyone, like).values())) < len(sets)


def test_buckets_of_many_that_are_almost_similar(spark, monkeypatch):
    """Pairs grow with the members, not with their square, and no link is lost."""
    monkeypatch.setattr(minhash, "CHUNK_BYTES", 20_000)
    pairs = {}
    for n in (60, 240):
        base = prose(21, 150)
        rows = [(i, edited(base, 0.02 + 0.02 * (i % 3), 1000 + i)) for i in range(n)]
        counted = []
        verified = minhash._verified
        monkeypatch.setattr(minhash, "_verified", lambda p, *a: counted.append(p.count()) or verified(p, *a))
        found = minhash.near_duplicates(documents(spark, rows), 80).collect()
        monkeypatch.setattr(minhash, "_verified", verified)
        assert {r.doc_id: r.component_id for r in found} == by_force(rows, 80)[1]
        pairs[n] = sum(counted)
    assert pairs[240] < 8 * pairs[60]


def test_repeated_rows_rows_without_id_and_an_empty_table(spark):
    text = prose(8, 30)
    rows = [(7, text), (7, text), (None, text), (9, text), (None, prose(9, 30)), (None, "")]
    found = minhash.near_duplicates(documents(spark, rows)).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in found) == sorted([
        ("7", "7", True), ("7", "7", True), ("None", "7", False), ("9", "7", False),
        ("None", "None", True), ("None", "None", True)])
    kept = minhash.keep_one(documents(spark, rows, extra=True))
    assert [r.doc_id for r in kept.where("doc_id is not null").collect()] == [7]
    assert kept.columns == documents(spark, rows, extra=True).columns
    assert minhash.near_duplicates(documents(spark, [])).count() == 0


def test_different_texts_without_an_id_or_under_one_id_stay(spark):
    one, two, three, four = (prose(k, 200) for k in (21, 22, 23, 24))
    near = two + " and more"
    rows = [(None, one), (None, one), (None, two), (None, near), (None, three), (None, ""), (None, ""), (None, None),
            (5, four), (5, prose(25, 80)), (6, prose(26, 80)), (6, "x " + prose(26, 80)), (8, ""), (8, ""), (9, three + " end")]
    kept = [(r.doc_id, r.text) for r in minhash.keep_one(documents(spark, rows, extra=True)).collect()]
    nameless = [t for i, t in kept if i is None]
    assert len(nameless) == 5 and nameless.count("") == 2 and nameless.count(None) == 1 and one in nameless
    assert (two in nameless) != (near in nameless)
    assert sorted((i, t[:20]) for i, t in kept if i not in (None, 6)) == sorted(
        (i, t[:20]) for i, t in [(5, four), (5, prose(25, 80)), (8, ""), (9, three)])
    assert sum(i == 6 for i, _ in kept) == 1
    found = minhash.near_duplicates(documents(spark, rows)).collect()
    assert sorted(r.component_id for r in found if r.doc_id is None and r.component_id) == [9]


def test_documents_that_share_little_are_not_paired(spark):
    """Heavily changed copies share bands, but what they share bounds their similarity."""
    base = prose(4, 300)
    rows = [(i, edited(base, 0.12, i)) for i in range(1, 80)] + [(0, base)]
    sizes, lowest = by_force(rows, 85)
    found = minhash.near_duplicates(documents(spark, rows), 85).collect()
    assert {r.doc_id: r.component_id for r in found} == lowest


@pytest.mark.parametrize("shape", ["path", "star", "circles", "random"])
def test_components(spark, shape):
    rng = random.Random(3)
    links = {
        "path": [(i, i + 1) for i in range(40)],
        "star": [(17, i) for i in range(40) if i != 17],
        "circles": [(10 * c + i, 10 * c + (i + 1) % 10) for c in range(5) for i in range(10)],
        "random": [(rng.randrange(60), rng.randrange(60)) for _ in range(45)],
    }[shape]
    links = [(a, b) for a, b in links if a != b]
    rng.shuffle(links)
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    nodes = {n for link in links for n in link}
    assert {r.node: r.component for r in found} == groups(nodes, links) and len(found) == len(nodes)


def test_exploded_rows_are_never_broadcast(spark, monkeypatch):
    """Spark takes a document's 24 bands for one, and a document of many chunks for a row."""
    found = joins_staged(monkeypatch, minhash)
    blocks = []
    exact = minhash._exact_links

    def links(left, texts, percent):
        out = exact(left, texts, percent)
        blocks.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(minhash, "_exact_links", links)
    minhash.near_duplicates(documents(spark, near_table()), 85).count()
    assert found["buckets"] == ["SortMergeJoin bucket"]
    assert any("SortMergeJoin [id#" in line for line in blocks[0].splitlines())
