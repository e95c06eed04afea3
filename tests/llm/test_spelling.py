import random
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import documents

from paylode.llm import spelling


def counted(rows, damage):
    total = Counter()
    for doc, text in rows:
        run = ""
        for c in [*(text or ""), " "]:
            if "A" <= c <= "Z":
                c = c.lower()
            if "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
                if damage and h % damage == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
                total[run] += 1
            run = ""
    return total


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def by_force(rows, damage=0):
    n = {w: k for w, k in counted(rows, damage).items() if len(w) >= 6 and k >= 5}
    around = {w: [o for o in n if near(w, o)] for w in n}
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (n[w], len(around[w]), form.get(w), n[form[w]] if w in form else None, root(w)) for w in n}


def table():
    rng = random.Random(2)
    words = ["".join(rng.choices("abeèÿÀ", k=rng.randint(5, 8))) for _ in range(60)]
    for w in list(words):
        for _ in range(6):
            at = rng.randrange(len(w))
            words.append(w[:at] + rng.choice(["", "a", "bè", "ÿ", w[at] * 2]) + w[at + 1:])
    weights = [rng.choice([1, 1, 5, 30, 200, 2000]) for _ in words]
    gaps = [" ", "\n", "-", "1", "×", "ā", "'", "日"]
    text = lambda n: "".join(w + rng.choice(gaps) for w in rng.choices(words, weights, k=n))
    rows = [(k, text(rng.randint(0, 300)).upper() if k % 7 == 0 else text(200)) for k in range(60)]
    return [*rows, (100, None), (101, ""), (102, " 12 -"), (None, text(500)), (None, text(500)), (5, text(300)), (103, "zzzzzz " * 9),
            (104, ("q" * 3_000 + " ") * 6 + ("q" * 2_999 + " ") * 40)]


@pytest.mark.parametrize("damage", [0, 3, spelling.DAMAGE])
def test_variants_are_those_of_brute_force(spark, damage):
    rows = table()
    found = spelling.variants(documents(spark, rows, extra=True), damage)
    assert {r.word: tuple(r)[1:] for r in found.collect()} == by_force(rows, damage)


def test_small_filters_only_send_more_to_the_join(spark, monkeypatch):
    monkeypatch.setattr(spelling, "MOST_BYTES", 64)
    rows = table()
    assert {r.word: tuple(r)[1:] for r in spelling.variants(documents(spark, rows)).collect()} == by_force(rows)


def test_pieces_of_few_neighbours(monkeypatch):
    words = ["banana", "bananb", "aanana", "zzzzzz"]
    others = ["banan", "aanan", "bnana", "zzzzz", "anana", "canana", "banane", "zzzzzy"]
    filters = spelling.Filters({5: 5, 6: 7})
    for w in words + others:
        h = spelling.word_hashes([w])
        filters.words[filters.place(h, np.array([len(w)]))[0]] |= np.uint64(1) << ((h * spelling._LANES) >> np.uint64(58))
    alphabet = np.frombuffer(b"abcdenyz", np.uint8)
    whole = sorted(spelling.neighbours(words, filters, alphabet))
    wanted = {(i, o) for i, w in enumerate(words) for o in words + others if near(w, o) and (len(o) < len(w) or o > w)}
    assert {(i, w) for i, w in whole if w in words + others} == {(i, o) for i, o in wanted if len(o) <= 6} and len(whole) == len(set(whole))
    monkeypatch.setattr(spelling, "PIECE", 1)
    assert sorted(spelling.neighbours(words, filters, alphabet)) == whole


def test_chains_and_empty_tables(spark):
    rows = [(1, " ".join(["aaaaaa"] * 5 + ["aaaaab"] * 25 + ["aaaabb"] * 125 + ["aaabbb"] * 625 + ["aabbbb"] * 3125))]
    found = {r.word: r.root for r in spelling.variants(documents(spark, rows)).collect()}
    assert set(found.values()) == {"aabbbb"} and len(found) == 5
    for empty in ([], [(1, None), (None, "")]):
        assert spelling.variants(documents(spark, empty)).count() == 0
