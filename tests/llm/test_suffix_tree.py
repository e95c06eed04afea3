import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from helpers import documents, prose

from paylode.llm import suffix_tree as S

END, BEGIN = 1, 0


def sequence(text):
    return [BEGIN, *(text or "").encode().lower().split(), END]


def is_held_out(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


class Tree:
    def __init__(self, texts, depth, least_share, least_count, divergence):
        seqs = [sequence(t) for t in texts]
        self.words = Counter(w for s in seqs for w in s[1:])
        self.n, self.v = sum(self.words.values()), len(self.words)
        least = max(least_count, math.ceil(self.n * least_share))
        after = defaultdict(Counter)
        for s in seqs:
            for i in range(1, len(s)):
                for k in range(1, min(depth, i) + 1):
                    after[tuple(s[i - k:i])][s[i]] += 1
        self.after = {c: f for c, f in after.items() if sum(f.values()) >= least}
        self.states = set()
        for c in sorted(self.after, key=len):
            n, types, gain = sum(self.after[c].values()), len(self.after[c]), 0.0
            for w, k in self.after[c].items():
                above = self.p(w, c[1:], self.after)
                gain += k * math.log((max(k - 2, 0) + (types - (k == 1)) * above) / ((n - 1) * above))
            if gain > divergence:
                self.states |= {c[i:] for i in range(len(c))}

    def p(self, w, c, states):
        if not c:
            return (self.words[w] + 1) / (self.n + self.v + 1)
        n, types = sum(self.after[c].values()), len(self.after[c])
        return (max(self.after[c][w] - 1, 0) + types * self.p(w, c[1:], states)) / n

    def scores(self, text, depth):
        s, base, total = sequence(text), 0.0, 0.0
        for i in range(1, len(s)):
            state = next((tuple(s[i - k:i]) for k in range(min(depth, i), 0, -1) if tuple(s[i - k:i]) in self.states), ())
            base += math.log10(self.p(s[i], (), None))
            total += math.log10(self.p(s[i], state, None))
        return len(s) - 1, sum(self.words[w] > 0 for w in s[1:]), self.n, base, total


def table():
    rng = random.Random(4)
    words = [prose(k, 1, "abcdefghü") for k in range(60)]
    phrase = [" ".join(rng.choices(words, k=5)) for _ in range(6)]
    text = lambda n: " ".join(rng.choice(phrase) if rng.random() < 0.3 else rng.choice(words) for _ in range(n))
    rows = [(k, text(rng.randint(1, 60)).upper() if k % 5 == 0 else text(40)) for k in range(80)]
    return [*rows, (200, None), (201, ""), (202, " \t"), (None, text(30)), (5, rows[5][1]), (5, rows[5][1]), (203, prose(99, 300)),
            (204, "once\nand " * 3000)]


@pytest.mark.parametrize(("hot", "followers"), [((S.HOT_ENTRIES, S.HOT_WORDS), S.FOLLOWERS), ((0, 0), 3), ((20, 10), 20)])
def test_scores_are_those_of_the_plain_tree(spark, monkeypatch, hot, followers):
    monkeypatch.setattr(S, "FOLLOWERS", followers)
    rows = table()
    random.Random(3).shuffle(rows)
    tree = Tree([t for i, t in rows if not is_held_out(i)], S.DEPTH, S.LEAST_SHARE, S.LEAST_COUNT, S.DIVERGENCE)
    assert {len(c) for c in tree.states} == {1, 2, 3} and len(tree.states) < len(tree.after)
    wanted = sorted(((i, is_held_out(i), *tree.scores(t, S.DEPTH)) for i, t in rows), key=str)
    found = sorted(map(tuple, S.scored(documents(spark, rows, extra=True), hot_entries=hot[0], hot_words=hot[1]).collect()), key=str)
    assert [w[:5] for w in wanted] == [f[:5] for f in found]
    for w, f in zip(wanted, found):
        assert f[5:] == pytest.approx(w[5:], rel=1e-9)
    assert sum(f[6] for f in found if f[1]) > sum(f[5] for f in found if f[1])


def test_every_state_is_a_distribution():
    tree = Tree([t for _, t in table()], 3, S.LEAST_SHARE, 8, S.DIVERGENCE)
    for state in [(), *list(tree.states)[:40]]:
        assert sum(tree.p(w, state, None) for w in [*tree.words, "never seen"]) == pytest.approx(1)


def test_empty_tables_and_nothing_to_learn_from(spark):
    assert S.scored(documents(spark, [])).count() == 0
    out = next(i for i in range(100) if is_held_out(i))
    assert [tuple(r) for r in S.scored(documents(spark, [(out, "a b")])).collect()] == [(out, True, 3, 0, 0, 0.0, 0.0)]


def test_most_frequent_rows_are_bounded(spark):
    rows = spark.createDataFrame([(n,) for n in [1] * 50 + [2] * 20 + [3] * 5 + [5000, 5010, 90_000]], "n long")
    assert S.most_frequent(rows, 1000) == 1 and S.most_frequent(rows, 30) == 2 and S.most_frequent(rows, 8) == 3
    assert rows.where(rows.n >= S.most_frequent(rows, 2)).count() <= 2 and rows.where(rows.n >= S.most_frequent(rows, 0)).count() == 0
