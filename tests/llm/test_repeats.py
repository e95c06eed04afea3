import hashlib
import random
import re
from collections import Counter

import pytest
from helpers import documents, joins_of, joins_staged, prose

from paylode.llm import repeats


def by_force(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(rows, texts):
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((doc, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def table():
    rng = random.Random(1)
    passage, other = prose(1, 60), prose(2, 40, "aéüñ€")
    texts = [prose(10, 80) + passage + prose(11, 30), passage, prose(12, 9) + passage[:150] + prose(13, 40),
             "x" * 300, "ab" * 200 + prose(14, 20) + "ab" * 60, None, "", "short", passage[20:] + prose(15, 3) + passage[:170],
             other * 2 + prose(16, 12, "é"), other[3:], prose(17, 200), prose(17, 200), "é" * 90 + "è" + "é" * 60, "é" * 80]
    line = "a line that many documents have, word for word, and that is long enough to count " * 2
    texts += [prose(30 + k, rng.randint(1, 20)) + line[:rng.randint(60, len(line))] + prose(60 + k, rng.randint(1, 20)) for k in range(25)]
    return list(enumerate(texts))


@pytest.mark.parametrize("hot", [20_000, 0])
def test_what_is_removed_is_what_brute_force_removes(spark, hot):
    rows = table()
    found = repeats.repeated_spans(documents(spark, rows, extra=True), length=80, gram=20, hot=hot).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == by_force(rows, 80)
    texts = dict(rows)
    for r in found:
        data, last = (texts[r.doc_id] or "").encode(), 0
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert all(last <= s.start < s.end <= len(data) for s in r.spans)
        kept = "".join(data[a:b].decode(errors="ignore") for a, b in zip(
            [0, *(s.end for s in r.spans)], [*(s.start for s in r.spans), len(data)]))
        assert len(r.text) - len(kept) in range(2 * len(r.spans) + 1) and not set(kept) - set(r.text)


def test_repeated_rows_rows_without_id_and_an_empty_table(spark):
    rows = [(1, prose(3, 50)), (1, prose(3, 50)), (None, prose(4, 60)), (None, prose(4, 60)), (None, prose(5, 60)), (2, None)]
    found = repeats.repeated_spans(documents(spark, rows), 80, 20).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == by_force(rows, 80)
    assert repeats.repeated_spans(documents(spark, []), 80, 20).count() == 0
    assert repeats.without_repeats(documents(spark, []), 80, 20).count() == 0


def passages_by_force(rows, words):
    """Texts without the runs of words that start twice, copies without all of their words."""
    word = re.compile(rb"[^ \t\n\v\f\r]+")
    spans = [(doc, t, (t or "").encode(), [m.span() for m in word.finditer((t or "").encode())]) for doc, t in rows]
    seen = Counter(d[at[i][0]:at[i + words - 1][1]] for _, _, d, at in spans for i in range(len(at) - words + 1))
    out = []
    for doc, t, data, at in spans:
        gone = bytearray(len(data))
        for i in range(len(at) - words + 1):
            if seen[data[at[i][0]:at[i + words - 1][1]]] > 1:
                gone[at[i][0]:at[i + words - 1][1]] = b"\1" * (at[i + words - 1][1] - at[i][0])
        out.append((doc, t and bytes(b for b, g in zip(data, gone) if not g).decode()))
    return sorted(out, key=str)


def test_runs_of_words_that_go_are_those_of_brute_force(spark):
    rng = random.Random(7)
    parts = [prose(k, n) for k, n in enumerate((10, 11, 12, 14, 25, 60))] + [prose(50, 30, "aéü€")]
    texts = [f"{prose(100 + k, rng.randint(0, 9))} {rng.choice(parts)}{rng.choice([' ', '', '\n'])}{prose(200 + k, rng.randint(1, 9))}"
             for k in range(40)]
    rows = [*enumerate(texts), (100, parts[0]), (101, parts[0]), (102, parts[3]), (103, parts[3]), (None, parts[5]), (104, None), (105, ""),
            (106, " ".join([parts[1]] * 3)), (107, prose(400, 3)), (108, prose(400, 3)), (109, prose(401, 9_000)), (110, "a " * 40), (111, "b " + "a b " * 6)]
    df = documents(spark, rows, extra=True)
    found = repeats.without_passages(df, words=12)
    assert found.dtypes == df.dtypes
    assert sorted(((r.doc_id, r.text) for r in found.collect()), key=str) == passages_by_force(rows, 12)
    assert repeats.without_passages(documents(spark, [])).count() == 0


@pytest.mark.parametrize("hot", [20_000, 0])
def test_runs_of_short_words_and_other_gaps(spark, hot):
    """A run counts by its words, not by its bytes; words that go on and other gaps end it."""
    ones, twos = [" ".join(random.Random(k).choices("abcdefghijkl", k=30)) for k in (1, 2)]
    texts = [f"x1 {ones} y1", f"\tx2 {ones[:40]}z {ones} y2", ones[:21], f"q {ones[:21]}", f"{ones[:20]}z", twos, twos.replace(" ", "  ", 15),
             f"é {twos}€ ü", twos[9:41] + "\x01 v", "a " * 30, " b" * 30 + "\n", " b" * 30 + "\n", "c\x01 " + "c " * 11, " \n ", None]
    rows = list(enumerate(texts))
    found = repeats.without_passages(documents(spark, rows, extra=True), words=11, hot=hot).collect()
    assert sorted(((r.doc_id, r.text) for r in found), key=str) == passages_by_force(rows, 11)


def test_a_repeated_run_costs_its_anchors_and_not_its_words(spark, monkeypatch):
    """What is staged grows with the anchors: no table has a row for each of the words that repeat."""
    kept, rows = repeats.staged, []

    def counted(df, name):
        out = kept(df, name)
        rows.append((name, out.count()))
        return out

    monkeypatch.setattr(repeats, "staged", counted)
    shared = prose(1, 4_000)
    found = repeats.without_passages(documents(spark, [(k, f"{prose(10 + k, 5)} {shared} {prose(20 + k, 5)}") for k in range(2)]))
    assert all(len(r.text.split()) == 10 for r in found.collect())
    assert max(n for _, n in rows) < 4_000 // 4, rows


def test_words_are_found_and_anchored_in_pieces(monkeypatch):
    import numpy as np

    from paylode.llm import hashing

    data = [t.encode() for t in (prose(1, 300) + " " + prose(2, 90), "", prose(1, 300, "é"), "w" * 700, prose(1, 300))]
    at = np.cumsum([0, *map(len, data)])
    buffer = np.frombuffer(b"".join(data), np.uint8)
    found = repeats._words(buffer, at)
    places = repeats.word_anchors(found, 20, 8)
    assert all((a == b).all() for a, b in zip(found, hashing.words(buffer, at)))
    monkeypatch.setattr(repeats, "_BLOCK", 100)
    assert all((a == b).all() for a, b in zip(found, repeats._words(buffer, at)))
    assert all((a == b).all() for a, b in zip(places, repeats.word_anchors(found, 20, 8)))


def test_texts_lose_whole_characters_only(spark):
    shared = prose(1, 40)
    rows = [(1, "start é" + shared + "è end"), (2, "begin ê" + shared + "é close"), (3, None), (4, "alone")]
    df = documents(spark, rows, extra=True)
    found = {r.doc_id: r for r in repeats.without_repeats(df, 80, 20).collect()}
    assert found[1].text == "start éè end" and found[2].text == "begin êé close"
    assert found[3].text is None and found[4].text == "alone" and found[1].n_chars == len("start éè end")
    assert repeats.without_repeats(df, 80, 20).columns == df.columns


def test_intervals_are_the_tree_of_common_prefixes():
    words = sorted(["abcd", "abce", "abx", "b", "ba", "c"])
    shared = [repeats._common(a.encode(), b.encode()) for a, b in zip(words, words[1:])]
    found = {(a, b, d) for a, b, d in repeats.intervals(shared) if d > 0}
    assert found == {(0, 1, 3), (0, 2, 2), (3, 4, 1)}


def test_a_long_text_is_searched_in_pieces(spark, monkeypatch):
    import numpy as np

    data = np.frombuffer((prose(1, 400) + prose(2, 100) + prose(1, 400)).encode(), np.uint8)
    whole = repeats.anchors(data, np.array([0, len(data)]), 80, 20)
    monkeypatch.setattr(repeats, "_BLOCK", 500)
    pieces = repeats.anchors(data, np.array([0, len(data)]), 80, 20)
    assert (whole[0] == pieces[0]).all() and (whole[1] == pieces[1]).all()


def test_what_spark_sizes_too_low_is_never_broadcast(spark, monkeypatch):
    """Exploded anchors, lists of anchors, texts and the windows of hot anchors, which are far more than their surroundings."""
    found = joins_staged(monkeypatch, repeats)
    _, involved = repeats._spans(documents(spark, table()), 80, 20, 0)
    assert found["texts-asked-for"] == ["SortMergeJoin text_id", "SortMergeJoin gram"]
    assert found["cut-surroundings"][0] == "SortMergeJoin text_id"
    windows = [line for line in involved._jdf.queryExecution().executedPlan().toString().splitlines() if "Join [gram#" in line and "hash_a#" in line]
    assert windows and all("SortMergeJoin" in line for line in windows)
