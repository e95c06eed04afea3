import random

import pytest
from helpers import documents, prose

from paylode.llm import units


def by_force(rows, least=1):
    """The units that go, as the set of their spans by document."""
    found = []
    for doc, text in rows:
        at = 0
        for place, line in enumerate((text or "").split("\n")):
            words = line.encode().lower().split()
            found.append(((doc is None, doc or 0, place), b" ".join(words), len(words), doc, at, at + len(line)))
            at += len(line) + 1
    first, gone = {}, {}
    for rank, unit, n, *_ in sorted(found):
        if n >= least:
            first.setdefault(unit, rank)
    for rank, unit, n, doc, start, end in found:
        if n >= least and first[unit] != rank:
            gone.setdefault(doc, set()).add((start, end))
    return gone


def table():
    pick = random.Random(4)
    shared = [prose(k, pick.randint(3, 12)) for k in range(12)]
    shared += [shared[0].upper(), "  " + shared[1].replace(" ", " \t ") + "\r", "Ünï Çödé ünï çödé eins zwei", "ünï Çödé ünï çödé EINS zwei"]
    rows = [(k, "\n".join(pick.choice(shared) if pick.random() < 0.5 else prose(100 * k + j, 8) for j in range(pick.randint(1, 9))))
            for k in range(60)]
    return [*rows, (100, None), (101, ""), (102, "\n\n"), (103, shared[3]), (104, shared[3] + "\n"), (105, prose(9, 30_000))]


@pytest.mark.parametrize("least", [1, 5])
def test_what_goes_is_what_brute_force_removes(spark, least):
    rows = table()
    random.Random(1).shuffle(rows)
    gone = by_force(rows, least)
    df = documents(spark, rows, extra=True)
    found = (units.repeated_units(df) if least == 1 else units.repeated_units(df, least_words=least)).collect()
    assert len(found) == len(rows)
    for r in found:
        spans = {(s.start, s.end) for s in r.spans}
        assert spans == gone.get(r.doc_id, set()) and r.n_removed == len(spans)
        assert r.removed_chars == sum(end - start for start, end in spans)
        assert r.n_units == sum(bool(line.encode().split()) for line in (dict(rows)[r.doc_id] or "").split("\n"))


def test_repeated_rows_rows_without_id_and_an_empty_table(spark):
    line, other = prose(1, 9), prose(2, 9)
    rows = [(5, line), (5, line), (None, line), (None, other), (None, other), (3, "a few words")]
    found = units.repeated_units(documents(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in found) == [
        ("3", 0), ("5", 0), ("5", 0), ("None", 0), ("None", 0), ("None", 1)]
    assert units.repeated_units(documents(spark, [])).count() == 0
    assert units.without_repeated_units(documents(spark, [])).count() == 0


def test_texts_without_repeated_lines(spark):
    a, b, c = (prose(k, 7) for k in range(3))
    rows = [(1, f"{a}\n{b}"), (2, f"{a}\n{c}\nend"), (3, f"start\n{b}"), (4, b), (5, None), (6, f"{c}\n\n{c}")]
    df = documents(spark, rows, extra=True)
    found = units.without_repeated_units(df)
    assert found.columns == df.columns
    texts = {r.doc_id: (r.text, r.n_chars) for r in found.collect()}
    assert texts == {i: (t, None if t is None else len(t)) for i, t in {
        1: f"{a}\n{b}", 2: f"{c}\nend", 3: "start", 4: "", 5: None, 6: ""}.items()}


def test_sentences():
    import re

    text = "One two. Three?  Four\nfive! 6.7 eight"
    assert [text[a:b] for a, b in units.cut(text, re.compile(units.SENTENCES))] == ["One two.", "Three?", "Four", "five!", "6.7 eight"]


@pytest.mark.parametrize(("text", "parts"), [
    ("one\ntwo\n\nthree", ["one\ntwo", "three"]), ("a\n \t\n\n b", ["a", "b"]), ("", [""]), ("\n\nx", ["", "x"])])
def test_paragraphs(text, parts):
    import re

    assert [text[a:b] for a, b in units.cut(text, re.compile(units.PARAGRAPHS))] == parts
