"""Brute-force versions and small texts shared by the tests of this folder."""

from __future__ import annotations

import random
import re

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int, letters: str = "abcdefgh") -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(words))


def documents(spark, texts, sources=("s1", "s2"), extra: bool = False):
    """Rows of ``documents``; with ``extra``, further columns under names that operators use themselves."""
    rows = [(i if not isinstance(i, tuple) else i[0], t, "en", sources[k % len(sources)], None if t is None else len(t))
            for k, (i, t) in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    if extra:
        for name in ("id", "digest", "_digest", "row", "n", "component_id", "kept", "copies", "spans", "score", "ids", "size"):
            df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def groups(nodes, links):
    """Smallest node reachable, for every node."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def joins_staged(monkeypatch, module):
    """A dictionary that gets, by the name it is staged under, the joins of each table that ``module`` stages."""
    found, staged = {}, module.staged

    def watched(df, name, *partition_by):
        found.setdefault(name, []).extend(joins_of(df))
        return staged(df, name, *partition_by)

    monkeypatch.setattr(module, "staged", watched)
    return found


def joins_of(df):
    """The joins of the plan, from the result down, as the planner chose them before anything ran: ``kind keys``."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [" ".join(re.findall(r"\w+Join|(?<=\[)\w+(?=#)", line)[:2]) for line in plan.splitlines() if re.search(r"\w+Join \[", line)]
