import hashlib
import random

import pytest

from paylode.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(rows):
    """``(cost, edits, lines)`` over all strings of edits, forwards; rows are (role, text, must go, truncated)."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    best = {"": (0, "", ())}

    def better(table, state, way):
        if state not in table or way < table[state]:
            table[state] = way

    def inserted(table):
        for _ in range(4):
            for state, (cost, edits, lines) in list(table.items()):
                for letter, role in (("u", "user"), ("a", "assistant")):
                    if (state, letter) in after:
                        better(table, after[state, letter], (cost + 3, edits + "I", (*lines, f"{role}:")))
        return table

    for role, text, gone, open_ in rows:
        new = {}
        for state, (cost, edits, lines) in inserted(dict(best)).items():
            better(new, state, (cost + 4, edits + "D", lines))
            if not gone:
                for letter, name, price, own in (
                        ("K", role, 0, role[:1]), ("R", "user", 3, "u"), ("R", "assistant", 3, "a")):
                    if (state, own) in after:
                        better(new, after[state, own], (cost + price + 3 * open_, edits + letter, (*lines, f"{name}:{text}")))
        best = new
    best = inserted(dict(best))
    return min(best[s] for s in ("", "a") if s in best)


def by_force(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0, " " if r is None else r, " " if x is None else x)
                      for c, t, r, x in rows if c == conv), key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))
        seen, kinds, parts = set(), [], []
        for _, _, role, text in own:
            body = text.rstrip(C.SPACES)
            kind = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            kinds.append(kind)
            parts.append((role, text, kind in ("blank", "duplicate"), kind == "truncated"))
        turns = [t for known, t, *_ in own if known]
        cost, edits, lines = cheapest(parts)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(parts, parts[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), illegal, cost, edits,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def found(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def turns(seed, n, conv=1):
    rng = random.Random(seed)
    return [(conv, rng.choice([None, *range(max(2, n))]), rng.choice(["user", "user", "assistant", "assistant", "system", "tool", None, ""]),
             rng.choice(["yes.", "no", "", " \t", None, "Wait!\n", f"text {rng.randrange(9)}.", "ünï。", "why?"])) for _ in range(n)]


def test_edits_are_the_cheapest_and_least_of_all(spark):
    rows = [r for k in range(150) for r in turns(k, k % 13 + 1, k if k else None)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS block", "'x' AS at", "0 AS code", "'y' AS edits", "2 AS fault")
    assert found(C.report(df)) == by_force(rows)


@pytest.mark.parametrize("piece", [C.PIECE, 40])
def test_a_conversation_over_many_partitions(spark, monkeypatch, piece):
    monkeypatch.setattr(C, "PIECE", piece)
    rows = [*turns(5, 700, 7), *turns(6, 4, 3), *turns(8, 5, 9), *[(7, 3, "user", "the same.")] * 200, *turns(9, 300, None)]
    names = {"spark.sql.shuffle.partitions": "9", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        df = spark.createDataFrame(rows, SCHEMA).repartition(5)
        blocks = C._ordered(df).groupBy("conv_id").agg({"block": "max", "*": "count"}).collect()
        assert max(r["max(block)"] for r in blocks) > 4
        assert found(C.report(df)) == by_force(rows)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_a_join_by_shuffles_keeps_conversations_whole(spark):
    rows = [r for k in range(60) for r in turns(k, k % 9 + 1, k)] + turns(70, 200, 70)
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        assert found(C.report(spark.createDataFrame(rows, SCHEMA).repartition(5))) == by_force(rows)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_rows_of_the_repaired_conversation(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hello!"), (1, 2, "user", "Anyone?"), (1, 3, "assistant", "Hello!")]
    out = C.repaired(spark.createDataFrame(rows, SCHEMA)).orderBy("at").collect()
    assert "".join(r.edits for r in out) == cheapest([(r, t, False, False) for _, _, r, t in rows])[1] == "KKIKK"
    assert [(x.role, x.text) for r in out for x in r.lines] == [
        ("system", "Be kind."), ("user", "Hello!"), ("assistant", ""), ("user", "Anyone?"), ("assistant", "Hello!")]


def test_checkpoints_do_not_change_the_walk():
    rng = random.Random(3)
    for n in (1, 2, 5, 40, 1000):
        codes = bytes(rng.choice([0, 1, 1, 2, 2, 3, 5, 6, 9, 10]) for _ in range(n))
        kinds = [("sua"[c & 3] if c & 3 < 3 else "x", "t", bool(c & 4), bool(c & 8)) for c in codes]
        names = {"s": "system", "u": "user", "a": "assistant", "x": "x"}
        cost, edits, _ = cheapest([(names[k[0]], *k[1:]) for k in kinds])
        walked = "".join("I" * len(b) + op + "I" * len(a) for b, op, _, a, _ in C.walk(codes, C.START, C.END))
        assert walked == edits and C.through(C.matrix(codes), C.END)[C.START] == cost


def test_empty_tables_and_conversations_without_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.report(empty).count() == C.audited(empty).count() == C.repaired(empty).count() == 0
    import zlib

    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    out = C.audited(spark.createDataFrame([(dropped, 0, "user", "Hello.")], SCHEMA)).collect()
    assert [tuple(r) for r in out] == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_damage(spark):
    import zlib

    kinds = {zlib.crc32(f"5:{t}".encode()) % 20: t for t in range(500)}
    rows = [(5, kinds[k], "assistant", "a.b!c? d") for k in range(6)] + [(None, None, None, None)]
    got = sorted(map(tuple, C.damaged(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    null = zlib.crc32(b" : ") % 20
    expected = [(5, kinds[1], "assistant", ""), (5, kinds[2], "assistant", "abc d"), (5, kinds[4], "user", "a.b!c? d"),
                (5, kinds[5], "assistant", "a.b!c? d")] + [(5, kinds[3], "assistant", "a.b!c? d")] * 2
    assert null > 4
    assert got == sorted([*expected, (None, None, " ", " ")], key=str)
