"""Repair of a conversation's structure by a square-root checkpointed dynamic programme.

The rows of a conversation, in the order of their turns, become a sequence of role initials ``(s?(ua)+)?`` by the
cheapest edits: Keep 0, Rerole to user or assistant 3, Delete 4, Insert an empty user or assistant row 3; a
blank or duplicate row must go, and a truncated one that stays costs 3 more.  Of equally cheap edits those with
the smallest letters in ASCII order are taken.

What a prefix has produced is one of four states (nothing, ``s``, ends in ``u``, ends in ``a``).  Backwards over
the rows runs a vector with the cost to go from each state; only every ``sqrt(n)``-th vector is stored.  The walk
forward recomputes the vectors of one block at a time and takes, in each state, the smallest letter that is
tight, that is, whose cost and the cost to go after it add up to the cost to go here.

Long conversations: all rows are sorted by conversation and turn over range partitions, so that a conversation
with a third of all rows is many segments.  A segment's effect is a 4 x 4 matrix of costs; those of the few
conversations that cross a partition's border (at most two a partition) are chained on the driver, which gives
each segment the vector behind it and the state in front of it.  All segments then emit their edits at once.  A
task holds a byte per row of one segment.  Only the digest and the list of edits of a conversation over several
partitions are made in one task, since they are one value: its pieces stream through it.

Defined results: null conversations are one conversation.  A null role or text is one space.  Null turns come
first; rows of one turn are ordered by role, then text, and equal rows are interchangeable.  Roles are compared
by their first character; an empty role has none.  Empty tables give empty results, further columns are ignored.
``conv_id`` and ``turn`` are whole numbers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylode.llm.common import ready
from paylode.session import settled, staged

KEEP, REROLE, DELETE, INSERT, MEND = 0, 3, 4, 3, 3
SPACES = " \t\n\x0b\x0c\r"
#: States: nothing yet, after the system row, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
_FAR = 1 << 60
#: The state after a role's initial, by the state before it; what is not here is not allowed.
_AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_INSERTS = ((START, "u", USER), (SYSTEM, "u", USER), (USER, "a", ASSISTANT), (ASSISTANT, "u", USER))
_ROLES = {"u": "user", "a": "assistant"}
_INITIALS = "sua"
#: A row's code: its initial (3: another), plus 4 if it must go, plus 8 if it is truncated.
_MUST_GO, _TRUNCATED = 4, 8
PIECE = 1 << 22


def _moves(code: int) -> list[list[tuple[str, int, int, str]]]:
    """For each state ``(letter, cost, state after, role)`` of the row's edits in ASCII order."""
    mend = MEND if code & _TRUNCATED else 0
    initial = _INITIALS[code & 3] if code & 3 < 3 else ""
    moves: list[list[tuple[str, int, int, str]]] = [[("D", DELETE, state, "")] for state in range(4)]
    if not code & _MUST_GO:
        for state in range(4):
            if state in _AFTER.get(initial, ()):
                moves[state].append(("K", KEEP + mend, _AFTER[initial][state], ""))
            for letter, role in _ROLES.items():
                if state in _AFTER[letter]:
                    moves[state].append(("R", REROLE + mend, _AFTER[letter][state], role))
    return moves


MOVES = [_moves(code) for code in range(16)]


def _closed(costs: list[int]) -> list[int]:
    """Costs to go once rows may be inserted too; from USER and ASSISTANT before the states that lead there."""
    start, system, user, assistant = costs
    user, assistant = min(user, assistant + INSERT), min(assistant, user + INSERT)
    return [min(start, user + INSERT), min(system, user + INSERT), user, assistant]


#: Behind the last row: done, unless a system or user row waits for what must follow.
END = tuple(_closed([0, _FAR, _FAR, 0]))


def step_back(code: int, behind: list[int] | tuple[int, ...]) -> list[int]:
    """The costs to go in front of a row, from those behind it."""
    return _closed([min(cost + behind[after] for _, cost, after, _ in moves) for moves in MOVES[code]])


def matrix(codes: bytes) -> list[int]:
    """Cheapest ways from each state in front of the rows to each behind them, row by row of 4."""
    columns = [[0 if state == end else _FAR for state in range(4)] for end in range(4)]
    for code in reversed(codes):
        columns = [step_back(code, column) for column in columns]
    return [min(columns[end][state], _FAR) for state in range(4) for end in range(4)]


def through(costs: list[int], behind: list[int] | tuple[int, ...]) -> list[int]:
    """The vector in front of a segment, from its matrix and the vector behind it."""
    return [min(costs[4 * state + end] + behind[end] for end in range(4)) for state in range(4)]


def walk(codes: bytes, state: int, behind: list[int] | tuple[int, ...], last: bool = True) -> Iterator[tuple[str, str, str, str, int]]:
    """For each row ``(inserted before, letter, new role, inserted after, state after)``, the ASCII-least tight edits."""
    n = len(codes)
    block = max(1, math.isqrt(n))
    stored = {}
    vector = list(behind)
    for i in range(n - 1, -1, -1):
        if (i + 1) % block == 0 or i == n - 1:
            stored[i // block] = vector
        vector = step_back(codes[i], vector)
    for first in range(0, n, block):
        vectors = [stored[first // block]]
        for i in range(min(first + block, n) - 1, first - 1, -1):
            vectors.append(step_back(codes[i], vectors[-1]))
        for i in range(first, min(first + block, n)):
            here, next_ = vectors[-1], vectors[-2]
            before = ""
            while True:
                letter, cost, after, role = _tight(codes[i], state, here, next_)
                if letter != "I":
                    break
                before, state = before + role, after
            state, trailing = after, ""
            if last and i == n - 1:
                while next_[state]:
                    _, inserted, state = next(x for x in _INSERTS if x[0] == state)
                    trailing += inserted
            yield before, letter, role, trailing, state
            vectors.pop()


def _tight(code: int, state: int, here: list[int], behind: list[int]) -> tuple[str, int, int, str]:
    """The smallest letter whose cost and cost to go make up the cost to go in ``state``."""
    found = [m for m in MOVES[code][state] if m[1] + behind[m[2]] == here[state]]
    if not found or found[0][0] > "I":
        for origin, letter, after in _INSERTS:
            if origin == state and INSERT + here[after] == here[state]:
                return "I", INSERT, after, letter
    return found[0]


def _ordered(conversations: DataFrame) -> DataFrame:
    """All rows with their place ``at`` in the order of conversations and turns, and the faults of the row alone."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"), F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
        F.monotonically_increasing_id().alias("row"))  # lets equal rows be on both sides of a border
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "row"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
    ending = F.rtrim(F.col("text"), F.lit(SPACES))
    place = F.monotonically_increasing_id()
    return staged(ordered.select("*", place.alias("at"), F.shiftright(place, 33).cast("int").alias("block"),
                                 (ending == "").alias("blank"), (~F.right(ending, F.lit(1)).isin(".", "!", "?")).alias("open"),
                                 F.substring("role", 1, 1).alias("initial")), "ordered-turns")


def _faults(ordered: DataFrame) -> DataFrame:
    """The rows without their texts, each with its first fault."""
    # A length in front of the role keeps different pairs apart.
    pair = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.length("role").cast("string"), "role", "text")
    rows = ordered.select("conv_id", "turn", "at", "block", "blank", "open", "initial", F.unhex(F.sha2(pair, 256)).alias("pair"))
    first = rows.groupBy("pair").agg(F.min("at").alias("first"))
    fault = F.when(F.col("blank"), "blank").when(F.col("at") != F.col("first"), "duplicate").when(F.col("open"), "truncated")
    code = (F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
            + F.when(F.col("fault").isin("blank", "duplicate"), _MUST_GO).otherwise(0)
            + F.when(F.col("fault") == "truncated", _TRUNCATED).otherwise(0))
    return rows.join(first, "pair").withColumn("fault", fault).select(
        "conv_id", "turn", "at", "block", "initial", "fault", code.cast("int").alias("code"))


def _segments(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """``(block, conv_id, one list per column)`` of rows that come sorted by block and place."""
    key, held = None, None
    for batch in batches:
        lists = [batch.column(c).to_pylist() for c in columns]
        for i, own in enumerate(zip(batch.column("block").to_pylist(), batch.column("conv_id").to_pylist())):
            if own != key:
                if key is not None:
                    yield (*key, *held)
                key, held = own, [[] for _ in columns]
            for column, values in zip(held, lists):
                column.append(values[i])
    if key is not None:
        yield (*key, *held)


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block, conv, codes in _segments(batches, "code"):
        yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "conv_id": pa.array([conv], pa.int64()),
                                          "costs": pa.array([matrix(bytes(codes))], pa.list_(pa.int64()))})


def _exits(behind: dict):
    """For each segment the state behind it, by the state in front of it."""

    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, conv, codes in _segments(batches, "code"):
            ends = []
            for state in range(4):
                for *_, after in walk(bytes(codes), state, behind[conv, block], last=False):
                    pass
                ends.append(after)
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "conv_id": pa.array([conv], pa.int64()),
                                              "states": pa.array([ends], pa.list_(pa.int32()))})

    return exits


_EDITS = "block int, at long, fault string, before string, letter string, new_role string, after string"


def _edit(entries: dict):
    """The edits of every row; ``entries`` has ``(state in front, vector behind, whether it is the last)`` of segments."""

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * 7
        kinds = (pa.int32(), pa.int64(), *[pa.string()] * 5)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          names=["block", "at", "fault", "before", "letter", "new_role", "after"])

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for block, conv, codes, at, faults in _segments(batches, "code", "at", "fault"):
            state, behind, last = entries.get((conv, block), (START, END, True))
            for place, fault, (before, letter, role, after, _) in zip(at, faults, walk(bytes(codes), state, behind, last)):
                rows.append((block, place, fault, before, letter, role, after))
                if len(rows) >= 50_000:
                    yield packed(rows)
                    rows = []
        yield packed(rows)

    return edit


def _by_block(rows: DataFrame) -> DataFrame:
    return rows.repartition("block").sortWithinPartitions("block", "at")


def _entries(faults: DataFrame) -> dict:
    """What the segments of conversations over several partitions need; at most two conversations a partition."""
    several = faults.groupBy("conv_id").agg(F.min("block").alias("low"), F.max("block").alias("high")).where("low < high")
    several = several.select(F.col("conv_id").alias("of")).collect()
    if not several:
        return {}
    ids = faults.sparkSession.createDataFrame([(r.of,) for r in several], "of long")
    crossing = staged(faults.join(F.broadcast(ids), F.col("conv_id").eqNullSafe(F.col("of"))).select(
        "block", "conv_id", "at", "code"), "crossing-turns")
    segments: dict = {}
    for r in _by_block(crossing).mapInArrow(_matrices, "block int, conv_id long, costs array<long>").collect():
        segments.setdefault(r.conv_id, {})[r.block] = r.costs
    behind = {}
    for conv, blocks in segments.items():
        vector = END
        for block in sorted(blocks, reverse=True):
            behind[conv, block] = tuple(vector)
            vector = through(blocks[block], vector)
    states = {(r.conv_id, r.block): r.states for r in _by_block(crossing).mapInArrow(
        _exits(behind), "block int, conv_id long, states array<int>").collect()}
    entries = {}
    for conv, blocks in segments.items():
        state = START
        for block in sorted(blocks):
            entries[conv, block] = state, behind[conv, block], block == max(blocks)
            state = states[conv, block][state]
    return entries


def repaired(conversations: DataFrame) -> DataFrame:
    """``conv_id, at, turn, role, text, fault, initial, edits, lines``: a row per row, in the order of ``at``.

    ``edits`` has the letters of the row's own edit and of the rows inserted around it, ``lines`` what stands in
    the repaired conversation for them: structs of role and text.
    """
    return settled(ready(conversations.sparkSession), "repaired-turns", lambda: _by_block(_repaired(conversations)[0]))


def _line(role, text=None):
    return F.struct(role.alias("role"), (F.lit("") if text is None else text).alias("text"))


def _inserted(letters: str):
    letter = lambda i: F.substring(F.col(letters), i, F.lit(1))
    return F.transform(F.sequence(F.lit(1), F.length(letters)), lambda i: _line(F.when(letter(i) == "u", "user").otherwise("assistant")))


def _repaired(conversations: DataFrame) -> tuple[DataFrame, set]:
    """The rows, placed as their join with the edits leaves them, and the conversations in several blocks."""
    ordered = _ordered(conversations)
    faults = staged(_faults(ordered), "faults")
    entries = _entries(faults)
    edits = _by_block(faults).mapInArrow(_edit(entries), _EDITS)
    role = F.when(F.col("letter") == "K", F.col("role")).otherwise(F.col("new_role"))
    none = F.array().cast("array<struct<role:string,text:string>>")
    lines = F.concat(
        F.when(F.col("before") != "", _inserted("before")).otherwise(none),
        F.when(F.col("letter") != "D", F.array(_line(role, F.col("text")))).otherwise(none),
        F.when(F.col("after") != "", _inserted("after")).otherwise(none))
    marks = F.concat(F.regexp_replace("before", ".", "I"), "letter", F.regexp_replace("after", ".", "I"))
    rows = ordered.join(edits, ["block", "at"]).select(
        "conv_id", "block", "at", "turn", "role", "text", "fault", "initial", marks.alias("edits"), lines.alias("lines"))
    return rows, {conv for conv, _ in entries}


_PIECES = ("conv_id long, block int, piece int, whole boolean, audit string, said binary, rows long, blank long, duplicate long, "
           "truncated long, illegal long, first string, last string, low long, high long, turns long, cost long")
_COUNTED = ("rows", "blank", "duplicate", "truncated", "illegal", "turns", "cost")
_LEGAL = ("su", "ua", "au")


class _Piece:
    """What is known of neighbouring rows of one conversation; two of them add up."""

    def __init__(self):
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = self.cost = 0
        self.first = self.last = self.low = self.high = None

    def add(self, rows, first, last, low, high, illegal=0, turns=0, **counts):
        if self.rows and first is not None:
            self.illegal += f"{self.last}{first}" not in _LEGAL
        self.first, self.last = (self.first if self.rows else first), last
        # Turns come in order: one that a piece shares with the one before is one turn.
        self.turns += turns - (low is not None and low == self.high)
        self.low, self.high = (low if self.low is None else self.low), (self.high if high is None else high)
        self.rows, self.illegal = self.rows + rows, self.illegal + illegal
        for name, n in counts.items():
            setattr(self, name, getattr(self, name) + n)

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def _cut(most: int, crossing: set):
    """Pieces of about ``most`` bytes of the repaired conversations of rows that come sorted by block and place.

    ``said`` of a conversation that is one piece is its digest.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, piece, number, audit, said, size, out, held = None, _Piece(), 0, [], [], 0, [], 0

        def row(ended):
            whole, lines = ended and not number and key[1] not in crossing, b"\n".join(said)
            lines = hashlib.sha256(lines).digest() if whole else lines + b"\n" * bool(said)
            return (key[1], key[0], number, whole, "".join(audit), lines,
                    *(getattr(piece, c) for c in ("rows", "blank", "duplicate", "truncated", "illegal", "first", "last", "low", "high", "turns", "cost")))

        names = [f.split()[0] for f in _PIECES.split(", ")]
        kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}
        types = [kinds[f.split()[1]] for f in _PIECES.split(", ")]

        def packed():
            columns = list(zip(*out)) or [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, types)], names=names)

        columns = ("block", "conv_id", "turn", "fault", "initial", "edits", "lines")
        for batch in batches:
            for block, conv, turn, fault, initial, edits, lines in zip(*(batch.column(c).to_pylist() for c in columns)):
                if (block, conv) != key or size >= most:
                    if key is not None:
                        out.append(row((block, conv) != key))
                        held += len(out[-1][5])
                        if held > most or len(out) > 5_000:
                            yield packed()
                            out, held = [], 0
                    number = number + 1 if (block, conv) == key else 0
                    key, piece, audit, said, size = (block, conv), _Piece(), [], [], 0
                kept = edits.strip("I")
                cost = INSERT * (len(edits) - 1) + {"D": DELETE, "K": KEEP, "R": REROLE}[kept] + MEND * (fault == "truncated" and kept != "D")
                piece.add(1, initial, initial, turn, turn, turns=int(turn is not None), cost=cost, **({fault: 1} if fault else {}))
                audit.append(edits)
                said += [f"{x['role']}:{x['text']}".encode() for x in lines]
                size += sum(len(x["role"]) + len(x["text"]) + 1 for x in lines) + len(edits)
        if key is not None:
            out.append(row(True))
        yield packed()

    return pieces


_REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per conversation, of pieces that come sorted by conversation, block and number."""
    names = [f.split()[0] for f in _REPORT.split(", ")]
    types = [pa.string() if f.endswith("string") else pa.int64() for f in _REPORT.split(", ")]
    conv, total, audit, digest, waiting, out = None, None, [], None, b"", []

    def row():
        if isinstance(digest, bytes):
            ended = digest.hex()
        else:
            digest.update(waiting[:-1])  # no line break behind the last line
            ended = digest.hexdigest()
        return (conv, total.gaps, total.blank, total.duplicate, total.truncated, total.illegal, total.cost, "".join(audit), ended)

    def packed():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * len(names), types)], names=names)

    for batch in batches:
        for r in batch.drop_columns(["block", "piece"]).to_pylist():
            if total is None or r["conv_id"] != conv:
                if total is not None:
                    out.append(row())
                    if len(out) > 5_000:
                        yield packed()
                        out = []
                conv, total, audit, digest, waiting = r["conv_id"], _Piece(), [], hashlib.sha256(), b""
            total.add(**{c: r[c] for c in (*_COUNTED, "first", "last", "low", "high")})
            audit.append(r["audit"])
            if r["whole"]:
                digest = r["said"]
            elif r["said"]:
                digest.update(waiting)
                waiting = r["said"]
    if total is not None:
        out.append(row())
    yield packed()


def report(conversations: DataFrame) -> DataFrame:
    """``conv_id``, its counts of faults, the cost, the letters of the edits and the digest of the repaired conversation."""

    def build() -> DataFrame:
        rows, crossing = _repaired(conversations)
        # The join may deal a block over many tasks, by its place as well; only now is it one task's, in order.
        pieces = _by_block(rows.drop("role", "text")).mapInArrow(_cut(PIECE, crossing), _PIECES)
        return pieces.repartition("conv_id").sortWithinPartitions(
            F.col("conv_id").asc_nulls_first(), "block", "piece").mapInArrow(_joined, _REPORT)

    return settled(ready(conversations.sparkSession), "conversation-report", build)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in by the hash of conversation and turn: dropped, emptied, cut short, repeated, wrong role."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(named[0], F.lit(":"), named[1]).cast("binary")) % 20
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    return conversations.withColumns({"_kind": kind}).where("_kind != 0").select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")


def audited(conversations: DataFrame) -> DataFrame:
    """``report`` of the damaged conversations, with a row for every original one."""
    empty = hashlib.sha256(b"").hexdigest()
    ids = conversations.select(F.col("conv_id").cast("long").alias("original")).distinct()
    found = report(damaged(conversations))
    joined = ids.join(found, F.col("original").eqNullSafe(F.col("conv_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(F.col("original").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
