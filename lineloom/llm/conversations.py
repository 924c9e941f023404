"""Repair of conversations at least cost, by a shortest path over big-integer weights.

A repaired conversation has role initials `(s?(ua)+)?`. Rows are taken in the
order of their turns (without one first), then by role and text. Each may be
kept (cost 0) or given the role user or assistant (2), or deleted (3); user or
assistant rows without text may be inserted anywhere (2). A blank or duplicate
row must be deleted; a truncated row that stays costs 1 more. Of the cheapest
ways the one whose edits' initials come first by ASCII is taken.

The steps of all ways form a DAG of (row, state), the state being the last role.
One integer is the weight of a way: its high digits are the cost, its low digits
the edits' initials, each at its own place and zeros behind the last, so the least
integer is the answer by cost and by initials at once. The low digits cover a
bounded number of edits. When they are full, the ways that are left (one a state)
are put in order, the finished initials are set aside, and one digit with the
way's place in that order takes their stead: as ways that have dealt with the same
rows never have initials of which one is the start of the other, nothing is lost.

Rows are shuffled by their conversation and sorted by Spark, which spills, and
read as a stream: a task holds four ways of the conversation at hand and no
texts, also where one conversation has a third of all rows. The SHA-256 of the
repaired rows is carried along each way. Duplicates are numbered by a window over
(conversation, role, text), so no set of what was seen is held.

Defined cases: an empty table gives no rows; a NULL role or text is one space; NULL
is a conversation of its own; repeated rows are duplicates of their first; rows
that differ only in white space are different; a conversation of which all rows
are marked absent gives zeros, no edits and the hash of the empty text. Other
columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

# Costs of the edits, and what a truncated row costs if it stays.
COSTS = {"K": 0, "R": 2, "D": 3, "I": 2}
TRUNCATED = 1
# Digits of the edits, in the order of ASCII; 0 is padding.
DIGITS = {"D": 1, "I": 2, "K": 3, "R": 4}
BITS = 3
PLACES = 384
LEGAL = {"su", "ua", "au"}
SPACES = " \t\n\v\f\r"

# States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAME = {USER: "user", ASSISTANT: "assistant"}
_LETTERS = {digit: letter for letter, digit in DIGITS.items()}


class _Way:
    """The best way to a state: weight, edits in its low digits, finished edits, hash of its rows."""

    __slots__ = ("weight", "length", "past", "hash", "empty")

    def __init__(self, weight: int, length: int, past: tuple | None, rows, empty: bool):
        self.weight, self.length, self.past, self.hash, self.empty = weight, length, past, rows, empty


class Repair:
    """One conversation, row by row; `places` edits fit the low digits."""

    def __init__(self, places: int = PLACES):
        self.places = places
        self.digits = BITS * places
        self.unit = self.digits + BITS  # where the cost begins
        self.ways: list[_Way | None] = [_Way(0, 0, None, sha256(), True), None, None, None]

    def _after(self, way: _Way, letter: str, length: int, extra: int = 0) -> int:
        """What an edit at place `length` adds to a weight."""
        return ((COSTS[letter] + extra) << self.unit) + (DIGITS[letter] << (self.digits - BITS * (length + 1)))

    def row(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        if max(way.length for way in self.ways if way) + 2 > self.places:
            self._settle()
        extra = TRUNCATED if truncated else 0
        best: list[tuple | None] = [None] * 4

        def offer(state: int, weight: int, way: _Way, said: tuple, edits: int) -> None:
            if best[state] is None or weight < best[state][0]:
                best[state] = (weight, way, said, edits)

        for state, way in enumerate(self.ways):
            if way is None:
                continue
            # An insertion before a deletion is one after it, with later initials.
            offer(state, way.weight + self._after(way, "D", way.length), way, (), 1)
            if must_go:
                continue
            inserted = NEXT[state]
            weight = way.weight + self._after(way, "I", way.length)
            # Two insertions in a row lead nowhere that none would not.
            for at, base, said, length in (
                (state, way.weight, (), way.length),
                (inserted, weight, (f"{NAME[inserted]}:",), way.length + 1),
            ):
                follows = NEXT[at]
                initial = role[:1]
                kept = SYSTEM if initial == "s" and at == START else follows if initial == NAME[follows][0] else None
                edits = length + 1 - way.length
                if kept is not None:
                    offer(kept, base + self._after(way, "K", length, extra), way, (*said, f"{role}:{text}"), edits)
                offer(follows, base + self._after(way, "R", length, extra), way, (*said, f"{NAME[follows]}:{text}"), edits)
        self.ways = [None if found is None else self._taken(*found) for found in best]

    def _taken(self, weight: int, way: _Way, said: tuple, edits: int) -> _Way:
        rows, empty = way.hash, way.empty
        if said:
            rows = rows.copy()
            for line in said:
                rows.update((line if empty else "\n" + line).encode("utf-8", "surrogatepass"))
                empty = False
        return _Way(weight, way.length + edits, way.past, rows, empty)

    def _edits(self, way: _Way) -> str:
        digits = [(way.weight >> (self.digits - BITS * (i + 1))) & ((1 << BITS) - 1) for i in range(way.length)]
        return "".join(_LETTERS[d] for d in digits)

    def _settle(self) -> None:
        """Set the edits so far aside; their order stays as the digit below the cost."""
        low = (1 << self.unit) - 1
        order = sorted((way for way in self.ways if way), key=lambda way: way.weight & low)
        for place, way in enumerate(order):
            way.past = (way.past, self._edits(way))
            way.weight = (way.weight >> self.unit << self.unit) + (place << self.digits)
            way.length = 0

    def end(self) -> tuple[int, str, str]:
        """(cost, edits' initials, hash of the repaired rows)."""
        if max(way.length for way in self.ways if way) + 1 > self.places:
            self._settle()
        found = [way for state, way in enumerate(self.ways) if way and state in (START, ASSISTANT)]
        open_way = self.ways[USER]
        if open_way is not None:
            weight = open_way.weight + self._after(open_way, "I", open_way.length)
            found.append(self._taken(weight, open_way, (f"{NAME[ASSISTANT]}:",), 1))
        way = min(found, key=lambda way: way.weight)
        pieces, past = [self._edits(way)], way.past
        while past is not None:
            past, piece = past
            pieces.append(piece)
        return way.weight >> self.unit, "".join(reversed(pieces)), way.hash.hexdigest()


class _Conversation:
    def __init__(self, conv_id):
        self.conv_id, self.repair = conv_id, Repair()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initial = self.first = self.last = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str, nth: int) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        said = text.rstrip(SPACES)
        blank = not said
        duplicate = not blank and nth > 1
        truncated = not (blank or duplicate) and said[-1] not in ".!?"
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        if self.initial is not None and self.initial + role[:1] not in LEGAL:
            self.illegal += 1
        self.initial = role[:1]
        self.repair.row(role, text, blank or duplicate, truncated)

    def result(self) -> dict:
        cost, audit, rows = self.repair.end()
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return {
            "conv_id": self.conv_id, "gaps": gaps, "blank": self.blank, "duplicate": self.duplicate,
            "truncated": self.truncated, "illegal": self.illegal, "cost": cost, "audit": audit, "repaired_sha256": rows,
        }


def repair(
    rows: DataFrame,
    *,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    absent: Column | None = None,
) -> DataFrame:
    """One row per conversation: conv_id, faults, cost, edits and the hash of the repaired rows.

    `gaps` are turns missing between the first and last; `blank`, `duplicate` and
    `truncated` count rows by their first fault; `illegal` counts neighbours whose
    role initials may not follow each other; `audit` has the edits' initials. Rows
    that `absent` marks only name their conversation.
    """
    said = lambda column: F.coalesce(F.col(column).cast("string"), F.lit(" "))
    gone = F.lit(False) if absent is None else F.coalesce(absent, F.lit(False))
    taken = rows.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        said(role).alias("role"), said(text).alias("text"), gone.alias("absent"),
    )
    same = Window.partitionBy("conv_id", "absent", "role", "text").orderBy("turn")
    numbered = taken.withColumn("nth", F.row_number().over(same))
    streams = numbered.repartition("conv_id").sortWithinPartitions("conv_id", "absent", "turn", "role", "text", "nth")
    kind = rows.schema[conv_id].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    return streams.mapInArrow(_conversations, f"conv_id {kind}, {counts}, audit string, repaired_sha256 string")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, done, kind = None, [], None
    fields = [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    fields += [("audit", pa.string()), ("repaired_sha256", pa.string())]
    for batch in batches:
        kind = pa.schema([("conv_id", batch.schema.field("conv_id").type), *fields])
        for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "nth", "absent"))):
            if current is None or row[0] != current.conv_id:
                if current is not None:
                    done.append(current.result())
                current = _Conversation(row[0])
            if not row[5]:
                current.add(*row[1:5])
        if len(done) > 1000:
            yield pa.RecordBatch.from_pylist(done, schema=kind)
            done = []
    if current is not None:
        done.append(current.result())
        yield pa.RecordBatch.from_pylist(done, schema=kind)
