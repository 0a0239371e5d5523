"""Repair of conversation structure at least cost, by tables over blocks of turns.

A repaired conversation reads: perhaps one system turn, then user and assistant in turn, ending with the assistant; or
nothing.  Turns are kept (0), get the role user or assistant (2), or go (3; blank and repeated turns must); empty turns of user or
assistant come in anywhere (2).  A truncated turn that does not go costs 1 more.  The cheapest list of edits wins, of equal
ones that whose initials (D, I, K, R) come first in ASCII order.

What the rest of a conversation costs is a vector over four states (nothing yet, after system, after user, after
assistant).  Taken relative to its least entry it has few values, so for every value and every block of BLOCK turn symbols
the vector before the block is worked out once; a conversation is then read from its end by lookups, one a block.  Edits are traced from
the start: each block is expanded backward from the vector on its right, which makes the choice among ties exact.

A conversation streams through one task, twice within one sort: first its symbols (one byte a turn is held), then its texts,
which go into a running digest or come out at once.  So a long conversation needs time in a task, but no memory to speak of.

Nulls in role and text count as one space, a null turn comes before all others, and null conv_id is a conversation of its own.
Turns of the same number stand in the order of role and digest of the text; equal ones differ in nothing but being a repetition.  A
role counts by its first character; one that is none of s, u, a cannot be kept.  Columns beyond the four are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4
FAR = 1 << 20
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
ROLES = "sua"
# symbols: nothing, must go, then whole turns by role (s, u, a, other), then truncated ones
NOTHING, MUST_GO, WHOLE, TRUNCATED = 0, 1, 2, 6
SYMBOLS = 10
FRESH = (2, 2, 3, 2)  # state after a turn whose role is chosen
KEPT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}  # by state and role
RENAMED = {2: "user", 3: "assistant"}
KEEP, RENAME, DELETE, INSERT, CUT_SHORT = 0, 2, 3, 2, 1

Vector = tuple[int, int, int, int]


def with_inserts(v: Vector) -> Vector:
    """The vector where turns may come in first; two of them suffice, a third leads back."""
    for _ in range(2):
        v = tuple(min(v[q], INSERT + v[FRESH[q]]) for q in range(4))
    return v


def before(v: Vector, symbol: int) -> Vector:
    """The vector before a turn, from the one behind it."""
    if symbol == NOTHING:
        return v
    out = [DELETE + v[q] for q in range(4)]
    if symbol != MUST_GO:
        role, extra = (symbol - WHOLE) % 4, CUT_SHORT * (symbol >= TRUNCATED)
        for q in range(4):
            kept = KEPT.get((q, role))
            keep = KEEP + extra + v[kept] if kept is not None else FAR
            out[q] = min(out[q], keep, RENAME + extra + v[FRESH[q]])
    return with_inserts(tuple(out))


END = with_inserts((0, FAR, FAR, 0))


class Tables(NamedTuple):
    """Relative vectors, and per (vector, block code) the one before the block and the cost it adds."""

    vectors: list[Vector]
    move: np.ndarray
    cost: np.ndarray


@lru_cache(1)
def tables() -> Tables:
    """All blocks, made from single symbols.  The vectors are those that turns can lead to, so their number is fixed."""
    least = min(END)
    vectors, number = [], {}

    def known(v: Vector) -> int:
        low = min(v)
        v = tuple(x - low for x in v)
        if v not in number:
            number[v] = len(vectors)
            vectors.append(v)
        return number[v]

    known(END)
    assert least == 0
    move, cost = [], []
    at = 0
    while at < len(vectors):
        after = [before(vectors[at], s) for s in range(SYMBOLS)]
        move.append([known(v) for v in after])
        cost.append([min(v) for v in after])
        at += 1
    one_move, one_cost = np.array(move, np.int32), np.array(cost, np.int32)
    block_move, block_cost = one_move, one_cost
    for _ in range(BLOCK - 1):  # a symbol further to the left, in the highest digit
        block_cost = np.concatenate([block_cost + one_cost[block_move, s] for s in range(SYMBOLS)], 1)
        block_move = np.concatenate([one_move[block_move, s] for s in range(SYMBOLS)], 1)
    return Tables(vectors, block_move, block_cost)


@lru_cache(200_000)
def expanded(code: int, right: int, state: int) -> tuple[str, tuple[int, ...]]:
    """Edits of one block from a state on, as initials with the state behind each."""
    symbols = [code // SYMBOLS ** (BLOCK - 1 - k) % SYMBOLS for k in range(BLOCK)]
    vectors = [tables().vectors[right]]
    for s in reversed(symbols):
        vectors.append(before(vectors[-1], s))
    vectors.reverse()
    initials, states = "", []
    for k, symbol in enumerate(symbols):
        here, behind = vectors[k], vectors[k + 1]
        role, extra = (symbol - WHOLE) % 4, CUT_SHORT * (symbol >= TRUNCATED)
        while symbol != NOTHING:
            if here[state] == DELETE + behind[state]:
                edit = "D"
            elif here[state] == INSERT + here[FRESH[state]]:
                edit, state = "I", FRESH[state]
            elif (state, role) in KEPT and here[state] == KEEP + extra + behind[KEPT[state, role]]:
                edit, state = "K", KEPT[state, role]
            else:
                edit, state = "R", FRESH[state]
            initials += edit
            states.append(state)
            if edit != "I":
                break
    return initials, tuple(states)


def planned(symbols: bytes) -> tuple[int, Iterator[tuple[str, tuple[int, ...]]]]:
    """The least cost, and block by block the edits that have it."""
    t = tables()
    digits = np.frombuffer(symbols.rjust(-(-len(symbols) // BLOCK) * BLOCK, bytes([NOTHING])), np.uint8).astype(np.int32)
    codes = (digits.reshape(-1, BLOCK) @ SYMBOLS ** np.arange(BLOCK - 1, -1, -1)).tolist()
    rights, vector, cost = [0] * len(codes), 0, 0
    for k in range(len(codes) - 1, -1, -1):
        rights[k] = vector
        cost += int(t.cost[vector, codes[k]])
        vector = int(t.move[vector, codes[k]])
    cost += t.vectors[vector][0]

    def edits() -> Iterator[tuple[str, tuple[int, ...]]]:
        state = 0
        for code, right in zip(codes, rights, strict=True):
            initials, states = expanded(code, right, state)
            yield initials, states
            state = states[-1] if states else state
        tail = []
        while state not in (0, 3):
            state = FRESH[state]
            tail.append(state)
        yield "I" * len(tail), tuple(tail)

    return cost, edits()


def _symbol(fault: int, role: str) -> int:
    if fault in (1, 2):
        return MUST_GO
    at = ROLES.find(role[:1]) if role else -1
    return (TRUNCATED if fault == 3 else WHOLE) + (at if at >= 0 else 3)


class _Conversation:
    """State of the conversation that streams by."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.symbols = bytearray()
        self.faults = [0, 0, 0, 0]
        self.illegal = self.numbers = self.place = self.cost = 0
        self.first = self.last = self.initial = self.edits = None
        self.audit: list[str] = []
        self.digest = hashlib.sha256()

    def note(self, turn, role: str, fault: int) -> None:
        initial = role[:1]
        self.illegal += self.initial is not None and self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.numbers += 1
        self.faults[fault] += 1
        self.symbols.append(_symbol(fault, role))

    def steps(self) -> Iterator[tuple[str, int]]:
        self.cost, blocks = planned(bytes(self.symbols))
        for initials, states in blocks:
            self.audit.append(initials)
            yield from zip(initials, states, strict=True)

    def put(self, edit: str, role: str, text: str) -> tuple:
        self.digest.update(f"{chr(10) if self.place else ''}{role}:{text}".encode())
        self.place += 1
        return self.conv_id, self.place - 1, edit, role, text

    def turn(self, role: str, text: str) -> Iterator[tuple]:
        """What comes out at a turn: turns that come in before it, and itself unless it goes."""
        self.edits = self.edits or self.steps()
        for edit, state in self.edits:
            if edit == "I":
                yield self.put(edit, RENAMED[state], "")
                continue
            if edit != "D":
                yield self.put(edit, role if edit == "K" else RENAMED[state], text)
            return

    def end(self) -> Iterator[tuple]:
        for edit, state in self.edits or self.steps():
            yield self.put(edit, RENAMED[state], "")

    def summary(self) -> tuple:
        gaps = self.last - self.first + 1 - self.numbers if self.numbers else 0
        return self.conv_id, gaps, *self.faults[1:], self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest()


TURN_DDL = "conv_id bigint, place bigint, edit string, role string, text string"
SUMMARY_DDL = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
)
TURN_TYPES = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
SUMMARY_TYPES = pa.schema(
    [("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("repaired_sha256", pa.string())]
)


def _streamed(want_turns: bool):
    schema = TURN_TYPES if want_turns else SUMMARY_TYPES

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Conversation | None = None
        out: list[tuple] = []

        def close() -> None:
            last = list(now.end())
            out.extend(last if want_turns else [now.summary()])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "with_text", "turn", "role", "fault", "text")]
            for conv_id, with_text, turn, role, fault, text in zip(*columns, strict=True):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        close()
                    now = _Conversation(conv_id)
                if with_text:
                    turns = list(now.turn(role, text))
                    if want_turns:
                        out.extend(turns)
                else:
                    now.note(turn, role, fault)
            if out:
                yield packed(out)
                out = []
        if now is not None:
            close()
            if out:
                yield packed(out)

    return run


def fault(text: Column, repetition: Column) -> Column:
    """1 blank, 2 repeated, 3 truncated, 0 none; the first that holds."""
    visible = F.rtrim(text, F.lit(BLANKS))
    return F.when(visible == "", 1).when(repetition > 1, 2).when(~F.right(visible, F.lit(1)).isin(*ENDS), 3).otherwise(0)


def _in_order(rows: DataFrame) -> DataFrame:
    """Each conversation's turns twice, sorted: with their faults, then with their texts."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), blank("role").alias("role"), blank("text").alias("text"))
    rows = rows.withColumn("digest", F.sha2("text", 256))
    faults = rows.select("conv_id", "turn", "role", "digest", fault(F.col("text"), F.lit(0)).alias("fault"))
    # one shuffle serves the repetitions and, where Spark keeps it, the order of turns
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "digest").orderBy(F.col("turn").asc_nulls_first()))
    faults = faults.withColumn("again", again).withColumn("fault", F.when((F.col("fault") != 1) & (F.col("again") > 1), 2).otherwise(F.col("fault")))
    first = faults.select("conv_id", F.lit(False).alias("with_text"), "turn", "role", "digest", "again", "fault", F.lit(None).cast("string").alias("text"))
    second = rows.select("conv_id", F.lit(True).alias("with_text"), "turn", "role", "digest", F.lit(0).alias("again"), F.lit(0).alias("fault"), "text")
    order = ["conv_id", "with_text", F.col("turn").asc_nulls_first(), "role", "digest", "again"]
    return first.unionByName(second).repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "with_text", "turn", "role", "fault", "text")


def repaired(rows: DataFrame) -> DataFrame:
    """The turns (conv_id, place, edit, role, text) of all conversations after repair, place from 0."""
    return _in_order(rows).mapInArrow(_streamed(True), TURN_DDL)


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation: gaps in its numbers, faults, illegal neighbours, cost and initials of the edits, digest of the repaired turns."""
    return _in_order(rows).mapInArrow(_streamed(False), SUMMARY_DDL)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults: by CRC-32 of ``conv_id:turn`` modulo 20 a row is dropped, emptied, loses its ends, stands twice, or becomes the user's."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    text = F.when(draw == 1, "").when(draw == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    times = F.when(draw == 0, 0).when(draw == 3, 2).otherwise(1)
    role = F.when(draw == 4, "user").otherwise(blank("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(1), times)).alias("copy")).drop("copy")


def audited_after_damage(rows: DataFrame) -> DataFrame:
    """audits() of damaged(), with a row for conversations of which nothing is left."""
    ids = rows.select(F.col("conv_id").cast("bigint").alias("whole_id")).distinct()
    found = audits(damaged(rows))
    joined = ids.join(found, F.col("whole_id").eqNullSafe(F.col("conv_id")), "left")
    zeros = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256().hexdigest()
    return joined.select(F.col("whole_id").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
