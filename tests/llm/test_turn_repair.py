"""Conversation repair against search over all edits, and against the SQL twin on hard rows."""

import hashlib
import random
import zlib
from functools import lru_cache

import duckdb
import pytest

from replaykit.llm import queries
from replaykit.llm import turn_repair as tr

WHITE = " \t\n\x0b\x0c\r"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def least(turns):
    """Cost and initials by search; ``turns`` are (role, fault)."""
    allowed = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    fresh = {0: 2, 1: 2, 2: 3, 3: 2}

    @lru_cache(None)
    def rest(i, q, inserts):
        found = []
        if i == len(turns):
            found += [(0, "")] if q in (0, 3) else []
        else:
            role, fault = turns[i]
            step = lambda c, e, s: [(c + s[0], e + s[1])]
            found += step(3, "D", rest(i + 1, q, 0))
            if fault not in (1, 2):
                extra = int(fault == 3)
                if role[:1] in allowed[q]:
                    found += step(extra, "K", rest(i + 1, allowed[q][role[:1]], 0))
                found += step(2 + extra, "R", rest(i + 1, fresh[q], 0))
        if inserts < 4:
            c, s = rest(i, fresh[q], inserts + 1)
            found.append((2 + c, "I" + s))
        return min(found, default=(10**6, ""))

    return rest(0, 0, 0)


def brute(rows):
    """Figures of one conversation after damage, from (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    seen, turns = set(), []
    for _, role, text in rows:
        shown = text.rstrip(WHITE)
        turns.append((role, 1 if not shown else 2 if (role, text) in seen else 3 if shown[-1] not in ".!?" else 0))
        seen.add((role, text))
    cost, audit = least(tuple(turns))
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    out, at, state = [], 0, 0
    for e in audit:
        if e == "D":
            at += 1
            continue
        if e in "RI":
            state = 3 if state == 2 else 2
            role = {2: "user", 3: "assistant"}[state]
        else:
            role = rows[at][1]
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
        out.append(f"{role}:{'' if e == 'I' else rows[at][2]}")
        at += e != "I"
    faults = [f for _, f in turns]
    return gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if draw == 1 else "".join(c for c in text if c not in ".!?") if draw == 2 else text
        role = "user" if draw == 4 else role
        out.setdefault(conv, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(draw, 1))
    return out


def hard_rows(rng):
    roles, texts = ["user", "assistant", "system", "s", "tool", "", None, "Üser"], ["Yes.", "No", "", " \n", "Yes. ", None, "ok!", "x?\t", "é"]
    rows = []
    for conv in [*range(300), None]:
        for turn in range(rng.randint(1, 11)):
            rows.append((conv, rng.choice([turn, turn, turn, None, turn + 3]), rng.choice(roles[:3] if rng.random() < 0.7 else roles), rng.choice(texts)))
    return rows


@pytest.mark.parametrize("seed", range(40))
def test_block_tables_equal_search(seed):
    rng = random.Random(seed)
    for _ in range(60):
        turns = tuple((rng.choice(["s", "u", "a", "x"]), rng.choice([0, 0, 1, 2, 3])) for _ in range(rng.randint(0, 13)))
        cost, blocks = tr.planned(bytes(tr._symbol(f, r) for r, f in turns))
        assert (cost, "".join(i for i, _ in blocks)) == least(turns)


@pytest.fixture(scope="module")
def conversations(spark):
    rows = hard_rows(random.Random(3))
    rows += [(1000, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(5000)]
    return rows, spark.createDataFrame([(*r, "x", 1, True) for r in rows], "conv_id int, turn int, role string, text string, digest string, again int, with_text boolean").repartition(3)


def test_audits_equal_brute_force(conversations):
    rows, df = conversations
    got = {r[0]: tuple(r)[1:] for r in tr.audited_after_damage(df).select(*COLUMNS).collect()}
    expected = {c: brute(turns) for c, turns in damage(rows).items() if c != 1000}
    assert {c: v for c, v in got.items() if c != 1000} == expected and got[1000][6]


def test_audits_equal_the_twin(spark, tmp_path, conversations):
    _, df = conversations
    df.where("conv_id IS NULL OR conv_id < 1000").select(
        df.conv_id.cast("bigint").alias("conv_id"), df.turn.cast("bigint").alias("turn"), "role", "text"
    ).coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    cursor = con.execute(queries.ORACLES["op12_turn_repair"])
    assert [d[0] for d in cursor.description] == COLUMNS
    got = queries.QUERIES["op12_turn_repair"](spark, str(tmp_path)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == sorted(cursor.fetchall(), key=str)


def test_repaired_turns_match_their_digest(conversations):
    _, df = conversations
    turns = {}
    for r in sorted(tr.repaired(df).collect(), key=lambda r: r.place):
        turns.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
        assert "" != r.role and r.edit in "KRI"
    for r in tr.audits(df).collect():
        assert hashlib.sha256("\n".join(turns.get(r.conv_id, [])).encode()).hexdigest() == r.repaired_sha256


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert tr.audited_after_damage(empty).count() == 0 and tr.repaired(empty).count() == 0
