"""Conversation repair against a walk over states, row by row."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from hypothesis import given, seed, settings
from hypothesis import strategies as st

from docroll.llm import conv_repair as C
from docroll.llm import queries as Q

from .conftest import SMALL

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def cheapest(rows: list[tuple[str, str]]) -> tuple[int, str]:
    """(initial, fault) rows; the least (cost, audit) by the last initial put out."""

    def put(table, state, cost, audit):
        if state not in table or (cost, audit) < table[state]:
            table[state] = (cost, audit)

    def inserts(table):
        for _ in range(4):
            for state, (cost, audit) in list(table.items()):
                for x in NEXT[state]:
                    if x != "s":
                        put(table, x, cost + 3, audit + "I")
        return table

    now = inserts({"": (0, "")})
    for initial, fault in rows:
        after: dict = {}
        for state, (cost, audit) in now.items():
            put(after, state, cost + 4, audit + "D")
            if fault not in ("blank", "duplicate"):
                more = 3 if fault else 0
                for x in NEXT[state]:
                    if initial == x:
                        put(after, x, cost + more, audit + "K")
                    if x != "s":
                        put(after, x, cost + 3 + more, audit + "R")
        now = inserts(after)
    return min(now[s] for s in ("", "a") if s in now)


def report(rows: list[tuple]) -> dict:
    """Rows (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(SPACES)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    cost, audit = cheapest([(role[:1], f) for (_, role, _), f in zip(rows, faults)])
    out, at = [], 0
    last = ""
    for letter in audit:
        role, text = ("user" if last != "u" else "assistant", "") if letter == "I" else rows[at][1:]
        at += letter != "I"
        if letter == "R":
            role = "user" if last != "u" else "assistant"
        if letter != "D":
            out.append(f"{role}:{text}")
            last = role[:1]
    turns = [t for t, _, _ in rows if t is not None]
    initials = [role[:1] for _, role, _ in rows]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(out).encode()).hexdigest(),
    }


def after_damage(table: list[tuple]) -> dict:
    """Conversations of (conv_id, turn, role, text) rows after the stated damage, in order."""
    out: dict = {}
    for conv, turn, role, text in table:
        rows = out.setdefault(conv, [])
        role, text = role if role is not None else " ", text if text is not None else " "
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = text.replace(".", "").replace("!", "").replace("?", "")
        if fault == 4:
            role = "user"
        rows += [(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    for rows in out.values():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


def odd_conversations() -> list[tuple]:
    dice = random.Random(5)
    texts = ["Yes.", "No!", "cut off", "", " \n", "Why?", "a", "b.", None, "x" * 300_000 + ".", "same.", "same."]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "u"]
    rows = [(c, t, dice.choice(roles[:3] * 4 + roles), dice.choice(texts)) for c in range(60) for t in range(dice.randint(1, 9))]
    rows += [(c, dice.choice([None, 3, 7, 100]), dice.choice(roles), f"t{i}.") for c in (70, 71, None) for i in range(6)]
    rows += [(80, 1, "user", "twice."), (80, 1, "user", "twice."), (81, None, None, None), (81, None, None, None), (None, None, None, None)]
    rows += [(90, t, dice.choice(["user", "assistant"]), dice.choice([f"turn {t}.", f"turn {t // 3}.", "again!"])) for t in range(1500)]  # most of the table
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, conv_key string, part int, at string, present boolean"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", False) for r in rows], SCHEMA)


FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("held", [C.HELD, 3])
def test_against_the_walk(spark, monkeypatch, held):
    rows = odd_conversations()
    monkeypatch.setattr(C, "HELD", held)
    got = {r.conv_id: r.asDict() for r in C.repair_report(C.damaged(table(spark, rows).repartition(5)), present="present").collect()}
    want = {c: report(r) for c, r in after_damage(rows).items()}
    assert got.keys() == want.keys()
    for c in want:
        assert {f: got[c][f] for f in FIELDS} == want[c], c


def test_rows_of_the_repaired_conversations(spark):
    rows = odd_conversations()
    fixed: dict = {}
    for r in C.repaired_turns(C.damaged(table(spark, rows)), present="present").collect():
        fixed.setdefault(r.conv_id, []).append(r)
    for c, before in after_damage(rows).items():
        want = report(before)
        after = sorted(fixed.get(c, []), key=lambda r: r.seq)
        assert [r.seq for r in after] == list(range(len(after)))
        assert "".join(r.edit for r in after) == want["audit"].replace("D", "")
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in after).encode()).hexdigest() == want["repaired_sha256"]


def test_whole_query(spark):
    got = Q.QUERIES["op11_conversation_repair"](spark, SMALL)
    rows = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    want = {c: report(r) for c, r in after_damage([tuple(r) for r in rows]).items()}
    assert {r.conv_id: {f: r[f] for f in FIELDS} for r in got.collect()} == want


@seed(1)
@settings(max_examples=300, deadline=None)
@given(st.text("suaxSUAX-", max_size=12), st.integers(1, 11))
def test_every_split_gives_the_same_cell(rows, at):
    names = {"-": "blank"}
    want = cheapest([("" if r in "xX-" else r.lower(), names.get(r, "truncated" if r.isupper() else "")) for r in rows])
    assert C.best(C.parse(rows)) == want
    assert C.best(C.parse_cells([C.parse_rows(p) if p else C.nothing() for p in (rows[:at], rows[at:])])) == want


def test_long_sequences_by_runs():
    dice = random.Random(3)
    rows = "".join(dice.choice("suaUAx-uaua") for _ in range(3000))
    assert C.best(C.parse(rows)) == cheapest([("" if r in "x-" else r.lower(), "blank" if r == "-" else "truncated" if r.isupper() else "") for r in rows])


def test_empty_and_invalid_text(spark):
    assert C.repair_report(table(spark, [])).collect() == []
    bad = table(spark, [(1, 0, "user", "ok?")]).selectExpr("conv_id", "turn", "role", "decode(unhex('41FF'), 'ISO-8859-1') AS text").unionByName(
        spark.sql("SELECT 1L AS conv_id, 1L AS turn, 'assistant' AS role, CAST(unhex('41FF2E') AS STRING) AS text"))
    (r,) = C.repair_report(bad).collect()
    assert r.cost == 3 and r.audit == "KK" and r.repaired_sha256 == hashlib.sha256("user:Aÿ".encode() + b"\nassistant:A\xff.").hexdigest()
