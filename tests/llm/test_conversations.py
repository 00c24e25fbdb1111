"""Conversation repair against a version that carries the best audit of every state forward, row by row."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from changeflow.llm import conversations as cv
from changeflow.llm.queries import QUERIES

DDL = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\v\f\r"
ORDER = {"": "u", "s": "u", "u": "a", "a": "u"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        kind = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = shown[2], shown[3]
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute(rows):
    """The report of one conversation's rows after damage."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    counts = dict(blank=0, duplicate=0, truncated=0, illegal=0)
    seen, faults = set(), []
    for _, _, role, text in rows:
        body = text.strip(SPACE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else ""
        fault = fault or ("truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
        faults.append(fault)
        if fault:
            counts[fault] += 1
    for x, y in zip(rows, rows[1:]):
        counts["illegal"] += x[2][:1] + y[2][:1] not in ("su", "ua", "au")
    turns = {r[1] for r in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0

    def with_inserts(states):
        todo = list(states)
        while todo:
            q = todo.pop()
            cost, audit, out = states[q]
            new = (cost + 5, audit + "I", [*out, ({"u": "user", "a": "assistant"}[ORDER[q]], "")])
            if ORDER[q] not in states or new[:2] < states[ORDER[q]][:2]:
                states[ORDER[q]] = new
                todo.append(ORDER[q])
        return states

    states = with_inserts({"": (0, "", [])})
    for (_, _, role, text), fault in zip(rows, faults):
        after = {}

        def offer(q, entry):
            if q not in after or entry[:2] < after[q][:2]:
                after[q] = entry

        for q, (cost, audit, out) in states.items():
            offer(q, (cost + 2, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            extra, initial = 5 * (fault == "truncated"), role[:1]
            if initial == ORDER[q] or (initial == "s" and q == ""):
                offer(initial, (cost + extra, audit + "K", [*out, (role, text)]))
            name = {"u": "user", "a": "assistant"}[ORDER[q]]
            offer(ORDER[q], (cost + extra + 1, audit + "R", [*out, (name, text)]))
        states = with_inserts(after)
    cost, audit, out = min((states[q] for q in ("", "a") if q in states), key=lambda e: e[:2])
    lines = "\n".join(f"{r}:{t}" for r, t in out)
    return {
        "gaps": gaps, **counts, "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256(lines.encode()).hexdigest(),
    }


def expected(rows):
    groups = {r[0]: [] for r in rows}
    for r in damaged(rows):
        groups[r[0]].append(r)
    return {conv: brute(g) for conv, g in groups.items()}


def found(frame):
    out = {}
    for r in frame.collect():
        row = r.asDict()
        conv = row.pop("conv_id")
        assert conv not in out
        out[conv] = row
    return out


def conversation(rng, conv, n):
    roles = ["user", "assistant", "system", "tool", "u", "", None]
    texts = ["Yes.", "No", "a!", "b", " ", "", None, "x?\n", "y.\t", "z;", "ü.", " "]
    weights = [8, 8, 2, 1, 1, 1, 1]
    for i in range(n):
        turn = None if rng.random() < 0.05 else i + rng.randrange(0, 3)
        text = rng.choice(texts) if rng.random() < 0.4 else f"t{rng.randrange(n)}" + rng.choice([".", "?", ""])
        yield conv, turn, rng.choices(roles, weights)[0], text


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = [r for conv in range(300) for r in conversation(rng, conv, rng.randrange(1, 14))]
    out += list(conversation(rng, None, 9))
    out += [r for conv in (1000, 1001) for r in conversation(rng, conv, 700)]
    out += [(1002, None, "user", "Same.")] * 400
    return out


@pytest.mark.parametrize("block_rows", [cv.BLOCK_ROWS, 7, 1])
def test_repair_agrees_with_the_plain_version(spark, rows, block_rows):
    frame = spark.createDataFrame(rows, DDL).repartition(5)
    assert found(cv.report(cv.repair(cv.damage(frame), block_rows))) == expected(rows)


def test_query_agrees_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op12_conversation_structure_repair"](spark, "/root/testdata/sf0.01")) == expected(rows)


def test_turns_are_what_the_audit_says(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi again."), (1, 2, "user", "So?"), (2, 0, "system", "Be good."),
            (2, 1, "assistant", "Yes."), (2, 2, "user", "ok")]
    out = cv.repair(spark.createDataFrame(rows, DDL))
    got = {r["conv_id"]: (r["audit"], [(t["role"], t["text"]) for t in r["turns"]]) for r in out.collect()}
    assert got[1] == ("DKR", [("user", "Hi again."), ("assistant", "So?")])
    assert got[2] == ("RKD", [("user", "Be good."), ("assistant", "Yes.")])


def test_empty_tables_clashing_columns_and_long_texts(spark):
    nothing = cv.report(cv.repair(spark.createDataFrame([], DDL)))
    assert nothing.collect() == []
    long = "word " * 400_000 + "."
    rows = [(1, 0, "user", long), (1, 1, "assistant", "Yes.")]
    frame = spark.createDataFrame(rows, DDL).withColumns(
        {c: F.lit(7) for c in ("digest", "first", "part", "block", "whole", "state", "k", "piece", "cost")}
    )
    got = cv.report(cv.repair(frame)).collect()
    lines = f"user:{long}\nassistant:Yes."
    assert [(r["audit"], r["cost"]) for r in got] == [("KK", 0)]
    assert got[0]["repaired_sha256"] == hashlib.sha256(lines.encode()).hexdigest()


def test_a_conversation_whose_rows_are_all_dropped(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    rows = [(5, turn, "user", "Hi."), (6, None, None, None)]
    assert found(cv.report(cv.repair(cv.damage(spark.createDataFrame(rows, DDL))))) == expected(rows)
