"""Repair of conversation structure: the cheapest edits after which roles read `(s?(ua)+)?`.

Edits of a row are Keep, Rerole (to user or assistant) and Delete; Insert adds
an empty turn anywhere. The grammar has four states (nothing yet, after a
system, a user, an assistant turn), so the cheapest way on from any row is a
vector of four costs. Those vectors are computed backwards and stored at
checkpoints only; a forward walk recomputes the rows between two checkpoints
and takes the ASCII-least edit among the tight ones. Every letter of an audit
leads to one state, so the least letter at each step gives the least audit.

The same is done on two levels. Rows are range partitioned and sorted, so a
conversation of any length is cut into blocks over many tasks. A block sends
its 4 x 4 (min, +) matrix; the vectors at the ends of blocks, the outer
checkpoints, follow from the matrices alone. Inside a block the checkpoints
stand at every square root of its rows. Most conversations are one block and
end in the task that sorted them.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import written

BLOCK_ROWS, BLOCK_CHARS = 1 << 16, 16_000_000  # a block ends with the row that reaches either
PREFIX = 32  # characters of a text that decide between range partitions
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5  # costs
INF = 1 << 60
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # the state after an inserted or reroled turn
KEEP = {  # state after a kept role, by its initial
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
ROLE = {USER: "user", ASSISTANT: "assistant"}
CLASSES = ("", "s", "u", "a")  # initials that the grammar knows, and all others
GONE = 8  # kind of a row that has to go; other kinds are class + 4 * truncated
Vector = tuple[int, int, int, int]

ROWS = "conv_id, turn, role, text, copies, first".split(", ")
STATS = "blank long, duplicate long, truncated long, illegal long"
ENDS = "initial string, final string, turns_seen long, low long, high long, n long"
TURNS = "turns array<struct<role:string,text:string>>"
BLOCK = (
    f"conv_id long, part int, block long, whole boolean, gaps long, {STATS}, {ENDS}, cost long, audit string, {TURNS}, "
    "kinds binary, copies array<long>, matrix array<long>"
)


def inserted(v: list[int]) -> Vector:
    """Costs with any number of turns inserted first."""
    u, a = min(v[USER], INSERT + v[ASSISTANT]), min(v[ASSISTANT], INSERT + v[USER])
    return min(v[START], INSERT + u), min(v[SYSTEM], INSERT + u), u, a


END = inserted([0, INF, INF, 0])


def before(kind: int, v: Vector) -> Vector:
    """Costs before a row of this kind from those after it."""
    if kind == GONE:
        return tuple(x + DELETE for x in v)
    initial, extra = CLASSES[kind % 4], TRUNCATED * (kind // 4)
    out = []
    for q in range(4):
        best = min(DELETE + v[q], REROLE + extra + v[NEXT[q]])
        kept = KEEP.get(initial, {}).get(q)
        out.append(best if kept is None else min(best, extra + v[kept]))
    return inserted(out)


def matrix(kinds: bytes) -> list[int]:
    """The block's costs from state to state, row by row of the 4 x 4 matrix."""
    columns = [tuple(0 if p == q else INF for p in range(4)) for q in range(4)]
    columns = [inserted(list(c)) for c in columns] if not kinds else columns
    for kind in reversed(kinds):
        columns = [before(kind, c) for c in columns]
    return [min(columns[q][p], INF) for p in range(4) for q in range(4)]


def through(m: list[int], v: Vector) -> Vector:
    """Costs before a block from those after it."""
    return tuple(min(m[4 * p + q] + v[q] for q in range(4)) for p in range(4))


def walk(kinds: bytes, state: int, after: Vector, last: bool) -> tuple[str, int, Vector]:
    """The least tight edits of a block entered in `state`: letters, the state behind it, the costs before it.

    Vectors are kept at every square root of the rows; those between two
    checkpoints are computed again when the walk comes to them.
    """
    n = len(kinds)
    step = max(1, math.isqrt(n))
    kept, v = {n: after}, after
    for i in range(n - 1, -1, -1):
        v = before(kinds[i], v)
        if i % step == 0:
            kept[i] = v
    first, letters = v, []
    for lo in range(0, n, step):
        hi = min(lo + step, n)
        rows = [kept[hi]]
        for i in range(hi - 1, lo - 1, -1):
            rows.append(before(kinds[i], rows[-1]))
        rows.reverse()
        for i in range(lo, hi):
            here, there = rows[i - lo], rows[i - lo + 1]
            while True:
                letter, state = _tight(kinds[i], state, here, there)
                letters.append(letter)
                if letter != "I":
                    break
    while last and after[state]:
        letters.append("I")
        state = NEXT[state]
    return "".join(letters), state, first


def _tight(kind: int, q: int, here: Vector, there: Vector) -> tuple[str, int]:
    if here[q] == DELETE + there[q]:
        return "D", q
    if here[q] == INSERT + here[NEXT[q]]:
        return "I", NEXT[q]
    extra, kept = TRUNCATED * (kind // 4), KEEP.get(CLASSES[kind % 4], {}).get(q)
    if kept is not None and here[q] == extra + there[kept]:
        return "K", kept
    return "R", NEXT[q]


def edited(letters: str, state: int, rows: list[tuple[str, str]]) -> list[dict[str, str]]:
    """The turns that the edits leave of `rows` (role, text), entered in `state`."""
    out, at = [], 0
    for letter in letters:
        if letter == "I":
            state = NEXT[state]
            out.append({"role": ROLE[state], "text": ""})
            continue
        role, text = rows[at]
        at += 1
        if letter == "K":
            state = KEEP[role[:1]][state]
            out.append({"role": role, "text": text})
        elif letter == "R":
            state = NEXT[state]
            out.append({"role": ROLE[state], "text": text})
    return out


def audit_of(letters: str, copies: list[int]) -> str:
    """The edits of all rows: copies that were counted with a row are deleted after it."""
    if all(c <= 1 for c in copies):
        return letters
    out, at = [], 0
    for letter in letters:
        out.append(letter)
        if letter != "I":
            out.append("D" * (copies[at] - 1))
            at += 1
    return "".join(out)


def _legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def _gaps(low: int | None, high: int | None, seen: int) -> int:
    """Turns missing between the first and the last, in 64 bits that wrap."""
    missing = 0 if low is None else high - low + 1 - seen
    return (missing + (1 << 63)) % (1 << 64) - (1 << 63)


class _Block:
    """Rows of one conversation that stand together in one task."""

    def __init__(self, conv, number: int):
        self.conv, self.number, self.kinds = conv, number, bytearray()
        self.rows, self.copies, self.size = [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns_seen = self.n = 0
        self.low = self.high = self.last_turn = self.initial = self.final = None

    def add(self, turn, role: str, text: str, copies: int, first: bool) -> None:
        initial, body = role[:1], text.strip(" \t\n\v\f\r")
        repeats = copies - 1
        if not body:
            self.blank += copies
            kind = GONE
        elif not first:
            self.duplicate += copies
            kind = GONE
        else:
            cut = body[-1] not in ".!?"
            self.duplicate += repeats
            self.truncated += cut
            kind = (CLASSES.index(initial) if initial in CLASSES else 0) + 4 * cut
        if self.final is not None:
            self.illegal += not _legal(self.final, initial)
        else:
            self.initial = initial
        self.illegal += repeats
        self.final = initial
        if turn is not None:
            self.turns_seen += self.high is None or turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.n += copies
        self.kinds.append(kind)
        self.copies.append(copies)
        self.rows.append((role, text if kind != GONE else ""))
        self.size += len(text) if kind != GONE else 0

    def full(self, most: int) -> bool:
        return len(self.kinds) >= most or self.size >= BLOCK_CHARS

    def record(self, part: int, whole: bool) -> dict:
        out = {
            "conv_id": self.conv, "part": part, "block": self.number, "whole": whole, "blank": self.blank,
            "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal, "n": self.n,
            "turns_seen": self.turns_seen, "low": self.low, "high": self.high, "initial": self.initial,
            "final": self.final, "gaps": _gaps(self.low, self.high, self.turns_seen),
        }
        kinds = bytes(self.kinds)
        if whole:
            letters, _, first = walk(kinds, START, END, True)
            out |= {"cost": first[START] + self.repeated(), "audit": audit_of(letters, self.copies)}
            return out | {"turns": edited(letters, START, self.rows)}
        out |= {"kinds": kinds, "copies": self.copies, "matrix": matrix(kinds), "cost": self.repeated()}
        return out | {"turns": [{"role": r, "text": t} for r, t in self.rows]}

    def repeated(self) -> int:
        return DELETE * sum(c - 1 for c in self.copies)


def _blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """One record per block of a conversation; those that are whole in one task and block are repaired already."""
    schema = _arrow(BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        block, number, whole, out, size = None, 0, False, [], 0
        for batch in batches:
            for conv, turn, role, text, copies, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block is None or block.conv != conv or block.full(block_rows):
                    # Whole: it began behind another conversation in this task and ends before one.
                    same = block is not None and block.conv == conv
                    if block is not None:
                        out.append(block.record(part, whole=whole and not same))
                    number, whole = number + 1, block is not None and not same
                    block = _Block(conv, number)
                if copies:
                    block.add(turn, role, text, copies, first)
                    size += len(text)
                if len(out) >= 2000 or size >= BLOCK_CHARS:
                    size = 0
                    if out:
                        yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
        if block is not None:
            out.append(block.record(part, whole=False))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return rows.select(*ROWS).mapInArrow(run, BLOCK)


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


KEYS = "conv_id long, part int, block long"
AFTER = f"{KEYS}, after array<long>, last boolean, piece long, pieces long, blank long, duplicate long, truncated long, " \
        "illegal long, gaps long, cost long"


def _by_conversation(blocks: DataFrame, ddl: str, scanned) -> DataFrame:
    """`scanned` of every conversation's block records, in order: its checkpoints, never its rows."""
    schema = _arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if rows and row["conv_id"] != rows[-1]["conv_id"]:
                    yield pa.RecordBatch.from_pylist(scanned(rows), schema)
                    rows = []
                rows.append(row)
        if rows:
            yield pa.RecordBatch.from_pylist(scanned(rows), schema)

    return blocks.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block").mapInArrow(run, ddl)


def _costs_after(rows: list[dict]) -> list[dict]:
    """The outer checkpoints: costs behind every block, from the matrices of those that follow."""
    after = [END]
    for row in reversed(rows):
        after.append(through(row["matrix"], after[-1]))
    after.reverse()  # after[i]: the costs before block i
    total = {k: sum(r[k] for r in rows) for k in ("blank", "duplicate", "truncated", "illegal", "cost")}
    low = high = final = None
    seen = sum(r["turns_seen"] for r in rows)
    for row in rows:
        if row["n"]:
            total["illegal"] += final is not None and not _legal(final, row["initial"])
            final = row["final"]
        if row["low"] is not None:
            seen -= high == row["low"]
            low, high = row["low"] if low is None else low, row["high"]
    total |= {"gaps": _gaps(low, high, seen), "cost": after[0][START] + total["cost"]}
    where = {"last": False, "pieces": len(rows)}
    return [
        {"conv_id": r["conv_id"], "part": r["part"], "block": r["block"], "after": after[i + 1], "piece": i}
        | where | {"last": i + 1 == len(rows)} | total
        for i, r in enumerate(rows)
    ]


def _entered(rows: list[dict]) -> list[dict]:
    """The state every block is entered in, from where each block leads."""
    state, out = START, []
    for row in rows:
        out.append({"conv_id": row["conv_id"], "part": row["part"], "block": row["block"], "state": state})
        state = row["exits"][state]
    return out


def _each(frame: DataFrame, ddl: str, change) -> DataFrame:
    """`change` of every row, one dict for one."""
    schema = _arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, 1000 * BLOCK_CHARS // max(BLOCK_CHARS, batch.nbytes * 10))
            for lo in range(0, batch.num_rows, step):
                rows = batch.slice(lo, step).to_pylist()
                yield pa.RecordBatch.from_pylist([change(row) for row in rows], schema)

    return frame.mapInArrow(run, ddl)


def _exits(row: dict) -> dict:
    ends = [walk(row["kinds"], q, tuple(row["after"]), row["last"])[1] for q in range(4)]
    return {"conv_id": row["conv_id"], "part": row["part"], "block": row["block"], "exits": ends}


def _walked(row: dict) -> dict:
    letters, _, _ = walk(row["kinds"], row["state"], tuple(row["after"]), row["last"])
    rows = [(t["role"], t["text"]) for t in row["turns"]]
    return row | {"audit": audit_of(letters, row["copies"]), "turns": edited(letters, row["state"], rows)}


OUT = f"conv_id long, piece long, pieces long, gaps long, {STATS}, cost long, audit string, {TURNS}"


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The repaired conversations, in pieces: `conv_id, piece, pieces, gaps, blank, duplicate, truncated, illegal, cost,
    audit, turns`.

    `rows` has `conv_id, turn, role, text` and, if it likes, `copies`: how often the row stands there (0: not at all,
    the conversation is named all the same). `turns` are the turns of the piece after its edits, `audit` the initials
    of these (Keep, Rerole, Delete, Insert); figures are those of the whole conversation. Pieces are numbered from 0;
    a conversation has several if it is long or lies across tasks.

    Rows go by turn, nulls first, those of one turn by role and text. Null roles and texts count as one space, rows
    without `conv_id` as one conversation. Repeated rows are counted before they are shuffled. Other columns are
    ignored. A conversation without rows has no turns, an empty audit and zeros.
    """
    copies = F.col("copies").cast("long") if "copies" in rows.columns else F.lit(1).cast("long")
    slim = rows.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), copies.alias("copies"),
    ).groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    sorted_rows = (
        _first_seen(slim)
        .repartitionByRange("conv_id", "turn", "role", F.left("text", F.lit(PREFIX)))
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )
    blocks = written(_blocks(sorted_rows, block_rows), "blocks")
    parts = blocks.filter("not whole")
    facts = ["blank", "duplicate", "truncated", "illegal", "turns_seen", "low", "high", "initial", "final", "n", "cost"]
    after = written(_by_conversation(parts.select(*KEYS_, *facts, "matrix"), AFTER, _costs_after), "after")
    leads = parts.select(*KEYS_, "kinds").join(after.select("part", "block", "after", "last"), ["part", "block"])
    entered = _by_conversation(_each(leads, f"{KEYS}, exits array<int>", _exits), f"{KEYS}, state int", _entered)
    ends = after.join(entered.select("part", "block", "state"), ["part", "block"])
    long = parts.select("part", "block", "kinds", "copies", "turns").join(ends, ["part", "block"])
    columns = [f.split()[0] for f in OUT.split(", ")]
    whole = blocks.filter("whole").withColumns({"piece": F.lit(0).cast("long"), "pieces": F.lit(1).cast("long")})
    pieces = _each(long, OUT, _walked)
    return whole.select(*columns).unionByName(pieces.select(*columns))


KEYS_ = ("conv_id", "part", "block")


def _first_seen(rows: DataFrame) -> DataFrame:
    """Adds `first`: whether no earlier turn of the conversation has this role and text."""
    rows = rows.withColumn("digest", F.md5("text"))
    several = (
        rows.filter("copies > 0").groupBy("conv_id", "role", "digest")
        .agg(F.count("*").alias("k"), F.min("turn").alias("least"), F.count_if(F.col("turn").isNull()).alias("nulls"))
        .filter("k > 1")
    )
    r, s = rows.alias("r"), several.alias("s")
    same = F.expr("r.conv_id <=> s.conv_id AND r.role = s.role AND r.digest = s.digest")
    first = F.expr("s.k IS NULL OR (s.nulls > 0 AND r.turn IS NULL) OR (s.nulls = 0 AND r.turn = s.least)")
    return r.join(s, same, "left").select("r.conv_id", "r.turn", "r.role", "r.text", "r.copies", first.alias("first"))


def damage(rows: DataFrame) -> DataFrame:
    """`conv_id, turn, role, text, copies` with the faults that a checksum of conversation and turn picks."""

    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(shown("role")).alias("role"),
        text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


REPORT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def report(pieces: DataFrame) -> DataFrame:
    """One row per conversation: its figures, `audit` and `repaired_sha256` of its turns as `role:text` lines.

    Conversations of one piece are digested where they are. The pieces of a long one stream through one task in order,
    as the digest of a sequence must; a piece at a time is held.
    """
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    short = pieces.filter("pieces = 1").select(*REPORT, "audit", F.sha2(lines, 256).alias("repaired_sha256"))
    long = pieces.filter("pieces > 1").select(
        *REPORT, "piece", "audit", F.when(F.size("turns") > 0, lines.cast("binary")).alias("lines")
    )
    ddl = ", ".join(f"{c} long" for c in REPORT) + ", audit string, repaired_sha256 string"
    schema = _arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, audit, digest, begun = None, [], hashlib.sha256(), False

        def done() -> pa.RecordBatch:
            row = {c: now[c] for c in REPORT} | {"audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for row in batch.to_pylist():
                if now is None or now["conv_id"] != row["conv_id"]:
                    if now is not None:
                        yield done()
                    audit, digest, begun = [], hashlib.sha256(), False
                now = {c: row[c] for c in REPORT}
                audit.append(row["audit"])
                if row["lines"] is not None:
                    digest.update(b"\n" if begun else b"")
                    digest.update(row["lines"])
                    begun = True
        if now is not None:
            yield done()

    ordered = long.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(run, ddl)
    return short.unionByName(ordered)
