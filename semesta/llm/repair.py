"""Conversation structure repair: the cheapest edits that make roles alternate, with an audit of every edit.

Each row of a conversation is kept, given another role, or deleted, and turns may be inserted between rows, so that the
roles read ``system? (user assistant)+`` or nothing at all. Among the cheapest ways the one whose audit (initials of the
edits in order: D, I, K, R) is least in ASCII order is taken.

The audits are a persistent structure: an edit is a node linked to the edits before it, so all ways share their common
beginnings and a row adds a few nodes only. A node has its depth, a rolling hash of its audit and links to its ancestors at
powers of two. Two audits of equal cost are compared at the end of their longest common beginning, which a search
through the ancestors finds by hash; what hashes call equal is verified letter by letter up to the node that both share.
Two audits at one row and state never are a beginning of each other, as that would differ in cost.

Work is dealt out by ranges of (conversation, turn, role, text), so a conversation that holds a third of all rows lies in many
tasks. A task answers for each conversation in its range; for the first and last one, which other tasks may hold parts of,
it also gives the best way from each state to each state. Those parts are put together per conversation (one row a task), and
the repaired text of a conversation in several parts is digested in one ordered pass that holds one batch at a time.
Equal rows are counted before they are dealt out; repeats of a (role, text) are found by an aggregate of their digests.

Rows are ordered by turn (nulls first), role and text. Null role and text are one space; rows with null conversation id are
one conversation. Empty texts are blank rows. A conversation without rows has no result row; ``empty`` gives it one. An empty table gives an empty one. Only the four columns named are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from semesta.llm.common import stored

#: What an edit costs, and an undeleted truncated row besides.
RELABEL, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
#: Roles by state: nothing yet, after system, after user, after assistant.
EXPECTED = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
STATES, DONE = range(4), (0, 3)
BLANK, DUPLICATE, TRUNCATED, FINE = "blank", "duplicate", "truncated", ""
_MODULUS, _BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E6
_SOLID = r"[^\x20\x09-\x0D]"


class Edit:
    """An edit and, through its links, all edits before it."""

    __slots__ = ("letter", "depth", "hash", "up")

    def __init__(self, before: Edit | None, letter: str):
        self.letter = letter
        if before is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth = before.depth + 1
        self.hash = (before.hash * _BASE + ord(letter)) % _MODULUS
        up = [before]
        while len(up) <= len(up[-1].up):
            up.append(up[-1].up[len(up) - 1])
        self.up = tuple(up)

    def at(self, depth: int) -> Edit:
        """The ancestor of this depth."""
        node = self
        while node.depth > depth:
            node = node.up[(node.depth - depth).bit_length() - 1]
        return node

    def audit(self) -> str:
        letters, node = [], self
        while node.depth:
            letters.append(node.letter)
            node = node.up[0]
        return "".join(reversed(letters))


def _difference(one: Edit, two: Edit) -> int | None:
    """Depth of the first letter in which two audits of equal depth differ, read down to the node they share."""
    first = None
    while one is not two and one.depth:
        if one.letter != two.letter:
            first = one.depth
        one, two = one.up[0], two.up[0]
    return first


def less(one: Edit, two: Edit) -> bool:
    """Whether the audit of ``one`` comes before that of ``two``."""
    depth = min(one.depth, two.depth)
    a, b = one.at(depth), two.at(depth)
    difference, x, y = None, a, b
    if a.hash != b.hash:
        # Up to the highest ancestors that still differ; above them lies the common beginning.
        for step in range(len(a.up) - 1, -1, -1):
            if step < len(x.up) and x.up[step].hash != y.up[step].hash:
                x, y = x.up[step], y.up[step]
        difference, x, y = x.depth, x.up[0], y.up[0]
    # Equal hashes may hide a difference, which then comes first.
    difference = _difference(x, y) or difference
    if difference is None:
        return one.depth < two.depth
    return a.at(difference).letter < b.at(difference).letter


ROOT = Edit(None, "")
Best = list["tuple[int, Edit] | None"]


def _better(best: Best, state: int, cost: int, before: Edit, letter: str) -> None:
    held = best[state]
    if held is None or cost < held[0]:
        best[state] = (cost, Edit(before, letter))
    elif cost == held[0]:
        edit = Edit(before, letter)
        if less(edit, held[1]):
            best[state] = (cost, edit)


def inserted(best: Best) -> Best:
    """The best ways after any turns that are put in here."""
    best = list(best)
    # In this order an assistant can follow a user that was put in; more than that is never cheapest.
    for state, (_, after) in enumerate(EXPECTED):
        if best[state] is not None:
            _better(best, after, best[state][0] + INSERT, best[state][1], "I")
    return best


def after_row(best: Best, initial: str, fault: str) -> Best:
    """The best ways after a row, from those before it."""
    then: Best = [None] * 4
    for state, held in enumerate(best):
        if held is None:
            continue
        cost, edit = held
        _better(then, state, cost + DELETE, edit, "D")
        if fault in (BLANK, DUPLICATE):
            continue
        stay = cost + (CUT_OFF if fault == TRUNCATED else 0)
        role, after = EXPECTED[state]
        if initial == role[0]:
            _better(then, after, stay, edit, "K")
        elif initial == "s" and state == 0:
            _better(then, 1, stay, edit, "K")
        _better(then, after, stay + RELABEL, edit, "R")
    return inserted(then)


def start(state: int) -> Best:
    best: Best = [None] * 4
    best[state] = (0, ROOT)
    return inserted(best)


def finish(best: Best) -> tuple[int, str]:
    ends = [best[state] for state in DONE if best[state] is not None]
    cost = min(c for c, _ in ends)
    tied = [edit for c, edit in ends if c == cost]
    edit = tied[1] if len(tied) > 1 and less(tied[1], tied[0]) else tied[0]
    return cost, edit.audit()


class Writer:
    """Digest of the rows that an audit leaves, ``role:text`` by lines, row by row."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0
        self.digest, self.empty = hashlib.sha256(), True

    def _line(self, role: str, text: str) -> None:
        self.digest.update(("" if self.empty else "\n").encode() + role.encode("utf-8", "surrogatepass") + b":")
        self.digest.update(text.encode("utf-8", "surrogatepass"))
        self.empty = False

    def _insertions(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            role, self.state = EXPECTED[self.state]
            self._line(role, "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._insertions()
        letter = self.audit[self.at]
        self.at += 1
        expected, after = EXPECTED[self.state]
        if letter == "K":
            self._line(role, text)
            self.state = 1 if self.state == 0 and role[:1] == "s" else after
        elif letter == "R":
            self._line(expected, text)
            self.state = after

    def end(self) -> str:
        self._insertions()
        return self.digest.hexdigest()


@dataclass
class Part:
    """What a task has seen of a conversation."""

    rows: list[tuple[str, str, str]] = field(default_factory=list)
    turns: int = 0
    lowest: int | None = None
    highest: int | None = None
    last_turn: int | None = None
    counts: dict[str, int] = field(default_factory=lambda: {BLANK: 0, DUPLICATE: 0, TRUNCATED: 0, FINE: 0})
    illegal: int = 0

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if turn is not None:
            self.turns += turn != self.last_turn
            self.lowest = turn if self.lowest is None else self.lowest
            self.highest = self.last_turn = turn
        if self.rows:
            self.illegal += _illegal(self.rows[-1][0][:1], role[:1])
        self.counts[fault] += 1
        self.rows.append((role, text, fault))


def _illegal(one: str, two: str) -> bool:
    return one + two not in ("su", "ua", "au")


def _ways(rows: list[tuple[str, str, str]], state: int) -> Best:
    best = start(state)
    for role, _, fault in rows:
        best = after_row(best, role[:1], fault)
    return best


_PART = (
    "part int, conv_id {kind}, edge boolean, rows bigint, turns bigint, lowest bigint, highest bigint, first string, last string,"
    " blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string,"
    " ways array<struct<start:int,state:int,cost:bigint,audit:string>>"
)
_RESULT = (
    "conv_id {kind}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string,"
    " repaired_sha256 string"
)


def _parts(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row per conversation of a task's range; those at its ends also tell their best ways between all states."""
    number = TaskContext.get().partitionId()

    def summary(conv: object, part: Part, edge: bool) -> dict:
        cost, audit = finish(_ways(part.rows, 0))
        writer = Writer(audit)
        for role, text, _ in part.rows:
            writer.row(role, text)
        ways = None
        if edge:
            ways = [
                {"start": begin, "state": state, "cost": held[0], "audit": held[1].audit()}
                for begin in STATES
                for state, held in enumerate(_ways(part.rows, begin))
                if held is not None
            ]
        return {
            "part": number, "conv_id": conv, "edge": edge, "rows": len(part.rows), "turns": part.turns,
            "lowest": part.lowest, "highest": part.highest, "first": part.rows[0][0][:1], "last": part.rows[-1][0][:1],
            **{name: part.counts[name] for name in (BLANK, DUPLICATE, TRUNCATED)}, "illegal": part.illegal,
            "cost": cost, "audit": audit, "repaired_sha256": writer.end(), "ways": ways,
        }

    current, part, first, done = None, None, True, []
    for batch in batches:
        for row in batch.to_pylist():
            if part is None or row["conv_id"] != current:
                if part is not None:
                    done.append(summary(current, part, first))
                    first = False
                current, part = row["conv_id"], Part()
            part.add(row["turn"], row["role"], row["text"], row["fault"])
            for _ in range(row["copies"] - 1):
                # Copies of a row follow it; only a blank one is not a duplicate by that.
                part.add(row["turn"], row["role"], row["text"], BLANK if row["fault"] == BLANK else DUPLICATE)
            if len(done) >= 1000:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
    if part is not None:
        done.append(summary(current, part, True))
    yield pa.RecordBatch.from_pylist(done, schema)


def _joined(table: pa.Table, schema: pa.Schema) -> pa.Table:
    """The parts of one conversation put together, in the order of their ranges."""
    parts = sorted(table.to_pylist(), key=lambda part: part["part"])
    row = parts[0]
    if len(parts) > 1:
        best: dict[int, tuple[int, str]] = {0: (0, "")}
        turns = illegal = 0
        for before, one in zip([None, *parts], parts):
            then: dict[int, tuple[int, str]] = {}
            for way in one["ways"]:
                if way["start"] in best:
                    cost, audit = best[way["start"]]
                    found = (cost + way["cost"], audit + way["audit"])
                    then[way["state"]] = min(found, then.get(way["state"], found))
            best = then
            # Two rows, or one turn, may lie on both sides of a border.
            illegal += one["illegal"] + (before is not None and _illegal(before["last"], one["first"]))
            turns += one["turns"]
            if before is not None and one["lowest"] is not None:
                turns -= before["highest"] == one["lowest"]
        cost, audit = min(best[state] for state in DONE if state in best)
        days = [part for part in parts if part["lowest"] is not None]
        row |= {
            "turns": turns, "illegal": illegal, "cost": cost, "audit": audit, "repaired_sha256": None,
            "lowest": days[0]["lowest"] if days else None, "highest": days[-1]["highest"] if days else None,
            **{name: sum(part[name] for part in parts) for name in (BLANK, DUPLICATE, TRUNCATED)},
        }
    row["gaps"] = 0 if row["lowest"] is None else row["highest"] - row["lowest"] + 1 - row["turns"]
    return pa.Table.from_pylist([{name: row[name] for name in schema.names}], schema)


def _written(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Digest of each conversation; its audit comes as the first of its rows."""
    current, writer, done = None, None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["audit"] is not None:
                if writer is not None:
                    done.append({"conv_id": current, "repaired_sha256": writer.end()})
                current, writer = row["conv_id"], Writer(row["audit"])
            else:
                for _ in range(row["copies"]):
                    writer.row(row["role"], row["text"])
    if writer is not None:
        done.append({"conv_id": current, "repaired_sha256": writer.end()})
    yield pa.RecordBatch.from_pylist(done, schema)


def faults(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies, fault): equal rows once with their number, and the first fault of each."""
    counted = turns.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    digest = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    marked = counted.withColumn("digest", F.unhex(digest))
    said = marked.groupBy("conv_id", "digest").agg(
        F.min("turn").alias("first_turn"), F.bool_or(F.col("turn").isNull()).alias("without"), F.count(F.lit(1)).alias("times")
    )
    again = said.filter("times > 1").select(
        F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest"), "first_turn", "without"
    )
    rows = marked.join(again, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest")), "left")
    seen = F.col("turn").isNotNull() & (F.col("without") | (F.col("turn") > F.col("first_turn")))
    fault = (
        F.when(~F.col("text").rlike(_SOLID), BLANK)
        .when(F.coalesce(seen, F.lit(False)), DUPLICATE)
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), TRUNCATED)
        .otherwise(FINE)
    )
    return rows.select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"))


def repair(turns: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of (conv_id, turn, role, text)."""
    rows = faults(
        turns.select(
            "conv_id",
            F.col("turn").cast("bigint").alias("turn"),
            F.coalesce("role", F.lit(" ")).alias("role"),
            F.coalesce("text", F.lit(" ")).alias("text"),
        )
    )
    rows = stored(rows, "turns")
    kind = rows.schema["conv_id"].dataType.simpleString()
    order = ["conv_id", "turn", "role", "text"]
    part_schema, result_schema = _PART.format(kind=kind), _RESULT.format(kind=kind)
    part_arrow, result_arrow = (_arrow(rows.sparkSession, ddl) for ddl in (part_schema, result_schema))
    # Beginnings of role and text only, so that the ranges are found on short values.
    ranged = rows.repartitionByRange("conv_id", "turn", F.substring("role", 1, 32), F.substring("text", 1, 64))
    parts = stored(
        ranged.sortWithinPartitions(*order).mapInArrow(lambda batches: _parts(batches, part_arrow), part_schema), "parts"
    )
    gaps = F.coalesce(F.col("highest") - F.col("lowest") + 1 - F.col("turns"), F.lit(0))
    names = [name.split()[0] for name in result_schema.split(", ")]
    inner = parts.filter("NOT edge").withColumn("gaps", gaps).select(*names)
    # At most two conversations a task.
    edges = stored(
        parts.filter("edge").groupBy("conv_id").applyInArrow(
            lambda table: _joined(table, result_arrow), result_schema
        ),
        "edges",
    )
    whole = edges.filter("repaired_sha256 IS NOT NULL")
    several = edges.filter("repaired_sha256 IS NULL").drop("repaired_sha256")
    # The audit goes ahead of its conversation's rows.
    theirs = rows.withColumn("audit", F.lit(None).cast("string")).join(
        several.select(F.col("conv_id").alias("_conv")), F.col("conv_id").eqNullSafe(F.col("_conv")), "left_semi"
    )
    told = several.select("conv_id", "audit").unionByName(theirs.drop("fault"), allowMissingColumns=True)
    digest_schema = f"conv_id {kind}, repaired_sha256 string"
    digest_arrow = _arrow(rows.sparkSession, digest_schema)
    digests = (
        told.repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("audit").isNull(), "turn", "role", "text")
        .mapInArrow(lambda batches: _written(batches, digest_arrow), digest_schema)
        .withColumnRenamed("conv_id", "_conv")
    )
    finished = several.join(digests, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(*names)
    return inner.unionByName(whole.select(*names)).unionByName(finished)


def empty(repaired: DataFrame, conversations: DataFrame) -> DataFrame:
    """``repaired`` with a row for each conversation that has no rows left: zeros, an empty audit, an empty text's digest."""
    ids = conversations.select(F.col("conv_id").alias("_conv")).distinct()
    joined = ids.join(repaired, F.col("_conv").eqNullSafe(F.col("conv_id")), "left")
    nothing = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    return joined.select(
        F.col("_conv").alias("conv_id"),
        *(F.coalesce(name, nothing.get(name, F.lit(0))).alias(name) for name in repaired.columns if name != "conv_id"),
    )


def _arrow(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)
