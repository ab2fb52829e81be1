"""Conversation structure repair: the cheapest edits that make a conversation alternate.

A conversation should be an optional system turn and then user and assistant turns in
alternation, user first and assistant last: ``(s?(ua)+)?`` in role initials. Rows are dealt
out by conversation and sorted by turn, and one streaming pass carries a dynamic program
over the four states of that pattern from Arrow batch to Arrow batch. What a state holds
does not grow: its cost, its rank among the four by edit letters, and the running hash of
the text it would leave. The way back is two bytes for each row, kept in memory for the
usual conversation and spilled by the task for giant ones, as its sort does.

Edits: Keep costs 0, Rerole to user or assistant 3, Delete 4, Insert of an empty user or
assistant turn 3; a blank or duplicate row must be deleted, and a truncated row that is not
costs 3 more. Among the cheapest the least string of edit letters wins.

Why a state may forget all but its least string: the least string never has an insert just
before a delete (the other order is less and does the same), so inserts stand right before
the kept row or at the end. Between rows all strings then end with the letter of the same
row, none begins with another, and their order no longer depends on what follows.

Defined cases: a null role or text counts as one blank; rows without a turn come first;
rows of one turn follow in order of role and text; rows without a conversation id are one
conversation whose id is null; a conversation with no rows left has zeros, no edits and the
hash of nothing; repeated rows are duplicates; an empty table gives an empty result; other
columns are not read. Memory beyond the spill: one text at a time, and a conversation's
edit letters, which are one value of the result.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlight.llm.common import BLANKS

START, SYSTEM, USER, ASSISTANT = range(4)
MACROS = ("D", "IK", "IR", "K", "R")
KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
SPILL_BYTES = 1 << 20

REPORT = (
    "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


def _moves(initial: str) -> list[tuple[int, int, int, int, str | None, str | None]]:
    """Ways to leave a row in: from, to, letters, cost, inserted role, new role."""
    out = []
    if initial == "s":
        out.append((START, SYSTEM, MACROS.index("K"), KEEP, None, None))
    for role, to, ready in (
        ("user", USER, (START, SYSTEM, ASSISTANT)),
        ("assistant", ASSISTANT, (USER,)),
    ):
        for at in range(4):
            first, extra = ("", 0) if at in ready else ("I", INSERT)
            filler = None if at in ready else ("assistant" if role == "user" else "user")
            if initial == role[0]:
                out.append((at, to, MACROS.index(first + "K"), KEEP + extra, filler, None))
            out.append((at, to, MACROS.index(first + "R"), REROLE + extra, filler, role))
    return out


MOVES = {c: _moves(c) for c in ("s", "u", "a", "")}
#: What each state needs at the end: letters, cost, inserted lines.
CLOSING = {
    START: ("", 0, ()),
    ASSISTANT: ("", 0, ()),
    USER: ("I", INSERT, ("assistant:",)),
    SYSTEM: ("II", 2 * INSERT, ("user:", "assistant:")),
}
LEGAL = ("su", "ua", "au")


class _Conversation:
    """The running state of one conversation."""

    def __init__(self, conv: str | None):
        self.conv = conv
        self.best = {START: (0, 0, hashlib.sha256())}  # cost, rank, hash of what is left
        self.back = tempfile.SpooledTemporaryFile(max_size=SPILL_BYTES)
        self.held = bytearray()
        self.rows = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.turns, self.least, self.last = 0, None, None
        self.illegal, self.initial = 0, None

    def take(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if turn is not None and turn != self.last:
            self.turns += 1
            self.least = turn if self.least is None else self.least
            self.last = turn
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        if fault:
            self.faults[fault] += 1

        found = {q: (cost + DELETE, rank, 0, q, None, None) for q, (cost, rank, _) in self.best.items()}
        if fault not in ("blank", "duplicate"):
            extra = CUT if fault == "truncated" else 0
            for at, to, letters, price, filler, new in MOVES[initial if initial in MOVES else ""]:
                if at in self.best:
                    cost, rank, _ = self.best[at]
                    way = (cost + price + extra, rank, letters, at, filler, new)
                    if to not in found or way[:3] < found[to][:3]:
                        found[to] = way
        order = {q: r for r, q in enumerate(sorted(found, key=lambda q: found[q][1:3]))}
        before, after, packed = self.best, {}, 0
        for q, (cost, _, letters, at, filler, new) in found.items():
            left = before[at][2]
            if letters:
                left = left.copy()
                lines = [f"{filler}:"] * bool(filler) + [f"{new or role}:{text}"]
                left.update(("\n" * (at != START) + "\n".join(lines)).encode())
            after[q] = (cost, order[q], left)
            if q:
                packed |= (at * len(MACROS) + letters) << (5 * (q - 1))
        self.best = after
        self.held += packed.to_bytes(2, "little")
        self.rows += 1
        if len(self.held) >= 4096:
            self.back.write(self.held)
            self.held = bytearray()

    def audit(self, state: int, closing: str) -> str:
        """The edit letters, read back from the last row to the first."""
        self.back.write(self.held)
        letters, left = [closing], self.rows
        while left:
            size = min(left, 1 << 15)
            self.back.seek(2 * (left - size))
            for packed in np.frombuffer(self.back.read(2 * size), "<u2")[::-1].tolist():
                way = packed >> (5 * (state - 1)) & 31 if state else 0
                state, macro = divmod(way, len(MACROS))
                letters.append(MACROS[macro])
            left -= size
        self.back.close()
        return "".join(reversed(letters))

    def report(self) -> tuple:
        ends = {
            q: (cost + CLOSING[q][1], rank, CLOSING[q][0]) for q, (cost, rank, _) in self.best.items()
        }
        state = min(ends, key=ends.get)
        digest = self.best[state][2].copy()
        for k, line in enumerate(CLOSING[state][2]):
            digest.update(("\n" * (state != START or k > 0) + line).encode())
        gaps = 0 if self.least is None else self.last - self.least + 1 - self.turns
        return (
            self.conv, gaps, self.faults["blank"], self.faults["duplicate"], self.faults["truncated"],
            self.illegal, ends[state][0], self.audit(state, CLOSING[state][0]), digest.hexdigest(),
        )


def _reports(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [part.split()[0] for part in REPORT.split(", ")]
    now, done = None, []
    for batch in batches:
        columns = (batch[c] for c in ("conv", "turn", "has_turn", "role", "text", "fault", "copies"))
        for conv, turn, has_turn, role, text, fault, copies in zip(*columns, strict=True):
            if now is None or conv != now.conv:
                if now is not None:
                    done.append(now.report())
                now = _Conversation(conv)
            for k in range(copies):
                again = k > 0 and fault != "blank"
                now.take(turn if has_turn else None, role, text, "duplicate" if again else fault)
        if len(done) >= 1000:
            yield pd.DataFrame(done, columns=names)
            done = []
    if now is not None:
        done.append(now.report())
    if done:
        yield pd.DataFrame(done, columns=names)


def _fault(text: Column, duplicate: Column) -> Column:
    ends = F.substring(F.rtrim(text, F.lit(BLANKS)), -1, 1)
    return (
        F.when(ends == "", "blank")
        .when(duplicate, "duplicate")
        .when(~ends.isin(".", "!", "?"), "truncated")
        .otherwise("")
    )


def in_order(rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Rows dealt out by conversation and sorted by turn, each with its fault.

    ``rows`` has the conversation id, ``turn``, ``role``, ``text`` and perhaps ``copies``, the
    number of times that the row stands there (0: it does not). Equal rows of a conversation
    are found by a sort of the same partitions, so there is one exchange and no set in memory.
    """
    copies = F.col("copies").cast("int") if "copies" in rows.columns else F.lit(1)
    named = rows.select(
        F.col(conv).cast("string").alias("conv"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        F.col("turn").isNotNull().alias("has_turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        copies.alias("copies"),
    ).repartition("conv")
    equal = W.partitionBy("conv", F.col("copies") > 0, "role", "text").orderBy("has_turn", "turn")
    return (
        named.withColumn("_nth", F.row_number().over(equal))
        .withColumn("fault", _fault(F.col("text"), F.col("_nth") > 1))
        .drop("_nth")
        .sortWithinPartitions("conv", "has_turn", "turn", "role", "text")
    )


def repair(rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row for each conversation: gaps, faults, the cost and letters of the edits, and the
    hash of what they leave."""
    kind = rows.schema[conv].dataType
    found = in_order(rows, conv).mapInPandas(_reports, REPORT)
    return found.select(F.col("conv").cast(kind).alias(conv), *[c for c in found.columns if c != "conv"])


def _applied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Streams each conversation's letters, then its rows, and gives the turns that are left."""
    conv, audit, at, place, last = None, "", 0, 0, ""
    for batch in batches:
        done = []

        def emit(role: str, text: str, edit: str) -> None:
            nonlocal place, last
            done.append((conv, place, role, text, edit))  # noqa: B023
            place, last = place + 1, role[:1]

        def inserts() -> None:
            nonlocal at
            while audit[at : at + 1] == "I":
                emit("assistant" if last == "u" else "user", "", "I")
                at += 1

        columns = (batch[c] for c in ("conv", "role", "text", "copies", "audit"))
        for this, role, text, copies, letters in zip(*columns, strict=True):
            if letters is not None:
                conv, audit, at, place, last = this, letters, 0, 0, ""
                if not audit.strip("I"):
                    inserts()
                continue
            for _ in range(copies):
                inserts()
                edit, at = audit[at], at + 1
                if edit == "K":
                    emit(role, text, edit)
                elif edit == "R":
                    emit("assistant" if last == "u" else "user", text, edit)
                if at == len(audit.rstrip("I")):
                    inserts()
        if done:
            yield pd.DataFrame(done, columns=["conv", "place", "role", "text", "edit"])


def repaired(rows: DataFrame, reports: DataFrame, conv: str = "conv_id") -> DataFrame:
    """The turns that the edits leave: conversation, place from 0, role, text and edit letter.

    ``reports`` is what ``repair`` gave for the same rows. The letters travel as one row before
    their conversation, so nothing is held but them.
    """
    kind = rows.schema[conv].dataType
    turns = in_order(rows, conv).select("*", F.lit(None).cast("string").alias("audit"))
    heads = reports.select(F.col(conv).cast("string").alias("conv"), "audit")
    streamed = (
        turns.unionByName(heads, allowMissingColumns=True)
        .repartition("conv")
        .sortWithinPartitions("conv", F.col("audit").isNull(), "has_turn", "turn", "role", "text")
        .select("conv", "role", "text", F.coalesce("copies", F.lit(0)).alias("copies"), "audit")
    )
    found = streamed.mapInPandas(
        _applied, "conv string, place long, role string, text string, edit string"
    )
    return found.select(F.col("conv").cast(kind).alias(conv), "place", "role", "text", "edit")


def damage(rows: DataFrame) -> DataFrame:
    """Conversation rows with faults put in by a hash of id and turn: of 20 values 0 drops the
    row, 1 empties its text, 2 takes its ``.!?`` out, 3 repeats it, 4 makes it the user's."""

    def known(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20
    text = F.when(code == 1, "").when(code == 2, F.translate(known("text"), ".!?", "")).otherwise(known("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(code == 4, "user").otherwise(known("role")).alias("role"),
        text.alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("copies"),
    )
