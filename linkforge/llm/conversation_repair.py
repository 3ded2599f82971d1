"""Conversation structure repair (operator 12): generalised LR repair.

The rows of a conversation, in the order of their turns (null first, then role
and text), are read by the automaton of a role grammar (``role_grammar``):
``(s?(ua)+)?`` over the roles' first letters. Rows may be kept (K, cost 0),
given the role user or assistant (R, 3) or deleted (D, 4); empty rows of these
roles may be inserted (I, 3). A row without a character other than white space
(blank) or with the role and text of an earlier row (duplicate) must be
deleted; a truncated one, whose last such character isn't `.`, `!` or `?`,
costs 3 more unless it is deleted. Of the cheapest repairs the one whose edit
letters come first stays. In the order of the sort, rows that agree in all
columns stand together.

Scale: one shuffle, by conversation; finding duplicates and the order are two
sorts of the same partitions, which spill. A task then reads its rows as a
stream: it holds the open rows of one conversation (see ``role_grammar``) and
one running hash, however long the conversation is. A conversation is read by
one task, since its audit and its hash are one string and one SHA-256 over all
its rows in order; conversations are dealt out by hash.

Edge cases: null roles and texts are one space (so such a text is blank, and
such a role can't be kept); null turns come first and don't count as gaps; a
null conversation is one of its own. Repeated rows are duplicates. Rows with
``gone`` true name their conversation and nothing else. Extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CHARS
from .role_grammar import DELETE, RULES, Costs, Repair, RoleGrammar

ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
END_MARKS = ".!?"
BATCH_ROWS = 10_000
REPORT = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
          "audit string, repaired_sha256 string")
EDITS = "step bigint, edit string, turn bigint, role string, text string"


def _space(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: the rows after a fixed damage that
    crc32 of `conv_id:turn` deals out; rows it drops are ``gone``."""
    key = F.concat(_space("conv_id"), F.lit(":"), _space("turn"))
    dealt = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), _space("role").alias("role"), _space("text").alias("text"),
                        (F.crc32(F.encode(key, "UTF-8")) % 20).alias("spot"))
    text = (F.when(F.col("spot") == 1, "").when(F.col("spot") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    copies = F.when(F.col("spot") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return dealt.select("conv_id", "turn", F.when(F.col("spot") == 4, "user").otherwise(F.col("role")).alias("role"),
                        text.alias("text"), (F.col("spot") == 0).alias("gone"), F.explode(copies).alias("copy")).drop("copy")


def _marked(rows: DataFrame) -> DataFrame:
    """Rows in order within a conversation's partition, with their faults."""
    gone = F.col("gone") if "gone" in rows.columns else F.lit(False)
    named = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), _space("role").alias("role"), _space("text").alias("text"),
                        gone.alias("gone")).repartition("conv_id")
    same = Window.partitionBy("conv_id", "role", F.sha2("text", 256), "gone").orderBy(F.col("turn").asc_nulls_first())
    tail = F.right(F.rtrim("text", F.lit(SPACE_CHARS)), F.lit(1))
    fault = (F.when(tail == "", "blank").when(F.row_number().over(same) > 1, "duplicate")
              .when(~tail.isin(*END_MARKS), "truncated"))
    return (named.withColumn("fault", fault)
                 .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text"))


class _Conversation:
    """What is counted while a conversation's rows go by."""

    def __init__(self, conv_id: object, grammar: RoleGrammar):
        self.conv_id, self.repair, self.hash = conv_id, Repair(grammar), hashlib.sha256()
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.first_turn = self.last_turn = None
        self.turns = self.illegal = self.steps = 0
        self.before: str | None = None
        self.audit: list[str] = []
        self.started = False

    def read(self, turn: int | None, role: str, text: str, fault: str | None) -> Iterator[tuple]:
        if turn is not None:
            self.turns += turn != self.last_turn
            self.first_turn, self.last_turn = turn if self.first_turn is None else self.first_turn, turn
        self.illegal += self.before is not None and self.before + role[:1] not in LEGAL
        self.before = role[:1]
        if fault:
            self.faults[fault] += 1
        yield from self._told(self.repair.read((turn, role, text), role[:1], fault in ("blank", "duplicate"), fault == "truncated"))

    def finish(self) -> Iterator[tuple]:
        yield from self._told(self.repair.finish())

    def _told(self, edits: Iterator[tuple]) -> Iterator[tuple]:
        """(step, edit, turn, role, text) of each edit; deleted rows as they were."""
        for letter, role, row in edits:
            turn, was, text = row or (None, None, "")
            role = ROLES[role] if role else was
            if letter != DELETE:
                self.hash.update((("\n" if self.started else "") + role + ":").encode())
                self.hash.update(text.encode())
                self.started = True
            self.audit.append(letter)
            self.steps += 1
            yield self.steps, letter, turn, role, text

    def report(self) -> tuple:
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return gaps, *self.faults.values(), self.illegal, self.repair.cost, "".join(self.audit), self.hash.hexdigest()


def _stream(batches: Iterator[pa.RecordBatch], grammar: RoleGrammar) -> Iterator[tuple[_Conversation, tuple | None]]:
    """(conversation, edit) in order, and (conversation, None) at its end."""
    now: _Conversation | None = None
    for batch in batches:
        ids = batch.column(0).to_pylist()
        turns, faults, gone = (batch.column(i).to_pylist() for i in (1, 4, 5))
        for k, conv_id in enumerate(ids):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    yield from ((now, e) for e in now.finish())
                    yield now, None
                now = _Conversation(conv_id, grammar)
            if not gone[k]:
                read = now.read(turns[k], batch.column(2)[k].as_py(), batch.column(3)[k].as_py(), faults[k])
                yield from ((now, e) for e in read)
    if now is not None:
        yield from ((now, e) for e in now.finish())
        yield now, None


def _run(rows: DataFrame, types: str, per_conversation: bool, rules: tuple, costs: Costs) -> DataFrame:
    marked = _marked(rows).select("conv_id", "turn", "role", "text", "fault", "gone")
    kind = marked.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", *(part.split()[0] for part in types.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = RoleGrammar(rules, "".join(ROLES), costs)
        out: list[tuple] = []
        arrow = [pa.int64() if "bigint" in part else pa.string() for part in types.split(", ")]
        id_type = None

        def block() -> pa.RecordBatch:
            columns = list(zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], id_type)] + [pa.array(c, t) for c, t in zip(columns[1:], arrow)], names=names)

        def watched() -> Iterator[pa.RecordBatch]:
            nonlocal id_type
            for b in batches:
                id_type = b.schema.field(0).type
                yield b

        size = 0
        for conversation, edit in _stream(watched(), grammar):
            if (edit is None) == per_conversation:
                row = (conversation.conv_id, *(conversation.report() if edit is None else edit))
                out.append(row)
                size += sum(len(x) for x in row if isinstance(x, str))
                if len(out) >= BATCH_ROWS or size > 4 << 20:
                    yield block()
                    out, size = [], 0
        if out:
            yield block()

    return marked.mapInArrow(run, f"conv_id {kind}, {types}")


def repair_report(rows: DataFrame, rules: tuple = RULES, costs: Costs = Costs()) -> DataFrame:
    """One row per conversation: gaps between turns, faults of its rows,
    adjacent roles that may not follow one another, and the cheapest repair's
    cost, edit letters and SHA-256 of the repaired `role:text` lines."""
    return _run(rows, REPORT, True, rules, costs)


def repaired_rows(rows: DataFrame, rules: tuple = RULES, costs: Costs = Costs()) -> DataFrame:
    """conv_id, step (from 1), edit, turn, role, text: every edit of the
    cheapest repair in order; without those of edit D the repaired rows."""
    return _run(rows, EDITS, False, rules, costs)
