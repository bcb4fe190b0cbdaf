"""Operator 11: conversation structure repair as a secondary-sorted stream.

Rows are repartitioned by conversation and sorted by turn; a task reads its
conversations as Arrow batches and carries, across batches, one small table
of the repair plan (``turn_plan``) and the counters. A row's memory is four
bytes of back pointers. Up to ``PART_ROWS`` rows or ``PART_BYTES`` of text a
conversation is finished where it is. A longer one leaves the task in parts,
each with its packed back pointers and rows, written to the shared folder;
then

* a stream over its parts from last to first walks the pointers back and
  says each part's edits and the state it begins in;
* parts meet their edits by (conversation, part), so a giant's parts are
  spread over tasks, and are repaired there;
* a stream in order takes the digest over the repaired rows.

No step holds more than a part in memory, whatever a conversation's length
(the edits of a conversation, a letter a row, are one string by contract).
That a text was seen before is found by a window over (conversation, role,
text) that uses the same shuffle and sorts outside memory.

Defined results: a null role or text is one blank; null conversations are
one conversation; null turns come first; rows of one turn are ordered by
role, then text; equal rows are duplicates after the first; an empty role has
no initial, so such a row never stays as it is; texts of any length are read
whole; a conversation of only ``absent`` rows gets zeros, no edits and the
digest of the empty text; an empty table gives no rows; ``gaps`` beyond 64
bits wraps; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from shoplens.config import store
from shoplens.llm.turn_plan import GONE, SOUND, START, TRUNCATED, TurnPlan, apply_edits, walk_back

#: Rows and characters of a conversation that a task holds at a time.
PART_ROWS = 50_000
PART_BYTES = 16 << 20

#: White space of the contract: space, tab, LF, VT, FF, CR.
BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
_LEGAL = {"su", "ua", "au"}
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_ROW = (", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string, "
        "turns array<struct<role: string, text: string>>")
_FIRST = "part int, back binary, state int, tail int, " + _ROW
_DONE = "part int, " + _ROW


def damage(conversations: DataFrame) -> DataFrame:
    """The rows with faults put in by ``crc32(conv_id:turn) % 20``.

    0 drops a row (it stays as ``absent``, naming its conversation), 1
    empties the text, 2 takes ``.!?`` out of it, 3 doubles the row, 4 makes
    the role user.
    """
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.encode(F.concat(named[0], F.lit(":"), named[1]), "UTF-8")) % 20
    text = F.coalesce("text", F.lit(" "))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"),
                                kind.alias("kind"))
    out = F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (rows.select("conv_id", "turn", role.alias("role"), out.alias("text"), (F.col("kind") == 0).alias("absent"),
                        F.explode(copies).alias("copy"))
            .drop("copy"))


def _ordered(conversations: DataFrame, absent: str | None) -> DataFrame:
    """(conv, turn, role, text, fault), a conversation's rows together and in order.

    Faults: 0 none, 1 blank, 2 duplicate, 3 truncated, 4 absent.
    """
    gone = F.coalesce(F.col(absent), F.lit(False)) if absent else F.lit(False)
    rows = conversations.select(F.col("conv_id").alias("conv"), F.col("turn").cast("bigint").alias("turn"),
                                F.coalesce("role", F.lit(" ")).alias("role"),
                                F.coalesce("text", F.lit(" ")).alias("text"), gone.alias("gone"))
    seen = Window.partitionBy("conv", "gone", "role", "text").orderBy(F.asc_nulls_first("turn"))
    bare: Column = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = (F.when(F.col("gone"), 4).when(bare == "", 1).when(F.col("copy") > 1, 2)
             .when(~F.right(bare, F.lit(1)).isin(*ENDS), 3).otherwise(0))
    return (rows.repartition("conv").withColumn("copy", F.row_number().over(seen))
            .sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "text", "copy")
            .select("conv", "turn", "role", "text", fault.cast("int").alias("fault")))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)],
                                      schema=schema)


def _arrow(kind: StructType) -> pa.Schema:
    return pa.schema([(f.name, to_arrow_type(f.dataType)) for f in kind])


def _pairs(rows: list[tuple[str, str]]) -> list[dict[str, str]]:
    return [{"role": r, "text": t} for r, t in rows]


class _Digest:
    """SHA-256 of ``role:text`` lines, fed in order."""

    def __init__(self) -> None:
        self.sha, self.any = hashlib.sha256(), False

    def feed(self, rows: list[tuple[str, str]]) -> None:
        if rows:
            self.sha.update(b"\n" * self.any + "\n".join(f"{r}:{t}" for r, t in rows).encode("utf-8"))
            self.any = True


class _Conversation:
    """Counters, plan and rows held of the conversation being read."""

    def __init__(self, conv: object) -> None:
        self.conv, self.parts, self.table, self.cost = conv, 0, START, 0
        self.low = self.high = self.turn = self.last = None
        self.turns = self.illegal = 0
        self.faults = [0] * 5
        self.hold()

    def hold(self) -> None:
        self.rows: list[tuple[str, str]] = []
        self.back, self.size = bytearray(), 0

    def add(self, plan: TurnPlan, turn: int | None, role: str, text: str, fault: int) -> None:
        self.faults[fault] += 1
        if fault == 4:
            return
        if turn is not None and turn != self.turn:
            self.turns += 1
            self.low, self.high, self.turn = (turn if self.low is None else self.low), turn, turn
        initial = role[:1]
        self.illegal += self.last is not None and self.last + initial not in _LEGAL
        self.last = initial
        self.table, grown, back = plan.step(self.table, initial, (SOUND, GONE, GONE, TRUNCATED)[fault])
        self.cost += grown
        self.back += back
        self.rows.append((role, text))
        self.size += len(text)

    def full(self, part_rows: int) -> bool:
        return len(self.rows) >= part_rows or self.size >= PART_BYTES

    def part(self) -> tuple:
        row = (self.conv, self.parts, bytes(self.back), None, None, *[None] * 8, _pairs(self.rows))
        self.parts += 1
        self.hold()
        return row

    def close(self, plan: TurnPlan) -> Iterator[tuple]:
        more, state, tail = plan.close(self.table)
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        counts = ((gaps + 2**63) % 2**64 - 2**63, *self.faults[1:4], self.illegal, self.cost + more)
        if self.parts:
            if self.rows:
                yield self.part()
            yield self.conv, self.parts, None, state, tail, *counts, None, None, None
            return
        edits = walk_back(bytes(self.back), state)[0] + "I" * tail
        digest, rows = _Digest(), apply_edits(edits, self.rows, 0)
        digest.feed(rows)
        yield self.conv, 0, None, None, None, *counts, edits, digest.sha.hexdigest(), _pairs(rows)


def _emit(found: Iterator[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    """Batches of about ``PART_BYTES``; ``size`` is the place of the turns in a row."""
    rows, held = [], 0
    for row in found:
        rows.append(row)
        held += 200 + sum(len(t["text"]) for t in row[size] or ())
        if held >= PART_BYTES or len(rows) >= 10_000:
            yield _batch(rows, schema)
            rows, held = [], 0
    if rows:
        yield _batch(rows, schema)


def _forward(schema: pa.Schema, part_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = TurnPlan()

        def found() -> Iterator[tuple]:
            now = None
            for batch in batches:
                for conv, turn, role, text, fault in zip(*[c.to_pylist() for c in batch.columns]):
                    if now is None or conv != now.conv:
                        if now is not None:
                            yield from now.close(plan)
                        now = _Conversation(conv)
                    now.add(plan, turn, role, text, fault)
                    if now.full(part_rows):
                        yield now.part()
            if now is not None:
                yield from now.close(plan)

        yield from _emit(found(), schema, len(schema) - 1)

    return run


def _backward(schema: pa.Schema):
    """(conv, part, edits, state before): parts come last to first, the closing row before them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = 0
        for batch in batches:
            out = []
            for conv, part, back, end, tail in zip(*[c.to_pylist() for c in batch.columns]):
                if end is not None:
                    state, edits = end, "I" * tail
                    out.append((conv, part, edits, end))
                else:
                    edits, state = walk_back(back, state)
                    out.append((conv, part, edits, state))
            yield _batch(out, schema)

    return run


def _finish(schema: pa.Schema):
    """Parts in order with their edits: repaired rows per part; the closing row gets all edits and the digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            digest, audit = _Digest(), []
            for batch in batches:
                n = len(_COUNTS)
                for conv, part, edits, before, *rest in zip(*[c.to_pylist() for c in batch.columns]):
                    counts, turns = rest[:n], rest[n]
                    rows = apply_edits(edits, [(t["role"], t["text"]) for t in turns or ()], before)
                    digest.feed(rows)
                    audit.append(edits)
                    if turns is None:
                        yield conv, part, *counts, "".join(audit), digest.sha.hexdigest(), _pairs(rows)
                        digest, audit = _Digest(), []
                    else:
                        yield conv, part, *counts, None, None, _pairs(rows)

        yield from _emit(found(), schema, len(schema) - 1)

    return run


def repair(conversations: DataFrame, absent: str | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """Repaired conversations, one row per (conv_id, part).

    ``turns`` holds a part's repaired rows. The last part, the only one of an
    ordinary conversation, also holds the counts (``gaps``, ``blank``,
    ``duplicate``, ``truncated``, ``illegal``, ``cost``), ``audit`` (the edits
    as a string of K, R, D, I) and ``repaired_sha256``; they are null in the
    parts before. ``absent`` names a boolean column of rows that are not
    there but whose conversation is to be returned.
    """
    key = StructField("conv", conversations.schema["conv_id"].dataType)

    def schema(columns: str) -> StructType:
        return StructType([key, *StructType.fromDDL(columns).fields])

    first, edits, done = schema(_FIRST), schema("part int, edits string, before int"), schema(_DONE)
    read = store(_ordered(conversations, absent).mapInArrow(_forward(_arrow(first), part_rows), first), "turn_parts")
    whole = read.filter("back IS NULL AND state IS NULL").select(*done.names)
    giant = read.filter("back IS NOT NULL OR state IS NOT NULL")
    said = (giant.select("conv", "part", "back", "state", "tail").repartition("conv")
            .sortWithinPartitions("conv", F.desc("part")).mapInArrow(_backward(_arrow(edits)), edits))
    said = said.select(F.col("conv").alias("e_conv"), F.col("part").alias("e_part"), "edits", "before")
    met = giant.join(said, F.col("conv").eqNullSafe(F.col("e_conv")) & (F.col("part") == F.col("e_part")))
    ended = (met.select("conv", "part", "edits", "before", *_COUNTS, "turns").repartition("conv")
             .sortWithinPartitions("conv", "part").mapInArrow(_finish(_arrow(done)), done))
    return whole.unionByName(ended).withColumnRenamed("conv", "conv_id")
