"""Repair of conversation structure by the cheapest edits, over rows sorted by turn.

A sound conversation is empty, or an optional system row and then pairs of a
user's and an assistant's row: four states. The cheapest edits follow from the
costs of what is still to come, so rows of a conversation are streamed twice in
one task's sorted order: from the last turn to the first, carrying four costs
from one Arrow batch to the next and leaving a byte in each row (the first edit
of the cheapest end from each state: a backpointer of two bits); and, after
Spark has sorted the rows the other way, from the first to the last, following
those bytes. Conversations of any length so need four numbers and a state in
memory, and a letter of the audit for each edit; the sorts and their spilling
are Spark's, the bytes are spilled with the rows.

Rows are shuffled once, by conversation. One conversation is one task's work, as
its hash needs its rows in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.words import SPACES

KEEP, REROLE, DELETE, INSERT, TRUNCATED_COST = 0, 2, 3, 2, 1
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
EDITS = "DIKR"  # in the order of their letters, which settles ties
# States: nothing yet, after the system row, after a user's, after an assistant's.
ROLES = ("", "system", "user", "assistant")
ENDS = (0, 3)
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
NEXT = (2, 2, 3, 2)  # state after a row of the one role that edits may put there
NEVER = 1 << 60
REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def faulty_turns(turns: DataFrame) -> DataFrame:
    """Rows of `turns` with their place in the conversation, from 1, and first fault.

    Columns: conv_id, turn, role, text, place, fault, all rows of a conversation
    in one partition. Order is by turn (nulls first), then role and text. A null
    role or text is one space; a null conv_id is a conversation of its own.
    """
    text = F.coalesce(F.col("`text`"), F.lit(" ")).alias("text")
    role = F.coalesce(F.col("`role`"), F.lit(" ")).alias("role")
    rows = turns.select(F.col("`conv_id`").alias("conv_id"), F.col("`turn`").alias("turn"), role, text).repartition("conv_id")
    ended = F.rtrim(F.col("text"), F.lit(SPACES))
    # Both windows are local: rows are dealt by conversation already.
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("place")) > 1
    fault = (
        F.when(ended == "", BLANK).when(again, DUPLICATE)
        .when(~F.substring(ended, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(SOUND)
    )
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    return rows.withColumn("place", place).withColumn("fault", fault)


def end_costs() -> list[int]:
    """Cost to end from each state after the last row."""
    costs = [0 if s in ENDS else NEVER for s in range(4)]
    for _ in range(2):
        costs = [min(c, INSERT + costs[NEXT[s]]) for s, c in enumerate(costs)]
    return costs


def step_back(costs: list[int], initial: str, fault: int) -> tuple[list[int], int]:
    """Costs from each state before a row, given those after it, and the packed first edits."""
    extra = TRUNCATED_COST if fault == TRUNCATED else 0
    stays = fault not in (BLANK, DUPLICATE)
    options = []
    for s in range(4):
        kept = KEPT.get((s, initial)) if stays else None
        options.append([
            DELETE + costs[s], NEVER, NEVER if kept is None else KEEP + extra + costs[kept],
            REROLE + extra + costs[NEXT[s]] if stays else NEVER,
        ])
    least = [min(o) for o in options]
    for _ in range(2):
        least = [min(c, INSERT + least[NEXT[s]]) for s, c in enumerate(least)]
    packed = 0
    for s in range(4):
        options[s][1] = INSERT + least[NEXT[s]]
        packed |= options[s].index(least[s]) << 2 * s
    return least, packed


def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the byte of first edits; rows come by conversation, last place first."""
    now, costs = object(), end_costs()
    for rows in batches:
        out = []
        for conv, role, fault in zip(rows["conv_id"].to_pylist(), rows["role"].to_pylist(), rows["fault"].to_pylist()):
            if conv != now:
                now, costs = conv, end_costs()
            costs, packed = step_back(costs, role[:1], fault)
            out.append(packed)
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(out, pa.int16())], [*rows.schema.names, "edits"])


def _planned(turns: DataFrame) -> DataFrame:
    rows = faulty_turns(turns).select("conv_id", "turn", "role", "text", "place", "fault")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    backwards = rows.sortWithinPartitions("conv_id", F.desc("place")).mapInArrow(_plan, f"{kinds}, edits short")
    return backwards.sortWithinPartitions("conv_id", "place")


def edits_at(state: int, packed: int | None) -> tuple[list[tuple[str, int]], int]:
    """Edits up to and with the next row (None: the end): letter and state after each; and the last state."""
    made = []
    while state not in ENDS if packed is None else True:
        letter = "I" if packed is None else EDITS[packed >> 2 * state & 3]
        if letter == "I":
            state = NEXT[state]
            made.append((letter, state))
            continue
        return made + [(letter, state)], state
    return made, state


class _Walk:
    """One conversation from its first row on."""

    def __init__(self, conv) -> None:
        self.conv, self.state, self.audit, self.cost = conv, 0, bytearray(), 0
        self.counts, self.illegal, self.before = [0] * 4, 0, None
        self.first = self.last = None
        self.distinct = 0
        self.digest, self.lines = hashlib.sha256(), 0

    def turn(self, turn, role: str, text: str, fault: int, packed: int) -> list[tuple[str, str | None, str]]:
        """Take in a row; the (edit, role, text) it leads to, with role None for a deleted row."""
        self.counts[fault] += 1
        if self.before is not None:
            self.illegal += self.before + role[:1] not in ("su", "ua", "au")
        self.before = role[:1]
        if turn is not None and turn != self.last:
            self.distinct += 1
            self.first, self.last = turn if self.first is None else self.first, turn
        made, _ = edits_at(self.state, packed)
        out = []
        for letter, after in made:
            if letter == "I":
                out.append((letter, ROLES[after], ""))
                self.state = after
            elif letter == "D":
                out.append((letter, None, text))
                self.cost += DELETE
            else:
                self.state = KEPT[self.state, role[:1]] if letter == "K" else NEXT[self.state]
                out.append((letter, role if letter == "K" else ROLES[self.state], text))
                self.cost += (KEEP if letter == "K" else REROLE) + (TRUNCATED_COST if fault == TRUNCATED else 0)
        return self._noted(out)

    def end(self) -> list[tuple[str, str | None, str]]:
        made, self.state = edits_at(self.state, None)
        return self._noted([(letter, ROLES[after], "") for letter, after in made])

    def _noted(self, out: list) -> list:
        for letter, role, text in out:
            self.audit += letter.encode()
            self.cost += INSERT if letter == "I" else 0
            if role is not None:
                self.digest.update((b"\n" if self.lines else b"") + f"{role}:{text}".encode())
                self.lines += 1
        return out

    def report(self) -> tuple:
        gaps = self.last - self.first + 1 - self.distinct if self.distinct else 0
        return (self.conv, gaps, self.counts[BLANK], self.counts[DUPLICATE], self.counts[TRUNCATED], self.illegal, self.cost, self.audit.decode(), self.digest.hexdigest())


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Walk, bool, list[tuple[str, str | None, str]]]]:
    """Per row, and at the end of each conversation: the walk, whether it ended, and the edits made."""
    walk = None
    for rows in batches:
        columns = [rows[n].to_pylist() for n in ("conv_id", "turn", "role", "text", "fault", "edits")]
        for conv, *row in zip(*columns):
            if walk is None or conv != walk.conv:
                if walk is not None:
                    yield walk, True, walk.end()
                walk = _Walk(conv)
            yield walk, False, walk.turn(*row)
    if walk is not None:
        yield walk, True, walk.end()


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of rows with about `most` bytes of text."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(v) for v in row if isinstance(v, str))
        if size > most:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), schema.types)], schema.names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), schema.types)], schema.names)


def _arrow(df: DataFrame, columns: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    from pyspark.sql.pandas.types import to_arrow_type

    first = pa.field("conv_id", to_arrow_type(df.schema["conv_id"].dataType))
    return pa.schema([first, *[pa.field(n, kinds[k]) for n, k in (c.split() for c in columns.split(", "))]])


def repair_report(turns: DataFrame) -> DataFrame:
    """Per conversation of `turns` (conv_id, turn, role, text): faults, the cheapest edits, and a hash of the repaired rows.

    blank, duplicate and truncated count rows by their first fault; gaps are
    turns left out between the least and the greatest; illegal counts neighbours
    that may not follow each other. audit has a letter for each edit in order:
    Keep (0), Rerole (2), Delete (3, and all that blank and duplicate rows get),
    Insert an empty row (2); a truncated row that stays costs 1 more. Of equally
    cheap edits those with the least letters. Turns are whole numbers; null turns
    come first and count in no gap; equal turns go by role and text; rows that
    repeat are duplicates; an empty table gives no rows; other columns are left out.
    """
    rows = _planned(turns)
    schema = _arrow(rows, REPORT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((walk.report() for walk, ended, _ in _walks(batches) if ended), schema)

    return rows.mapInArrow(run, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {REPORT}")


def repaired_turns(turns: DataFrame) -> DataFrame:
    """Rows of the repaired conversations: conv_id, place (from 1), role, text, edit (K, R or I). See `repair_report`."""
    rows = _planned(turns)
    columns = "place long, role string, text string, edit string"
    schema = _arrow(rows, columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            place, last = 0, None
            for walk, _, made in _walks(batches):
                place, last = (place, walk) if walk is last else (0, walk)
                for letter, role, text in made:
                    if role is not None:
                        place += 1
                        yield walk.conv, place, role, text, letter

        yield from _batches(found(), schema)

    return rows.mapInArrow(run, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {columns}")


def with_every_conversation(report: DataFrame, ids: DataFrame) -> DataFrame:
    """The report with a row for every conv_id of `ids`: one without rows has zeros, no edits, and the hash of nothing."""
    every = ids.select(F.col("`conv_id`").alias("_every")).distinct()
    empty: dict[str, Column] = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    joined = every.join(report, F.col("_every").eqNullSafe(F.col("conv_id")), "left")
    names = [c for c in report.columns if c != "conv_id"]
    return joined.select(F.col("_every").alias("conv_id"), *[F.coalesce(n, empty.get(n, F.lit(0).cast("long"))).alias(n) for n in names])
