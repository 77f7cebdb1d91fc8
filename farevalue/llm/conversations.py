"""Repair of conversations: the cheapest edits that give a well-formed sequence of roles.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``. The repair
grammar has one nonterminal per pair of states of that language, ``[p, q]``, which stands
for all edited rows that lead from state p to state q; its rules ``[p, q] -> [p, r] [r, q]``
and ``[p, q] -> edit of one row`` are in Chomsky normal form. A cell holds the least
(cost, audit) of a span of rows for each nonterminal, and spans are combined bottom-up by
their length. Every parse can be split between any two rows, since some state holds there,
so one split a span finds the same minimum as all splits, and work grows with the rows.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farevalue.llm.common import WORD, slices

# The language of roles as states, the costs of edits, and the adjacent
# initials that are legal. State 0 is the start; 0 and 3 may end a conversation.
START, ENDS = 0, (0, 3)
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
STATES = range(4)
REROLE, DELETE, INSERT, UNFINISHED = 2, 3, 2, 1
LEGAL = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}
DAMAGES = 20

# Faults of a row; the first that holds counts.
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)

# Rows, and characters of text, that one span of cells covers at most.
SPAN_ROWS = 64
SPAN_CHARS = 1_000_000

Cells = dict[tuple[int, int], tuple[int, str]]


def damage(turns: DataFrame) -> DataFrame:
    """Planted faults, by a hash of conversation and turn: ``conv_id, turn, role, text, there``.

    A null role or text becomes one space, and so does a null in the hashed key. A dropped row
    stays as a mark of its conversation, with ``there`` false.
    """
    blank = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")))
    kind = F.crc32(F.encode(key, "utf-8")) % DAMAGES
    role, text = (F.coalesce(F.col(c).cast("string"), blank) for c in ("role", "text"))
    marked = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
    there = F.col("kind") != 0
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return marked.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind").isin(0, 1), "")
        .when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        there.alias("there"),
        copies.alias("copy"),
    ).drop("copy")


def mark_faults(turns: DataFrame) -> DataFrame:
    """Add ``fault``, the first that holds of blank, duplicate and truncated, to rows of
    ``conv_id, turn, role, text, there``, dealt by conversation and sorted by turn.

    Turns go with nulls first; rows of one turn by role and text, so that equal rows are
    adjacent. One shuffle serves the search for earlier equal rows and the order; both are
    external sorts, so a conversation of any length needs no memory of its own.
    """
    order = (F.asc_nulls_first("turn"), "role", "text")
    same = Window.partitionBy("conv_id", "there", "role", "text").orderBy(F.asc_nulls_first("turn"))
    fault = (
        F.when(~F.col("text").rlike(WORD), BLANK)
        .when(F.col("seen") > 1, DUPLICATE)
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), TRUNCATED)
        .otherwise(NONE)
    )
    return (
        turns.repartition("conv_id")
        .withColumn("seen", F.row_number().over(same))
        .withColumn("fault", fault)
        .drop("seen")
        .sortWithinPartitions(F.asc_nulls_first("conv_id"), "there", *order)
    )


def closure() -> Cells:
    """The cheapest insertions that lead from state to state."""
    cells: Cells = {(p, p): (0, "") for p in STATES}
    for _ in STATES:
        for (p, q), (cost, audit) in list(cells.items()):
            for c in ROLES:
                if (r := STEP.get((q, c))) is not None:
                    longer = (cost + INSERT, audit + "I")
                    cells[p, r] = min(cells.get((p, r), longer), longer)
    return cells


def combine(left: Cells, right: Cells) -> Cells:
    """``[p, q] -> [p, r] [r, q]``: the cells of two neighbouring spans as one.

    Audits of one span and one cost never begin with each other (both hold one letter a row
    beside insertions, which cost), so the least of joined audits is made of least ones.
    """
    cells: Cells = {}
    for (p, r), (cost, audit) in left.items():
        for q in STATES:
            if (found := right.get((r, q))) is not None:
                joined = (cost + found[0], audit + found[1])
                if (p, q) not in cells or joined < cells[p, q]:
                    cells[p, q] = joined
    return cells


INSERTIONS = closure()


def row_cells(initial: str, fault: int) -> Cells:
    """The cells of one row with insertions before and after it."""
    cells: Cells = {(p, p): (DELETE, "D") for p in STATES}
    if fault in (NONE, TRUNCATED):
        more = UNFINISHED if fault == TRUNCATED else 0
        edits = [(initial, "K", more), *((c, "R", REROLE + more) for c in ROLES)]
        for c, letter, cost in edits:
            for p in STATES:
                if (q := STEP.get((p, c))) is not None:
                    cells[p, q] = min(cells.get((p, q), (cost, letter)), (cost, letter))
    return combine(combine(INSERTIONS, cells), INSERTIONS)


_ROW_CELLS: dict[tuple[str, int], Cells] = {
    (initial, fault): row_cells(initial, fault)
    for initial in ("s", "u", "a", "")
    for fault in (NONE, BLANK, DUPLICATE, TRUNCATED)
}


def span_cells(rows: list[tuple[str, int]]) -> Cells:
    """The cells of a span of (initial, fault) rows, bottom-up by span length."""
    spans = [_ROW_CELLS[initial if initial in ("s", "u", "a") else "", fault] for initial, fault in rows]
    while len(spans) > 1:
        paired = [combine(a, b) for a, b in zip(spans[::2], spans[1::2], strict=False)]
        spans = paired + spans[len(paired) * 2 :]
    return spans[0] if spans else INSERTIONS


def edited(audit: str, state: int, rows: list[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The (role, text) rows that the edits of ``audit`` leave, entered in ``state``."""
    given = iter(rows)
    for letter in audit:
        wanted = "a" if state == 2 else "u"
        role, text = (ROLES[wanted], "") if letter == "I" else next(given)
        if letter == "D":
            continue
        if letter == "K":
            wanted = role[:1]
        else:
            role = ROLES[wanted]
        state = STEP[state, wanted]
        yield role, text


class Repair:
    """One conversation, row by row in order. It holds one span of rows, and for each state
    that the rows so far can end in the least (cost, audit) and the digest of its text."""

    def __init__(self) -> None:
        self.faults = [0, 0, 0, 0]
        self.illegal = self.turns = 0
        self.first_turn = self.last_turn = None
        self.initial: str | None = None
        self.rows: list[tuple[str, str]] = []
        self.tags: list[tuple[str, int]] = []
        self.chars = 0
        self.audit: list[str] = []  # what the audits of all states begin with
        self.best = {START: (0, "", hashlib.sha256(), False)}

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
            self.turns += 1
        initial = role[:1]
        self.illegal += self.initial is not None and self.initial + initial not in LEGAL
        self.initial = initial
        self.faults[fault] += 1
        self.rows.append((role, text))
        self.tags.append((initial, fault))
        self.chars += len(text) + len(role)
        if len(self.rows) >= SPAN_ROWS or self.chars >= SPAN_CHARS:
            self.close_span()

    def close_span(self) -> None:
        """Join the cells of the span to those of all rows before it."""
        cells = span_cells(self.tags)
        chosen: dict[int, tuple[int, str, int, str]] = {}
        for p, (cost, audit, _, _) in self.best.items():
            for q in STATES:
                if (cell := cells.get((p, q))) is not None:
                    joined = (cost + cell[0], audit + cell[1], p, cell[1])
                    if q not in chosen or joined[:2] < chosen[q][:2]:
                        chosen[q] = joined
        best = {}
        for q, (cost, audit, p, added) in chosen.items():
            _, _, digest, begun = self.best[p]
            digest = digest.copy()
            for role, text in edited(added, p, self.rows):
                digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
                begun = True
            best[q] = (cost, audit, digest, begun)
        common = os.path.commonprefix([b[1] for b in best.values()])
        self.audit.append(common)
        self.best = {q: (c, a[len(common) :], d, b) for q, (c, a, d, b) in best.items()}
        self.rows, self.tags, self.chars = [], [], 0

    def result(self) -> tuple:
        """``gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``."""
        if self.rows:
            self.close_span()
        cost, audit, digest, _ = min((self.best[q] for q in ENDS if q in self.best), key=lambda b: b[:2])
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        _, blank, duplicate, truncated = self.faults
        return (
            gaps, blank, duplicate, truncated, self.illegal,
            cost, "".join(self.audit) + audit, digest.hexdigest(),
        )


REPAIRED = pa.schema(
    [
        ("conv_id", pa.int64()),
        *((name, pa.int64()) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        ("audit", pa.string()),
        ("repaired_sha256", pa.string()),
    ]
)
REPAIRED_DDL = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string"
)


def repair(turns: DataFrame) -> DataFrame:
    """Count the faults of each conversation of ``conv_id, turn, role, text, there`` and find
    its cheapest repair: one row per conversation.

    Keep costs 0, a new role 2, deletion 3 (blank and duplicate rows must go), an inserted
    empty turn 2, and every truncated row that stays 1. Of equally cheap repairs the one with the
    least audit counts. ``there`` false marks a conversation without adding a row; without any
    row all numbers are 0. Rows without a conversation id are one conversation. Further columns
    of ``turns`` are ignored. A conversation is read by one task, row by row: its digest has
    to be. The audit is the only thing that grows with it.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, open_one, done, size = None, None, [], 0
        for part in slices(batches, "text"):
            names = ("conv_id", "there", "turn", "role", "text", "fault")
            for conv, there, turn, role, text, fault in zip(
                *(part.column(name).to_pylist() for name in names), strict=True
            ):
                if open_one is None or conv != current:
                    if open_one is not None:
                        done.append((current, *open_one.result()))
                        size += len(done[-1][7])
                    if len(done) >= 1000 or size >= SPAN_CHARS:
                        yield as_batch(done)
                        done, size = [], 0
                    current, open_one = conv, Repair()
                if there:
                    open_one.add(turn, role, text, fault)
        if open_one is not None:
            done.append((current, *open_one.result()))
            yield as_batch(done)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.record_batch(
            [pa.array(c, f.type) for c, f in zip(columns, REPAIRED, strict=True)], schema=REPAIRED
        )

    given = turns.select("conv_id", "turn", "role", "text", "there")
    return mark_faults(given).mapInArrow(parse, REPAIRED_DDL)


def repair_damaged(turns: DataFrame) -> DataFrame:
    """``repair`` after ``damage``: how the repair fares on planted faults."""
    return repair(damage(turns))
