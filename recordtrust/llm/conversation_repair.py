"""Conversation repair by weighted CYK parsing of spans of rows.

A conversation should be nothing, or an optional system row and then user and assistant rows in turn. Edits keep a row
(cost 0), change its role to user or assistant (1), delete it (2, the only edit of blank and repeated rows) or insert
an empty user or assistant row (5); a truncated row that stays costs 5 more.

The repair grammar is in Chomsky normal form over four states of a conversation (nothing yet, and after a system, user
or assistant row). The nonterminal pq derives a span of rows, with edits, that leads from state p to state q: pq -> pr rq
for a span of two parts, pq -> row for the edits of one row, each closed under insertions before and behind it. A span's
cell holds the least (cost, audit) per nonterminal, an audit being the edits' initials. Audits of equal cost over a span
never extend each other, as the longer one would cost more, so least parts make least wholes. Spans of up to BLOCK rows
are combined bottom-up by length over all splits; their cells are the rows of the next table, until one cell is left.

Rows are dealt to tasks by ranges of (conversation, turn), so a conversation of any length is parsed in pieces; pieces
of one conversation, two per task at most that others share, are parsed together as one more table. Only hashes of
texts go there. Repaired texts are then written in one streamed pass over sorted rows, behind their audit. By nature that pass
reads a conversation's rows in one task, as its digest is of one text, but holds no more than a batch of them.

Defined cases: a null role or text is one space; a null turn comes first; rows of one turn are ordered by role and by the hash
of the text; repeated rows of a turn are duplicates; a null conversation is one conversation; a role's
initial is its first code point; a conversation that has lost all rows gets zeros, an empty audit and the digest
of an empty text; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from recordtrust.sources.workspace import Workspace

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SPACE = r"\x20\x09-\x0D"
BLOCK = 8
LEGAL = {"su", "ua", "au"}

# States: 0 nothing yet, 1 after a system row, 2 after a user row, 3 after an assistant row.
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEXT_ROLE = {0: "user", 1: "user", 2: "assistant", 3: "user"}
AFTER = {"user": 2, "assistant": 3}
STATES = range(4)
Cell = tuple[int, str]
Cells = list[Cell | None]


def _place(p: int, q: int) -> int:
    return 4 * p + q


def _insertions() -> Cells:
    """Cells of no rows: the fewest insertions that lead from one state to another."""
    out: Cells = [None] * 16
    for p in STATES:
        out[_place(p, p)] = (0, "")
        at, cell = p, (0, "")
        for _ in STATES:
            at, cell = AFTER[NEXT_ROLE[at]], (cell[0] + INSERT, cell[1] + "I")
            if out[_place(p, at)] is None:
                out[_place(p, at)] = cell
    return out


INSERTIONS = _insertions()
#: Nonterminals that derive anything: those of insertions, and a system row kept.
NONTERMINALS = [(p, q) for p in STATES for q in STATES if INSERTIONS[_place(p, q)] is not None or (p, q) == (0, 1)]
RULES = [(_place(p, q), _place(p, r), _place(r, q)) for p, r in NONTERMINALS for x, q in NONTERMINALS if x == r]


def join(left: Cells, right: Cells, out: Cells | None = None) -> Cells:
    """Least cells of two spans side by side, and of ``out`` where these are less."""
    out = [None] * 16 if out is None else out
    for whole, a, b in RULES:
        x, y = left[a], right[b]
        if x is not None and y is not None:
            had, cost = out[whole], x[0] + y[0]
            if had is None or cost < had[0]:
                out[whole] = (cost, x[1] + y[1])
            elif cost == had[0]:
                out[whole] = min(had, (cost, x[1] + y[1]))
    return out


@lru_cache(1 << 14)
def row_cells(initial: str, removed: bool, truncated: bool, repeats: int) -> Cells:
    """Cells of a row and the equal rows of its turn behind it, with insertions around them."""
    cells: Cells = [None] * 16
    for p in STATES:
        cells[_place(p, p)] = (DELETE, "D")
    if not removed:
        for (p, symbol), q in STEPS.items():
            if symbol == initial:
                cells[_place(p, q)] = (TRUNCATED * truncated, "K")
            elif symbol != "s":
                cells[_place(p, q)] = (REROLE + TRUNCATED * truncated, "R")
    cells = join(join(INSERTIONS, cells), INSERTIONS)
    if repeats:
        gone: Cells = [None] * 16
        for p in STATES:
            gone[_place(p, p)] = (DELETE * repeats, "D" * repeats)
        cells = join(cells, join(gone, INSERTIONS))
    return cells


def parse_block(spans: list[Cells]) -> Cells:
    """CYK over neighbouring spans: the cells of all of them together."""
    table = {(i, i + 1): x for i, x in enumerate(spans)}
    for length in range(2, len(spans) + 1):
        for i in range(len(spans) - length + 1):
            cells: Cells = [None] * 16
            for k in range(i + 1, i + length):
                join(table[i, k], table[k, i + length], cells)
            table[i, i + length] = cells
    return table[0, len(spans)]


def parse(spans: list[Cells]) -> Cells:
    while len(spans) > 1:
        spans = [parse_block(spans[i : i + BLOCK]) for i in range(0, len(spans), BLOCK)]
    return spans[0] if spans else INSERTIONS


def cheapest(cells: Cells) -> Cell:
    """Whole conversations begin in state 0 and end there or behind an assistant row."""
    return min(x for x in (cells[_place(0, 0)], cells[_place(0, 3)]) if x is not None)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults, chosen by a hash of conversation and turn."""
    space = F.lit(" ")
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    role, text, fault = F.coalesce("role", space), F.coalesce("text", space), F.col("fault")
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.pmod(F.crc32(named.cast("binary")), F.lit(20)).alias("fault"))
    return rows.where(fault != 0).select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


ORDER = ["conv_id", "turn", "role", "digest"]


def _plain(rows: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(" "))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), F.sha2(text.cast("binary"), 256).alias("digest"))


def _flagged(plain: DataFrame, workspace: Workspace) -> DataFrame:
    """Distinct rows without their texts: how many copies, and their faults."""
    blank, ended = ~F.col("text").rlike(f"[^{SPACE}]"), F.col("text").rlike(f"[.!?][{SPACE}]*\\z")
    marked = plain.select(*ORDER, blank.alias("blank"), (~ended).alias("truncated"))
    rows = workspace.stage(marked.groupBy(*ORDER, "blank", "truncated").agg(F.count(F.lit(1)).alias("n")), "rows")
    # Written before the join, so Spark can split a text that one conversation holds in very many turns.
    first = workspace.stage(rows.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("first")), "first")
    other = first.select(F.col("conv_id").alias("__conv"), F.col("role").alias("__role"), F.col("digest").alias("__digest"), F.col("first.turn").alias("__turn"))
    same = F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("role") == F.col("__role")) & (F.col("digest") == F.col("__digest"))
    return workspace.stage(rows.join(other, same).select(*ORDER, "blank", "truncated", "n", (~F.col("turn").eqNullSafe(F.col("__turn"))).alias("duplicate")), "flagged")


class Piece(NamedTuple):
    """Neighbouring rows of a conversation in one task; ``open`` if it may have more rows in another."""

    low: int | None
    high: int | None
    turns: int
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    first: str
    last: str
    open: bool
    cost: int | None
    audit: str | None
    costs: list[int | None] | None
    audits: list[str | None] | None


PIECE = (
    "low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, first string, last string, "
    "open boolean, cost long, audit string, costs array<long>, audits array<string>"
)


def _piece(rows: list[tuple], open: bool) -> Piece:
    """rows: (turn, role, blank, truncated, n, duplicate) in order."""
    turns = [r[0] for r in rows if r[0] is not None]
    initials = [r[1][:1] for r in rows]
    counts = [0, 0, 0]
    spans, illegal = [], sum(a + b not in LEGAL for a, b in zip(initials[:-1], initials[1:], strict=True))
    for (_, _, blank, truncated, n, duplicate), initial in zip(rows, initials, strict=True):
        illegal += n - 1  # equal rows side by side
        if blank:
            counts[0] += n
        else:
            counts[1] += n - 1 + duplicate
            counts[2] += truncated and not duplicate
        spans.append(row_cells(initial if initial in ("s", "u", "a") else "", blank or duplicate, truncated, n - 1))
    cells = parse(spans)
    cost, audit = cheapest(cells)
    costs, audits = ([x and x[i] for x in cells] for i in (0, 1)) if open else (None, None)
    distinct = len(set(turns))
    return Piece(min(turns, default=None), max(turns, default=None), distinct, *counts, illegal, initials[0], initials[-1], open, cost, audit, costs, audits)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _fields(conv: str, more: str) -> tuple[str, pa.Schema]:
    text = f"conv_id {conv}, {more}"
    return text, pa.schema([(f.name, to_arrow_type(f.dataType)) for f in StructType.fromDDL(text)])


def _pieces(flagged: DataFrame) -> DataFrame:
    conv = flagged.schema["conv_id"].dataType.simpleString()
    text, schema = _fields(conv, f"at long, {PIECE}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, current, first = [], [], None, True
        for batch in batches:
            for conv_id, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and conv_id != current:
                    out.append((current, 0 if first else 1, *_piece(held, first)))
                    held, first = [], False
                current = conv_id
                held.append(tuple(row))
            if len(out) >= 2000:
                yield _table(out, schema)
                out = []
        if held:
            out.append((current, 0, *_piece(held, True)))
        if out:
            yield _table(out, schema)

    ordered = flagged.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    return ordered.select("conv_id", "turn", "role", "blank", "truncated", "n", "duplicate").mapInArrow(run, text)


def _merged(pieces: pa.Table) -> tuple:
    """A conversation's row from its pieces in order."""
    rows = pieces.to_pylist()
    cells = parse([[None if c is None else (c, a) for c, a in zip(r["costs"], r["audits"], strict=True)] for r in rows])
    cost, audit = cheapest(cells)
    between = [(a, b) for a, b in zip(rows[:-1], rows[1:], strict=True)]
    illegal = sum(r["illegal"] for r in rows) + sum(a["last"] + b["first"] not in LEGAL for a, b in between)
    lows, highs = ([r[k] for r in rows if r[k] is not None] for k in ("low", "high"))
    turns = sum(r["turns"] for r in rows) - sum(a is not None and a == b for a, b in zip(highs[:-1], lows[1:], strict=True))
    counts = [sum(r[k] for r in rows) for k in ("blank", "duplicate", "truncated")]
    return min(lows, default=None), max(highs, default=None), turns, *counts, illegal, cost, audit


RESULT = "low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def parsed(rows: DataFrame, workspace: Workspace) -> DataFrame:
    """Of every conversation with rows: least, largest and number of turns, faults, cost and audit."""
    flagged = _flagged(_plain(rows), workspace)
    conv = flagged.schema["conv_id"].dataType.simpleString()
    pieces = workspace.stage(_pieces(flagged).withColumn("part", F.spark_partition_id()), "pieces")
    text, schema = _fields(conv, RESULT)
    names = [f.name for f in schema]

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "ascending")])
        return pa.Table.from_batches([_table([(table.column("conv_id")[0].as_py(), *_merged(table))], schema)])

    opened = pieces.where("open").groupBy("conv_id").applyInArrow(merge, text)
    return pieces.where("NOT open").select(names).unionByName(opened)


def _streamed(rows: DataFrame, headers: DataFrame, use: Callable, fields: str) -> DataFrame:
    """Rows of every conversation behind its header (conv_id, audit, numbers), in order."""
    plain = _plain(rows)
    both = headers.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("digest"), F.col("audit").alias("text"), "numbers")
    both = both.unionByName(plain.withColumn("kind", F.lit(1)).withColumn("numbers", F.lit(None).cast("array<long>")))
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
    text, schema = _fields(rows.schema["conv_id"].dataType.simpleString(), fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, conversation = [], None
        for batch in batches:
            for conv_id, kind, role, text, numbers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == 0:
                    if conversation is not None:
                        out += conversation.end()
                    conversation = use(conv_id, text or "", numbers)
                else:
                    out += conversation.row(role, text)
            if len(out) >= 2000:
                yield _table(out, schema)
                out = []
        if conversation is not None:
            out += conversation.end()
        if out:
            yield _table(out, schema)

    return ordered.select("conv_id", "kind", "role", "text", "numbers").mapInArrow(run, text)


class Repair:
    """Carries out an audit on the rows of a conversation, one at a time."""

    def __init__(self, conv_id: object, audit: str, numbers: list[int] | None):
        self.conv_id, self.audit, self.numbers, self.at, self.state, self.made = conv_id, audit, numbers, 0, 0, 0

    def _insertions(self) -> list[tuple]:
        out = []
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            out += self._emit(NEXT_ROLE[self.state], "")
        return out

    def _emit(self, role: str, text: str) -> list[tuple]:
        self.state = STEPS[self.state, role[:1]]
        self.made += 1
        return self.emit(role, text)

    def emit(self, role: str, text: str) -> list[tuple]:
        return [(self.conv_id, self.made, role, text)]

    def row(self, role: str, text: str) -> list[tuple]:
        out = self._insertions()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            out += self._emit(role, text)
        elif edit == "R":
            out += self._emit(NEXT_ROLE[self.state], text)
        return out

    def end(self) -> list[tuple]:
        return self._insertions()


class Digest(Repair):
    """Digest of the repaired rows instead of the rows."""

    def __init__(self, *given: object):
        super().__init__(*given)
        self.sha = hashlib.sha256()

    def emit(self, role: str, text: str) -> list[tuple]:
        self.sha.update(f"{'' if self.made == 1 else chr(10)}{role}:{text}".encode())
        return []

    def end(self) -> list[tuple]:
        super().end()
        return [(self.conv_id, *self.numbers, self.audit, self.sha.hexdigest())]


def repair(rows: DataFrame, workspace: Workspace) -> DataFrame:
    """conv_id, at (from 1), role and text of the repaired rows."""
    headers = parsed(rows, workspace).select("conv_id", "audit", F.lit(None).cast("array<long>").alias("numbers"))
    return _streamed(rows, headers, Repair, "at long, role string, text string")


NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair_digests(conversations: DataFrame, rows: DataFrame, workspace: Workspace) -> DataFrame:
    """Faults, cost, audit and digest of the repaired ``rows`` of every conversation in ``conversations``."""
    found = workspace.stage(parsed(rows, workspace), "parsed")
    ids = conversations.select("conv_id").distinct()
    named = found.withColumnRenamed("conv_id", "__conv").withColumn("gaps", F.col("high") - F.col("low") + 1 - F.col("turns"))
    numbers = F.array(*[F.coalesce(F.col(c), F.lit(0)).cast("long") for c in NUMBERS])
    headers = ids.join(named, F.col("conv_id").eqNullSafe(F.col("__conv")), "left").select("conv_id", F.coalesce("audit", F.lit("")).alias("audit"), numbers.alias("numbers"))
    fields = ", ".join(f"{c} long" for c in NUMBERS) + ", audit string, repaired_sha256 string"
    return _streamed(rows, headers, Digest, fields)
