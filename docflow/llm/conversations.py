"""Conversation structure repair: weighted CYK over spans of turns with a repair grammar in Chomsky normal form.

The role initials of a repaired conversation are ``(s?(ua)+)?``. An automaton of four states reads them (0 nothing yet, 1 after s,
2 after u, 3 after a; 0 and 3 are ends), and the grammar has a nonterminal P(p, q) for the spans that can be repaired so
that they lead from p to q: P(p, q) -> P(p, r) P(r, q) for every state r, and for single turns Keep, Rerole (to user or
assistant) and Delete, each between insertions of any number (the insertion closure, itself the cell of an empty span). A cell
holds the least (cost, audit), the audit being the edits' initials. Cost follows from the audit, and of two audits of a span
with equal cost none begins with the other (only insertions could follow, and they cost), so the least of a span is made of the
least of its parts. Every split of a span gives the same cells, so one is enough: spans are combined in pairs, bottom-up
by length, n - 1 products for n turns.

A row's first fault counts: blank (nothing but white space), duplicate (role and text seen earlier), truncated (last character
besides white space not ``[.!?]``). Blank and duplicate rows must be deleted, a truncated row that stays costs 1.
Rows are taken by turn, nulls first, rows of one turn by role and md5 of the text. Null roles and texts are one space; a
null conversation id is a conversation. Roles without the initials s, u, a (an empty one too) can't be kept. A row with
``gone`` names its conversation only. Empty tables give empty tables; columns besides those read may have any name.

Conversations of at most ``ROWS`` rows and ``BYTES`` are sorted and repaired where they are hashed to. Longer ones, up to a third
of all rows, are dealt out by ranges, blocks of ``BLOCK`` rows are parsed on their own and a conversation's block cells
combined in order by span length; no task holds its texts. The digest reads such a conversation as a sorted stream,
because a SHA-256 over it is sequential, and holds its audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import BROADCAST_ROWS, written

COSTS = {"K": 0, "R": 2, "D": 3, "I": 2}
TRUNCATED = 1
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
STATES, ENDS = range(4), (0, 3)
LEGAL = {"su", "ua", "au"}
WHITE = " \t\n\x0b\f\r"
ROWS, BYTES = 2_000, 8 << 20  # of a conversation that one task may hold
BLOCK = 2_000
POSITION_BITS = 33  # of monotonically_increasing_id
Cells = dict[tuple[int, int], tuple[int, str]]

REPAIRED = ("conv_id long, row long, nth int, edit string, fault string, turn long, was string, role string, text string")


# --- rows -----------------------------------------------------------------------------------------------------------


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone after the damage that crc32 of ``conv_id:turn`` modulo 20 names: 0 drops a row (it
    stays as ``gone``), 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 makes its role user."""
    read = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(read["conv_id"], F.lit(":"), read["turn"]).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(read["text"], ".!?", "")).otherwise(read["text"])
    role = F.when(kind == 4, "user").otherwise(read["role"])
    times = F.when(kind == 3, F.array(F.lit(False), F.lit(False))).otherwise(F.array(kind == 0))
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       role.alias("role"), text.alias("text"), F.explode(times).alias("gone"))


def _own_fault(text: Column) -> Column:
    """Faults that a row shows by itself."""
    end = F.rtrim(text, F.lit(WHITE))
    return F.when(end == "", "blank").when(~F.right(end, F.lit(1)).isin(".", "!", "?"), "truncated")


def _prepared(rows: DataFrame) -> DataFrame:
    """Rows to repair: nulls read as one space, with their own fault and the md5 of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    gone = F.col("gone") if "gone" in rows.columns else F.lit(False)
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
                       text.alias("text"), F.coalesce(gone, F.lit(False)).alias("gone"), _own_fault(text).alias("fault"),
                       F.md5(text.cast("binary")).alias("mark"))


# --- grammar --------------------------------------------------------------------------------------------------------


def product(left: Cells, right: Cells) -> Cells:
    """Cells of a span from those of its two parts: P(p, q) -> P(p, r) P(r, q)."""
    out: Cells = {}
    for (p, r), (cost, audit) in left.items():
        for q in STATES:
            if (r, q) in right:
                more, rest = right[r, q]
                best = out.get((p, q))
                if best is None or cost + more < best[0] or cost + more == best[0] and audit + rest < best[1]:
                    out[p, q] = cost + more, audit + rest
    return out


def _closure() -> Cells:
    """The empty span: any number of users and assistants inserted."""
    one = {(p, q): (COSTS["I"], "I") for (p, x), q in STEPS.items() if x in "ua"}
    out: Cells = {(p, p): (0, "") for p in STATES}
    while True:
        more = product(out, one | {(p, p): (0, "") for p in STATES})
        if more == out:
            return out
        out = more


CLOSURE = _closure()


@lru_cache(maxsize=None)
def leaf(symbol: str) -> Cells:
    """Cells of one turn. Symbols: s u a - (initial, - for others), S U A _ (truncated), x (must go)."""
    edits: Cells = {(p, p): (COSTS["D"], "D") for p in STATES}
    cut = TRUNCATED if symbol in "SUA_" else 0
    for (p, x), q in STEPS.items() if symbol != "x" else ():
        if x == symbol.lower():
            edits[p, q] = COSTS["K"] + cut, "K"
        elif x in "ua":
            edits[p, q] = COSTS["R"] + cut, "R"
    return product(product(CLOSURE, edits), CLOSURE)


def parse(symbols: str) -> Cells:
    """Cells of all ``symbols``, by spans of 1, 2, 4, … turns."""
    spans = [leaf(x) for x in symbols] or [CLOSURE]
    while len(spans) > 1:
        spans = [product(*spans[i:i + 2]) if i + 1 < len(spans) else spans[i] for i in range(0, len(spans), 2)]
    return spans[0]


def best(cells: Cells) -> tuple[int, str]:
    return min(cells[0, q] for q in ENDS if (0, q) in cells)


@lru_cache(maxsize=100_000)
def _audit(symbols: str) -> str:
    return best(parse(symbols))[1]


def symbol(initial: str, fault: str | None) -> str:
    if fault in ("blank", "duplicate"):
        return "x"
    if initial not in ("s", "u", "a"):
        return "_" if fault else "-"
    return initial.upper() if fault else initial


def _per_row(audit: str, rows: int) -> list[str]:
    """The edits up to each row's own; those behind the last row's belong to it."""
    out, at = [], 0
    for _ in range(rows):
        end = at
        while audit[end] == "I":
            end += 1
        out.append(audit[at:end + 1])
        at = end + 1
    if out:
        out[-1] += audit[at:]
    return out


def _roles(kept: int, odd: bool) -> str:
    """The role that an insertion or a new role makes at a place: those before it are ``kept``, the first is a system turn or not."""
    return "assistant" if (kept - odd) % 2 else "user"


def _expanded(row: tuple, letters: str, kept: int, odd: bool) -> Iterator[tuple]:
    """Rows of the repaired table for one row (conv_id, row, fault, turn, role, text) and its edits."""
    conv, number, fault, turn, role, text = row
    for nth, edit in enumerate(letters):
        if edit == "I":
            yield conv, number, nth, edit, None, None, None, _roles(kept, odd), ""
        elif edit == "D":
            yield conv, number, nth, edit, fault, turn, role, None, None
        else:
            yield conv, number, nth, edit, fault, turn, role, role if edit == "K" else _roles(kept, odd), text
        kept += edit != "D"


NAMES = ["conv_id", "row", "nth", "edit", "fault", "turn", "was", "role", "text"]
TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), TYPES)], NAMES)


# --- conversations that a task may hold ------------------------------------------------------------------------------


def _repaired(conv: int | None, rows: list[tuple]) -> Iterator[tuple]:
    seen, symbols, faults = set(), [], []
    rows = [r for r in rows if not r[4]]
    if not rows:
        yield conv, 0, 0, "", None, None, None, None, None
    for _, role, text, fault, _ in rows:
        if fault != "blank" and (role, text) in seen:
            fault = "duplicate"
        seen.add((role, text))
        faults.append(fault)
        symbols.append(symbol(role[:1], fault))
    line = "".join(symbols)
    audit = _audit(line) if len(line) <= 32 else best(parse(line))[1]
    kept, odd = 0, len(audit.replace("D", "")) % 2 == 1
    for number, (letters, fault, (turn, role, text, _, _)) in enumerate(zip(_per_row(audit, len(rows)), faults, rows)):
        yield from _expanded((conv, number, fault, turn, role, text), letters, kept, odd)
        kept += len(letters) - letters.count("D")


def _short(batches):
    conv, rows, out, size = None, None, [], 0
    for batch in batches:
        for one, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if rows is None or one != conv:
                if rows is not None:
                    out.extend(_repaired(conv, rows))
                    if size > 4 << 20 or len(out) > 10_000:
                        yield _batch(out)
                        out, size = [], 0
                conv, rows = one, []
            rows.append(tuple(row))
            size += len(row[2])
    if rows is not None:
        out.extend(_repaired(conv, rows))
    if out:
        yield _batch(out)


def _in_order(rows: DataFrame) -> DataFrame:
    """Repaired rows of short conversations, each conversation in order in one partition."""
    sorted_rows = rows.repartition("conv_id").sortWithinPartitions(*_order())
    return sorted_rows.select("conv_id", "turn", "role", "text", "fault", "gone").mapInArrow(_short, REPAIRED)


def _order() -> list[Column]:
    return [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("mark")]


# --- longer conversations --------------------------------------------------------------------------------------------


def _placed(rows: DataFrame) -> DataFrame:
    """Rows with their place in the order of all (``row``), stored. Equal rows are counted first, so copies don't make a range
    that can't be split."""
    cols = ["conv_id", "turn", "role", "text", "fault", "mark"]
    counted = rows.groupBy(*cols).agg(F.count("*").alias("times"))
    ranged = counted.repartitionByRange(*_order()).sortWithinPartitions(*_order())
    copies = ranged.select(*cols, F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"))
    return written(copies.withColumn("row", F.monotonically_increasing_id()), "placed")


def _faults(placed: DataFrame) -> DataFrame:
    """conv_id, row, initial, fault, with duplicates: a pair of role and text meets the number of its first row."""
    key = ["conv_id", "pair"]
    slim = placed.select("conv_id", "row", "fault", F.substring("role", 1, 1).alias("initial"),
                         F.md5(F.concat("role", F.lit("\n"), "mark").cast("binary")).alias("pair"))
    first = slim.groupBy(*key).agg(F.min("row").alias("first")).select(F.col("conv_id").alias("_c"), F.col("pair").alias("_p"), "first")
    met = slim.join(first, (F.col("pair") == F.col("_p")) & F.col("conv_id").eqNullSafe(F.col("_c")))
    fault = F.when(F.coalesce(F.col("fault") == "blank", F.lit(False)), "blank").when(F.col("row") != F.col("first"), "duplicate").otherwise(F.col("fault"))
    return met.select("conv_id", "row", "initial", fault.alias("fault"))


CELLS = "conv_id long, first long, rows array<long>, cells array<struct<p int, q int, cost long, audit string>>"


def _cells(batches):
    for batch in batches:
        for conv, rows in zip(*(c.to_pylist() for c in batch.columns)):
            cells = parse("".join(symbol(r["initial"], r["fault"]) for r in rows))
            made = [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in cells.items()]
            numbers = [r["row"] for r in rows]
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "first": numbers[0], "rows": numbers, "cells": made}], schema=pa.schema([
                ("conv_id", pa.int64()), ("first", pa.int64()), ("rows", pa.list_(pa.int64())), ("cells", pa.list_(pa.struct([
                    ("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))]))


def _joined(batches):
    """Edits of every row of long conversations, from their blocks in order: spans of equal length are combined first."""
    conv, blocks, spans = None, [], []

    def finish():
        while len(spans) > 1:
            right, left = spans.pop(), spans.pop()
            spans.append((left[0] + right[0], product(left[1], right[1])))
        audit, at, kept = best(spans[0][1])[1], 0, 0
        odd = len(audit.replace("D", "")) % 2 == 1
        for i, rows in enumerate(blocks):
            end, left = at, len(rows)
            while left:
                left -= audit[end] != "I"
                end += 1
            letters = _per_row(audit[at:] if i + 1 == len(blocks) else audit[at:end], len(rows))
            befores = []
            for x in letters:
                befores.append(kept)
                kept += len(x) - x.count("D")
            yield pa.RecordBatch.from_arrays([
                pa.array(rows, pa.int64()), pa.array(letters), pa.array(befores, pa.int64()), pa.array([odd] * len(rows))],
                ["row", "letters", "kept", "odd"])
            at = end

    for batch in batches:
        for one, _, rows, cells in zip(*(c.to_pylist() for c in batch.columns)):
            if blocks and one != conv:
                yield from finish()
                blocks, spans = [], []
            conv = one
            blocks.append(rows)
            spans.append((1, {(c["p"], c["q"]): (c["cost"], c["audit"]) for c in cells}))
            while len(spans) > 1 and spans[-1][0] == spans[-2][0]:
                right, left = spans.pop(), spans.pop()
                spans.append((left[0] + right[0], product(left[1], right[1])))
    if blocks:
        yield from finish()


def _spread(batches):
    for batch in batches:
        out = [r for *row, letters, kept, odd in zip(*(c.to_pylist() for c in batch.columns))
               for r in _expanded(tuple(row), letters, kept, odd)]
        if out:
            yield _batch(out)


def _long(rows: DataFrame) -> DataFrame:
    """Repaired rows of long conversations, in no order."""
    placed = _placed(rows.where("not gone"))
    faults = written(_faults(placed), "faults")
    part, position = F.shiftright("row", POSITION_BITS), F.col("row").bitwiseAND((1 << POSITION_BITS) - 1)
    blocks = faults.groupBy("conv_id", part.alias("part"), F.floor(position / BLOCK).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("row", "initial", "fault"))).alias("rows"))
    cells = blocks.select("conv_id", "rows").mapInArrow(_cells, CELLS)
    edits = cells.repartition("conv_id").sortWithinPartitions("conv_id", "first").mapInArrow(
        _joined, "row long, letters string, kept long, odd boolean")
    met = placed.select("conv_id", "row", "turn", "role", "text").join(faults.select("row", "fault"), "row").join(edits, "row")
    out = met.select("conv_id", "row", "fault", "turn", "role", "text", "letters", "kept", "odd").mapInArrow(_spread, REPAIRED)
    named = rows.groupBy("conv_id").agg(F.bool_and("gone").alias("gone")).where("gone")
    return out.unionByName(named.select("conv_id", *[F.lit(v).cast(t).alias(n) for n, t, v in (
        ("row", "long", 0), ("nth", "int", 0), ("edit", "string", ""), ("fault", "string", None), ("turn", "long", None),
        ("was", "string", None), ("role", "string", None), ("text", "string", None))]))


def _split(rows: DataFrame, most: int, size: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of short conversations and those of long ones, if there are any."""
    prepared = _prepared(rows)
    long = written(prepared.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).where(
        (F.col("n") > most) | (F.col("size") > size)).select(F.col("conv_id").alias("_long")), "long")
    n = long.count()
    if not n:
        return prepared, None
    long = F.broadcast(long) if n <= BROADCAST_ROWS else long
    is_long = F.col("conv_id").eqNullSafe(F.col("_long"))
    return prepared.join(long, is_long, "left_anti"), prepared.join(long, is_long, "left_semi")


# --- results --------------------------------------------------------------------------------------------------------


def repair(rows: DataFrame, most: int = ROWS, size: int = BYTES) -> DataFrame:
    """The repaired conversations: conv_id, row and nth (their order), edit, fault, turn, was (the role before), role, text.

    Deleted rows have no role and text, inserted ones no turn and former role. A conversation without rows has one row without edit.
    """
    short, long = _split(rows, most, size)
    return _in_order(short) if long is None else _in_order(short).unionByName(_long(long))


class _Report:
    """What a conversation's repaired rows, seen in order, add up to."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = self.turns = 0
        self.least = self.last = self.before = None
        self.audit, self.sha, self.first = [], hashlib.sha256(), True

    def add(self, edit, fault, turn, was, role, text):
        if not edit:
            return
        self.audit.append(edit)
        self.cost += COSTS[edit] + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
        if edit != "D":
            self.sha.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
            self.first = False
        if edit == "I":
            return
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        if self.before is not None:
            self.illegal += self.before + was[:1] not in LEGAL
        self.before = was[:1]
        if turn is not None and turn != self.last:
            self.least = turn if self.least is None else self.least
            self.last, self.turns = turn, self.turns + 1

    def row(self):
        gaps = 0 if self.last is None else self.last - self.least + 1 - self.turns
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest())


REPORT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def _reports(batches):
    conv, report = None, None

    def made(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i < 7 else pa.string()) for i, c in enumerate(zip(*rows))],
                                          [c.split()[0] for c in REPORT.split(", ")])

    out = []
    for batch in batches:
        for one, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if report is None or one != conv:
                if report is not None:
                    out.append((conv, *report.row()))
                    if len(out) == 10_000:
                        yield made(out)
                        out = []
                conv, report = one, _Report()
            report.add(*row)
    if report is not None:
        out.append((conv, *report.row()))
    if out:
        yield made(out)


def digest(rows: DataFrame, most: int = ROWS, size: int = BYTES) -> DataFrame:
    """One row per conversation: faults, illegal neighbours, cost, audit and the hash of the repaired rows."""
    seen = ["conv_id", "edit", "fault", "turn", "was", "role", "text"]
    short, long = _split(rows, most, size)
    out = _in_order(short).select(*seen).mapInArrow(_reports, REPORT)
    if long is None:
        return out
    ordered = _long(long).repartition("conv_id").sortWithinPartitions("conv_id", "row", "nth")
    return out.unionByName(ordered.select(*seen).mapInArrow(_reports, REPORT))
