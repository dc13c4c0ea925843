"""Corrections against a row-at-a-time model of the form."""

import random
from datetime import datetime, timedelta

import pytest

from docflow.operators import review
from docflow.schemas import CORRECTIONS
from test_golden import DETAIL, header


def by_hand(lines, moves):
    """Lines of one document after its moves, in order; the last line stays."""
    current = [(str(i + 1), i + 1) for i in range(lines)]
    for op, line in moves:
        if op == "add":
            current.append((line, len(current) + 1))
        elif len(current) > 1:
            current = [c for c in current if c[0] != line]
    return sorted(current)


def moves_for(rng, lines):
    """Moves as a form records them: only present lines are removed."""
    present = [str(i + 1) for i in range(lines)]
    moves = []
    for i in range(rng.randint(0, 12)):
        if present and rng.random() < 0.7:
            line = rng.choice(present)
            moves.append((rng.choice(["remove", "pop"]), line))
            if len(present) > 1:
                present.remove(line)
            else:
                # A refused removal is not repeated for the same line.
                present = []
        else:
            moves.append(("add", f"new-{i}"))
            present.append(f"new-{i}")
    return moves


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_moves_match_the_form(spark, seed):
    rng, rows, detail, want = random.Random(seed), [], [], {}
    start = datetime(2024, 1, 1)
    for d in range(60):
        doc, lines = f"d{d}", rng.randint(0, 3)
        detail += [(doc, i + 1, "x", "1", "1") for i in range(lines)]
        moves = moves_for(rng, lines)
        rows += [(doc, "detail", line, op, None, None, i, start + timedelta(minutes=i // 2)) for i, (op, line) in enumerate(moves)]
        want[doc] = by_hand(lines, moves)
    head = header(spark, *[(f"d{d}", "", "1", "1") for d in range(60)])
    _, out = review.apply_corrections(head, spark.createDataFrame(detail, DETAIL), spark.createDataFrame(rows, CORRECTIONS))
    got = {doc: [] for doc in want}
    for r in out.collect():
        got[r.doc_id].append((r.line_id, r.LineNumber))
    assert {k: sorted(v) for k, v in got.items()} == want


def test_one_document_over_many_partitions(spark):
    """A single document with many moves: the walk is carried over partition borders."""
    rng = random.Random(7)
    moves, present = [], ["1"]
    for i in range(400):
        if rng.random() < 0.55 and len(present) > 1:
            moves.append(("remove", present.pop(rng.randrange(len(present)))))
        else:
            moves.append(("add", f"new-{i}"))
            present.append(f"new-{i}")
    rows = [("d", "detail", line, op, None, None, i, datetime(2024, 1, 1)) for i, (op, line) in enumerate(moves)]
    corrections = spark.createDataFrame(rows, CORRECTIONS)
    lines = spark.createDataFrame([("d", 1, "x", "1", "1")], DETAIL)
    _, out = review.apply_corrections(header(spark, ("d", "", "1", "1")), lines, corrections)
    assert sorted((r.line_id, r.LineNumber) for r in out.collect()) == by_hand(1, moves)


def test_latest_value_wins_and_changes_are_counted(spark):
    t = datetime(2024, 1, 1)
    rows = [
        ("d", "header", None, "set", "VendorName", "old", 1, t), ("d", "header", None, "set", "VendorName", "new", 2, t),
        ("d", "detail", "1", "set", "Quantity", "5", 3, t), ("d", "detail", "1", "set", "LineTotal", "9", 4, t),
    ]
    corrections = spark.createDataFrame(rows, CORRECTIONS)
    head, lines = review.apply_corrections(
        header(spark, ("d", "", "1", "1")), spark.createDataFrame([("d", 1, "x", "1", "1")], DETAIL), corrections)
    assert head.first().VendorName == "new"
    assert (lines.first().Quantity, lines.first().LineTotal, lines.first().Description) == ("5", "9", "x")
    got = review.change_summary(corrections).first()
    assert (got.total_header_changes, got.total_detail_changes) == (1, 1)
    assert {r.field: r.times_changed for r in review.latest_changes(corrections).collect()}["VendorName"] == 2
