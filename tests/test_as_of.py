"""Files beside the run they belong to."""

import random
from datetime import datetime, timedelta

import pytest

from docflow.operators import runlog

T0 = datetime(2024, 1, 1)


def sides(spark, files, runs):
    left = spark.createDataFrame([(f"f{i}", i, t) for i, t in enumerate(files)], "file_name STRING, file_size BIGINT, extraction_timestamp TIMESTAMP_NTZ")
    right = spark.createDataFrame([(t, t + timedelta(seconds=w), n) for t, w, n in runs], "scheduled_time TIMESTAMP_NTZ, began TIMESTAMP_NTZ, n BIGINT")
    return left, right


def joined(left, right):
    out = runlog.as_of_join(left, right, "extraction_timestamp", "scheduled_time", ["began", "n"], "file_name")
    assert out.columns == ["file_name", "file_size", "extraction_timestamp", "scheduled_time", "began", "n"]
    return {r.file_name: r.n for r in out.collect()}


def test_the_last_run_before_each_file(spark):
    rng = random.Random(2)
    times = [T0 + timedelta(seconds=rng.randint(0, 4000)) for _ in range(500)]
    runs = [(T0 + timedelta(seconds=60 * i + 30 * (i % 2)), rng.randint(0, 5), i) for i in range(3, 60) if i % 7] + [(T0 + timedelta(seconds=600), 9, 1000)]
    files = [*times, None]
    got = joined(*sides(spark, files, runs))
    for i, t in enumerate(files):
        before = [(s, s + timedelta(seconds=w), n) for s, w, n in runs if t is not None and s <= t]
        assert got[f"f{i}"] == (max(before)[2] if before else None)


def test_a_crowded_minute_gives_a_row_a_file(spark):
    left, right = sides(spark, [T0] * 10_000, [(T0, i % 50, i) for i in range(10_000)])
    got = joined(left, right)
    assert len(got) == 10_000 and set(got.values()) == {9999}


@pytest.mark.parametrize("files, runs", [([], [(T0, 1, 1)]), ([T0], []), ([], [])])
def test_empty_sides(spark, files, runs):
    assert joined(*sides(spark, files, runs)) == {f"f{i}": None for i in range(len(files))}
