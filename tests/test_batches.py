"""Stores of micro-batches: what is published counts, roll-ups change nothing but the number of folders."""

import math
import os
import threading

import pytest
from pyspark.sql import functions as F

from docflow.sources import batches
from docflow.streaming import jobs


def put(spark, path, i):
    batches.write_tables(spark, path, i, counts=spark.createDataFrame([(i % 3, 1), (7, i)], "key INT, n BIGINT").coalesce(1))


def totals(spark, path):
    return {r.key: r.n for r in jobs.read_counts(spark, path, "key", "n").collect()}


def want(n):
    return {**{k: len(range(k, n, 3)) for k in range(min(n, 3))}, 7: n * (n - 1) // 2}


def test_many_batches_lie_in_a_few_folders(spark, tmp_path):
    path = str(tmp_path / "counts")
    for i in range(31):
        put(spark, path, i)
        jobs.roll_up_counts(spark, path)
        if i % 15 == 14:
            assert totals(spark, path) == want(i + 1)
            batches.vacuum(spark, path)
    assert len(batches.live(spark, path)) <= math.log2(32)
    batches.vacuum(spark, path)
    assert len([f for f in os.listdir(path) if f != "log"]) == len(batches.live(spark, path)) <= math.log2(32)
    assert totals(spark, path) == want(31)


def test_a_batch_counts_when_it_is_whole_and_once(spark, tmp_path):
    path = str(tmp_path / "s")
    put(spark, path, 0)

    def broken(folder):
        spark.range(3).write.parquet(f"{folder}/counts")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        batches.write(spark, path, 1, broken)
    assert totals(spark, path) == want(1)
    put(spark, path, 1)
    put(spark, path, 1)
    assert totals(spark, path) == want(2)
    jobs.roll_up_counts(spark, path)
    put(spark, path, 0)  # a batch inside a rolled-up interval is there
    assert totals(spark, path) == want(2)
    put(spark, path, 5)
    with pytest.raises(ValueError):
        put(spark, path, 4)


def test_roll_up_beside_a_running_writer(spark, tmp_path):
    path, failed, seen = str(tmp_path / "s"), [], []
    put(spark, path, 0)
    done = threading.Event()

    def roll():
        try:
            while not done.is_set():
                jobs.roll_up_counts(spark, path, fan=3)
                seen.append(totals(spark, path)[7])
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    other = threading.Thread(target=roll)
    other.start()
    for i in range(1, 12):
        put(spark, path, i)
    done.set()
    other.join()
    jobs.roll_up_counts(spark, path, fan=3)
    assert not failed and seen == sorted(seen)
    assert totals(spark, path) == want(12)


def test_two_roll_ups_of_the_same_batches_count_once(spark, tmp_path):
    path = str(tmp_path / "s")
    for i in range(4):
        put(spark, path, i)
    found = batches.live(spark, path)
    for _ in range(2):
        name = f"rolled-0-4-{_}"
        batches.read_from(spark, path, found, "counts").write.parquet(f"{path}/{name}/counts")
        batches._publish(spark, path, batches.Interval(0, 4, name, 1, ("counts",)))
    assert totals(spark, path) == want(4)
    assert batches.vacuum(spark, path) == 5
    assert totals(spark, path) == want(4)


def test_rows_know_their_interval_and_nothing_is_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "s")
    assert batches.read(spark, path, "counts", "key INT, n BIGINT", low=True).count() == 0
    for i in (3, 4, 8):
        put(spark, path, i)
    rows = batches.read(spark, path, "counts", low=True).filter("key = 7").select(F.col("n"), "low").collect()
    assert {(r.n, r.low) for r in rows} == {(3, 3), (4, 4), (8, 8)}
