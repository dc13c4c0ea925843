"""The memory of stored numbers, and files that hold many documents."""

import random

import pytest

from docflow.operators.extract import BASIC
from docflow.schemas import RAW_JSON
from docflow.sources import batches, numbers
from docflow.sources.keys import reserve
from docflow.sources.tables import read_table
from docflow.streaming import jobs


def column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "number STRING")


def test_memory_is_exact_and_a_batch_reads_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(numbers, "BUCKETS", 8)
    path, rng, seen = str(tmp_path / "n"), random.Random(1), set()
    for i in range(24):
        values = [None, *(str(rng.randint(0, 400)) for _ in range(6))]
        asked = column(spark, values).filter("number is not null")
        if i % 6 == 5:
            assert {r.number for r in numbers.known(spark, path, asked).collect()} == seen & set(values)
        assert numbers.remember(spark, path, i, column(spark, values))
        assert not numbers.remember(spark, path, i, column(spark, ["not written"]))
        seen |= set(values) - {None}
        numbers.roll_up(spark, path, fan=2)
    folders = len(batches.live(spark, path))
    assert folders <= 5
    one = numbers.known(spark, path, column(spark, [min(seen)]))
    assert [r.number for r in one.collect()] == [min(seen)]
    stored = numbers.stored(spark, path, batches.live(spark, path))
    assert len(stored.inputFiles()) <= folders * 8
    assert len(stored.filter("bucket = 3")._jdf.queryExecution().executedPlan().toString().split("(bucket")) > folders
    assert {r.bucket for r in stored.filter("bucket = 3").collect()} == {3}
    assert numbers.known(spark, path, column(spark, [])).collect() == []
    assert numbers.known(spark, str(tmp_path / "none"), column(spark, ["1"])).collect() == []


def test_shuffled_when_the_batch_is_large(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(numbers, "BROADCAST_ROWS", 1)
    path = str(tmp_path / "n")
    numbers.remember(spark, path, 0, column(spark, ["a", "b", "c"]))
    assert sorted(r.number for r in numbers.known(spark, path, column(spark, ["c", "x", "a"])).collect()) == ["a", "c"]


@pytest.mark.parametrize("split", ["100", "1k", "4m"])
def test_documents_of_a_file_do_not_depend_on_its_splits(spark, tmp_path, split):
    files = tmp_path / "files"
    files.mkdir()
    texts = [f"Invoice Number: N-{i}\nTotal Amount: {i}.50\nNote: {'x' * (i % 90)} = = ==" for i in range(60)]
    (files / "many.txt").write_text("\n=====\n".join(texts) + "\n=====\n\n")
    (files / "one.txt").write_text("Invoice Number: ONE\nTotal Amount: 1.00")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        jobs.run_once([lambda: jobs.start_extract_stream(
            spark, str(files), str(tmp_path / "raw"), str(tmp_path / "c"), BASIC, pattern="*.txt", separator="\n=====\n")])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    rows = read_table(spark, str(tmp_path / "raw"), RAW_JSON).selectExpr(
        "extraction_id", "file_name", "variant_get(extracted_json, '$.invoice_number', 'string') number").collect()
    assert sorted(r.number for r in rows) == sorted([f"N-{i}" for i in range(60)] + ["ONE"])
    assert len({r.extraction_id for r in rows}) == 61
    assert {r.file_name for r in rows} == {"many.txt", "one.txt"}


def test_landing_gives_consecutive_ids_and_refuses_what_landed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(numbers, "BUCKETS", 1)  # all keys collide in their bucket
    files, base = tmp_path / "files", str(tmp_path / "store")
    files.mkdir()

    def run(checkpoint):
        jobs.run_once([lambda: jobs.start_landing_stream(
            spark, str(files), base, str(tmp_path / checkpoint), BASIC, pattern="*.txt", max_files=1)])

    for i in range(4):
        (files / f"{i}.txt").write_text(f"Invoice Number: N-{i}\n")
    run("a")
    (files / "4.txt").write_text("nothing")
    run("a")
    run("b")  # all files again
    raw, refused = jobs.read_landed(spark, base)
    assert sorted(r.extraction_id for r in raw.collect()) == [1, 2, 3, 4, 5]
    assert sorted(r.file_name for r in refused.collect()) == [f"{i}.txt" for i in range(5)]
    assert {r.file_name for r in raw.filter("processing_status = 'ERROR'").collect()} == {"4.txt"}


def test_a_batch_that_runs_again_has_the_same_ids(spark, tmp_path):
    path = str(tmp_path / "ids")
    assert [reserve(spark, path, b, n) for b, n in ((0, 5), (1, 0), (2, 7), (1, 0), (0, 5), (3, 1))] == [1, 6, 6, 6, 1, 13]
    with pytest.raises(ValueError):
        reserve(spark, path, 2, 8)


def test_a_new_checkpoint_goes_on_behind_the_last_batch(spark, tmp_path):
    path = str(tmp_path / "s")
    assert batches.first_id(spark, path, str(tmp_path / "c1")) == 0
    batches.write_tables(spark, path, 0, t=spark.range(1))
    (tmp_path / "c1" / "offsets").mkdir(parents=True)
    (tmp_path / "c1" / "offsets" / "0").write_text("")
    assert batches.first_id(spark, path, str(tmp_path / "c1")) == 0
    assert batches.first_id(spark, path, str(tmp_path / "c2")) == 1
    (tmp_path / "c2" / "offsets").mkdir(parents=True)
    (tmp_path / "c2" / "offsets" / "0").write_text("")
    batches.write_tables(spark, path, 1, t=spark.range(1))
    assert batches.first_id(spark, path, str(tmp_path / "c2")) == 1
