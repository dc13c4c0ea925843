"""Incremental jobs: same result in many batches as in one, nothing twice."""

import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docflow.operators import normalize as n, runlog
from docflow.operators.extract import BASIC
from docflow.schemas import INVOICE, RAW_JSON
from docflow.sources.tables import conform, stream_table
from docflow.streaming import jobs


def write_parts(df, path, k):
    """k files, one after the other, so that a stream sees them in this order."""
    for i in range(k):
        df.filter(F.pmod(F.xxhash64("extraction_id"), F.lit(k)) == i).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)


def test_batches_equal_one_batch(spark, tables, tmp_path):
    base = str(tmp_path)
    raw = conform(tables.raw_json, RAW_JSON)
    write_parts(raw, f"{base}/raw", 3)

    def start():
        return jobs.start_parse_stream(stream_table(spark, f"{base}/raw", RAW_JSON, max_files=1), f"{base}/tables", f"{base}/c")

    (done,) = jobs.run_once([start])
    assert len([p for p in done.recentProgress if p["numInputRows"]]) == 3
    inv, det = jobs.read_tables(spark, f"{base}/tables")
    for got, want in ((inv, n.parse_header(raw)), (det, n.parse_lines(raw))):
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # Nothing new: no batch, no row.
    jobs.run_once([start])
    assert jobs.read_tables(spark, f"{base}/tables")[0].count() == inv.count()
    # One more file: only its rows are added.
    more = raw.withColumn("extraction_id", F.col("extraction_id") + 10**9).limit(5)
    more.coalesce(1).write.mode("append").parquet(f"{base}/raw")
    jobs.run_once([start])
    assert jobs.read_tables(spark, f"{base}/tables")[0].count() == inv.count() + 5


def test_a_landed_file_can_be_read_in_parts(spark, tables, tmp_path, monkeypatch):
    """Few files a batch leave no core idle: their row groups are small, and documents are stored as they are read."""
    import pyarrow.parquet as pq

    from docflow.operators.extract import FULL

    monkeypatch.setattr(jobs, "ROW_GROUP", 1 << 14)
    files, landing = str(tmp_path / "files"), str(tmp_path / "raw")
    tables.texts.select("text").coalesce(1).write.option("lineSep", "\n=====\n").text(files)
    jobs.run_once([lambda: jobs.start_extract_stream(
        spark, files, landing, str(tmp_path / "c"), FULL, pattern="*.txt", as_of="2024-01-10 12:00:00", separator="\n=====\n")])
    found = [pq.ParquetFile(f) for f in (tmp_path / "raw").glob("*.parquet")]
    assert sum(f.metadata.num_rows for f in found) == tables.texts.count()
    assert sum(f.num_row_groups for f in found) > 2 * len(found)
    columns = {f.schema.column(i).path for f in found for i in range(len(f.schema))}
    assert {c for c in columns if c.startswith("extracted_json")} == {"extracted_json.metadata", "extracted_json.value"}


def test_a_repeated_batch_replaces_itself(spark, tables, tmp_path):
    from docflow.sources.tables import write_batch

    df = n.parse_header(tables.raw_json).limit(10)
    for _ in range(2):
        write_batch(df, str(tmp_path / "t"), 4)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 10


def test_files_are_extracted_once_and_bad_ones_are_rows(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    (files / "a.pdf").write_text("Invoice Number: A-1\nTotal Amount: 12.50\n")
    (files / "b.PDF").write_text("nothing to see")
    (files / "c.txt").write_text("Invoice Number: C-1\n")

    def start():
        return jobs.start_extract_stream(spark, str(files), str(tmp_path / "raw"), str(tmp_path / "c"), BASIC, as_of="2024-01-01 00:00:00")

    jobs.run_once([start, start])
    rows = {r.file_name: r for r in spark.read.parquet(str(tmp_path / "raw")).withColumn("j", F.to_json("extracted_json")).collect()}
    assert set(rows) == {"a.pdf", "b.PDF"}
    assert rows["a.pdf"].j == '{"invoice_number":"A-1","total_amount":"12.50"}'
    assert (rows["b.PDF"].processing_status, rows["b.PDF"].error_message) == ("ERROR", "no field found")
    (files / "d.pdf").write_text("Invoice Number: D-1\n")
    jobs.run_once([start])
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 3


def test_late_rows_are_counted(spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    schema = "extraction_timestamp TIMESTAMP_NTZ, processing_status STRING"

    def add(*minutes):
        rows = [(t0 + timedelta(minutes=m), "ERROR") for m in minutes]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.05)

    def run():
        df = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        jobs.run_once([lambda: jobs.start_counts(df, jobs.hourly_throughput, str(tmp_path / "out"), str(tmp_path / "c"))])

    add(5, 10, 65)
    add(300)
    add(15, 310)  # 00:15 comes late
    run()
    add(20)
    run()
    got = {r.hour: r.invoices_processed for r in jobs.read_counts(spark, str(tmp_path / "out"), "hour", "invoices_processed").collect()}
    assert got == {t0: 4, t0 + timedelta(hours=1): 1, t0 + timedelta(hours=5): 2}


def test_files_with_old_dates_are_delivered(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()

    def start():
        return jobs.start_extract_stream(spark, str(files), str(tmp_path / "raw"), str(tmp_path / "c"), BASIC)

    (files / "a.pdf").write_text("Invoice Number: A-1\n")
    jobs.run_once([start])
    (files / "b.pdf").write_text("Invoice Number: B-1\n")
    old = time.time() - 30 * 86_400
    os.utime(files / "b.pdf", (old, old))
    jobs.run_once([start])
    assert {r.file_name for r in spark.read.parquet(str(tmp_path / "raw")).collect()} == {"a.pdf", "b.pdf"}


def test_bytes_that_are_no_text_are_a_row_and_reach_a_worker(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    (files / "good.pdf").write_text("Invoice Number: A-1\n")
    (files / "bad.pdf").write_bytes(b"%PDF-1.7 \xff\xfe\x00")

    def kind(content, fields):
        return {"content": type(content).__name__, "size": str(len(content))}

    jobs.run_once([
        lambda: jobs.start_extract_stream(spark, str(files), str(tmp_path / "raw"), str(tmp_path / "c1"), BASIC),
        lambda: jobs.start_document_stream(spark, str(files), str(tmp_path / "parsed"), str(tmp_path / "c2")),
        lambda: jobs.start_document_stream(spark, str(files), str(tmp_path / "worked"), str(tmp_path / "c3"), worker=kind),
    ])
    for name in ("raw", "parsed"):
        rows = {r.file_name: (r.processing_status, r.error_message) for r in spark.read.parquet(str(tmp_path / name)).collect()}
        assert rows == {"good.pdf": ("SUCCESS", None), "bad.pdf": ("ERROR", "not UTF-8 text")}
    worked = spark.read.parquet(str(tmp_path / "worked")).collect()
    assert {r.extracted_text for r in worked} == {"bytes"} or {r.extracted_text for r in worked} == {"bytearray"}


def test_numbers_stay_unique_across_batches_and_runs(spark, tmp_path):
    t0 = datetime(2024, 1, 1)

    def add(*rows):
        df = spark.createDataFrame(
            [(i, number, t0 + timedelta(hours=h)) for i, number, h in rows],
            "invoice_id BIGINT, invoice_number STRING, created_timestamp TIMESTAMP_NTZ")
        conform(df, INVOICE).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.05)

    def start():
        stream = stream_table(spark, str(tmp_path / "in"), INVOICE, max_files=1)
        return jobs.start_unique_stream(stream, str(tmp_path / "stored"), str(tmp_path / "c"))

    add((1, "A", 0), (2, None, 0), (3, None, 0))
    add((4, "A", 1), (5, "B", 1))  # A again in the next batch
    jobs.run_once([start])
    add((6, "A", 100), (7, "B", 100), (8, "C", 100))  # long after, in a new run
    jobs.run_once([start])
    stored = spark.read.parquet(str(tmp_path / "stored"))
    assert sorted(r.invoice_id for r in stored.collect()) == [1, 2, 3, 5, 8]


def test_run_log_has_every_batch_and_the_failed_run(spark, tmp_path):
    for i in range(12):
        spark.range(i, i + 2).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = stream_table(spark, str(tmp_path / "in"), spark.range(1).schema, max_files=1)

    def write(batch, batch_id):
        if batch_id == 11:
            raise RuntimeError("disk full")

    start = lambda: jobs.start_logged(stream, "load", write, str(tmp_path / "log"), str(tmp_path / "c"))
    with pytest.raises(Exception, match="disk full"):
        jobs.run_once([start])
    rows = runlog.with_duration(spark.read.parquet(str(tmp_path / "log"))).collect()
    assert [r.return_value for r in rows if r.state == "SUCCEEDED"] == ["2"] * 11
    (failed,) = [r for r in rows if r.state == "FAILED"]
    assert (failed.error_code, failed.error_message, failed.return_value) == ("RuntimeError", "disk full", None)
    assert runlog.log_line(spark, "2024-01-01 00:00:00", "parse", "INFO", "done").first().message == "done"
