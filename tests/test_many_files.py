"""Streams of very many small files: few tasks list and read them, and no folder holds a single one."""

import os

from pyspark.sql import functions as F

from docflow.operators.extract import BASIC
from docflow.plans import streams
from docflow.session import MANY_FILES, settings
from docflow.streaming import jobs


def test_statements_lie_in_one_folder_one_each(tables):
    root = streams.statements(tables)
    found = [f for f in os.listdir(root) if f.endswith(".txt")]
    vendors = tables.invoice.select("vendor_name").distinct().count()
    assert len(found) == vendors and not [f for f in os.listdir(root) if os.path.isdir(f"{root}/{f}")]
    texts = {open(f"{root}/{f}").read() for f in found}
    assert len(texts) == vendors and all(t.startswith("Invoice Number: STATEMENT ") and t.count("\n") == 3 for t in texts)


def test_a_task_reads_many_small_files(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    for i in range(600):
        (files / f"{i}.txt").write_text(f"Invoice Number: {i}\n")
    with settings(spark, MANY_FILES):
        jobs.run_once([lambda: jobs.start_extract_stream(spark, str(files), str(tmp_path / "raw"), str(tmp_path / "c"), BASIC, pattern="*.txt")])
    parts = [f for f in os.listdir(tmp_path / "raw") if f.endswith(".parquet")]
    assert spark.read.parquet(str(tmp_path / "raw")).agg(F.count_distinct("file_name")).first()[0] == 600
    assert len(parts) <= spark.sparkContext.defaultParallelism  # 19 when a task took 32 files at most


def test_a_task_lists_many_paths(tables):
    assert int(tables.spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) <= 1000


def test_pages_are_written_by_many_tasks_and_read_whole(spark, tmp_path, monkeypatch):
    from docflow.plans import registry
    from docflow.plans.fixtures import Tables

    rows = [(i, f"<p>page {i}</p>") for i in range(64)]
    spark.createDataFrame(rows, "page_id BIGINT, html STRING").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    monkeypatch.setattr(streams, "scratch", lambda spark, name: f"{tmp_path}/kept/{name}")
    got = registry.load()["t3_document_stream"].run(Tables(spark, str(tmp_path))).collect()
    assert {(r.page_id, r.extracted_text, r.processing_status) for r in got} == {(i, f"page {i}", "SUCCESS") for i in range(64)}
    assert len(got) == 64 and len(os.listdir(tmp_path / "kept" / "pages")) >= 64
