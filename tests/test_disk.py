"""Jobs leave no more on disk than what is still to be read."""

import glob
import os
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from docflow.plans import fixtures, registry, streams
from docflow.plans.fixtures import Tables
from docflow.schemas import RAW_JSON
from docflow.sources.tables import conform, stream_table
from docflow.streaming import jobs

SF = "/root/testdata/sf0.001"


@pytest.fixture
def kept(monkeypatch, tmp_path):
    """A folder of its own for what the queries of a test write."""
    monkeypatch.setattr(streams, "scratch", lambda spark, name: f"{tmp_path}/kept/{name}-{uuid.uuid4().hex}")
    return tmp_path / "kept"


@pytest.fixture
def three_slices(monkeypatch):
    monkeypatch.setattr(fixtures, "SLICE_BYTES", os.path.getsize(f"{SF}/lineitem.parquet") // 3 + 1)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def texts(df):
    return df.withColumn("extracted_json", F.to_json("extracted_json"))


def test_slices_are_the_whole(tables, three_slices):
    parts = tables.slices()
    assert len(parts) == 3 and all(not p.raw_json.isEmpty() for p in parts)
    made = parts[0].raw_json.unionByName(parts[1].raw_json).unionByName(parts[2].raw_json)
    assert same(texts(made), texts(tables.raw_json))
    one, two = (p.table("orders").select("o_orderkey") for p in parts[:2])
    assert one.join(two, "o_orderkey").isEmpty()


def test_a_null_key_lies_in_one_slice(spark, tmp_path):
    spark.createDataFrame([(1,), (None,), (2,)], "o_orderkey BIGINT").write.parquet(f"{tmp_path}/orders.parquet")
    found = [fixtures.Slice(spark, str(tmp_path), i, 2).table("orders") for i in range(2)]
    assert sorted(str(r.o_orderkey) for df in found for r in df.collect()) == ["1", "2", "None"]


def test_what_the_part_gives_is_made_behind_the_shuffle(tables):
    made = tables.line_arrays._jdf.queryExecution().optimizedPlan().toString().splitlines()
    grouped = next(i for i, line in enumerate(made) if "Aggregate [" in line)
    assert "SKU-" in made[grouped] and not any("SKU-" in line for line in made[grouped + 1:])


@pytest.mark.parametrize("name", ["t2_parse_stream", "t8_triggers", "t1b_documents_in_files", "t4b_run_all_with_lines"])
def test_what_was_read_to_the_end_is_gone(spark, tables, kept, three_slices, name):
    got = registry.load()[name].run(Tables(spark, SF))
    left = {f.split("-")[0] for f in os.listdir(kept) if glob.glob(f"{kept}/{f}/**/part-*", recursive=True)}
    assert left == {name.split("_")[0]}  # no landing rows, documents or spool
    if name.startswith("t4b"):
        assert not glob.glob(f"{kept}/t4b-*/raw/part-*")
    invoices = tables.invoice.count()
    assert (got.agg(F.sum("documents")).first()[0] if "documents" in got.columns else got.count()) == invoices


def test_landing_rows_are_packed(spark, tables, kept):
    (path, *_) = glob.glob(f"{streams.landed(tables)}/part-*")
    assert pq.ParquetFile(path).metadata.row_group(0).column(0).compression == "ZSTD"


def test_shuffle_files_go_with_the_statement(spark, tables, kept):
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    local = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def shuffled():
        return {f for d in local for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}

    there = shuffled()
    streams.landed(tables)
    assert not shuffled() - there
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == before


def test_equal_documents_are_dealt_evenly(spark, kept):
    class Same:
        def __init__(self):
            self.spark = spark
            self.texts = spark.range(8).select(F.lit("Vendor: A").alias("text")).coalesce(1)

        def slices(self):
            return [self]

    spool = streams.deal(Same(), str(kept / "spool"), "parquet")
    assert [r["count"] for r in spark.read.parquet(spool).groupBy("file").count().collect()] == [2] * streams.FILES


def test_a_file_for_each_number(spark, tables, kept):
    spool = streams.deal(tables, str(kept / "spool"), "parquet")
    streams.large_files(tables, spool, str(kept / "pair"), range(2))
    assert len(glob.glob(f"{kept}/pair/part-*.txt")) == 2
    found = spark.read.text(str(kept / "pair"), lineSep=streams.SEPARATOR)
    assert found.count() == spark.read.parquet(spool).filter("file < 2").count()


def test_rolled_up_batches_are_deleted_on_request(spark, tables, tmp_path):
    raw = conform(tables.raw_json, RAW_JSON).filter("extraction_id < 200")
    raw.repartition(4).write.parquet(f"{tmp_path}/raw")
    jobs.run_once([lambda: jobs.start_parse_stream(
        stream_table(spark, f"{tmp_path}/raw", RAW_JSON, max_files=1), f"{tmp_path}/tables", f"{tmp_path}/c", vacuum=True)])
    assert [f.split("-")[0] for f in os.listdir(tmp_path / "tables") if f not in ("log", "runs")] == ["rolled"]
    assert jobs.read_tables(spark, f"{tmp_path}/tables")[0].count() == raw.filter("processing_status = 'SUCCESS'").count()
