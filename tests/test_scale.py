"""Large inputs are made, read and shuffled once; results are those of small ones."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from docflow.operators import extract as e, normalize as n, search as s, stored_index as si
from docflow.plans.fixtures import Tables


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def one_order(spark, tmp_path):
    day = datetime(2024, 1, 2)
    lines = [(1, 10, 5, 2, 3.0, 30.0, 0.0, 0.1, "N", "O", day), (1, 10, 5, 1, 1.0, 10.0, 0.0, 0.1, "N", "O", day)]
    spark.createDataFrame(lines, "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                          "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
                          "l_shipdate TIMESTAMP_NTZ").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(10, "bolt", 9.5, "steel")], "p_partkey BIGINT, p_name STRING, p_retailprice DOUBLE, p_type STRING").write.parquet(
        f"{tmp_path}/part.parquet")
    return Tables(spark, str(tmp_path))


def test_tables_without_long_orders_are_not_joined_with_them(one_order):
    arrays = one_order.line_arrays
    assert plan(arrays).count("Join ") == 1  # with the parts
    (row,) = arrays.collect()
    assert [line.line_number for line in row.lines] == [1, 2] and (row.part, row.offset, row["last"]) == (0, 0, True)


def test_content_is_not_made_again_by_a_filter_on_it(spark):
    rows = [(1, '{"response": {"invoice_number": "A"}}'), (2, '{"invoice_number": "B", "continues": "1:2"}')]
    raw = spark.createDataFrame(rows, "extraction_id BIGINT, j STRING").select(
        "extraction_id", F.parse_json(F.concat("j", F.lit(" "))).alias("extracted_json"), F.lit("SUCCESS").alias("processing_status"))
    found = n.documents(n.successful(raw)).select("extraction_id", F.try_variant_get("_v", "$.invoice_number", "string").alias("number"))
    assert plan(found).lower().replace("_", "").count("parsejson(") <= 1
    assert [tuple(r) for r in found.collect()] == [(1, "A")]


def test_field_sets_read_the_text_once(spark):
    df = spark.createDataFrame([("a.txt", "Invoice Number: 7\nTotal Amount: 9.50\n# 1 | x")], "file_name STRING, text STRING")
    got = e.compare_schemas(df, "text", {"Simple": {"invoice_number": "", "total": ""}, "Short": {"total": ""}})
    assert plan(got).count("regexp_extract_all") <= 2  # labels and values; no field is a line's
    assert {tuple(r) for r in got.collect()} == {
        ("Simple", "a.txt", '{"invoice_number":"7","total":"9.50"}'), ("Short", "a.txt", '{"total":"9.50"}')}


PARSED = ("parsed_id BIGINT, file_name STRING, file_url STRING, file_size BIGINT, last_modified TIMESTAMP_NTZ, "
          "extracted_text STRING, parse_timestamp TIMESTAMP_NTZ, processing_status STRING, error_message STRING")


def parsed(spark, texts):
    day = datetime(2024, 1, 1)
    return spark.createDataFrame([(i, f"{i}.txt", "", 1, day, text, day, "SUCCESS", None) for i, text in texts], PARSED)


def test_postings_are_counted_without_a_shuffle(spark):
    index = s.build_index(parsed(spark, [(1, "b a b"), (2, ""), (3, None)]))
    assert "Aggregate" not in plan(index.postings)
    assert {tuple(r) for r in index.postings.collect()} == {("a", 1, 1, 3), ("b", 1, 2, 3)}


def test_counts_of_documents_that_share_an_id_are_added(spark):
    index = s.build_index(parsed(spark, [(1, "a b"), (1, "a c"), (None, "a"), (None, "a"), (2, "a")]))
    assert {tuple(r) for r in index.postings.collect()} == {
        ("a", 1, 2, 2), ("b", 1, 1, 2), ("c", 1, 1, 2), ("a", None, 2, 1), ("a", 2, 1, 1)}


def test_lists_are_packed_from_a_sorted_stream(spark):
    rows = spark.range(1500).select(F.lit(0).alias("shard"), F.lit("w").alias("term"), (1500 - F.col("id")).alias("parsed_id"),
                                    F.lit(1).alias("tf"), F.lit(2).alias("doc_len"))
    blocks = si._pack(rows)
    assert "collect_list" not in plan(blocks)
    got = sorted(blocks.collect(), key=lambda r: r.ids[0])
    assert [r.n for r in got] == [512, 512, 476] and [i for r in got for i in r.ids] == list(range(1, 1501))


def test_the_first_batch_fixes_shards_by_its_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(si, "SHARDS", 2)
    monkeypatch.setattr(si, "SHARD_ROWS", 1)
    si.add(spark, f"{tmp_path}/index", parsed(spark, [(i, "a") for i in range(3)]), 0)
    assert si.open_index(spark, f"{tmp_path}/index").table("stats", si.STATS).first()["shards"] == 3


def test_rows_that_share_an_id_share_a_vector(spark):
    got = s.embed(parsed(spark, [(1, "x x"), (1, "y"), (2, ""), (None, "z")]), "extracted_text", dims=64).collect()
    by_id = {i: [list(r.embedding) for r in got if r.parsed_id == i] for i in (1, 2, None)}
    assert len(by_id[1]) == 2 and by_id[1][0] == by_id[1][1] and sum(x > 0 for x in by_id[1][0]) == 2
    assert by_id[2] == by_id[None] == [[0.0] * 64]
