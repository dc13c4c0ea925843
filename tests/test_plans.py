"""Shape of the physical plans, and tables where one key holds a third of the rows."""

import re

import pytest
from compare import compare, connect
from conftest import SF
from pyspark.sql import functions as F

import __spark_entry__ as entry
from docflow.operators import quality as q, views
from docflow.plans import fixtures

BATCH = [
    "n1_invoice_detail_view", "n2_monitoring", "n3_file_trace", "n4_invoice_summary", "n8_duplicate_pairs", "n11_semantic_self_join",
    "n13_one_row_report", "a5_item_analysis", "a16_statistics", "q4_orphan_lines", "q6_total_mismatch", "q7_check_totals",
    "q14_dedupe_headers", "q17_health_report", "v1_header_corrections", "m3_dims_and_metrics", "m4_metrics", "h2_search",
    "j2_parse_header", "j3_parse_lines", "e1_extract_fields", "e8_parse_pages",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins_and_no_python(spark, no_broadcast, name):
    text = plan(entry.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in text
    for spec in re.findall(r"windowspecdefinition\(([^)]*)", text):
        assert not spec.strip().startswith("specifiedwindowframe")


def test_pruning(spark):
    text = plan(entry.queries()["a3_vendor_spend"](spark, SF))
    # The sum of the lines is not asked for, and of the orders only what the filter and the sum need.
    assert "l_extendedprice" not in text
    assert "o_totalprice" in text and "o_orderdate" not in text.split("ReadSchema")[1]


def test_filters_do_not_copy_the_extraction(spark, tables):
    from docflow.operators import extract as e, normalize as n

    def size(df):
        return len(df._jdf.queryExecution().optimizedPlan().toString())

    raw = e.extract_fields(tables.texts, "text", e.FULL)
    assert size(n.documents(raw)) < 2 * size(raw)
    header = n.parse_header(raw.withColumn("extraction_timestamp", F.lit("2024-01-01").cast("timestamp_ntz")))
    assert size(header.filter("total_amount > 10")) < 2 * size(raw)


def test_dedupe_reduces_before_the_shuffle(spark, tables):
    text = plan(q.latest_invoices(tables.invoice))
    assert re.search(r"WindowGroupLimit.*Final", text) and re.search(r"WindowGroupLimit.*Partial", text)


def test_lines_are_reduced_before_the_join(spark, tables, no_broadcast):
    text = plan(views.invoice_summary(tables.invoice, tables.invoice_detail))
    assert "partial_sum(line_amount" in text and "partial_count" in text


def skewed(t):
    """The same tables with a third of the lines in one order."""
    hot = F.when(F.col("l_partkey") % 3 == 0, F.lit(3)).otherwise(F.col("l_orderkey"))
    lines = t.table("lineitem").withColumn("l_orderkey", hot)

    class Skewed(fixtures.Tables):
        def table(self, name):
            return lines if name == "lineitem" else super().table(name)

    return Skewed(t.spark, SF)


def test_hot_order_is_spread_over_documents(spark, tables, monkeypatch):
    from docflow.operators import normalize as n

    monkeypatch.setattr(fixtures, "LINES_PER_DOCUMENT", 100)
    t = skewed(tables)
    sizes = [r.n for r in t.line_arrays.select(F.size("lines").alias("n")).collect()]
    assert sum(sizes) == t.invoice_detail.count()
    assert max(sizes) < 250  # 2000 lines and more lie in about twenty parts
    known = t.invoice.select("invoice_id")
    parsed = n.parse_lines(t.raw_json)
    assert parsed.count() == t.invoice_detail.join(known, "invoice_id", "left_semi").count()
    assert parsed.select("invoice_detail_id").distinct().count() == parsed.count()
    assert n.parse_header(t.raw_json).count() == t.invoice.count()


IN_PARTS = ["j2_parse_header", "j3_parse_lines", "j3b_parse_lines_longest", "j4_flatten_records", "j5_flatten_fields",
            "j10_default_currency", "j13_line_item_count", "j14_json_structure", "e1_extract_fields", "e1b_extract_app",
            "e3_extract_records", "e12_split_header", "e12b_split_detail", "q8_json_issues", "s7_write_header_and_lines",
            "n12_lateral_lines", "k3_parent_links"]


@pytest.mark.parametrize("name", IN_PARTS)
def test_parts_of_a_document_are_one_document(spark, monkeypatch, name):
    monkeypatch.setattr(fixtures, "LINES_PER_DOCUMENT", 3)
    assert compare(entry.queries()[name](spark, SF), connect(SF), entry.oracle_sql()[name]) is None


def test_results_stay_whole_with_a_hot_order(spark, tables):
    t = skewed(tables)
    a = views.invoice_summary(t.invoice, t.invoice_detail).agg(F.sum("total_line_items").alias("n")).first().n
    orphans = q.orphan_lines(t.invoice_detail, t.invoice).first()["count"]
    assert a + orphans == t.invoice_detail.count()


def test_hot_invoice_number(spark, tables):
    inv = tables.invoice.withColumn("invoice_number", F.when(F.col("invoice_id") % 3 == 0, "HOT").otherwise(F.col("invoice_number")))
    inv = inv.withColumn("vendor_name", F.lit("V")).cache()
    pairs = q.duplicate_pairs(inv)
    groups = inv.dropna(subset=["invoice_number"]).groupBy("invoice_number").count()
    assert pairs.count() == groups.agg(F.sum(F.col("count") - 1)).first()[0]  # linear, no member left out
    kept = q.latest_invoices(inv)
    assert kept.filter("invoice_number = 'HOT'").count() == 1
    assert kept.count() == groups.count() + inv.filter("invoice_number IS NULL").count()
