"""Counts, summaries and one-row reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docflow.functions.casts import ago, at

MONEY = "decimal(38,2)"
AVERAGE = "decimal(22,6)"


def money_sum(name: str | Column) -> Column:
    return F.sum(name).cast(MONEY)


def exact_avg(name: str | Column) -> Column:
    """Average of a decimal, rounded once; ``avg`` rounds a first time to four more digits."""
    return F.try_divide(F.sum(name), F.count(name)).cast(AVERAGE)


def count_when(condition: Column) -> Column:
    """``SUM(CASE WHEN … THEN 1 ELSE 0 END)``: NULL, not 0, over no rows."""
    return F.sum(F.when(condition, 1).otherwise(0))


def beside(one_row: DataFrame, *others: DataFrame) -> DataFrame:
    """One-row frames side by side, as scalar subqueries."""
    for n, other in enumerate(others):
        one_row = one_row.withColumn(f"_s{n}", other.select(F.struct(*other.columns)).scalar())
    plain = [c for c in one_row.columns if not c.startswith("_s")]
    return one_row.select(*plain, *[f"_s{n}.*" for n in range(len(others))])


def status_counts(raw: DataFrame) -> DataFrame:
    status = F.col("processing_status")
    return raw.agg(
        F.count("*").alias("count"),
        count_when(status == "SUCCESS").alias("success_count"),
        count_when(status == "ERROR").alias("error_count"),
    )


def vendor_spend(inv: DataFrame) -> DataFrame:
    return inv.groupBy("vendor_name").agg(
        F.count("*").alias("invoice_count"), money_sum("total_amount").alias("total_spent")
    )


def monthly_summary(inv: DataFrame) -> DataFrame:
    return inv.groupBy(F.trunc("invoice_date", "MONTH").alias("month")).agg(
        F.count("*").alias("invoice_count"),
        money_sum("total_amount").alias("total_amount"),
        exact_avg("total_amount").alias("avg_invoice_amount"),
    )


def item_analysis(det: DataFrame) -> DataFrame:
    return det.groupBy("item_description").agg(
        F.count("*").alias("times_ordered"),
        F.sum("quantity").cast("decimal(38,4)").alias("total_quantity"),
        exact_avg("unit_price").alias("avg_unit_price"),
        money_sum("line_amount").alias("total_revenue"),
    )


def throughput_by_hour(raw: DataFrame) -> DataFrame:
    hour = F.date_trunc("HOUR", "extraction_timestamp").cast("timestamp_ntz").alias("hour")
    return raw.groupBy(hour).agg(F.count("*").alias("invoices_processed"))


def search_stats(parsed: DataFrame) -> DataFrame:
    """One row over the indexed documents; distinct names are reduced by a shuffle on the name."""
    return parsed.filter(F.col("processing_status") == "SUCCESS").agg(
        F.count("*").alias("total_documents_indexed"),
        F.count_distinct("file_name").alias("unique_files"),
        F.min("parse_timestamp").alias("first_indexed"),
        F.max("parse_timestamp").alias("last_indexed"),
        F.avg("file_size").alias("avg_file_size"),
        F.sum("file_size").alias("total_size_bytes"),
    )


def batch_volume(files: DataFrame) -> DataFrame:
    size = F.col("file_size").cast("decimal(20,0)")
    return files.filter(F.col("file_name").ilike("%.pdf")).agg(
        F.count("*").alias("total_files"),
        F.sum("file_size").alias("total_size_bytes"),
        F.round(F.sum(size) / 1048576, 2).cast("decimal(18,2)").alias("total_size_mb"),
        F.round(F.sum(size) / (F.count(size) * 1024), 2).cast("decimal(18,2)").alias("avg_file_size_kb"),
    )


def lines_per_invoice(inv: DataFrame, det: DataFrame) -> DataFrame:
    """All lines over all invoices; one aggregate per table."""
    lines = det.agg(F.count("*").alias("lines"))
    heads = inv.agg(F.count_distinct("invoice_id").alias("invoices"))
    return beside(lines, heads).select(
        F.round(F.try_divide(F.col("lines").cast("double"), F.col("invoices")), 6)
        .alias("average_line_items_per_invoice")
    )


def invoices_with_item(view: DataFrame, pattern: str) -> DataFrame:
    return (
        view.filter(F.col("item_description").like(pattern))
        .select("invoice_number", "vendor_name", "invoice_total").distinct()
    )


def table_totals(raw: DataFrame, inv: DataFrame, det: DataFrame) -> DataFrame:
    """One row of totals: a single conditional aggregate per table."""
    status = F.col("processing_status")
    r = raw.agg(
        F.count("*").alias("extractions"),
        F.count_if(status == "SUCCESS").alias("successful"),
        F.count_if(status == "ERROR").alias("failed"),
    )
    i = inv.agg(
        F.count("*").alias("invoices"),
        money_sum("total_amount").alias("invoice_value"),
        F.round(F.avg("total_amount"), 2).cast(MONEY).alias("avg_invoice_amount"),
    )
    d = det.agg(F.count("*").alias("line_items"))
    return beside(r, i, d)


def file_count(files: DataFrame) -> DataFrame:
    return files.filter(F.col("file_name").ilike("%.pdf")).agg(F.count("*").alias("files"))


def as_rows(one_row: DataFrame, labels: dict[str, str], key: str, value: str, value_type: str) -> DataFrame:
    """One row of totals turned into (label, value) rows."""
    typed = one_row.select(*[F.col(c).cast(value_type).alias(label) for c, label in labels.items()])
    return typed.unpivot([], list(labels.values()), key, value)


def statistics(raw: DataFrame, inv: DataFrame, det: DataFrame) -> DataFrame:
    totals = table_totals(raw, inv, det).fillna(0, ["invoice_value"])
    labels = {
        "extractions": "Total Files Processed", "successful": "Successful Extractions",
        "failed": "Failed Extractions", "invoices": "Total Invoices",
        "line_items": "Total Line Items", "invoice_value": "Total Invoice Amount",
    }
    return as_rows(totals, labels, "metric", "value", MONEY)


def checklist(files: DataFrame, raw: DataFrame, inv: DataFrame, det: DataFrame) -> DataFrame:
    totals = beside(table_totals(raw, inv, det), file_count(files))
    labels = {
        "files": "Files in Stage", "extractions": "Extractions in raw_json",
        "successful": "Successful Extractions", "failed": "Failed Extractions",
        "invoices": "Invoices Created", "line_items": "Line Items Created",
    }
    return as_rows(totals, labels, "check_item", "count", "bigint")


def completeness(files: DataFrame, raw: DataFrame, inv: DataFrame, det: DataFrame) -> DataFrame:
    t = beside(table_totals(raw, inv, det), file_count(files))
    return t.select(
        F.col("files").alias("files_in_stage"), "extractions", "invoices", "line_items",
        F.when(F.col("files") == F.col("successful"), "✓ All files extracted")
        .otherwise("✗ Some files not extracted").alias("extraction_status"),
        F.when(F.col("successful") == F.col("invoices"), "✓ All extractions parsed")
        .otherwise("✗ Some extractions not parsed").alias("parsing_status"),
    )


def health_report(files: DataFrame, raw: DataFrame, inv: DataFrame, det: DataFrame, as_of: str) -> DataFrame:
    t = beside(table_totals(raw, inv, det), file_count(files))
    return t.select(
        at(as_of).alias("report_time"), F.col("files").alias("total_files"),
        F.col("extractions").alias("total_extractions"),
        F.col("successful").alias("successful_extractions"),
        F.col("failed").alias("failed_extractions"), F.col("invoices").alias("total_invoices"),
        F.col("line_items").alias("total_line_items"), "avg_invoice_amount",
        F.col("invoice_value").alias("total_invoice_value"),
        F.when(F.col("failed") == 0, "✓ HEALTHY").otherwise("⚠ NEEDS ATTENTION").alias("pipeline_status"),
    )


def info_rows(sections: list[tuple[str, DataFrame]]) -> DataFrame:
    """Stacked one-row reports of different width, missing columns NULL."""
    out = None
    for label, df in sections:
        part = df.select(F.lit(label).alias("section"), "*")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out

