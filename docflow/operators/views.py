"""Report views over the landing, header and line tables. Views are unsorted; callers sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docflow.functions.casts import ago, status_icon


def line_stats(det: DataFrame) -> DataFrame:
    """Lines per invoice, reduced before any join so that headers never fan out.

    Rows are counted instead of line ids, which are never NULL, so the ids are not read.
    """
    return det.groupBy("invoice_id").agg(
        F.count("*").alias("line_count"),
        F.sum("line_amount").cast("decimal(38,2)").alias("line_total"),
    )


def invoice_detail_view(inv: DataFrame, det: DataFrame) -> DataFrame:
    header = inv.select(
        "invoice_id", "invoice_number", "invoice_date", "vendor_name", "customer_name",
        F.col("total_amount").alias("invoice_total"),
    )
    line = det.select(
        "invoice_id", "line_number", "item_description", "item_code", "quantity",
        "unit_of_measure", "unit_price", "line_amount", "category",
    )
    return line.join(header, "invoice_id").select(
        "invoice_number", "invoice_date", "vendor_name", "customer_name", "invoice_total",
        "line_number", "item_description", "item_code", "quantity", "unit_of_measure",
        "unit_price", "line_amount", "category",
    )


def monitoring(raw: DataFrame, inv: DataFrame, det: DataFrame) -> DataFrame:
    """Every extraction with its invoice, if any, and the number of lines."""
    landed = raw.select(
        "extraction_id", "file_name", "extraction_timestamp", "processing_status", "error_message"
    )
    header = inv.select(
        "extraction_id", "invoice_id", "invoice_number", "vendor_name", "customer_name",
        "invoice_date", "total_amount", "currency",
    )
    counts = line_stats(det).select("invoice_id", F.col("line_count").alias("line_item_count"))
    return (
        landed.join(header, "extraction_id", "left")
        .join(counts, "invoice_id", "left")
        .select(
            *landed.columns, *[c for c in header.columns if c != "extraction_id"],
            F.coalesce("line_item_count", F.lit(0)).alias("line_item_count"),
        )
    )


def file_trace(files: DataFrame, raw: DataFrame, inv: DataFrame, det: DataFrame) -> DataFrame:
    """From each listed PDF to its extraction, invoice and number of lines."""
    listed = files.filter(F.col("file_name").ilike("%.pdf")).select(
        F.col("file_name").alias("original_file")
    )
    landed = raw.select("extraction_id", "file_name", "extraction_timestamp", "processing_status")
    header = inv.select("extraction_id", "invoice_id", "invoice_number")
    counts = line_stats(det).select("invoice_id", F.col("line_count").alias("line_items"))
    return (
        listed.join(landed, F.col("original_file") == F.col("file_name"), "left")
        .join(header, "extraction_id", "left")
        .join(counts, "invoice_id", "left")
        .select(
            "original_file", "extraction_id", "file_name", "extraction_timestamp",
            "processing_status", "invoice_id", "invoice_number",
            F.coalesce("line_items", F.lit(0)).alias("line_items"),
        )
    )


def invoice_summary(inv: DataFrame, det: DataFrame) -> DataFrame:
    return inv.join(line_stats(det), "invoice_id", "left").select(
        "invoice_id", "invoice_number", "invoice_date", "due_date", "vendor_name", "customer_name",
        "subtotal", "tax_amount", "shipping_amount", "total_amount", "currency", "payment_terms",
        F.coalesce("line_count", F.lit(0)).alias("total_line_items"),
        F.col("line_total").alias("line_items_total"), "created_timestamp",
    )


def header_line_counts(inv: DataFrame, det: DataFrame) -> DataFrame:
    return inv.join(line_stats(det), "invoice_id", "left").select(
        "invoice_id", "invoice_number", F.coalesce("line_count", F.lit(0)).alias("line_item_count")
    )


def extraction_links(raw: DataFrame, inv: DataFrame) -> DataFrame:
    landed = raw.filter(F.col("processing_status") == "SUCCESS").select("extraction_id", "file_name")
    return landed.join(
        inv.select("extraction_id", "invoice_id", "invoice_number"), "extraction_id", "left"
    )


def search_monitoring(parsed: DataFrame) -> DataFrame:
    return parsed.select(
        "parsed_id", "file_name", "file_size", "parse_timestamp", "processing_status",
        "error_message", status_icon(F.col("processing_status")).alias("status_icon"),
    )


def recent(df: DataFrame, ts: str, as_of: str, unit: str = "HOUR", n: int = 24) -> DataFrame:
    return df.filter(F.col(ts) > ago(as_of, unit, n))
