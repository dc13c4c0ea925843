"""Data-quality checks, reconciliation and duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from docflow.functions.casts import ago, at, clean_money
from docflow.functions.variants import line_item_count, text_at, texts_at
from docflow.operators.analytics import beside
from docflow.operators.normalize import begins, successful, with_content
from docflow.operators.views import line_stats
from docflow.schemas import LENGTHS

# Rows of a micro-batch whose numbers may be sent to every task.
BROADCAST_ROWS = 200_000


def missing_fields(inv: DataFrame) -> DataFrame:
    required = ["invoice_number", "invoice_date", "vendor_name", "total_amount"]
    issue = F.coalesce(*[F.when(F.col(c).isNull(), f"Missing {c}") for c in required])
    return inv.select("invoice_id", "invoice_number", issue.alias("data_issue")).filter(
        F.col("data_issue").isNotNull()
    )


def invalid_numbers(inv: DataFrame) -> DataFrame:
    bad = (F.col("total_amount") <= 0) | (F.col("subtotal") < 0) | (F.col("tax_amount") < 0)
    return inv.filter(bad).select("invoice_id", "invoice_number", "total_amount", "subtotal", "tax_amount")


def invalid_dates(inv: DataFrame, as_of: str) -> DataFrame:
    bad = (F.col("invoice_date") > F.lit(as_of).cast("date")) | (F.col("due_date") < F.col("invoice_date"))
    return inv.filter(bad).select("invoice_id", "invoice_number", "invoice_date", "due_date")


def orphan_lines(det: DataFrame, inv: DataFrame) -> DataFrame:
    """Lines are counted per invoice id before the join, so a hot id is one row."""
    per_invoice = det.groupBy("invoice_id").agg(F.count("*").alias("n"))
    orphans = per_invoice.join(inv.select("invoice_id"), "invoice_id", "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("count"))


def total_mismatch(inv: DataFrame, det: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """Subtotal against the sum of the lines; invoices without subtotal or lines drop out."""
    sums = line_stats(det).select("invoice_id", F.col("line_total").alias("detail_total"))
    variance = F.abs(F.col("invoice_subtotal") - F.col("detail_total")).cast("decimal(38,2)")
    return (
        inv.select("invoice_id", "invoice_number", F.col("subtotal").alias("invoice_subtotal"))
        .join(sums, "invoice_id")
        .withColumn("variance", variance)
        .filter(F.col("variance") > F.lit(tolerance).cast("decimal(18,4)"))
    )


def check_totals(header: DataFrame, detail: DataFrame, key: str = "doc_id") -> DataFrame:
    """Sum of the lines, rounded to cents, against the subtotal when it is above zero,
    else the total; the two must be equal."""
    form = "decimal(28,6)"
    zero = F.lit(0).cast(form)

    def amount(name: str) -> Column:
        return clean_money(F.col(name), 28, 6)

    sums = detail.groupBy(key).agg(F.round(F.sum(amount("LineTotal")), 2).cast(form).alias("line_total_sum"))
    use_subtotal = F.col("subtotal") > 0
    return (
        header.select(
            key, F.greatest(amount("InvoiceSubtotal"), zero).alias("subtotal"),
            amount("InvoiceTotal").alias("invoice_total"),
        )
        .join(sums, key, "left")
        .withColumn("line_total_sum", F.coalesce("line_total_sum", zero))
        .withColumn("comparison_total", F.when(use_subtotal, F.col("subtotal")).otherwise(F.col("invoice_total")))
        .withColumn("difference", F.abs(F.col("comparison_total") - F.col("line_total_sum")).cast(form))
        .select(
            key, "line_total_sum", "comparison_total",
            F.when(use_subtotal, "InvoiceSubtotal").otherwise("InvoiceTotal").alias("comparison_field"),
            "subtotal", "invoice_total", "difference", (F.col("difference") == 0).alias("matches"),
            zero.alias("tolerance"),
        )
    )


def json_issues(raw: DataFrame) -> DataFrame:
    """One issue at most per document; lines are counted over all its parts."""
    v = F.col("_v")
    parts = with_content(successful(raw)).select(
        F.col("_parent").alias("extraction_id"),
        F.when(begins(v), F.struct("file_name", text_at(v, "invoice_number").alias("number"))).alias("h"),
        line_item_count(v).alias("n"), F.coalesce(F.size(texts_at(v, "line_items.line_number")), F.lit(0)).alias("numbers"),
        F.try_variant_get(v, "$.line_items", "map<string,variant>").isNotNull().alias("is_object"),
    )
    found = parts.groupBy("extraction_id").agg(
        F.max("h").alias("h"), F.sum("n").alias("n"), F.sum("numbers").alias("numbers"), F.max("is_object").alias("is_object"))
    issue = (
        F.when(F.col("h.number").isNull(), "Missing invoice_number")
        .when(F.col("n").isNull(), "Missing line_items")
        .when(F.col("n") == 0, "Empty line_items")
        .when(F.col("is_object") & (F.col("numbers") < F.col("n")), "Lines without line_number")
    )
    return found.filter("h IS NOT NULL").select(
        "extraction_id", "h.file_name", issue.alias("issue_type")).filter(F.col("issue_type").isNotNull())


def extraction_errors(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("processing_status") == "ERROR").select(
        "extraction_id", "file_name", "error_message", "extraction_timestamp"
    )


def data_quality_issues(inv: DataFrame) -> DataFrame:
    rules = [
        (F.col("invoice_number").isNull(), "Missing invoice number"),
        (F.col("invoice_date").isNull(), "Missing invoice date"),
        (F.col("vendor_name").isNull(), "Missing vendor"),
        (F.col("total_amount").isNull(), "Missing total"),
        (F.col("total_amount") <= 0, "Invalid total amount"),
    ]
    issue = F.coalesce(*[F.when(rule, label) for rule, label in rules])
    return inv.select("invoice_id", "invoice_number", issue.alias("issue")).filter(F.col("issue").isNotNull())


def declared_checks(df: DataFrame, table: str, key: str) -> DataFrame:
    """Over-long values and missing keys per column, one pass; duplicate keys from a count per key."""
    lengths = {c: n for c, n in LENGTHS[table].items() if c in df.columns}
    fields = df.agg(
        *[F.count_if(F.length(c) > n).alias(f"over_length:{c}") for c, n in lengths.items()],
        F.count_if(F.col(key).isNull()).alias(f"null_key:{key}"),
    )
    keys = (
        df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias(f"duplicate_key:{key}"))
    )
    one = beside(fields, keys)
    return one.unpivot([], one.columns, "check_name", "violations")


def duplicate_numbers(inv: DataFrame) -> DataFrame:
    return (
        inv.filter(F.col("invoice_number").isNotNull())
        .groupBy("invoice_number").agg(F.count("*").alias("count"))
        .filter(F.col("count") > 1)
    )


def duplicate_sources(inv: DataFrame, raw: DataFrame) -> DataFrame:
    """Every invoice of a repeated number with the file it came from."""
    dup = inv.join(duplicate_numbers(inv).select("invoice_number"), "invoice_number", "left_semi")
    return dup.select("invoice_number", "invoice_id", "extraction_id", "created_timestamp").join(
        raw.select("extraction_id", "file_name"), "extraction_id"
    ).select("invoice_number", "invoice_id", "extraction_id", "file_name", "created_timestamp")


def duplicate_pairs(inv: DataFrame) -> DataFrame:
    """Invoices of the same number and vendor, each paired with the first of its group.

    Two equal invoices give one pair. A larger group gives one pair per further member,
    not every combination, so the result grows with the table and names every member.
    """
    keys = ["invoice_number", "vendor_name"]
    known = inv.dropna(subset=keys)
    first = known.groupBy(*keys).agg(
        F.min_by(F.struct("invoice_id", "total_amount", "invoice_date"), "invoice_id").alias("f"),
        F.count("*").alias("n"),
    ).filter(F.col("n") > 1)
    return (
        known.select(*keys, F.col("invoice_id").alias("invoice_id_2"))
        .join(first, keys)
        .filter(F.col("f.invoice_id") < F.col("invoice_id_2"))
        .select(
            F.col("f.invoice_id").alias("invoice_id_1"), "invoice_id_2", *keys,
            F.col("f.total_amount").alias("total_amount"), F.col("f.invoice_date").alias("invoice_date"),
        )
    )


def latest_invoices(inv: DataFrame, null_keys: str = "keep") -> DataFrame:
    """Newest row per invoice number, ties to the higher id.

    Each map task passes on one row per number (a partial group limit), so a number that
    fills a third of the table does not reach one reducer whole. ``keep`` leaves rows
    without a number alone; ``collapse`` treats them as one group.
    """
    if null_keys not in ("keep", "collapse"):
        raise ValueError("null_keys is 'keep' or 'collapse'")
    # With "keep" a row without a number is a group of its own.
    own = F.when(F.col("invoice_number").isNull(), F.col("invoice_id")) if null_keys == "keep" else F.lit(None)
    newest = Window.partitionBy("invoice_number", "_own").orderBy(
        F.col("created_timestamp").desc_nulls_last(), F.col("invoice_id").desc()
    )
    ranked = inv.withColumn("_own", own.cast("bigint")).withColumn("rn", F.row_number().over(newest))
    return ranked.filter("rn = 1").drop("rn", "_own")


def dedupe_latest(inv: DataFrame, det: DataFrame, null_keys: str = "keep") -> tuple[DataFrame, DataFrame]:
    kept = latest_invoices(inv, null_keys)
    dropped = inv.select("invoice_id").join(kept.select("invoice_id"), "invoice_id", "left_anti")
    return kept, det.join(dropped, "invoice_id", "left_anti")


def new_invoices(
    batch: DataFrame, stored: DataFrame, key: str = "invoice_number", batch_rows: int | None = None
) -> DataFrame:
    """Batch rows whose number is not stored yet, one per number inside the batch.

    With ``batch_rows`` given and small, the batch's numbers are sent to the stored table,
    which is then read but not shuffled.
    """
    fresh = latest_invoices(batch)
    numbers = fresh.select(key).filter(F.col(key).isNotNull())
    known = stored.select(key).filter(F.col(key).isNotNull())
    if batch_rows is not None and batch_rows <= BROADCAST_ROWS:
        known = known.join(F.broadcast(numbers), key, "left_semi").distinct()
    return fresh.join(known, key, "left_anti")


def log_mismatches(inv: DataFrame, det: DataFrame, as_of: str, hours: int = 1) -> DataFrame:
    """Total mismatches of the last hours as rows of the issue table."""
    window = inv.filter(F.col("created_timestamp") > ago(as_of, "HOUR", hours))
    details = F.concat(
        F.lit("Invoice subtotal: "), F.col("invoice_subtotal").cast("string"),
        F.lit(", Line items total: "), F.col("detail_total").cast("string"),
        F.lit(", Variance: "), F.col("variance").cast("string"),
    )
    return total_mismatch(window, det).select(
        "invoice_id", F.lit("TOTAL_MISMATCH").alias("issue_type"), details.alias("issue_details"),
        at(as_of).alias("detected_timestamp"),
    )
