"""Reviewed documents: corrections, change counts, saving header and lines as a unit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from docflow.functions.casts import clean_money, safe_date
from docflow.operators.normalize import APP_MONEY, APP_TEXT, drop_empty_lines
from docflow.schemas import APP_DETAIL, APP_HEADER
from docflow.session import cut_lineage
from docflow.sources.keys import uuid_key
from docflow.sources.tables import conform

HEADER_FIELDS = APP_TEXT + APP_MONEY
DETAIL_FIELDS = ["Description", "Quantity", "LineTotal"]


def _latest_set(field: str) -> Column:
    """Newest value set for ``field``; a plain aggregate, so it is reduced before the shuffle."""
    hit = F.when(F.col("field") == field, F.struct("changed_at", "seq"))
    return F.max_by("value", hit).alias(f"_{field}")


def _overlay(df: DataFrame, edits: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    kept = [c for c in df.columns if c not in fields]
    return df.join(edits, keys, "left").select(
        *kept, *[F.coalesce(f"_{f}", f).alias(f) for f in fields]
    )


def apply_corrections(
    header: DataFrame, detail: DataFrame, corrections: DataFrame, key: str = "doc_id"
) -> tuple[DataFrame, DataFrame]:
    """Header and lines after all corrections.

    Lines are named by ``line_id``: the original line number, or for an added line the id
    its ``add`` row carries. ``pop`` and ``remove`` name the line they take away; the last
    line of a document is never taken away. Line numbers do not move on removal.
    """
    sets = corrections.filter(F.col("op") == "set")
    head_edits = sets.filter(F.col("scope") == "header").groupBy(key).agg(*map(_latest_set, HEADER_FIELDS))
    line_edits = (
        sets.filter(F.col("scope") == "detail").groupBy(key, "line_id").agg(*map(_latest_set, DETAIL_FIELDS))
    )
    lines = detail
    if "line_id" not in detail.columns:
        lines = detail.withColumn("line_id", F.col("LineNumber").cast("string"))
    steps = line_steps(lines, corrections, key)
    added = steps.filter("op = 'add'").select(
        key, F.col("line_count").alias("LineNumber"), F.lit("").alias("Description"),
        F.lit("0").alias("Quantity"), F.lit("").alias("LineTotal"), "line_id",
    )
    gone = steps.filter("op = 'remove' AND NOT refused").select(key, "line_id")
    remaining = lines.unionByName(added).join(gone, [key, "line_id"], "left_anti")
    return (
        _overlay(header, head_edits, [key], HEADER_FIELDS),
        _overlay(remaining, line_edits, [key, "line_id"], DETAIL_FIELDS),
    )


def line_steps(lines: DataFrame, corrections: DataFrame, key: str = "doc_id") -> DataFrame:
    """Adds and removals in order, each with the line count after it and whether it was refused.

    A removal is refused when it would leave no line, so the count is a walk held at one:
    count = free walk + number of refusals so far, and the refusals so far are the furthest
    the free walk went below one. Rows are range-partitioned by document and time, so the
    steps of one document may lie in many partitions; per-partition sums and maxima carry
    the walk across them.
    """
    moves = corrections.filter("scope = 'detail' AND op IN ('add', 'pop', 'remove')").select(
        key, "line_id", F.when(F.col("op") == "add", "add").otherwise("remove").alias("op"), "changed_at", "seq"
    )
    # A line goes at most once: its earliest removal counts, also when that one is refused.
    once = moves.groupBy(key, "line_id", "op").agg(F.min(F.struct("changed_at", "seq")).alias("t")).select(
        key, "line_id", "op", "t.changed_at", "t.seq"
    )
    order = [key, "changed_at", "seq", "line_id"]
    placed = cut_lineage(once.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    step = F.when(F.col("op") == "add", 1).otherwise(-1)
    inside = Window.partitionBy(key, "_part").orderBy(*order[1:])
    rows = placed.withColumn("_walk", F.sum(step).over(inside)).withColumn("_low", F.max(-F.col("_walk")).over(inside))
    across = Window.partitionBy(key).orderBy("_part")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per document and partition.
    parts = (
        rows.groupBy(key, "_part").agg(F.max("_low").alias("_low"), F.sum(step).alias("_sum"))
        .withColumn("_start", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        .withColumn("_seen", F.max(F.col("_low") - F.col("_start")).over(before))
        .select(key, "_part", "_start", "_seen")
    )
    counts = lines.join(placed.select(key).distinct(), key, "left_semi").groupBy(key).agg(F.count("*").alias("_n"))
    earlier = F.lag("_low").over(inside)
    joined = rows.withColumn("_prev", earlier).join(parts, [key, "_part"]).join(counts, key, "left")
    n = F.coalesce("_n", F.lit(0))

    def shortfall(low: Column) -> Column:
        return F.greatest(F.lit(0), 1 - n + low)

    was = F.greatest(shortfall(F.col("_seen")), shortfall(F.col("_prev") - F.col("_start")))
    now = F.greatest(was, shortfall(F.col("_low") - F.col("_start")))
    return joined.select(
        key, "line_id", "op",
        (n + F.col("_start") + F.col("_walk") + now).cast("bigint").alias("line_count"),
        ((F.col("op") == "remove") & (now > was)).alias("refused"),
    )


def change_summary(corrections: DataFrame, key: str = "doc_id") -> DataFrame:
    """Changed header fields and changed lines per document, each counted once."""
    is_header = F.col("scope") == "header"
    what = F.when(is_header, F.col("field")).otherwise(F.col("line_id")).alias("what")
    changed = corrections.filter(F.col("op") == "set").groupBy(key, "scope", what).agg(F.lit(1).alias("one"))
    return changed.groupBy(key).agg(
        F.count_if(is_header).alias("total_header_changes"),
        F.count_if(~is_header).alias("total_detail_changes"),
    )


def latest_changes(corrections: DataFrame, key: str = "doc_id") -> DataFrame:
    """The value each changed field ended with, one row per field."""
    return corrections.filter(F.col("op") == "set").groupBy(key, "scope", "line_id", "field").agg(
        F.max_by("value", F.struct("changed_at", "seq")).alias("value"),
        F.count("*").alias("times_changed"),
    )


def reviewed_rows(
    header: DataFrame, detail: DataFrame, preserve_cents: bool = False, key: str = "doc_id"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows to save, and documents whose date is neither blank nor ISO, which are not saved."""
    day = F.trim(F.coalesce("InvoiceDate", F.lit("")))
    dated = header.withColumn("invoice_date", safe_date(day)).withColumn(
        "_bad", (day != "") & F.col("invoice_date").isNull()
    )
    good = dated.filter(~F.col("_bad"))
    failed = dated.filter("_bad").select(key, F.concat(F.lit("not a date: "), day).alias("error"))
    blank = F.lit("")
    ids = uuid_key(F.col(key)).alias("invoice_id")
    head = good.select(
        ids, F.coalesce("VendorName", blank).alias("vendor_name"), F.coalesce("InvoiceNo", blank).alias("invoice_no"),
        F.coalesce("PurchaseOrderNo", blank).alias("purchase_order_no"), "invoice_date",
        clean_money(F.col("InvoiceSubtotal")).alias("invoice_subtotal"),
        clean_money(F.col("InvoiceTaxAmount")).alias("invoice_tax_amount"),
        clean_money(F.col("InvoiceTotal")).alias("invoice_total"),
        clean_money(F.col("DepositCreditAmount")).alias("deposit_credit_amount"),
        *(["uploaded_file_path"] if "uploaded_file_path" in header.columns else []),
    )
    line_key = F.col("line_id") if "line_id" in detail.columns else F.col("LineNumber").cast("string")
    kept = drop_empty_lines(detail).join(failed.select(key), key, "left_anti")
    quantity, total = clean_money(F.col("Quantity"), 18, 4), clean_money(F.col("LineTotal"))
    lines = kept.select(
        uuid_key(F.col(key), line_key).alias("detail_id"), ids,
        F.coalesce("LineNumber", F.lit(0)).alias("line_item_number"),
        F.trim(F.coalesce("Description", blank)).alias("item_description"),
        quantity.alias("quantity"), total.alias("line_total"),
    )
    if preserve_cents:
        lines = lines.withColumn("line_item_number", F.col("line_item_number").cast("decimal(38,0)"))
    else:
        lines = conform(lines, APP_DETAIL)
    return conform(head, APP_HEADER), lines, failed


def save_reviewed(
    header: DataFrame, detail: DataFrame, path: str, commit_id: str, preserve_cents: bool = False
) -> DataFrame:
    """Write header and lines, then the commit row that makes both visible; gives the failed documents.

    Running the same commit again replaces its own folders only.
    """
    spark = header.sparkSession
    head, lines, failed = reviewed_rows(header, detail, preserve_cents)
    head.write.mode("overwrite").parquet(f"{path}/header/commit_id={commit_id}")
    lines.write.mode("overwrite").parquet(f"{path}/detail/commit_id={commit_id}")
    spark.createDataFrame([(commit_id,)], "commit_id STRING").write.mode("overwrite").parquet(
        f"{path}/commits/{commit_id}"
    )
    return failed


def read_reviewed(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Committed headers and lines only."""
    commits = spark.read.schema("commit_id STRING").option("recursiveFileLookup", True).parquet(f"{path}/commits")

    def committed(name: str) -> DataFrame:
        stored = spark.read.parquet(f"{path}/{name}").withColumn("commit_id", F.col("commit_id").cast("string"))
        return stored.join(commits, "commit_id", "left_semi").drop("commit_id")

    return committed("header"), committed("detail")
