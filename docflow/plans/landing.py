"""Queries: sources, sinks, keys, and extraction results to tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.functions.casts import clean_money, safe_date, safe_decimal, strict_date
from docflow.functions.variants import as_json, error_object, first_of, line_item_count, text_at, unwrap
from docflow.operators import normalize as n, review
from docflow.operators.extract import FULL, extract_fields
from docflow.plans.fixtures import AS_OF, with_tables
from docflow.plans.registry import query
from docflow.schemas import INVOICE, PARSED, RAW_JSON
from docflow.session import scratch
from docflow.sources import files as fs, keys, tables as st

# ---- files ----------------------------------------------------------------------------


def document_files(t) -> str:
    """Documents as text files, one folder per language and source; size grows with the table."""
    root = scratch(t.spark, "files")
    t.table("documents").select("text", "lang", "source").write.partitionBy("lang", "source").text(root)
    return root


def folder(name: str):
    return F.regexp_extract(name, "^(.*)/[^/]*$", 1).alias("folder")


FOLDERS = """SELECT CONCAT('lang=', lang, '/source=', source) AS folder, CAST(SUM(STRLEN(text) + 1) AS BIGINT) AS bytes
FROM documents GROUP BY 1"""


@query("s1_list_files", FOLDERS)
def _(t):
    listed = fs.list_files(t.spark, document_files(t), "*.txt")
    return listed.groupBy(folder("file_name")).agg(F.sum("file_size").alias("bytes"))


@query("s2_file_type", with_tables("""
SELECT file_name, file_size FROM raw_json WHERE file_name ILIKE '%.pdf'""", "raw_json"))
def _(t):
    return fs.of_type(t.files).select("file_name", "file_size")


@query("s3_read_bytes", """
SELECT CONCAT('lang=', lang, '/source=', source) AS folder, CAST(SUM(LENGTH(text) + 1) AS BIGINT) AS characters FROM documents GROUP BY 1""")
def _(t):
    read = fs.read_files(t.spark, document_files(t), "*.txt")
    return read.groupBy(folder("file_name")).agg(F.sum(F.length(F.decode("content", "UTF-8"))).alias("characters"))


@query("s4_file_url", with_tables("SELECT file_name, 'stage://invoices/' || file_name AS file_url FROM raw_json", "raw_json"))
def _(t):
    return t.files.select("file_name", fs.file_url("stage://invoices/", F.col("file_name")).alias("file_url"))


@query("s5_land_extractions", with_tables(f"""
SELECT r.extraction_id, r.file_name, r.file_size, TIMESTAMP '{AS_OF}' AS extraction_timestamp, 'SUCCESS' AS processing_status,
  i.vendor_name AS vendor FROM raw_json r JOIN invoice i ON r.extraction_id = i.extraction_id""", "raw_json", "invoice"))
def _(t):
    path = scratch(t.spark, "raw_json")
    st.append(st.raw_rows(extract_fields(t.texts, "text", FULL), AS_OF), path)
    stored = n.documents(st.read_table(t.spark, path, RAW_JSON))
    return stored.select(
        "extraction_id", "file_name", "file_size", "extraction_timestamp", "processing_status",
        text_at(F.col("extracted_json"), "vendor").alias("vendor"),
    )


@query("s6_land_documents", with_tables("""
SELECT parsed_id, file_name, file_size, processing_status, extracted_text FROM parsed_invoices""", "parsed_invoices"))
def _(t):
    path = scratch(t.spark, "parsed")
    rows = t.parsed.withColumn("parsed_content", F.to_variant_object(F.struct(F.col("extracted_text").alias("content"))))
    st.append(st.conform(rows, PARSED), path)
    stored = st.read_table(t.spark, path, PARSED)
    return stored.select(
        "parsed_id", "file_name", "file_size", "processing_status", text_at(F.col("parsed_content"), "content").alias("extracted_text")
    )


@query("s7_write_header_and_lines", with_tables("""
SELECT i.invoice_id, i.invoice_number, i.total_amount, COUNT(d.invoice_id) AS lines, CAST(SUM(d.line_amount) AS DECIMAL(38,2)) AS line_total
FROM invoice i LEFT JOIN invoice_detail d ON i.invoice_id = d.invoice_id GROUP BY 1, 2, 3""", "invoice"))
def _(t):
    base = scratch(t.spark, "tables")
    raw_path = f"{base}/raw_json"
    st.append(st.conform(t.raw_json, RAW_JSON), raw_path)
    raw = st.read_table(t.spark, raw_path, RAW_JSON)
    st.append(n.parse_header(raw), f"{base}/invoice")
    st.append(n.parse_lines(raw), f"{base}/invoice_detail")
    lines = t.spark.read.parquet(f"{base}/invoice_detail").groupBy("invoice_id").agg(
        F.count("*").alias("lines"), F.sum("line_amount").cast("decimal(38,2)").alias("line_total"))
    header = t.spark.read.parquet(f"{base}/invoice").select("invoice_id", "invoice_number", "total_amount")
    return header.join(lines, "invoice_id", "left").fillna(0, ["lines"])


UUID = """CONCAT_WS('-', SUBSTR(h, 1, 8), SUBSTR(h, 9, 4), SUBSTR(h, 13, 4), SUBSTR(h, 17, 4), SUBSTR(h, 21, 12))"""


@query("s8_save_reviewed", with_tables(f"""
SELECT {UUID} AS invoice_id, vendor_name, invoice_no, purchase_order_no, invoice_date, invoice_subtotal, invoice_tax_amount,
  invoice_total, deposit_credit_amount FROM (SELECT SHA256(doc_id) AS h, "VendorName" AS vendor_name, "InvoiceNo" AS invoice_no,
  "PurchaseOrderNo" AS purchase_order_no, TRY_CAST(NULLIF("InvoiceDate", '') AS DATE) AS invoice_date,
  CAST(REPLACE("InvoiceSubtotal", '$', '') AS DECIMAL(18,2)) AS invoice_subtotal, CAST(0 AS DECIMAL(18,2)) AS invoice_tax_amount,
  CAST("InvoiceTotal" AS DECIMAL(18,2)) AS invoice_total, CAST(0 AS DECIMAL(18,2)) AS deposit_credit_amount FROM app_header)""", "app_header"))
def _(t):
    path = scratch(t.spark, "reviewed")
    review.save_reviewed(t.app_header, t.app_detail, path, "first")
    return review.read_reviewed(t.spark, path)[0].drop("uploaded_file_path")


@query("s8b_save_reviewed_lines", with_tables(f"""
SELECT {UUID} AS invoice_id, CAST("LineNumber" AS DECIMAL(38,0)) AS line_item_number, "Description" AS item_description,
  CAST(ROUND(CAST("Quantity" AS DECIMAL(18,4)), 0) AS DECIMAL(38,0)) AS quantity,
  CAST(ROUND(CAST(REPLACE("LineTotal", '$', '') AS DECIMAL(18,2)), 0) AS DECIMAL(38,0)) AS line_total
FROM (SELECT SHA256(doc_id) AS h, * FROM app_detail)""", "app_detail"))
def _(t):
    path = scratch(t.spark, "reviewed")
    review.save_reviewed(t.app_header, t.app_detail, path, "first")
    return review.read_reviewed(t.spark, path)[1].drop("detail_id")


@query("s9_dated_path", with_tables("""
SELECT file_name, 'invoices/' || STRFTIME(last_modified, '%m-%d-%Y') || '/' || REGEXP_REPLACE(file_name, '\\.[^.]*$', '') || '_'
  || SUBSTR(SHA256(CAST(extraction_id AS VARCHAR)), 1, 8) || '.' || REGEXP_EXTRACT(file_name, '[^.]*$') AS path FROM raw_json""", "raw_json"))
def _(t):
    return t.raw.select("file_name", keys.unique_path(
        F.col("file_name"), F.col("extraction_id"), F.col("last_modified")).alias("path"))


@query("s10_backup", "SELECT * FROM orders")
def _(t):
    return st.backup(t.table("orders"), scratch(t.spark, "backup"))


@query("s11_reset", with_tables("""
SELECT COUNT(*) AS rows_before, CAST(0 AS BIGINT) AS rows_after FROM invoice""", "invoice"))
def _(t):
    path = scratch(t.spark, "reset")
    st.append(st.conform(t.invoice, INVOICE), path)
    before = t.spark.read.parquet(path).agg(F.count("*").alias("n")).first()["n"]
    st.reset(t.spark, path, INVOICE)
    return t.spark.read.parquet(path).agg(F.lit(before).alias("rows_before"), F.count("*").alias("rows_after"))


# Listings of two days: finished orders have changed, the newest are new, the oldest are gone.
OLD = "last_modified < TIMESTAMP '2000-01-01 00:00:00'"
NEW = "last_modified >= TIMESTAMP '1996-01-01 00:00:00'"


def manifests(t):
    old = t.files.filter(OLD)
    later = F.when(F.col("file_name").endswith(".PDF"), F.col("file_size") + 1).otherwise(F.col("file_size"))
    return old, t.files.filter(NEW).withColumn("file_size", later)


CHANGES = f"""SELECT file_name, file_size, 'DELETE' AS action FROM raw_json WHERE {OLD} AND (NOT ({NEW}) OR file_name LIKE '%.PDF')
UNION ALL SELECT file_name, CASE WHEN file_name LIKE '%.PDF' THEN file_size + 1 ELSE file_size END, 'INSERT' FROM raw_json
WHERE {NEW} AND (NOT ({OLD}) OR file_name LIKE '%.PDF')"""


@query("c2_change_feed", with_tables(CHANGES, "raw_json"))
def _(t):
    return fs.manifest_diff(*manifests(t)).select("file_name", "file_size", "action")


@query("c2b_inserts", with_tables(f"SELECT file_name, file_size FROM ({CHANGES}) WHERE action = 'INSERT'", "raw_json"))
def _(t):
    return fs.inserts(fs.manifest_diff(*manifests(t))).select("file_name", "file_size")


@query("c4_has_new_data", with_tables("""
SELECT COUNT(*) AS new_files, COUNT(*) > 0 AS has_data FROM raw_json WHERE processing_status <> 'SUCCESS'""", "raw_json"))
def _(t):
    waiting = fs.pending(t.files, n.successful(t.raw))
    return waiting.agg(F.count("*").alias("new_files"), (F.count("*") > 0).alias("has_data"))


@query("c7_peek_pending", with_tables("SELECT file_name FROM raw_json WHERE processing_status <> 'SUCCESS'", "raw_json"))
def _(t):
    return fs.pending(t.files, n.successful(t.raw)).select("file_name")


# ---- keys -----------------------------------------------------------------------------


@query("k1_dense_ids", with_tables("""
SELECT invoice_id, invoice_date, ROW_NUMBER() OVER (ORDER BY invoice_date, invoice_id) AS dense_id FROM invoice""", "invoice"))
def _(t):
    return keys.dense_ids(t.invoice.select("invoice_id", "invoice_date"), ["invoice_date", "invoice_id"], "dense_id")


@query("k1b_content_keys", "SELECT COUNT(*) AS rows, COUNT(DISTINCT o_orderkey) AS keys FROM orders")
def _(t):
    keyed = keys.surrogate_key(t.files, ["file_name", "last_modified"], "extraction_id")
    return keyed.agg(F.count("*").alias("rows"), F.count_distinct("extraction_id").alias("keys"))


@query("k2_uuid_keys", f"SELECT o_orderkey, {UUID} AS invoice_id FROM (SELECT o_orderkey, SHA256(CAST(o_orderkey AS VARCHAR)) AS h FROM orders)")
def _(t):
    return t.table("orders").select("o_orderkey", keys.uuid_key(F.col("o_orderkey")).alias("invoice_id"))


@query("k3_parent_links", with_tables("""
SELECT r.extraction_id, MAX(i.invoice_id) AS invoice_id, COUNT(d.invoice_id) AS lines FROM raw_json r
JOIN invoice i ON r.extraction_id = i.extraction_id JOIN invoice_detail d ON d.invoice_id = i.invoice_id GROUP BY 1""", "raw_json", "invoice"))
def _(t):
    lines = n.parse_lines(t.raw_json).groupBy("invoice_id").agg(F.count("*").alias("lines"))
    return n.parse_header(t.raw_json).select("extraction_id", "invoice_id").join(lines, "invoice_id")


# ---- extraction results to tables -----------------------------------------------------


@query("j1_path_access", with_tables("SELECT extraction_id, invoice_number, vendor_name, po_number FROM invoice", "invoice"))
def _(t):
    v = F.col("_v")
    return n.documents(n.successful(t.raw_json)).select(
        "extraction_id", text_at(v, "invoice_number").alias("invoice_number"),
        text_at(v, "vendor.name", "vendor").alias("vendor_name"), text_at(v, "po_number").alias("po_number"),
    )


@query("j2_parse_header", with_tables("""
SELECT i.invoice_id, i.extraction_id, invoice_number, invoice_date, due_date, vendor_name, customer_name, subtotal, tax_amount, tax_rate,
  shipping_amount, discount_amount, total_amount, currency, payment_terms, po_number, NULL::VARCHAR AS vendor_city, NULL::VARCHAR AS notes,
  r.extraction_timestamp AS created_timestamp FROM invoice i JOIN raw_json r ON i.extraction_id = r.extraction_id""", "raw_json", "invoice"))
def _(t):
    return n.parse_header(t.raw_json).select(
        "invoice_id", "extraction_id", "invoice_number", "invoice_date", "due_date", "vendor_name", "customer_name",
        "subtotal", "tax_amount", "tax_rate", "shipping_amount", "discount_amount", "total_amount", "currency",
        "payment_terms", "po_number", "vendor_city", "notes", "created_timestamp",
    )


PARSED_LINES = """SELECT d.invoice_id, d.line_number, d.item_description, d.item_code, d.quantity, d.unit_of_measure, d.unit_price,
  d.line_amount, d.tax_amount, d.category FROM invoice_detail d JOIN invoice i ON d.invoice_id = i.invoice_id"""
LINE_COLUMNS = ["invoice_id", "line_number", "item_description", "item_code", "quantity", "unit_of_measure", "unit_price",
                "line_amount", "tax_amount", "category"]


@query("j3_parse_lines", with_tables(PARSED_LINES, "invoice"))
def _(t):
    return n.parse_lines(t.raw_json).select(*LINE_COLUMNS)


@query("j3b_parse_lines_longest", with_tables(PARSED_LINES, "invoice"))
def _(t):
    return n.parse_lines(t.raw_json, pad="longest").select(*LINE_COLUMNS)


@query("j4_flatten_records", with_tables("""
SELECT i.extraction_id, i.invoice_number, d.item_description, CAST(ROUND(d.quantity, 0) AS DECIMAL(38,0)) AS quantity,
  CAST(ROUND(d.unit_price, 0) AS DECIMAL(38,0)) AS unit_price, CAST(ROUND(d.line_amount, 0) AS DECIMAL(38,0)) AS line_amount
FROM invoice_detail d JOIN invoice i ON d.invoice_id = i.invoice_id""", "invoice"))
def _(t):
    return n.flatten_records(t.raw_records)


@query("j5_flatten_fields", with_tables("""
SELECT r.file_name AS filename, invoice_number, invoice_date, vendor_name, CAST(ROUND(total_amount, 0) AS DECIMAL(38,0)) AS total_amount
FROM invoice i JOIN raw_json r ON i.extraction_id = r.extraction_id""", "raw_json", "invoice"))
def _(t):
    return n.flatten_fields(t.raw_json)


# Date texts in several forms, by order priority; only ISO dates are read.
DATE_TEXT = """CASE SUBSTRING(o_orderpriority, 1, 1) WHEN '1' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
  WHEN '2' THEN STRFTIME(o_orderdate, '%m/%d/%Y') WHEN '3' THEN STRFTIME(o_orderdate, '%Y') WHEN '4' THEN '' ELSE NULL END"""


@query("j6_safe_date", f"""
SELECT o_orderkey, {DATE_TEXT} AS raw_date, CASE WHEN SUBSTRING(o_orderpriority, 1, 1) = '1' THEN CAST(o_orderdate AS DATE) END AS parsed FROM orders""")
def _(t):
    first, day = F.substring("o_orderpriority", 1, 1), F.col("o_orderdate")
    text = (
        F.when(first == "1", F.date_format(day, "yyyy-MM-dd")).when(first == "2", F.date_format(day, "MM/dd/yyyy"))
        .when(first == "3", F.date_format(day, "yyyy")).when(first == "4", "")
    )
    return t.table("orders").select("o_orderkey", text.alias("raw_date"), safe_date(text).alias("parsed"))


@query("j7_strict_date", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS parsed FROM orders""")
def _(t):
    text = F.when(F.col("o_orderstatus") == "P", " ").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.table("orders").select("o_orderkey", strict_date(text).alias("parsed"))


@query("j8_safe_decimal", """
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(ROUND(CAST(o_totalprice AS DECIMAL(18,2)), 0) AS DECIMAL(38,0)) AS whole,
  NULL::DECIMAL(18,2) AS grouped FROM orders""")
def _(t):
    text = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    return t.table("orders").select(
        "o_orderkey", safe_decimal(text, 18, 2).alias("amount"), safe_decimal(text).alias("whole"),
        safe_decimal(F.concat(F.lit("1,"), text), 18, 2).alias("grouped"),
    )


@query("j9_clean_money", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS amount FROM orders""")
def _(t):
    grouped = F.concat(F.lit("$ "), F.format_number(F.col("o_totalprice").cast("decimal(18,2)"), 2))
    text = F.when(F.col("o_orderstatus") == "F", "None").otherwise(grouped)
    return t.table("orders").select("o_orderkey", clean_money(text).alias("amount"))


@query("j10_default_currency", with_tables("SELECT currency, COUNT(*) AS invoices FROM invoice GROUP BY 1", "invoice"))
def _(t):
    return n.parse_header(t.raw_json).groupBy("currency").agg(F.count("*").alias("invoices"))


@query("j11_to_json", """
SELECT event_id, REPLACE(REPLACE(props, ': ', ':'), ', ', ',') AS json_data FROM events""")
def _(t):
    return t.table("events").select("event_id", as_json(F.parse_json("props")).alias("json_data"))


@query("j12_error_object", with_tables("""
SELECT extraction_id, '{"error":"' || error_message || '"}' AS json_data FROM raw_json WHERE processing_status = 'ERROR'""", "raw_json"))
def _(t):
    return t.raw.filter("processing_status = 'ERROR'").select(
        "extraction_id", as_json(error_object(F.col("error_message"))).alias("json_data")
    )


@query("j13_line_item_count", with_tables("""
SELECT i.extraction_id, NULLIF(COUNT(d.invoice_id), 0) AS line_items FROM invoice i
LEFT JOIN invoice_detail d ON d.invoice_id = i.invoice_id GROUP BY 1""", "invoice"))
def _(t):
    return n.line_counts(t.raw_json)


@query("j14_json_structure", with_tables("""
SELECT i.extraction_id, r.file_name, i.invoice_number, CAST(i.invoice_date AS VARCHAR) AS invoice_date, i.vendor_name, i.customer_name,
  CAST(ROUND(i.total_amount, 0) AS DECIMAL(38,0)) AS total_amount, c.line_item_count
FROM invoice i JOIN raw_json r ON i.extraction_id = r.extraction_id
  LEFT JOIN (SELECT invoice_id, COUNT(*) AS line_item_count FROM invoice_detail GROUP BY 1) c ON c.invoice_id = i.invoice_id""",
       "raw_json", "invoice"))
def _(t):
    return n.json_structure(t.raw_json)


@query("j15_business_rule", with_tables("""
SELECT invoice_id, invoice_number, total_amount, total_amount <= 250000 AS accepted FROM invoice""", "invoice"))
def _(t):
    rule = F.col("total_amount") <= 250000
    cols = ["invoice_id", "invoice_number", "total_amount"]
    taken = n.parse_header(t.raw_json, where=rule).select(*cols, F.lit(True).alias("accepted"))
    return taken.unionByName(n.rejected_headers(t.raw_json, rule).select(*cols, F.lit(False).alias("accepted")))


@query("j16_drop_empty_lines", with_tables("""
SELECT doc_id, line_id, "Description" FROM (SELECT d.doc_id, d.line_id, d."Description", l_returnflag
  FROM app_detail d JOIN changed ON CAST(l_id AS VARCHAR) = d.line_id) WHERE l_returnflag <> 'N'""", "app_detail", "changed"))
def _(t):
    # Lines not yet returned or accepted come without content, as blank form rows do.
    from docflow.plans.fixtures import line_id

    flags = t.table("lineitem").select(line_id().cast("string").alias("line_id"), "l_returnflag")
    blank = F.col("l_returnflag") == "N"
    form = t.app_detail.join(flags, "line_id").select(
        "doc_id", "line_id", *[F.when(~blank, F.col(c)).otherwise(v).alias(c)
                               for c, v in (("Description", " "), ("Quantity", "0"), ("LineTotal", ""))])
    return n.drop_empty_lines(form).select("doc_id", "line_id", "Description")


@query("n12_lateral_lines", with_tables("""
SELECT i.extraction_id, COUNT(d.invoice_id) AS records, CAST(SUM(d.line_amount) AS DECIMAL(38,2)) AS total
FROM invoice i JOIN invoice_detail d ON d.invoice_id = i.invoice_id GROUP BY 1""", "invoice"))
def _(t):
    records = F.try_variant_get(F.col("_v"), "$.line_items", "array<variant>")
    items = n.with_content(t.raw_records).select(F.col("_parent").alias("extraction_id"), F.explode(records).alias("item"))
    amount = safe_decimal(text_at(F.col("item"), "line_amount"), 18, 2)
    return items.groupBy("extraction_id").agg(F.count("*").alias("records"), F.sum(amount).cast("decimal(38,2)").alias("total"))


@query("x2_table_function", """
SELECT event_id, REGEXP_EXTRACT(props, '"([^"]+)"', 1) AS key, REGEXP_EXTRACT(props, ': *([0-9]+)', 1) AS value FROM events""")
def _(t):
    events = t.table("events").select("event_id", F.parse_json("props").alias("v"))
    events.createOrReplaceTempView("docflow_events")
    return t.spark.sql("SELECT event_id, e.key, CAST(e.value AS STRING) AS value FROM docflow_events, LATERAL variant_explode(v) AS e")


@query("e6_normalize_response", with_tables("""
SELECT extraction_id, currency <> 'EUR' AND payment_terms <> 'Net 30' AS in_envelope, po_number FROM invoice""", "invoice"))
def _(t):
    v = F.col("extracted_json")
    return n.documents(n.successful(t.raw_json)).select(
        "extraction_id", F.try_variant_get(v, "$.response", "variant").isNotNull().alias("in_envelope"),
        text_at(unwrap(v), "po_number").alias("po_number"),
    )


@query("e10_fallback_fields", with_tables("""
SELECT extraction_id, COALESCE(invoice_number, po_number, 'UNKNOWN') AS reference FROM invoice""", "invoice"))
def _(t):
    return n.documents(n.successful(t.raw_json)).select(
        "extraction_id", first_of(F.col("_v"), "invoice_number", "po_number").alias("reference")
    )


@query("e11_validation_status", with_tables("""
SELECT extraction_id, CASE WHEN invoice_number IS NULL THEN 'Missing invoice number' WHEN total_amount IS NULL THEN 'Missing total'
  WHEN total_amount <= 0 THEN 'Invalid total' ELSE 'Valid' END AS validation_status FROM invoice""", "invoice"))
def _(t):
    return n.documents(n.successful(t.raw_json)).select("extraction_id", n.validation_status(F.col("_v")).alias("validation_status"))


@query("e12_split_header", with_tables("""
SELECT CAST(invoice_id AS VARCHAR) AS doc_id, vendor_name AS "VendorName", COALESCE(invoice_number, '') AS "InvoiceNo",
  po_number AS "PurchaseOrderNo", CAST(invoice_date AS VARCHAR) AS "InvoiceDate", COALESCE(CAST(subtotal AS VARCHAR), '0') AS "InvoiceSubtotal",
  CAST(tax_amount AS VARCHAR) AS "InvoiceTaxAmount", CAST(total_amount AS VARCHAR) AS "InvoiceTotal", '0' AS "DepositCreditAmount" FROM invoice""", "invoice"))
def _(t):
    return n.split_header_detail(t.app_responses)[0]


@query("e12b_split_detail", with_tables("""
SELECT CAST(d.invoice_id AS VARCHAR) AS doc_id, ROW_NUMBER() OVER w AS "LineNumber",
  CASE WHEN i.payment_terms = 'Net 30' AND COUNT(*) OVER (PARTITION BY d.invoice_id) = ROW_NUMBER() OVER w THEN '' ELSE item_description END AS "Description",
  CAST(quantity AS VARCHAR) AS "Quantity", CAST(line_amount AS VARCHAR) AS "LineTotal"
FROM invoice_detail d JOIN invoice i ON d.invoice_id = i.invoice_id
WINDOW w AS (PARTITION BY d.invoice_id ORDER BY line_number, invoice_detail_id)""", "invoice"))
def _(t):
    return n.split_header_detail(t.app_responses)[1]
