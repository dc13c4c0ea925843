"""Queries: incremental jobs, each run to the end of the data it finds."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, functions as F

from docflow.functions.variants import text_at
from docflow.operators import stored_index as si
from docflow.operators.extract import FULL
from docflow.operators.normalize import parse_header, parse_lines
from docflow.operators.views import invoice_summary
from docflow.plans.documents import PAGES_SQL
from docflow.plans.fixtures import AS_OF, with_tables
from docflow.plans.registry import query
from docflow.plans.search import HIT, TEXT, one, scored
from docflow.schemas import INVOICE, PARSED, RAW_JSON
from docflow.session import MANY_FILES, PACKED, RELEASED, discard, scratch, settings
from docflow.sources import batches, files as fs, tables as st
from docflow.sources.keys import POSITION_BITS
from docflow.streaming import jobs


def feed(t, df, name: str, spread: bool = False) -> str:
    """A table written as files for a stream to find; ``spread``: as many as the cluster has cores."""
    path = scratch(t.spark, name)
    with settings(t.spark, RELEASED):
        (df.repartition(t.spark.sparkContext.defaultParallelism) if spread else df).write.option("compression", PACKED).parquet(path)
    return path


def landed(t) -> str:
    path = scratch(t.spark, "raw_json")
    with settings(t.spark, RELEASED):
        for part in t.slices():
            st.conform(part.raw_json, RAW_JSON).write.mode("append").option("compression", PACKED).parquet(path)
    return path


# Each task puts its files in place when it ends; by default the driver moves all of them, one by one, at the end.
IN_PLACE = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def statements(t) -> str:
    """One text file per vendor with its invoice total, all in one folder."""
    root = scratch(t.spark, "statements")
    per = t.invoice.groupBy("vendor_name").agg(F.sum("total_amount").cast("decimal(38,2)").alias("total"))
    text = F.concat(
        F.lit("Invoice Number: STATEMENT "), F.substring("vendor_name", -9, 9), F.lit("\nVendor: "), "vendor_name",
        F.lit("\nTotal Amount: "), F.col("total").cast("string"),
    )
    per.select(text.alias("value")).write.options(**IN_PLACE).option("maxRecordsPerFile", 1).text(root)
    return root


STATEMENTS = """SELECT vendor_name, 'STATEMENT ' || RIGHT(vendor_name, 9) AS invoice_number, CAST(SUM(total_amount) AS VARCHAR) AS total_amount,
  'SUCCESS' AS processing_status FROM invoice GROUP BY 1, 2"""


@query("t1_extract_stream", with_tables(STATEMENTS, "invoice"))
def _(t):
    base, files = scratch(t.spark, "t1"), statements(t)
    jobs.run_once([lambda: jobs.start_extract_stream(
        t.spark, files, f"{base}/raw", f"{base}/checkpoint", FULL, pattern="*.txt", as_of=AS_OF)])
    v = F.col("extracted_json")
    return t.spark.read.parquet(f"{base}/raw").select(
        text_at(v, "vendor").alias("vendor_name"), text_at(v, "invoice_number").alias("invoice_number"),
        text_at(v, "total_amount").alias("total_amount"), "processing_status",
    )


TABLES_SQL = with_tables("""
SELECT i.invoice_id, i.invoice_number, i.total_amount, COUNT(d.invoice_id) AS total_line_items,
  CAST(SUM(d.line_amount) AS DECIMAL(38,2)) AS line_items_total
FROM invoice i LEFT JOIN invoice_detail d ON i.invoice_id = d.invoice_id GROUP BY 1, 2, 3""", "invoice")


def summary_of(t, path: str):
    inv, det = jobs.read_tables(t.spark, path)
    return invoice_summary(inv, det).select("invoice_id", "invoice_number", "total_amount", "total_line_items", "line_items_total")


SEPARATOR = "\n=====\n"
FILES = 4


def deal(t, path: str, kind: str, **options: str) -> str:
    """All invoices as documents, dealt to folders ``file=0`` and on. The texts are not shuffled; equal ones, which share a
    key within a file, are spread evenly."""
    position = F.monotonically_increasing_id().bitwiseAND((1 << POSITION_BITS) - 1)
    with settings(t.spark, RELEASED | {"spark.sql.maxConcurrentOutputFileWriters": str(FILES)}):
        for part in t.slices():
            dealt = part.texts.select("text").sortWithinPartitions(F.xxhash64("text")).withColumn("file", position % FILES)
            dealt.write.mode("append").partitionBy("file").format(kind).options(**options).save(path)
    return path


def document_files(t) -> str:
    """All invoices as documents, many to a file; what one task packs is small enough to be read by one."""
    return deal(t, scratch(t.spark, "documents"), "text", lineSep=SEPARATOR, compression="gzip")


def large_files(t, spool: str, path: str, numbers) -> None:
    """Of the documents dealt as ``spool`` a file for each number, which can be read in parts."""
    found = t.spark.read.schema("text STRING, file INT").parquet(spool)
    each = [found.filter(F.col("file") == i).select("text").coalesce(1) for i in numbers]
    with settings(t.spark, {"spark.sql.unionOutputPartitioning": "false"}):  # else the single partitions become one
        reduce(DataFrame.unionAll, each).write.option("lineSep", SEPARATOR).text(path)


# Documents and lines by vendor, from the files of many documents.
BY_VENDOR = """
SELECT vendor_name, COUNT(*) AS documents, CAST(SUM(n) AS BIGINT) AS lines, CAST(SUM(total_amount) AS DECIMAL(38,2)) AS total_amount,
  CAST(SUM(amount) AS DECIMAL(38,2)) AS line_amount
FROM invoice i LEFT JOIN (SELECT invoice_id, COUNT(*) AS n, SUM(line_amount) AS amount FROM invoice_detail GROUP BY 1) d ON d.invoice_id = i.invoice_id
GROUP BY 1"""


def by_vendor(inv, det):
    lines = det.groupBy("invoice_id").agg(F.count("*").alias("n"), F.sum("line_amount").alias("amount"))
    return inv.join(lines, "invoice_id", "left").groupBy("vendor_name").agg(
        F.count("*").alias("documents"), F.sum("n").alias("lines"), F.sum("total_amount").cast("decimal(38,2)").alias("total_amount"),
        F.sum("amount").cast("decimal(38,2)").alias("line_amount"))


@query("t1b_documents_in_files", with_tables(BY_VENDOR, "invoice"))
def _(t):
    base, files = scratch(t.spark, "t1b"), document_files(t)
    jobs.run_once([lambda: jobs.start_extract_stream(
        t.spark, files, f"{base}/raw", f"{base}/checkpoint", FULL, pattern="*.txt.gz", as_of=AS_OF, separator=SEPARATOR)])
    discard(t.spark, files)
    raw = st.read_table(t.spark, f"{base}/raw", RAW_JSON)
    return by_vendor(parse_header(raw), parse_lines(raw))


@query("t4b_run_all_with_lines", with_tables(BY_VENDOR, "invoice"))
def _(t):
    base, files = scratch(t.spark, "t4b"), scratch(t.spark, "documents")
    spool = deal(t, scratch(t.spark, "spool"), "parquet", compression=PACKED)
    for first in range(0, FILES, 2):
        # Files come as many at a time as a batch takes; those that were read are removed.
        pair = range(first, first + 2)
        large_files(t, spool, files, pair)
        for i in pair:
            discard(t.spark, f"{spool}/file={i}")
        jobs.run_once([lambda: jobs.start_extract_stream(
            t.spark, files, f"{base}/raw", f"{base}/c1", FULL, pattern="*.txt", max_files=2, as_of=AS_OF, separator=SEPARATOR)])
        discard(t.spark, files)
    jobs.run_once([lambda: jobs.start_parse_stream(
        st.stream_table(t.spark, f"{base}/raw", RAW_JSON, max_files=4), f"{base}/tables", f"{base}/c2", vacuum=True)])
    discard(t.spark, f"{base}/raw")
    return by_vendor(*jobs.read_tables(t.spark, f"{base}/tables"))


@query("s5b_land_with_dense_ids", with_tables("""
SELECT COUNT(DISTINCT vendor_name) AS documents, COUNT(DISTINCT vendor_name) AS ids, CAST(1 AS BIGINT) AS first_id,
  COUNT(DISTINCT vendor_name) AS last_id, COUNT(DISTINCT vendor_name) AS refused FROM invoice""", "invoice"))
def _(t):
    base, files = scratch(t.spark, "s5b"), statements(t)
    # With a new checkpoint the stream reads the files again; what landed before is refused.
    with settings(t.spark, MANY_FILES):
        for run in ("first", "second"):  # the first run's list of files is not held during the second
            jobs.run_once([lambda: jobs.start_landing_stream(
                t.spark, files, f"{base}/store", f"{base}/{run}", FULL, pattern="*.txt", as_of=AS_OF)])
    raw, refused = jobs.read_landed(t.spark, f"{base}/store")
    counts = raw.agg(F.count("*").alias("documents"), F.count_distinct("extraction_id").alias("ids"),
                     F.min("extraction_id").alias("first_id"), F.max("extraction_id").alias("last_id"))
    return counts.withColumn("refused", refused.agg(F.count("*")).scalar())


@query("t2_parse_stream", TABLES_SQL)
def _(t):
    base, path = scratch(t.spark, "t2"), landed(t)
    raw = st.stream_table(t.spark, path, RAW_JSON)
    jobs.run_once([lambda: jobs.start_parse_stream(raw, f"{base}/tables", f"{base}/checkpoint")])
    discard(t.spark, path)
    return summary_of(t, f"{base}/tables")


@query("t3_document_stream", PAGES_SQL + """
SELECT page_id, ARRAY_TO_STRING(LIST_TRANSFORM(b, lambda x: x.text), CHR(10)) AS extracted_text, 'SUCCESS' AS processing_status FROM blocks""")
def _(t):
    base, files = scratch(t.spark, "t3"), scratch(t.spark, "pages")
    pages = t.table("pages").select(F.col("html").alias("value"), "page_id")
    pages.repartition("page_id").write.options(**IN_PLACE).partitionBy("page_id").text(files)
    with settings(t.spark, MANY_FILES):
        jobs.run_once([lambda: jobs.start_document_stream(
            t.spark, files, f"{base}/parsed", f"{base}/checkpoint", pattern="*.txt", as_of=AS_OF)])
    return t.spark.read.parquet(f"{base}/parsed").select(
        F.regexp_extract("file_name", "page_id=([0-9]+)/", 1).cast("bigint").alias("page_id"), "extracted_text", "processing_status"
    )


@query("t4_run_all", with_tables("""
SELECT vendor_name, CAST(SUM(total_amount) AS DECIMAL(18,2)) AS total_amount FROM invoice GROUP BY 1""", "invoice"))
def _(t):
    base, files = scratch(t.spark, "t4"), statements(t)
    jobs.run_once([
        lambda: jobs.start_extract_stream(t.spark, files, f"{base}/raw", f"{base}/c1", FULL, pattern="*.txt", as_of=AS_OF),
        lambda: jobs.start_parse_stream(st.stream_table(t.spark, f"{base}/raw", RAW_JSON), f"{base}/tables", f"{base}/c2"),
    ])
    return jobs.read_tables(t.spark, f"{base}/tables")[0].select("vendor_name", "total_amount")


@query("t5_hourly_throughput", with_tables("""
SELECT CAST(DATE_TRUNC('hour', extraction_timestamp) AS TIMESTAMP) AS hour, COUNT(*) AS invoices_processed FROM raw_json GROUP BY 1""", "raw_json"))
def _(t):
    base = scratch(t.spark, "t5")
    stream = st.stream_table(t.spark, feed(t, t.raw, "landing"), t.raw.schema)
    jobs.run_once([lambda: jobs.start_counts(stream, jobs.hourly_throughput, f"{base}/hours", f"{base}/checkpoint")])
    return jobs.read_counts(t.spark, f"{base}/hours", "hour", "invoices_processed")


@query("t6_error_windows", with_tables("""
WITH e AS (SELECT extraction_timestamp AS ts FROM raw_json WHERE processing_status = 'ERROR'),
  w AS (SELECT ts, TIME_BUCKET(INTERVAL '5' MINUTE, ts) + n * INTERVAL '5' MINUTE AS window_end FROM e, RANGE(1, 13) r(n))
SELECT window_end, COUNT(*) AS error_count FROM w GROUP BY 1""", "raw_json"))
def _(t):
    base = scratch(t.spark, "t6")
    stream = st.stream_table(t.spark, feed(t, t.raw, "landing"), t.raw.schema)
    jobs.run_once([lambda: jobs.start_counts(stream, jobs.error_windows, f"{base}/windows", f"{base}/checkpoint")])
    return jobs.read_counts(t.spark, f"{base}/windows", "window_end", "error_count")


@query("t7_unique_numbers", with_tables("""
SELECT COUNT(*) AS rows, COUNT(invoice_number) AS numbered, COUNT(DISTINCT invoice_number) AS numbers FROM
  (SELECT DISTINCT ON (COALESCE(invoice_number, 'id ' || invoice_id)) invoice_number FROM invoice)""", "invoice"))
def _(t):
    base = scratch(t.spark, "t7")
    stream = st.stream_table(t.spark, feed(t, st.conform(t.invoice, INVOICE), "invoices"), INVOICE)
    jobs.run_once([lambda: jobs.start_unique_stream(stream, f"{base}/stored", f"{base}/checkpoint")])
    return t.spark.read.parquet(f"{base}/stored").agg(
        F.count("*").alias("rows"), F.count("invoice_number").alias("numbered"),
        F.count_distinct("invoice_number").alias("numbers"),
    )


@query("t8_triggers", TABLES_SQL)
def _(t):
    # A job on an interval: runs until nothing is left, then is stopped from outside.
    base, path = scratch(t.spark, "t8"), landed(t)
    raw = st.stream_table(t.spark, path, RAW_JSON)
    running = jobs.start_parse_stream(raw, f"{base}/tables", f"{base}/checkpoint", every="1 second")
    running.processAllAvailable()
    running.stop()
    discard(t.spark, path)
    return summary_of(t, f"{base}/tables")


FOLDER_ROWS = """SELECT CONCAT('lang=', lang, '/source=', source) AS folder, CAST(SUM(STRLEN(text) + 1) AS BIGINT) AS bytes FROM documents GROUP BY 1"""


@query("c1_new_files_stream", FOLDER_ROWS)
def _(t):
    from docflow.plans.landing import document_files, folder

    base, root = scratch(t.spark, "c1"), document_files(t)
    found = fs.stream_files(t.spark, root, "*.txt").select(folder("file_name"), "file_size")
    start = lambda: jobs.start_append(found, f"{base}/seen", f"{base}/checkpoint")
    # The second run finds nothing new and adds nothing.
    jobs.run_once([start, start])
    return t.spark.read.parquet(f"{base}/seen").groupBy("folder").agg(F.sum("file_size").alias("bytes"))


@query("c3_table_stream", "SELECT * FROM orders")
def _(t):
    base = scratch(t.spark, "c3")
    orders = t.table("orders")
    stream = st.stream_table(t.spark, feed(t, orders, "orders"), orders.schema)
    jobs.run_once([lambda: jobs.start_append(stream, f"{base}/out", f"{base}/checkpoint")])
    return t.spark.read.parquet(f"{base}/out")


@query("c5_process_again", "SELECT o_orderstatus, 2 * COUNT(*) AS rows_read FROM orders GROUP BY 1")
def _(t):
    base = scratch(t.spark, "c5")
    orders = t.table("orders").select("o_orderkey", "o_orderstatus")
    path = feed(t, orders, "orders")
    stream = st.stream_table(t.spark, path, orders.schema)
    # A new checkpoint folder reads everything once more.
    jobs.run_once([
        lambda: jobs.start_append(stream, f"{base}/out1", f"{base}/first"),
        lambda: jobs.start_append(stream, f"{base}/out2", f"{base}/second"),
    ])
    read = t.spark.read.parquet(f"{base}/out1").unionByName(t.spark.read.parquet(f"{base}/out2"))
    return read.groupBy("o_orderstatus").agg(F.count("*").alias("rows_read"))


@query("c6_files_per_run", "SELECT COUNT(*) AS rows_read, TRUE AS a_run_per_file FROM orders")
def _(t):
    base = scratch(t.spark, "c6")
    orders = t.table("orders").select("o_orderkey")
    path = feed(t, orders, "orders", spread=True)
    files = len(t.spark.read.parquet(path).inputFiles())
    stream = st.stream_table(t.spark, path, orders.schema, max_files=1)

    def count(batch, batch_id):
        st.write_batch(batch, f"{base}/out", batch_id)

    done = stream.writeStream.foreachBatch(count).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    done.awaitTermination()
    return t.spark.read.parquet(f"{base}/out").agg(
        F.count("*").alias("rows_read"), (F.count_distinct("batch_id") == files).alias("a_run_per_file"))


@query("r11_run_log", """
SELECT 'orders' AS name, 'SUCCEEDED' AS state, NULL AS error_code, COUNT(*) AS rows_read FROM orders
UNION ALL SELECT 'broken', 'FAILED', 'ValueError', NULL""")
def _(t):
    base = scratch(t.spark, "r11")
    orders = t.table("orders").select("o_orderkey")
    stream = st.stream_table(t.spark, feed(t, orders, "orders", spread=True), orders.schema, max_files=1)

    def fail(batch, batch_id):
        raise ValueError("no room")

    jobs.run_once([lambda: jobs.start_logged(
        stream, "orders", lambda batch, i: st.write_batch(batch, f"{base}/out", i), f"{base}/log", f"{base}/c1")])
    try:
        jobs.run_once([lambda: jobs.start_logged(stream, "broken", fail, f"{base}/log", f"{base}/c2")])
    except StreamingQueryException:
        pass  # the job stops at its first batch, which the log has
    return t.spark.read.parquet(f"{base}/log").groupBy("name", "state", "error_code").agg(
        F.sum(F.col("return_value").cast("bigint")).alias("rows_read")
    )


@query("h10_index_refresh", with_tables(
    scored(one(), 50) + f" SELECT {HIT} FROM lexical l JOIN docs d ON d.parsed_id = l.parsed_id", "parsed_invoices"))
def _(t):
    base = scratch(t.spark, "h10")
    path = feed(t, st.conform(t.parsed, PARSED), "parsed", spread=True)
    stream = st.stream_table(t.spark, path, PARSED, max_files=1)
    jobs.run_once([lambda: jobs.start_index_stream(stream, f"{base}/index", f"{base}/checkpoint")])
    return si.search(si.open_index(t.spark, f"{base}/index"), TEXT, 50)


# Documents 7, 27, 47, … come again with the text of their successor, 9, 19, 29, … are removed.
CHANGED = """SELECT p.parsed_id + CASE WHEN n.parsed_id IS NULL THEN 0 ELSE 1000000000 END AS parsed_id, p.file_name, p.file_url, p.file_size, p.last_modified,
    p.parse_timestamp, COALESCE(n.extracted_text, p.extracted_text) AS extracted_text, p.processing_status FROM parsed_invoices p
  LEFT JOIN parsed_invoices n ON n.parsed_id = p.parsed_id + 1 AND p.parsed_id % 20 = 7 AND n.processing_status = 'SUCCESS' AND p.processing_status = 'SUCCESS'
  WHERE p.parsed_id % 10 <> 9"""


@query("h10b_changed_and_removed", with_tables(
    scored(one(), 50).replace("FROM parsed_invoices WHERE", f"FROM ({CHANGED}) WHERE")
    + f" SELECT {HIT} FROM lexical l JOIN docs d ON d.parsed_id = l.parsed_id", "parsed_invoices"))
def _(t):
    base = scratch(t.spark, "h10b")
    first = st.conform(t.parsed, PARSED)
    ok = first.filter("processing_status = 'SUCCESS'")
    following = ok.select((F.col("parsed_id") - 1).alias("before"), F.col("extracted_text").alias("following"))
    later = ok.filter("parsed_id % 20 = 7").join(following, F.col("parsed_id") == F.col("before")).withColumns({
        "extracted_text": F.col("following"), "parsed_id": F.col("parsed_id") + 1_000_000_000})
    removed = first.filter("parsed_id % 10 = 9").withColumns({
        "extracted_text": F.lit(None).cast("string"), "processing_status": F.lit("REMOVED")})
    for i, rows in enumerate((first, st.conform(later, PARSED), removed)):
        rows.write.parquet(f"{base}/in/{i}")
        stream = st.stream_table(t.spark, f"{base}/in/*", PARSED)
        jobs.run_once([lambda s=stream: jobs.start_index_stream(s, f"{base}/index", f"{base}/checkpoint")])
    before = si.search(si.open_index(t.spark, f"{base}/index"), TEXT, 50)
    before.write.parquet(f"{base}/before")
    si.compact(t.spark, f"{base}/index")
    batches.vacuum(t.spark, f"{base}/index")
    # Compaction changes nothing: what either search has and the other has not would come twice or be missing.
    after = si.search(si.open_index(t.spark, f"{base}/index"), TEXT, 50)
    return after.union(t.spark.read.parquet(f"{base}/before")).distinct()


@query("x4_form_helpers", with_tables("""
SELECT CAST(invoice_id AS VARCHAR) AS doc_id, CAST(total_amount AS DECIMAL(18,2)) AS invoice_total FROM invoice""", "invoice"))
def _(t):
    from docflow.functions.casts import clean_money
    from docflow.operators.normalize import split_header_detail

    header, _ = split_header_detail(t.app_responses)
    return header.select("doc_id", clean_money(F.col("InvoiceTotal")).alias("invoice_total"))
