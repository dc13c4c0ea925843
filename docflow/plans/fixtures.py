"""Invoice tables derived from the given tables, in Spark and as portable SQL.

Both forms state the same rules (FIXTURES.md §3). Planted cases: missing and shared invoice
numbers, due dates before the issue date, subtotals that differ from the lines, negative tax,
zero totals, failed extractions (their lines have no header), invoices without lines.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from docflow.functions.variants import error_object
from docflow.operators.extract import once
from docflow.session import store, tune

AS_OF_DATE = "2001-01-01"
AS_OF = "2024-01-10 12:00:00"
# A document holds about this many lines; a longer order is one document in several parts.
LINES_PER_DOCUMENT = 2000
ID_RANGE = 1 << 60  # line ids are 60 bits of a hash
BROADCAST_ROWS = 200_000
SLICE_BYTES = 1 << 30  # stored lines whose documents are made, and shuffled, at a time

# The failed extractions leave the invoices by NOT EXISTS: DuckDB 2.0.0 stops with an internal
# error when the status column is filtered above the joins.
SQL = {
    "k": """SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, o_orderstatus, o_orderpriority,
         o_orderkey - CASE WHEN o_orderkey % 10 = 9 THEN 1 ELSE 0 END AS base_key,
         CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'ERROR' ELSE 'SUCCESS' END AS status
  FROM orders""",
    "invoice_detail": """SELECT CAST(CONCAT('0x', SUBSTR(MD5(CONCAT_WS('|',
             CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
             CAST(l_linenumber AS VARCHAR), CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR),
             CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR),
             CAST(CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR), CAST(CAST(l_tax AS DECIMAL(18,2)) AS VARCHAR),
             l_returnflag, l_linestatus, CAST(CAST(l_shipdate AS DATE) AS VARCHAR))), 1, 15)) AS BIGINT)
           AS invoice_detail_id,
         CAST(l_orderkey AS BIGINT) AS invoice_id, CAST(l_linenumber AS BIGINT) AS line_number,
         p_name AS item_description, CONCAT('SKU-', CAST(l_partkey AS VARCHAR)) AS item_code,
         CAST(l_quantity AS DECIMAL(18,4)) AS quantity,
         CASE WHEN l_partkey % 3 = 0 THEN 'BOX' WHEN l_partkey % 3 = 1 THEN 'EA' ELSE 'HR' END AS unit_of_measure,
         CAST(p_retailprice AS DECIMAL(18,4)) AS unit_price,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS line_amount,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(5,2)) AS DECIMAL(18,2)) AS tax_amount,
         p_type AS category
  FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "line_sum": """SELECT invoice_id, CAST(SUM(line_amount) AS DECIMAL(18,2)) AS s
  FROM invoice_detail GROUP BY invoice_id""",
    "invoice": """SELECT CAST(o_orderkey AS BIGINT) AS invoice_id, CAST(o_orderkey AS BIGINT) AS extraction_id,
         CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CONCAT('INV-', CAST(base_key AS VARCHAR)) END AS invoice_number,
         CAST(o_orderdate AS DATE) AS invoice_date,
         CAST(CASE WHEN o_orderkey % 50 = 0 THEN CAST(o_orderdate AS DATE) - INTERVAL '5' DAY
              ELSE CAST(o_orderdate AS DATE) + INTERVAL '30' DAY END AS DATE) AS due_date,
         s_name AS vendor_name, c_name AS customer_name,
         CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE s END AS subtotal,
         CAST(CASE WHEN o_orderkey % 89 = 0 THEN -1.00 ELSE o_totalprice * 0.08 END AS DECIMAL(18,2)) AS tax_amount,
         CAST(8.00 AS DECIMAL(5,2)) AS tax_rate,
         CAST(o_orderkey % 200 AS DECIMAL(18,2)) AS shipping_amount,
         CAST(o_orderkey % 13 AS DECIMAL(18,2)) AS discount_amount,
         CAST(CASE WHEN o_orderkey % 83 = 0 THEN 0 ELSE o_totalprice END AS DECIMAL(18,2)) AS total_amount,
         CASE WHEN o_orderkey % 5 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
         CASE WHEN o_orderkey % 2 = 0 THEN 'Net 30' ELSE 'Due on Receipt' END AS payment_terms,
         CONCAT('PO-', CAST(o_custkey AS VARCHAR)) AS po_number,
         o_orderdate + (o_orderkey % 1440) * INTERVAL '1' MINUTE AS created_timestamp
  FROM k JOIN customer ON o_custkey = c_custkey
         JOIN supplier ON s_suppkey = base_key % (SELECT COUNT(*) FROM supplier)
         LEFT JOIN line_sum ON invoice_id = o_orderkey
  WHERE NOT EXISTS (SELECT 1 FROM orders e WHERE e.o_orderkey = k.o_orderkey
    AND e.o_orderpriority = '5-LOW' AND e.o_orderstatus = 'P')""",
    "raw_json": """SELECT CAST(o_orderkey AS BIGINT) AS extraction_id,
         CONCAT('invoice_', CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderpriority = '1-URGENT' THEN '.PDF'
           WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '.txt' ELSE '.pdf' END) AS file_name,
         CAST(o_orderkey * 37 % 900000 AS BIGINT) AS file_size, o_orderdate AS last_modified,
         TIMESTAMP '2024-01-01 00:00:00' + o_orderkey * INTERVAL '1' MINUTE AS extraction_timestamp,
         status AS processing_status,
         CASE WHEN status = 'ERROR' THEN CONCAT('unreadable order ', CAST(o_orderkey AS VARCHAR)) END AS error_message
  FROM k""",
    "parsed_invoices": """SELECT CAST(doc_id AS BIGINT) AS parsed_id, CONCAT('doc_', CAST(doc_id AS VARCHAR), '.txt') AS file_name,
         CONCAT('stage://documents/doc_', CAST(doc_id AS VARCHAR), '.txt') AS file_url,
         CAST(n_chars AS BIGINT) AS file_size, TIMESTAMP '2024-01-01 00:00:00' AS last_modified,
         text AS extracted_text,
         TIMESTAMP '2024-01-01 00:00:00' + doc_id * INTERVAL '1' MINUTE AS parse_timestamp,
         CASE WHEN n_chars < 100 THEN 'ERROR' ELSE 'SUCCESS' END AS processing_status,
         CASE WHEN n_chars < 100 THEN 'text too short' END AS error_message
  FROM documents""",
    "run_log": """SELECT CASE event_type WHEN 'click' THEN 'extract' WHEN 'view' THEN 'parse' ELSE event_type END AS name,
         CASE WHEN value > 200 THEN 'FAILED' ELSE 'SUCCEEDED' END AS state,
         ts AS scheduled_time, ts + INTERVAL '1' SECOND AS query_start_time,
         ts + INTERVAL '1' SECOND + CAST(ROUND(value) AS BIGINT) * INTERVAL '1' SECOND AS completed_time,
         props AS return_value, CASE WHEN value > 200 THEN 'TIMEOUT' END AS error_code,
         CASE WHEN value > 200 THEN CONCAT('run of user ', CAST(user_id AS VARCHAR)) END AS error_message
  FROM events""",
    # Form documents: one per order, lines as form text.
    "app_header": """SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, s_name AS "VendorName",
         CONCAT('INV-', CAST(base_key AS VARCHAR)) AS "InvoiceNo",
         CONCAT('PO-', CAST(o_custkey AS VARCHAR)) AS "PurchaseOrderNo",
         CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS "InvoiceDate",
         CASE WHEN o_orderkey % 4 = 0 THEN '0' ELSE COALESCE('$' || CAST(s AS VARCHAR), '0') END AS "InvoiceSubtotal",
         '0' AS "InvoiceTaxAmount", CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS "InvoiceTotal",
         CASE WHEN o_orderstatus = 'F' THEN 'None' ELSE '0' END AS "DepositCreditAmount"
  FROM k JOIN supplier ON s_suppkey = base_key % (SELECT COUNT(*) FROM supplier)
         LEFT JOIN line_sum ON invoice_id = o_orderkey""",
    "app_detail": """SELECT CAST(invoice_id AS VARCHAR) AS doc_id, CAST(invoice_detail_id AS VARCHAR) AS line_id,
         line_number AS "LineNumber", item_description AS "Description",
         CAST(quantity AS VARCHAR) AS "Quantity", CONCAT('$', CAST(line_amount AS VARCHAR)) AS "LineTotal"
  FROM invoice_detail""",
    # Reviewer's changes: header values, quantities of returned lines, removed and added lines.
    "corrections": """SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, 'header' AS scope, NULL AS line_id, 'set' AS op,
         'VendorName' AS field, CONCAT('Vendor of ', CAST(o_custkey AS VARCHAR)) AS value, 1 AS seq,
         o_orderdate AS changed_at FROM k WHERE o_orderstatus = 'F'
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'header', NULL, 'set', 'VendorName', 'Urgent vendor', 2, o_orderdate
    FROM k WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'header', NULL, 'set', 'InvoiceTotal', '1,000.00', 3, o_orderdate
    FROM k WHERE o_orderpriority = '2-HIGH'
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'detail', CONCAT('new-', CAST(o_orderkey AS VARCHAR)), 'add',
      NULL, NULL, 4, o_orderdate FROM k WHERE o_orderstatus = 'O'
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'detail', CONCAT('new-', CAST(o_orderkey AS VARCHAR)), 'set',
      'Description', 'handling', 5, o_orderdate FROM k WHERE o_orderstatus = 'O'
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'detail', CAST(l_id AS VARCHAR), 'set', 'Quantity', '1', 6, l_shipdate
    FROM changed WHERE l_returnflag = 'R'
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'detail', CAST(l_id AS VARCHAR), 'remove', NULL, NULL, 7, l_shipdate
    FROM changed WHERE l_returnflag = 'A' OR l_linestatus = 'F'""",
}
LINE_ID = SQL["invoice_detail"][SQL["invoice_detail"].index("CAST(CONCAT"):SQL["invoice_detail"].index("AS invoice_detail_id")]
SQL["changed"] = f"SELECT {LINE_ID} AS l_id, l_orderkey, l_returnflag, l_linestatus, l_shipdate FROM lineitem"
NEEDS = {
    "corrections": ["k", "changed"],
    "line_sum": ["invoice_detail"], "invoice": ["k", "line_sum"], "raw_json": ["k"],
    "app_header": ["k", "line_sum"], "app_detail": ["invoice_detail"],
}


def with_tables(select: str, *names: str) -> str:
    """``select`` with the derived tables it names as CTEs."""
    chosen: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in chosen:
            chosen.append(name)

    for name in names:
        add(name)
    ctes = ",\n".join(f"{n} AS (\n  {SQL[n]})" for n in chosen)
    select = select.strip()
    if select.upper().startswith("WITH "):
        return f"WITH {ctes},\n{select[5:]}"
    return f"WITH {ctes}\n{select}"


def line_id() -> Column:
    """BIGINT key from the content of a ``lineitem`` row."""
    def text(name: str) -> Column:
        return F.col(name).cast("string")

    def fixed(name: str) -> Column:
        return F.col(name).cast("decimal(18,2)").cast("string")

    content = F.concat_ws(
        "|", text("l_orderkey"), text("l_partkey"), text("l_suppkey"), text("l_linenumber"),
        fixed("l_quantity"), fixed("l_extendedprice"), fixed("l_discount"), fixed("l_tax"),
        "l_returnflag", "l_linestatus", F.col("l_shipdate").cast("date").cast("string"),
    )
    return F.conv(F.substring(F.md5(content.cast("binary")), 1, 15), 16, 10).cast("bigint")


def _small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``BROADCAST_ROWS`` rows."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


class Tables:
    """The given and derived tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def slices(self) -> list[Tables]:
        """The tables cut by order, a slice for each ``SLICE_BYTES`` of lines: what is made per order is the union over the
        slices, and the shuffle files of only one of them need room at a time."""
        fs, make = store(self.spark, self.dir)
        n = -(-fs.getContentSummary(make(f"{self.dir}/lineitem.parquet")).getLength() // SLICE_BYTES)
        return [Slice(self.spark, self.dir, i, n) for i in range(n)] if n > 1 else [self]

    @cached_property
    def orders(self) -> DataFrame:
        key = F.col("o_orderkey")
        failed = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")
        return self.table("orders").select(
            "*", (key - F.when(key % 10 == 9, 1).otherwise(0)).alias("base_key"),
            F.when(failed, "ERROR").otherwise("SUCCESS").alias("status"),
        )

    @cached_property
    def _lines_with_part(self) -> DataFrame:
        """What ``_line`` makes a line from; the key of the line is made before the join, so its columns do not travel."""
        lines = self.table("lineitem").select(
            line_id().alias("invoice_detail_id"),
            F.col("l_orderkey").alias("invoice_id"), F.col("l_linenumber").cast("bigint").alias("line_number"),
            F.col("l_partkey").alias("part_key"), F.col("l_quantity").cast("decimal(18,4)").alias("quantity"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("line_amount"), F.col("l_tax").cast("decimal(5,2)").alias("tax_rate"),
        )
        parts = self.table("part").select(
            "p_partkey", F.col("p_name").alias("item_description"), F.col("p_retailprice").cast("decimal(18,4)").alias("unit_price"),
            F.col("p_type").alias("category"))
        return lines.join(parts, F.col("part_key") == F.col("p_partkey"))

    def _line(self, of) -> dict[str, Column]:
        """The columns of a line from those of ``_lines_with_part``, which ``of`` gives by name."""
        kind = of("part_key") % 3
        return {
            "line_number": of("line_number"), "invoice_detail_id": of("invoice_detail_id"),
            "item_description": of("item_description"), "item_code": F.concat(F.lit("SKU-"), of("part_key").cast("string")),
            "quantity": of("quantity"), "unit_of_measure": F.when(kind == 0, "BOX").when(kind == 1, "EA").otherwise("HR"),
            "unit_price": of("unit_price"), "line_amount": of("line_amount"),
            "tax_amount": (of("line_amount") * of("tax_rate")).cast("decimal(18,2)"), "category": of("category"),
        }

    @cached_property
    def invoice_detail(self) -> DataFrame:
        line = self._line(F.col)
        names = ["invoice_detail_id", "invoice_id", "line_number", "item_description", "item_code", "quantity", "unit_of_measure",
                 "unit_price", "line_amount", "tax_amount", "category"]
        return self._lines_with_part.select(*[line.get(name, F.col(name)).alias(name) for name in names])

    @cached_property
    def _line_sum(self) -> DataFrame:
        """Sum of the lines per order, from the lines alone: every part key has its part."""
        return self.table("lineitem").groupBy(F.col("l_orderkey").alias("sum_key")).agg(
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("s")
        )

    @cached_property
    def _orders_with_vendor(self) -> DataFrame:
        n = self.table("supplier").agg(F.count("*")).scalar()
        vendors = self.table("supplier").select("s_suppkey", "s_name")
        return (
            self.orders.withColumn("vendor_key", F.col("base_key") % n)
            .join(vendors, F.col("vendor_key") == F.col("s_suppkey"))
            .join(self._line_sum, F.col("o_orderkey") == F.col("sum_key"), "left")
        )

    @cached_property
    def invoice(self) -> DataFrame:
        key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
        money, price = "decimal(18,2)", F.col("o_totalprice")
        customers = self.table("customer").select("c_custkey", "c_name")
        return (
            self._orders_with_vendor.filter("status = 'SUCCESS'")
            .join(customers, F.col("o_custkey") == F.col("c_custkey"))
            .select(
                key.alias("invoice_id"), key.alias("extraction_id"),
                F.when(key % 97 != 0, F.concat(F.lit("INV-"), F.col("base_key").cast("string"))).alias("invoice_number"),
                day.alias("invoice_date"),
                F.when(key % 50 == 0, F.date_sub(day, 5)).otherwise(F.date_add(day, 30)).alias("due_date"),
                F.col("s_name").alias("vendor_name"), F.col("c_name").alias("customer_name"),
                F.when(key % 4 == 0, price.cast(money)).otherwise(F.col("s")).alias("subtotal"),
                F.when(key % 89 == 0, F.lit(-1.0)).otherwise(price * 0.08).cast(money).alias("tax_amount"),
                F.lit(8).cast("decimal(5,2)").alias("tax_rate"),
                (key % 200).cast(money).alias("shipping_amount"), (key % 13).cast(money).alias("discount_amount"),
                F.when(key % 83 == 0, F.lit(0.0)).otherwise(price).cast(money).alias("total_amount"),
                F.when(key % 5 == 0, "EUR").otherwise("USD").alias("currency"),
                F.when(key % 2 == 0, "Net 30").otherwise("Due on Receipt").alias("payment_terms"),
                F.concat(F.lit("PO-"), F.col("o_custkey").cast("string")).alias("po_number"),
                F.expr("timestampadd(MINUTE, CAST(o_orderkey % 1440 AS INT), o_orderdate)").alias("created_timestamp"),
            )
        )

    @cached_property
    def raw(self) -> DataFrame:
        """Landing rows without the extraction result."""
        key = F.col("o_orderkey").cast("string")
        urgency = F.col("o_orderpriority")
        ext = F.when(urgency == "1-URGENT", ".PDF").when(urgency == "4-NOT SPECIFIED", ".txt").otherwise(".pdf")
        name = F.concat(F.lit("invoice_"), key, ext)
        return self.orders.select(
            F.col("o_orderkey").alias("extraction_id"), name.alias("file_name"),
            F.concat(F.lit("stage://invoices/"), name).alias("file_url"),
            (F.col("o_orderkey") * 37 % 900000).alias("file_size"), F.col("o_orderdate").alias("last_modified"),
            F.expr("timestampadd(MINUTE, o_orderkey, TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("extraction_timestamp"),
            F.col("status").alias("processing_status"),
            F.when(F.col("status") == "ERROR", F.concat(F.lit("unreadable order "), key)).alias("error_message"),
        )

    @cached_property
    def files(self) -> DataFrame:
        return self.raw.select("file_name", "file_url", "file_size", "last_modified")

    @cached_property
    def parsed(self) -> DataFrame:
        key = F.col("doc_id").cast("string")
        short = F.col("n_chars") < 100
        name = F.concat(F.lit("doc_"), key, F.lit(".txt"))
        return self.table("documents").select(
            F.col("doc_id").alias("parsed_id"), name.alias("file_name"),
            F.concat(F.lit("stage://documents/"), name).alias("file_url"), F.col("n_chars").alias("file_size"),
            F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'").alias("last_modified"),
            F.col("text").alias("extracted_text"),
            F.expr("timestampadd(MINUTE, doc_id, TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("parse_timestamp"),
            F.when(short, "ERROR").otherwise("SUCCESS").alias("processing_status"),
            F.when(short, "text too short").alias("error_message"),
        )

    @cached_property
    def run_log(self) -> DataFrame:
        failed = F.col("value") > 200
        kind = F.col("event_type")
        return self.table("events").select(
            F.when(kind == "click", "extract").when(kind == "view", "parse").otherwise(kind).alias("name"),
            F.when(failed, "FAILED").otherwise("SUCCEEDED").alias("state"),
            F.col("ts").alias("scheduled_time"),
            F.expr("timestampadd(SECOND, 1, ts)").alias("query_start_time"),
            F.expr("timestampadd(SECOND, 1 + CAST(ROUND(value) AS BIGINT), ts)").alias("completed_time"),
            F.col("props").alias("return_value"), F.when(failed, "TIMEOUT").alias("error_code"),
            F.when(failed, F.concat(F.lit("run of user "), F.col("user_id").cast("string"))).alias("error_message"),
        )

    # ---- documents that hold their lines ----------------------------------------------

    @cached_property
    def _long_ids(self) -> DataFrame:
        """(long_id) of orders with more than ``LINES_PER_DOCUMENT`` lines: at most one for so many lines."""
        counts = self.table("lineitem").groupBy(F.col("l_orderkey").alias("long_id")).agg(F.count("*").alias("n"))
        return counts.filter((F.col("n") > LINES_PER_DOCUMENT) & F.col("long_id").isNotNull()).select("long_id")

    @cached_property
    def _long_lines(self) -> DataFrame:
        """(long_id, long_number, buckets) of long orders: into how many ranges of line ids the lines of each number are cut."""
        lines = self.table("lineitem").select(F.col("l_orderkey").alias("long_id"), F.col("l_linenumber").cast("bigint").alias("long_number"))
        counts = lines.join(_small(self._long_ids), "long_id", "left_semi").groupBy("long_id", "long_number").agg(F.count("*").alias("n"))
        return counts.select("long_id", "long_number", F.ceil(F.col("n") / LINES_PER_DOCUMENT).cast("bigint").alias("buckets"))

    @cached_property
    def line_arrays(self) -> DataFrame:
        """Lines collected per document, ordered by line number and id: ``lines``, ``part``, ``offset`` (lines of the
        order in earlier parts) and ``last``.

        An order with more than ``LINES_PER_DOCUMENT`` lines comes in parts, ranges of (line number, line id), so the
        rows are shuffled by order and part; the parts of an order are numbered from their counts alone. Tables without
        such orders are not joined with them.

        What is a function of the part's key or of two amounts is made from them behind the shuffle.
        """
        d = self._lines_with_part
        row = F.struct(
            "line_number", "invoice_detail_id", "item_description", "unit_price", "category", "part_key", "quantity", "line_amount", "tax_rate")
        lines = F.transform(F.sort_array(F.collect_list("row")), lambda r: F.struct(
            *[value.alias(name) for name, value in self._line(lambda name: r[name]).items()])).alias("lines")

        def whole(lines: DataFrame) -> DataFrame:
            return lines.select(
                "invoice_id", "lines", F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("offset"), F.lit(True).alias("last"))

        if self._long_ids.isEmpty():
            return whole(d.select("invoice_id", row.alias("row")).groupBy("invoice_id").agg(lines))
        long_lines = _small(self._long_lines)
        same = (F.col("invoice_id") == F.col("long_id")) & (F.col("line_number") == F.col("long_number"))
        width = F.ceil(F.lit(ID_RANGE) / F.col("buckets"))
        cut = F.when(F.col("buckets").isNotNull(), F.struct(
            "line_number", F.floor(F.col("invoice_detail_id") / width).alias("bucket"))).alias("cut")
        keyed = d.join(long_lines, same, "left").select("invoice_id", cut, row.alias("row"))
        collected = keyed.groupBy("invoice_id", "cut").agg(lines)

        ids = self.table("lineitem").select(
            F.col("l_orderkey").alias("invoice_id"), F.col("l_linenumber").cast("bigint").alias("line_number"),
            line_id().alias("invoice_detail_id"))
        counts = ids.join(long_lines, same).select("invoice_id", cut).groupBy("invoice_id", "cut").agg(F.count("*").alias("n"))
        order = Window.partitionBy("invoice_id").orderBy("cut")
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        parts = counts.select(
            "invoice_id", "cut", (F.row_number().over(order) - 1).alias("part"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.lead("n").over(order).isNull().alias("last"))
        rest = whole(collected.filter("cut IS NULL"))
        return collected.filter("cut IS NOT NULL").join(parts, ["invoice_id", "cut"]).select(*rest.columns).unionByName(rest)

    @cached_property
    def documents_with_lines(self) -> DataFrame:
        """One row per invoice document or part: header columns, the array ``lines`` (empty if none), and for further
        parts ``continues``."""
        raw = self.raw.select("extraction_id", "file_name", "file_url", "file_size", "last_modified", "extraction_timestamp")
        link = F.concat_ws(":", F.col("extraction_id").cast("string"), F.col("offset").cast("string"))
        return (
            self.invoice.join(raw, "extraction_id")
            .join(self.line_arrays, "invoice_id", "left")
            .withColumns({"part": F.coalesce("part", F.lit(0)), "last": F.coalesce("last", F.lit(True))})
            .withColumn("continues", F.when(F.col("part") > 0, link))
        )

    @cached_property
    def raw_json(self) -> DataFrame:
        """Landing rows, failed extractions with their error, the others with JSON in one of three shapes:
        nested with records (EUR), flat with parallel arrays (USD, Net 30), flat in an envelope."""
        return self._with_json(
            lambda flat, nested: F.when(F.col("currency") == "EUR", F.to_json(nested))
            .when(F.col("payment_terms") == "Net 30", F.to_json(flat))
            .otherwise(F.to_json(F.struct(flat.alias("response"))))
        )

    @cached_property
    def raw_records(self) -> DataFrame:
        """The same landing rows, all of them nested with records."""
        return self._with_json(lambda flat, nested: F.to_json(nested))

    def _with_json(self, text) -> DataFrame:
        d = self.documents_with_lines
        day = [F.col(c).cast("string").alias(c) for c in ("invoice_date", "due_date")]
        terms = ["payment_terms", "po_number"]
        money = ["subtotal", "tax_amount", "tax_rate", "shipping_amount", "discount_amount", "total_amount"]

        def column(name: str) -> Column:
            return F.transform("lines", lambda r: r[name].cast("string"))

        arrays = F.struct(
            column("line_number").alias("line_number"), column("item_description").alias("line_description"),
            column("item_code").alias("item_code"), column("quantity").alias("quantity"),
            column("unit_of_measure").alias("unit_of_measure"), column("unit_price").alias("unit_price"),
            column("line_amount").alias("line_amount"), column("tax_amount").alias("tax_amount"),
            column("category").alias("category"),
        )
        records = F.transform("lines", lambda r: F.struct(
            r["line_number"].alias("line_number"), r["item_description"].alias("description"),
            r["item_code"].alias("item_code"), r["quantity"].alias("quantity"),
            r["unit_of_measure"].alias("unit_of_measure"), r["unit_price"].alias("unit_price"),
            r["line_amount"].alias("line_amount"), r["tax_amount"].alias("tax_amount"),
            r["category"].alias("category"),
        ))
        has_lines = F.col("lines").isNotNull()
        flat = F.struct(
            "invoice_number", *day, F.col("vendor_name").alias("vendor"), F.col("customer_name").alias("customer"),
            *[F.col(c).cast("string").alias(c) for c in money],
            # A missing currency stands for USD.
            F.when(F.col("currency") != "USD", F.col("currency")).alias("currency"),
            *terms, "continues", F.when(has_lines, arrays).alias("line_items"),
        )
        nested = F.struct(
            "invoice_number", *day, F.struct(F.col("vendor_name").alias("name")).alias("vendor"),
            F.struct(F.col("customer_name").alias("name")).alias("customer"),
            F.struct(*money, "currency").alias("financial"), *terms, "continues", F.when(has_lines, records).alias("line_items"),
        )
        first = F.col("part") == 0
        keep = [
            F.when(first, F.col("extraction_id")).otherwise(F.xxhash64("extraction_id", "part")).alias("extraction_id"),
            F.when(first, F.col("file_name")).otherwise(F.concat_ws("#", "file_name", "part")).alias("file_name"),
            "file_url", "file_size", "last_modified", "extraction_timestamp",
        ]
        # Made once per document: a filter on the result must not make it a second time.
        made = once(d, keep, F.struct(F.parse_json(text(flat, nested)).alias("extracted_json")))
        return made.select(
            "extraction_id", "file_name", "file_url", "file_size", "last_modified", "extracted_json", "extraction_timestamp",
            F.lit("SUCCESS").alias("processing_status"), F.lit(None).cast("string").alias("error_message"),
        ).unionByName(self.raw.filter("processing_status = 'ERROR'").withColumn(
            "extracted_json", error_object(F.col("error_message"))))

    @cached_property
    def texts(self) -> DataFrame:
        """The same invoices as document text: labelled header lines and one row per line item."""
        d = self.documents_with_lines

        def labelled(label: str, name: str) -> Column:
            return F.concat(F.lit(f"{label}: "), F.col(name).cast("string"))

        head = F.concat_ws(
            "\n", F.lit("INVOICE"), labelled("Invoice Number", "invoice_number"), labelled("Invoice Date", "invoice_date"),
            labelled("Due Date", "due_date"), labelled("Vendor", "vendor_name"), labelled("Customer", "customer_name"),
            labelled("PO Number", "po_number"), labelled("Payment Terms", "payment_terms"),
            labelled("Currency", "currency"), labelled("Continues", "continues"),
        )
        rows = F.transform("lines", lambda r: F.concat_ws(
            " | ", F.concat(F.lit("# "), r["line_number"].cast("string")), r["item_description"], r["item_code"],
            r["quantity"].cast("string"), r["unit_of_measure"], r["unit_price"].cast("string"),
            r["line_amount"].cast("string"), r["tax_amount"].cast("string")))
        foot = F.concat_ws(
            "\n", labelled("Subtotal", "subtotal"), labelled("Tax Amount", "tax_amount"), labelled("Tax Rate", "tax_rate"),
            labelled("Shipping Amount", "shipping_amount"), labelled("Discount Amount", "discount_amount"),
            labelled("Total Amount", "total_amount"),
        )
        first = F.col("part") == 0
        return d.select(
            F.when(first, F.col("extraction_id")).otherwise(F.xxhash64("extraction_id", "part")).alias("extraction_id"),
            F.when(first, F.col("file_name")).otherwise(F.concat_ws("#", "file_name", "part")).alias("file_name"),
            "file_url", "file_size", "last_modified",
            F.concat_ws("\n", head, F.array_join(rows, "\n"), foot).alias("text"), "part",
        )

    # ---- form documents ----------------------------------------------------------------

    @cached_property
    def app_header(self) -> DataFrame:
        key = F.col("o_orderkey")
        zero = F.lit("0")
        return self._orders_with_vendor.select(
            key.cast("string").alias("doc_id"), F.col("s_name").alias("VendorName"),
            F.concat(F.lit("INV-"), F.col("base_key").cast("string")).alias("InvoiceNo"),
            F.concat(F.lit("PO-"), F.col("o_custkey").cast("string")).alias("PurchaseOrderNo"),
            F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("InvoiceDate"),
            F.when(key % 4 == 0, zero).otherwise(F.coalesce(F.concat(F.lit("$"), F.col("s").cast("string")), zero)).alias("InvoiceSubtotal"),
            zero.alias("InvoiceTaxAmount"),
            F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("InvoiceTotal"),
            F.when(F.col("o_orderstatus") == "F", "None").otherwise("0").alias("DepositCreditAmount"),
        )

    @cached_property
    def app_detail(self) -> DataFrame:
        return self.invoice_detail.select(
            F.col("invoice_id").cast("string").alias("doc_id"), F.col("invoice_detail_id").cast("string").alias("line_id"),
            F.col("line_number").alias("LineNumber"), F.col("item_description").alias("Description"),
            F.col("quantity").cast("string").alias("Quantity"),
            F.concat(F.lit("$"), F.col("line_amount").cast("string")).alias("LineTotal"),
        )

    @cached_property
    def app_responses(self) -> DataFrame:
        """Form responses in their envelope; orders paid net have one description too few."""
        d = self.documents_with_lines

        def column(name: str) -> Column:
            return F.transform("lines", lambda r: r[name].cast("string"))

        names = column("item_description")
        short = F.when((F.col("payment_terms") == "Net 30") & F.col("last"), F.slice(names, F.lit(1), F.greatest(F.size(names) - 1, F.lit(0))))
        response = F.struct(
            F.col("vendor_name").alias("VendorName"), F.col("invoice_number").alias("InvoiceNo"),
            F.col("po_number").alias("PurchaseOrderNo"), F.col("invoice_date").cast("string").alias("InvoiceDate"),
            F.col("subtotal").cast("string").alias("InvoiceSubtotal"), F.col("tax_amount").cast("string").alias("InvoiceTaxAmount"),
            F.col("total_amount").cast("string").alias("InvoiceTotal"),
            column("quantity").alias("Quantities"), F.coalesce(short, names).alias("ItemDescriptions"),
            column("line_amount").alias("LineTotals"), "continues",
        )
        return d.select(
            F.concat_ws("#", F.col("invoice_id").cast("string"), F.when(F.col("part") > 0, F.col("part"))).alias("doc_id"),
            F.parse_json(F.to_json(F.struct(response.alias("response")))).alias("extracted_json"),
        )

    @cached_property
    def corrections(self) -> DataFrame:
        def rows(df: DataFrame, doc: str, scope: str, line: Column, op: str, field: str | None, value: Column,
                 seq: int, time: str) -> DataFrame:
            return df.select(
                F.col(doc).cast("string").alias("doc_id"), F.lit(scope).alias("scope"), line.cast("string").alias("line_id"),
                F.lit(op).alias("op"), F.lit(field).cast("string").alias("field"), value.cast("string").alias("value"),
                F.lit(seq).cast("bigint").alias("seq"), F.col(time).alias("changed_at"),
            )

        none, o = F.lit(None), self.orders
        urgency, status = F.col("o_orderpriority"), F.col("o_orderstatus")
        added = F.concat(F.lit("new-"), F.col("o_orderkey").cast("string"))
        lines = self.table("lineitem")
        parts = [
            rows(o.filter(status == "F"), "o_orderkey", "header", none, "set", "VendorName",
                 F.concat(F.lit("Vendor of "), F.col("o_custkey").cast("string")), 1, "o_orderdate"),
            rows(o.filter(urgency == "1-URGENT"), "o_orderkey", "header", none, "set", "VendorName",
                 F.lit("Urgent vendor"), 2, "o_orderdate"),
            rows(o.filter(urgency == "2-HIGH"), "o_orderkey", "header", none, "set", "InvoiceTotal",
                 F.lit("1,000.00"), 3, "o_orderdate"),
            rows(o.filter(status == "O"), "o_orderkey", "detail", added, "add", None, none, 4, "o_orderdate"),
            rows(o.filter(status == "O"), "o_orderkey", "detail", added, "set", "Description", F.lit("handling"), 5, "o_orderdate"),
            rows(lines.filter("l_returnflag = 'R'"), "l_orderkey", "detail", line_id(), "set", "Quantity",
                 F.lit("1"), 6, "l_shipdate"),
            rows(lines.filter("l_returnflag = 'A' OR l_linestatus = 'F'"), "l_orderkey", "detail", line_id(), "remove", None,
                 none, 7, "l_shipdate"),
        ]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out


class Slice(Tables):
    """The ``number``-th of ``count`` slices: its orders and their lines, all of the other tables."""

    KEYS = {"orders": "o_orderkey", "lineitem": "l_orderkey"}

    def __init__(self, spark: SparkSession, sf_dir: str, number: int, count: int):
        super().__init__(spark, sf_dir)
        self.number, self.count = number, count

    def table(self, name: str) -> DataFrame:
        df = super().table(name)
        if name not in self.KEYS:
            return df
        return df.filter(F.pmod(F.xxhash64(F.col(self.KEYS[name]).cast("bigint")), F.lit(self.count)) == self.number)
