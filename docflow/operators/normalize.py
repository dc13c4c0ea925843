"""Semi-structured extraction results to typed header and line tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docflow.functions.casts import clean_money, safe_date, safe_decimal
from docflow.functions.variants import fields_at, line_item_count, text_at, texts_at, unwrap
from docflow.operators.extract import once
from docflow.schemas import INVOICE, INVOICE_DETAIL
from docflow.sources.tables import conform

# Where each header column is found: nested form first, then flat. Fixed values.
HEADER_TEXT = {
    "invoice_number": ["invoice_number"],
    "order_number": ["order_number"],
    "vendor_name": ["vendor.name", "vendor_name", "vendor"],
    "vendor_address": ["vendor.address", "vendor_address"],
    "vendor_city": ["vendor.city"],
    "vendor_state": ["vendor.state"],
    "vendor_zip": ["vendor.zip"],
    "vendor_country": ["vendor.country"],
    "vendor_phone": ["vendor.phone", "vendor_phone"],
    "vendor_email": ["vendor.email", "vendor_email"],
    "vendor_tax_id": ["vendor.tax_id", "vendor_tax_id"],
    "customer_name": ["customer.name", "customer_name", "customer"],
    "customer_address": ["customer.address", "customer_address"],
    "customer_city": ["customer.city"],
    "customer_state": ["customer.state"],
    "customer_zip": ["customer.zip"],
    "customer_country": ["customer.country"],
    "customer_phone": ["customer.phone", "customer_phone"],
    "customer_email": ["customer.email", "customer_email"],
    "payment_terms": ["payment_terms"],
    "po_number": ["po_number"],
    "notes": ["notes"],
}
HEADER_DATES = ["invoice_date", "due_date"]
HEADER_MONEY = {
    "subtotal": 18, "tax_amount": 18, "tax_rate": 5,
    "shipping_amount": 18, "discount_amount": 18, "total_amount": 18,
}
# Line fields as keys of the array object, and the names records may use instead.
LINE_FIELDS = {
    "line_number": ["line_number"],
    "item_description": ["line_description", "item_description", "description"],
    "item_code": ["item_code"],
    "quantity": ["quantity"],
    "unit_of_measure": ["unit_of_measure"],
    "unit_price": ["unit_price"],
    "line_amount": ["line_amount", "total"],
    "tax_amount": ["tax_amount"],
    "category": ["category"],
    "notes": ["line_note", "notes"],
}
APP_TEXT = ["VendorName", "InvoiceNo", "PurchaseOrderNo", "InvoiceDate"]
APP_MONEY = ["InvoiceSubtotal", "InvoiceTaxAmount", "InvoiceTotal", "DepositCreditAmount"]


def successful(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("processing_status") == "SUCCESS")


def with_content(raw: DataFrame, key: str = "extraction_id") -> DataFrame:
    """``_v``: the extraction result without its envelope; ``_parent`` and ``_offset``: the document it belongs to
    and how many of its lines earlier parts hold.

    A document with very many lines comes in parts. Each further part has ``continues``: the first part's key, a
    colon and the number of lines before it.
    """
    content = once(raw, raw.columns, F.struct(unwrap(F.col("extracted_json")).alias("_v")))
    link = F.split(text_at(F.col("_v"), "continues"), ":")
    kind = raw.schema[key].dataType
    return content.withColumns({
        "_parent": F.coalesce(F.try_element_at(link, F.lit(1)).try_cast(kind), F.col(key)),
        "_offset": F.coalesce(F.try_element_at(link, F.lit(2)).try_cast("int"), F.lit(0)),
    })


def begins(v: Column) -> Column:
    """Whether the content is a document's first or only part."""
    return text_at(v, "continues").isNull()


def documents(raw: DataFrame, key: str = "extraction_id") -> DataFrame:
    """``with_content`` of the first parts: one row per document."""
    return with_content(raw, key).filter(begins(F.col("_v")))


def parse_header(raw: DataFrame, where: Column | None = None) -> DataFrame:
    """One typed invoice row per successful extraction; ``where`` is a rule on its columns.

    ``invoice_id`` is the extraction id, so lines link to it without reading it back.
    """
    money = {name: [f"financial.{name}", name] for name in [*HEADER_MONEY, "currency"]}
    paths = [p for of in [*HEADER_TEXT.values(), *money.values()] for p in of] + HEADER_DATES
    nested = {p.split(".")[0] for p in paths if "." in p}

    def pick(*names: str) -> Column:
        """As ``text_at``, from the fields that were read in one pass over the document."""
        return F.coalesce(*[F.try_variant_get(f"_h.{first}", f"${dot}{rest}", "string") if first in nested else F.col(f"_h.{first}")
                            for first, dot, rest in (name.partition(".") for name in names)])

    cols = [F.col("extraction_id").alias("invoice_id"), "extraction_id"]
    cols += [pick(*of).alias(name) for name, of in HEADER_TEXT.items()]
    cols += [safe_date(pick(name)).alias(name) for name in HEADER_DATES]
    cols += [safe_decimal(pick(*money[name]), precision, 2).alias(name) for name, precision in HEADER_MONEY.items()]
    cols += [F.coalesce(pick(*money["currency"]), F.lit("USD")).alias("currency"), F.col("extraction_timestamp").alias("created_timestamp")]
    kinds = {p.split(".")[0]: "variant" if p.split(".")[0] in nested else "string" for p in paths}
    read = once(documents(successful(raw)), ["extraction_id", "extraction_timestamp"], F.struct(fields_at(F.col("_v"), "$", kinds).alias("_h")))
    header = conform(read.select(*cols), INVOICE)
    return header if where is None else header.filter(where)


def rejected_headers(raw: DataFrame, where: Column) -> DataFrame:
    """Rows ``parse_header(raw, where)`` leaves out, a rule that gives NULL included."""
    return parse_header(raw).filter(~F.coalesce(where, F.lit(False)))


LINE_KEYS = sorted({k for names in LINE_FIELDS.values() for k in names})
LINE_RECORDS = f"array<struct<{','.join(f'{k}:string' for k in LINE_KEYS)}>>"


def _line_shapes(v: Column) -> Column:
    """Struct of the lines as records and as columns, each read in one pass; NULL if the document has the other shape."""
    return F.struct(F.try_variant_get(v, "$.line_items", LINE_RECORDS).alias("_records"),
                    fields_at(v, "$.line_items", dict.fromkeys(LINE_KEYS, "array<string>")).alias("_columns"))


def _lines(pad: str) -> Column:
    """Array of line structs of text, whatever shape the document used, from ``_line_shapes``."""
    zipped = F.arrays_zip(*[F.coalesce(F.col(f"_columns.{k}"), F.array().cast("array<string>")).alias(k) for k in LINE_KEYS])
    if pad == "driver":
        zipped = F.slice(zipped, F.lit(1), F.coalesce(F.size("_columns.line_number"), F.lit(0)))
    elif pad != "longest":
        raise ValueError("pad is 'driver' or 'longest'")
    return F.coalesce("_records", zipped.cast(LINE_RECORDS))


def parse_lines(raw: DataFrame, pad: str = "driver") -> DataFrame:
    """One typed line per array position.

    ``driver`` yields as many lines as there are line numbers; ``longest`` keeps every
    position of the longest array. Shorter arrays give NULL. Record arrays give all records.
    Lines of a further part belong to the first part's document.
    """
    read = once(with_content(successful(raw)), ["_parent", "extraction_timestamp", "_offset"], _line_shapes(F.col("_v")))
    lines = read.select(
        F.col("_parent").alias("extraction_id"), "extraction_timestamp", "_offset", F.posexplode(_lines(pad)).alias("_pos", "_r"))
    text = {name: F.coalesce(*[F.col(f"_r.{k}") for k in keys]) for name, keys in LINE_FIELDS.items()}
    return conform(
        lines.select(
            F.xxhash64("extraction_id", F.col("_offset") + F.col("_pos")).alias("invoice_detail_id"),
            F.col("extraction_id").alias("invoice_id"),
            safe_decimal(text["line_number"]).cast("bigint").alias("line_number"),
            safe_decimal(text["quantity"], 18, 4).alias("quantity"),
            safe_decimal(text["unit_price"], 18, 4).alias("unit_price"),
            safe_decimal(text["line_amount"], 18, 2).alias("line_amount"),
            safe_decimal(text["tax_amount"], 18, 2).alias("tax_amount"),
            *[text[n].alias(n) for n in ("item_description", "item_code", "unit_of_measure", "category", "notes")],
            F.col("extraction_timestamp").alias("created_timestamp"),
        ),
        INVOICE_DETAIL,
    )


def flatten_records(raw: DataFrame, key: str = "extraction_id") -> DataFrame:
    """Record arrays only: one row per record, numbers without decimals as a plain number cast gives."""
    records = F.try_variant_get(
        F.col("_v"), "$.line_items",
        "array<struct<description:string,quantity:string,unit_price:string,line_amount:string>>",
    )
    lines = with_content(successful(raw), key).select(
        F.col("_parent").alias(key), text_at(F.col("_v"), "invoice_number").alias("invoice_number"), F.explode(records).alias("r")
    )
    return lines.select(
        key, "invoice_number", F.col("r.description").alias("item_description"),
        *[safe_decimal(F.col(f"r.{c}")).alias(c) for c in ("quantity", "unit_price", "line_amount")],
    )


def flatten_fields(raw: DataFrame) -> DataFrame:
    """Four header fields straight from the extraction result."""
    v = F.col("_v")
    return documents(successful(raw)).select(
        F.col("file_name").alias("filename"),
        text_at(v, "invoice_number").alias("invoice_number"),
        safe_date(text_at(v, "invoice_date")).alias("invoice_date"),
        text_at(v, "vendor.name", "vendor_name", "vendor").alias("vendor_name"),
        safe_decimal(text_at(v, "financial.total_amount", "total_amount")).alias("total_amount"),
    )


def line_counts(raw: DataFrame) -> DataFrame:
    """Line items per document (``extraction_id``, ``line_items``) over all its parts; NULL without lines."""
    counts = with_content(successful(raw)).select(
        F.col("_parent").alias("extraction_id"), line_item_count(F.col("_v")).cast("bigint").alias("n"))
    return counts.groupBy("extraction_id").agg(F.sum("n").alias("line_items"))


def json_structure(raw: DataFrame) -> DataFrame:
    """Header fields and the number of lines per document; the first part has the header, every part counts."""
    v = F.col("_v")
    head = F.struct(
        "file_name", text_at(v, "invoice_number").alias("invoice_number"), text_at(v, "invoice_date").alias("invoice_date"),
        text_at(v, "vendor.name", "vendor_name", "vendor").alias("vendor_name"),
        text_at(v, "customer.name", "customer_name", "customer").alias("customer_name"),
        safe_decimal(text_at(v, "financial.total_amount", "total_amount")).alias("total_amount"),
    )
    parts = with_content(successful(raw)).select(
        F.col("_parent").alias("extraction_id"), F.when(begins(v), head).alias("h"),
        line_item_count(v).cast("bigint").alias("n"))
    found = parts.groupBy("extraction_id").agg(F.max("h").alias("h"), F.sum("n").alias("line_item_count"))
    return found.filter("h IS NOT NULL").select("extraction_id", "h.*", "line_item_count")


def validation_status(v: Column) -> Column:
    number = text_at(v, "invoice_number")
    total = text_at(v, "financial.total_amount", "total_amount")
    return (
        F.when(number.isNull(), "Missing invoice number")
        .when(total.isNull(), "Missing total")
        .when(safe_decimal(total) <= 0, "Invalid total")
        .otherwise("Valid")
    )


def split_header_detail(responses: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Form response to a header row and lines; every array is padded to the longest."""
    content, v = with_content(responses, key), F.col("_v")
    header = documents(responses, key).select(
        key,
        *[F.coalesce(text_at(v, c), F.lit("")).alias(c) for c in APP_TEXT],
        *[F.coalesce(text_at(v, c), F.lit("0")).alias(c) for c in APP_MONEY],
    )
    arrays = {"Description": "ItemDescriptions", "Quantity": "Quantities", "LineTotal": "LineTotals"}
    zipped = F.arrays_zip(*[
        F.coalesce(texts_at(v, path), F.array().cast("array<string>")).alias(name) for name, path in arrays.items()
    ])
    lines = content.select(F.col("_parent").alias(key), "_offset", F.posexplode(zipped).alias("_pos", "_r"))
    detail = lines.select(
        key, (F.col("_offset") + F.col("_pos") + 1).cast("bigint").alias("LineNumber"),
        *[F.coalesce(F.col(f"_r.{name}"), F.lit("")).alias(name) for name in arrays],
    )
    return header, detail


def drop_empty_lines(detail: DataFrame) -> DataFrame:
    """Without lines that have no description, no quantity and no total."""
    empty = (
        (F.trim(F.coalesce("Description", F.lit(""))) == "")
        & (clean_money(F.col("Quantity"), 28, 6) == 0)
        & (clean_money(F.col("LineTotal"), 28, 6) == 0)
    )
    return detail.filter(~empty)
