"""Schema-driven field extraction from document text.

A field set is a dict ``{field: description}``. Lines are declared as an object of arrays,
``{"line_items": {"properties": {...}}}``, as an array of records,
``{"line_items": [{...}]}``, or as typed top-level arrays,
``{"Quantities": {"type": "array", ...}}``. The set may be wrapped in
``{"schema": {"properties": ...}}``.

The built-in rules read ``Label: value`` lines and ``#``-led, ``|``-separated line rows with
native regular expressions. A worker, any ``callable(content, fields) -> dict``, replaces
them for other formats and runs over Arrow batches.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from docflow.functions.variants import error_object

# Field names must equal those the normalizer and the form read. Fixed values.
BASIC = {"invoice_number": "Number of the invoice", "total_amount": "Amount to pay"}
VENDOR = {
    "vendor_name": "Who issued the invoice", "vendor_address": "Mailing address of the issuer",
    "vendor_phone": "Phone of the issuer", "vendor_email": "E-mail of the issuer",
}
FINANCIAL = {
    "subtotal": "Sum before tax and shipping", "tax_amount": "Tax charged", "tax_rate": "Tax in percent",
    "shipping": "Delivery charge", "total": "Sum with all charges", "currency": "Currency code",
}
DATES = {
    "invoice_date": "Issue date as YYYY-MM-DD", "due_date": "Payment date as YYYY-MM-DD",
    "service_period_start": "First day of service", "service_period_end": "Last day of service",
}
RECORDS = {
    "invoice_number": "Number of the invoice",
    "line_items": [{
        "description": "What was sold", "quantity": "How many", "unit_price": "Price of one",
        "line_amount": "Price of the line",
    }],
}
FULL = {
    "invoice_number": "Number of the invoice", "order_number": "Number of the order",
    "invoice_date": "Issue date as YYYY-MM-DD", "due_date": "Payment date as YYYY-MM-DD",
    "vendor": "Who issued the invoice", "vendor_address": "Address of the issuer",
    "vendor_phone": "Phone of the issuer", "vendor_email": "E-mail of the issuer",
    "vendor_tax_id": "Tax number of the issuer",
    "customer": "Who has to pay", "customer_address": "Address of the payer",
    "customer_phone": "Phone of the payer", "customer_email": "E-mail of the payer",
    "subtotal": "Sum before tax", "tax_amount": "Tax charged", "tax_rate": "Tax in percent",
    "shipping_amount": "Delivery charge", "discount_amount": "Discount given",
    "total_amount": "Sum with all charges", "currency": "Currency code",
    "payment_terms": "When to pay", "po_number": "Number of the purchase order", "notes": "Remarks",
    "line_items": {"properties": {
        "line_number": "Position", "line_description": "What was sold", "line_amount": "Price of the line",
        "line_note": "Remark on the line", "item_code": "Article code", "quantity": "How many",
        "unit_of_measure": "Unit", "unit_price": "Price of one", "tax_amount": "Tax of the line",
    }},
}
APP = {
    "VendorName": "Who issued the invoice", "InvoiceNo": "Number of the invoice",
    "PurchaseOrderNo": "Number of the purchase order", "InvoiceDate": "Issue date as YYYY-MM-DD",
    "InvoiceSubtotal": "Sum before tax", "InvoiceTaxAmount": "Tax charged",
    "InvoiceTotal": "Sum with all charges", "DepositCreditAmount": "Deposit already paid",
    "Quantities": {"type": "array", "description": "How many, per line"},
    "ItemDescriptions": {"type": "array", "description": "What was sold, per line"},
    "LineTotals": {"type": "array", "description": "Price, per line"},
}

# A further part of a document with very many lines names the first part and the lines before it; every field set
# of the built-in rules reads this mark.
CONTINUES = "continues"

# Labels the built-in rules look for, where they differ from the field name.
LABELS = {
    "vendor_name": "Vendor", "VendorName": "Vendor", "InvoiceNo": "Invoice Number",
    "PurchaseOrderNo": "PO Number", "InvoiceDate": "Invoice Date", "InvoiceSubtotal": "Subtotal",
    "InvoiceTaxAmount": "Tax Amount", "InvoiceTotal": "Total Amount", "total": "Total Amount",
    "DepositCreditAmount": "Deposit", "shipping": "Shipping Amount",
}
# Cells of a line row: "# number | description | code | quantity | unit | price | amount | tax | note".
CELLS = {
    "line_number": 0, "line_description": 1, "description": 1, "ItemDescriptions": 1, "item_code": 2,
    "quantity": 3, "Quantities": 3, "unit_of_measure": 4, "unit_price": 5,
    "line_amount": 6, "total": 6, "LineTotals": 6, "tax_amount": 7, "line_note": 8, "notes": 8,
}


def properties(fields: dict) -> dict:
    """The field set without its ``schema`` wrapper."""
    inner = fields.get("schema", fields)
    return inner.get("properties", inner) if isinstance(inner, dict) else fields


# A labelled line, and a line row after its mark.
LABELLED = r"(?m)^[ \t]*([^:|#\r\n]+?)[ \t]*:[ \t]*([^\r\n]*?)[ \t]*$"
LINE_ROW = r"(?m)^#([^\r\n]*)$"


def read_text(df: DataFrame, text_col: str, lines: bool = True) -> DataFrame:
    """Adds the labels, their values and, for field sets that have ``lines``, the cells of the line rows, each read once."""
    text = F.col(text_col)
    rows = F.regexp_extract_all(text, F.lit(LINE_ROW), F.lit(1))
    cells = [F.transform(rows, lambda row: F.split(row, r"\|")).alias("_cells")] if lines else []
    found = once(df, df.columns, F.struct(F.regexp_extract_all(text, F.lit(LABELLED), F.lit(0)).alias("_labelled"), *cells))
    blanks = F.lit(" \t")
    # A label has no colon, so the first one ends it.
    return once(found, [c for c in found.columns if c != "_labelled"], F.struct(
        F.transform("_labelled", lambda line: F.lower(F.btrim(F.substring_index(line, ":", 1), blanks))).alias("_labels"),
        F.transform("_labelled", lambda line: F.btrim(F.substr(line, F.position(F.lit(":"), line) + 1), blanks)).alias("_values"),
    ))


def _has_lines(spec: object) -> bool:
    return isinstance(spec, list) or isinstance(spec, dict) and ("properties" in spec or spec.get("type") == "array")


def _label_value(field: str) -> Column:
    """Value of the first line that carries the label."""
    label = LABELS.get(field, field.replace("_", " ")).lower()
    # Position 0, no such label, gives index -1 and with it NULL.
    return F.nullif(F.get("_values", F.array_position("_labels", label).cast("int") - 1), F.lit(""))


def _cell(cells: Column, field: str) -> Column:
    return F.nullif(F.trim(F.get(cells, F.lit(CELLS[field]))), F.lit(""))


def _column(field: str) -> Column:
    return F.transform("_cells", lambda cells: _cell(cells, field))


def _records(fields: list[str]) -> Column:
    return F.transform("_cells", lambda cells: F.struct(*[_cell(cells, name).alias(name) for name in fields]))


def rule_columns(fields: dict) -> list[Column]:
    """One native column per declared field, over the columns of ``read_text``."""
    out = []
    for name, spec in properties(fields).items():
        if isinstance(spec, list):
            value = _records(list(spec[0]))
        elif isinstance(spec, dict) and "properties" in spec:
            value = F.struct(*[_column(key).alias(key) for key in spec["properties"]])
        elif isinstance(spec, dict) and spec.get("type") == "array":
            value = _column(name)
        else:
            value = _label_value(name)
        out.append(value.alias(name))
    return out


def readable(df: DataFrame, content_col: str) -> DataFrame:
    """Bytes as text; ``_garbled`` marks bytes that are no UTF-8, which become NULL."""
    if not isinstance(df.schema[content_col].dataType, T.BinaryType):
        return df.withColumn("_garbled", F.lit(False))
    text = F.try_validate_utf8(F.col(content_col).cast("string"))
    return df.withColumn("_garbled", F.col(content_col).isNotNull() & text.isNull()).withColumn(content_col, text)


def extract_fields(
    df: DataFrame, text_col: str, fields: dict,
    worker: Callable[[object, dict], dict] | None = None, partitions: int | None = None,
) -> DataFrame:
    """Adds ``extracted_json`` (VARIANT), ``processing_status`` and ``error_message``.

    A document nothing can be read from becomes an ``ERROR`` row with ``{"error": …}``; it
    never fails the job. ``text_col`` may hold bytes: a worker gets them as they are, the
    built-in rules read them as UTF-8. It is dropped. ``partitions`` spreads few large documents
    over more tasks before a worker.
    """
    if worker is not None:
        return _with_worker(df, text_col, fields, worker, partitions)
    found = _read_fields(readable(df, text_col), text_col, [fields])
    return once(found, [c for c in df.columns if c != text_col], F.struct(
        _content("0").alias("extracted_json"),
        F.when(F.col("_message0").isNull(), "SUCCESS").otherwise("ERROR").alias("processing_status"),
        F.col("_message0").alias("error_message"),
    ))


def _read_fields(source: DataFrame, text_col: str, sets: list[dict]) -> DataFrame:
    """For each field set, by its number, ``_f0`` … with the fields and ``_message0`` … with why there are none."""
    found = read_text(source, text_col, any(_has_lines(spec) for fields in sets for spec in properties(fields).values()))
    found = found.withColumns({
        f"_f{i}": F.struct(*rule_columns(fields), _label_value(CONTINUES).alias(CONTINUES)) for i, fields in enumerate(sets)})
    messages = {}
    for i, fields in enumerate(sets):
        names = list(properties(fields))
        scalars = [n for n, s in properties(fields).items() if isinstance(s, str)]
        probe = [F.col(f"_f{i}.{n}") for n in (scalars or names)]
        messages[f"_message{i}"] = (
            F.when(F.col("_garbled"), "not UTF-8 text").when(F.col(text_col).isNull(), "no text")
            .when(F.coalesce(*[p.cast("string") for p in probe]).isNull(), "no field found")
        )
    return found.withColumns(messages)


def _content(number: str) -> Column:
    message = F.col(f"_message{number}")
    return F.when(message.isNull(), F.try_parse_json(F.to_json(F.col(f"_f{number}")))).otherwise(error_object(message))


def once(df: DataFrame, keep: list[str], result: Column) -> DataFrame:
    """``keep`` and the fields of the struct ``result``, evaluated once per row whatever is asked of them.

    Catalyst copies an expression into every filter it pushes below the projection that makes it; it does not push
    filters on the output of a generator.
    """
    return df.select(*keep, F.inline_outer(F.array(result)))


def _with_worker(df, text_col, fields, worker, partitions) -> DataFrame:
    keep = [f for f in df.schema.fields if f.name != text_col]
    names = [f.name for f in keep]
    wanted = properties(fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            payload, errors = [], []
            for content in pdf[text_col]:
                try:
                    payload.append(json.dumps(worker(content, wanted)))
                    errors.append(None)
                except Exception as exc:  # a bad document is a row, not a failed task
                    payload.append(None)
                    errors.append(f"{type(exc).__name__}: {exc}")
            yield pdf[names].assign(_json=payload, error_message=errors)

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    source = df.repartition(partitions) if partitions else df
    out = source.mapInPandas(run, f"{ddl}, _json STRING, error_message STRING")
    # The worker's text is parsed once; text that is not JSON is an error of that document.
    parsed = out.withColumn("_v", F.try_parse_json("_json"))
    message = F.when(F.col("error_message").isNull() & F.col("_v").isNull(), "not JSON").otherwise(F.col("error_message"))
    return parsed.select(
        *names,
        F.when(message.isNull(), F.col("_v")).otherwise(error_object(message)).alias("extracted_json"),
        F.when(message.isNull(), "SUCCESS").otherwise("ERROR").alias("processing_status"),
        message.alias("error_message"),
    )


def status_label(value: Column) -> Column:
    return F.when(value.isNull(), "Extraction failed").otherwise("Success")


def try_extract(texts: DataFrame, json_col: str) -> DataFrame:
    """Extraction text read as VARIANT once, with both status labels."""
    parsed = texts.withColumn("extracted_data", F.try_parse_json(json_col))
    return parsed.select(
        "*", status_label(F.col("extracted_data")).alias("extraction_status"),
        F.when(F.col("extracted_data").isNotNull(), "SUCCESS").otherwise("ERROR").alias("status"),
    )


def compare_schemas(df: DataFrame, text_col: str, approaches: dict[str, dict]) -> DataFrame:
    """The same documents, made and read once, with several field sets: one row per document and set."""
    found = _read_fields(readable(df, text_col), text_col, list(approaches.values()))
    keep = [c for c in df.columns if c != text_col]
    rows = F.array(*[F.struct(F.lit(label).alias("approach"), F.to_json(_content(str(i))).alias("result"))
                     for i, label in enumerate(approaches)])
    return found.select(*keep, F.inline(rows)).select("approach", *keep, "result")


def schema_agreement(df: DataFrame, text_col: str, a: dict, b: dict) -> DataFrame:
    """Per shared field: in how many documents both sets found it, and found the same."""
    shared = [n for n in properties(a) if n in properties(b)]
    lines = any(_has_lines(spec) for fields in (a, b) for spec in properties(fields).values())
    one = read_text(df, text_col, lines).select(
        F.struct(*rule_columns(a)).alias("a"), F.struct(*rule_columns(b)).alias("b")
    )
    pairs = F.array(*[
        F.struct(F.lit(n).alias("field"), F.col(f"a.{n}").cast("string").alias("x"), F.col(f"b.{n}").cast("string").alias("y"))
        for n in shared
    ])
    return one.select(F.explode(pairs).alias("p")).groupBy(F.col("p.field").alias("field")).agg(
        F.count("*").alias("documents"),
        F.count_if(F.col("p.x").isNotNull() & F.col("p.y").isNotNull()).alias("both_found"),
        F.count_if(F.col("p.x") == F.col("p.y")).alias("equal"),
    )
