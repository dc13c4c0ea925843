"""Fixed schemas of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {
    "STRING": T.StringType(), "BIGINT": T.LongType(), "DATE": T.DateType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(), "VARIANT": T.VariantType(),
    "DECIMAL(5,2)": T.DecimalType(5, 2), "DECIMAL(18,2)": T.DecimalType(18, 2),
    "DECIMAL(18,4)": T.DecimalType(18, 4), "DECIMAL(38,0)": T.DecimalType(38, 0),
}


def schema(columns: str) -> T.StructType:
    """``name TYPE, …``; unlike ``StructType.fromDDL`` it needs no running session."""
    pairs = [column.split() for column in columns.split(", ")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


FILES = schema("file_name STRING, file_url STRING, file_size BIGINT, last_modified TIMESTAMP_NTZ")

RAW_JSON = schema(
    "extraction_id BIGINT, file_name STRING, file_url STRING, file_size BIGINT, "
    "last_modified TIMESTAMP_NTZ, extracted_json VARIANT, extraction_timestamp TIMESTAMP_NTZ, "
    "processing_status STRING, error_message STRING"
)

INVOICE = schema(
    "invoice_id BIGINT, extraction_id BIGINT, invoice_number STRING, order_number STRING, "
    "invoice_date DATE, due_date DATE, "
    "vendor_name STRING, vendor_address STRING, vendor_city STRING, vendor_state STRING, "
    "vendor_zip STRING, vendor_country STRING, vendor_phone STRING, vendor_email STRING, "
    "vendor_tax_id STRING, "
    "customer_name STRING, customer_address STRING, customer_city STRING, customer_state STRING, "
    "customer_zip STRING, customer_country STRING, customer_phone STRING, customer_email STRING, "
    "subtotal DECIMAL(18,2), tax_amount DECIMAL(18,2), tax_rate DECIMAL(5,2), "
    "shipping_amount DECIMAL(18,2), discount_amount DECIMAL(18,2), total_amount DECIMAL(18,2), "
    "currency STRING, payment_terms STRING, po_number STRING, notes STRING, "
    "created_timestamp TIMESTAMP_NTZ"
)

INVOICE_DETAIL = schema(
    "invoice_detail_id BIGINT, invoice_id BIGINT, line_number BIGINT, item_description STRING, "
    "item_code STRING, quantity DECIMAL(18,4), unit_of_measure STRING, unit_price DECIMAL(18,4), "
    "line_amount DECIMAL(18,2), tax_amount DECIMAL(18,2), category STRING, notes STRING, "
    "created_timestamp TIMESTAMP_NTZ"
)

PARSED = schema(
    "parsed_id BIGINT, file_name STRING, file_url STRING, file_size BIGINT, "
    "last_modified TIMESTAMP_NTZ, parsed_content VARIANT, extracted_text STRING, "
    "parse_timestamp TIMESTAMP_NTZ, processing_status STRING, error_message STRING"
)

APP_HEADER = schema(
    "invoice_id STRING, vendor_name STRING, invoice_no STRING, purchase_order_no STRING, "
    "invoice_date DATE, invoice_subtotal DECIMAL(18,2), invoice_tax_amount DECIMAL(18,2), "
    "invoice_total DECIMAL(18,2), deposit_credit_amount DECIMAL(18,2), uploaded_file_path STRING"
)

APP_DETAIL = schema(
    "detail_id STRING, invoice_id STRING, line_item_number DECIMAL(38,0), "
    "item_description STRING, quantity DECIMAL(38,0), line_total DECIMAL(38,0)"
)

RUN_LOG = schema(
    "name STRING, state STRING, scheduled_time TIMESTAMP_NTZ, query_start_time TIMESTAMP_NTZ, "
    "completed_time TIMESTAMP_NTZ, return_value STRING, error_code STRING, error_message STRING"
)

VALIDATION_ISSUES = schema(
    "issue_id BIGINT, invoice_id BIGINT, issue_type STRING, issue_details STRING, "
    "detected_timestamp TIMESTAMP_NTZ"
)

CORRECTIONS = schema(
    "doc_id STRING, scope STRING, line_id STRING, op STRING, field STRING, value STRING, "
    "seq BIGINT, changed_at TIMESTAMP_NTZ"
)

# Declared text lengths and required or unique keys; fixed values.
LENGTHS = {
    "raw_json": {"file_name": 500, "file_url": 1000, "processing_status": 50, "error_message": 5000},
    "invoice": {
        "invoice_number": 100, "vendor_name": 500, "vendor_address": 1000, "vendor_city": 100,
        "vendor_state": 50, "vendor_zip": 20, "vendor_country": 100, "vendor_phone": 50,
        "vendor_email": 100, "vendor_tax_id": 100, "customer_name": 500, "customer_address": 1000,
        "customer_city": 100, "customer_state": 50, "customer_zip": 20, "customer_country": 100,
        "customer_phone": 50, "customer_email": 100, "currency": 10, "payment_terms": 200,
        "po_number": 100, "notes": 5000,
    },
    "invoice_detail": {
        "item_description": 1000, "item_code": 100, "unit_of_measure": 50, "notes": 1000,
    },
}
