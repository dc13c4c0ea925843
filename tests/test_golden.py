"""Hand-written rows, one per rule."""

from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from docflow.functions.casts import clean_money, safe_date, safe_decimal, seconds_between, strict_date
from docflow.functions.variants import first_of, line_item_count
from docflow.operators import normalize as n, quality as q, review, runlog, semantic as m
from docflow.schemas import INVOICE, INVOICE_DETAIL
from docflow.sources.tables import conform


def raw(spark, *jsons):
    rows = [(i, f"f{i}.pdf", j, datetime(2024, 1, 1), "SUCCESS") for i, j in enumerate(jsons)]
    df = spark.createDataFrame(
        rows, "extraction_id BIGINT, file_name STRING, j STRING, extraction_timestamp TIMESTAMP_NTZ, processing_status STRING")
    return df.withColumn("extracted_json", F.parse_json("j")).drop("j")


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()["y"]


def test_json_null_is_missing(spark):
    assert [r.currency for r in n.parse_header(raw(spark, '{"currency":null}', "{}")).collect()] == ["USD", "USD"]


def test_ragged_arrays(spark):
    doc = raw(spark, '{"line_items":{"line_number":[1,2,3],"line_description":["a"],"line_amount":["1","x"]}}')
    got = n.parse_lines(doc).orderBy("line_number").collect()
    assert [(r.line_number, r.item_description, r.line_amount) for r in got] == [
        (1, "a", D("1.00")), (2, None, None), (3, None, None)]


def test_lines_without_numbers(spark):
    doc = raw(spark, '{"invoice_number":"1","line_items":{"line_description":["a","b"]}}')
    assert n.parse_lines(doc).count() == 0
    assert n.parse_lines(doc, pad="longest").count() == 2
    assert [r.issue_type for r in q.json_issues(doc).collect()] == ["Lines without line_number"]
    with pytest.raises(ValueError):
        n.parse_lines(doc, pad="other")


def test_driver_lines_are_among_the_longest(spark, tables):
    a = n.parse_lines(tables.raw_json).select("invoice_detail_id")
    b = n.parse_lines(tables.raw_json, pad="longest").select("invoice_detail_id")
    assert a.exceptAll(b).count() == 0


@pytest.mark.parametrize("doc", ['{"vendor":{"name":"A"}}', '{"response":{"vendor":"A"}}', '{"vendor":"A"}', '{"vendor_name":"A"}'])
def test_vendor_in_every_shape(spark, doc):
    assert n.parse_header(raw(spark, doc)).first().vendor_name == "A"


@pytest.mark.parametrize("doc, want", [
    ('{"vendor":{"name":null},"vendor_name":"B","financial":{"subtotal":"1.5","currency":null},"subtotal":2,"currency":"EUR"}', ("B", "1.50", "EUR")),
    ('{"vendor":{"city":"X"},"financial":7,"subtotal":"2"}', ('{"city":"X"}', "2.00", "USD")),
    ('{"vendor":null,"vendor_name":{"a":1},"financial":[1],"currency":["x"]}', ('{"a":1}', None, '["x"]')),
    ("[1]", (None, None, "USD")), ("7", (None, None, "USD")),
])
def test_header_fields_in_odd_shapes(spark, doc, want):
    r = n.parse_header(raw(spark, doc)).first()
    assert (r.vendor_name, r.subtotal and str(r.subtotal), r.currency) == want


def test_labels_are_found_in_one_pass(spark):
    from docflow.operators.extract import read_text

    text = "INVOICE\n \tVendor Name \t:\t A: b \t\n# 1 | x: y\nTOTAL:\r\nn|o: 1\n: none\nDate:2024\u2028Due : x\ny"
    got = read_text(spark.createDataFrame([(text,), (None,), ("",)], "text string"), "text", lines=False)
    assert [(r._labels, r._values) for r in got.collect()] == [
        (["vendor name", "total", "date", "due"], ["A: b", "", "2024", "x"]), (None, None), ([], [])]
    assert got._jdf.queryExecution().executedPlan().toString().count("regexp_extract_all") == 1


def test_lines_in_odd_shapes(spark):
    docs = raw(spark, '{"line_items":{"line_number":["1",null,3],"quantity":"4","unit_price":[{"a":1}]}}', '{"line_items":[{"line_number":1,"quantity":[2]},7,null]}',
               '{"line_items":"none"}', '{"line_items":null}', "[]")
    got = sorted(((r.invoice_id, r.line_number, r.quantity, r.unit_price) for r in n.parse_lines(docs).collect()), key=str)
    one, two = sorted({g[0] for g in got})
    assert sorted([g[1:] for g in got if g[0] == one], key=str) == sorted([(1, None, None), (3, None, None), (None, None, None)], key=str)
    assert sorted([g[1:] for g in got if g[0] == two], key=str) == sorted([(1, None, None), (None, None, None), (None, None, None)], key=str)


def test_line_item_count(spark):
    docs = raw(spark, '{"line_items":[{},{}]}', '{"line_items":{"a":[1,2,3],"b":[1]}}', "{}", '{"line_items":{}}')
    got = docs.select(line_item_count(F.col("extracted_json")).alias("n")).collect()
    assert [r.n for r in got] == [2, 3, None, 0]


def test_json_issues(spark):
    docs = raw(spark, "{}", '{"invoice_number":"1"}', '{"invoice_number":"1","line_items":[]}',
               '{"invoice_number":"1","line_items":[{"line_number":1}]}')
    assert [r.issue_type for r in q.json_issues(docs).orderBy("extraction_id").collect()] == [
        "Missing invoice_number", "Missing line_items", "Empty line_items"]


def test_fallback_and_validation(spark):
    docs = raw(spark, '{"invoice_id":"7"}', "{}", '{"invoice_number":"1","total_amount":"0"}', '{"invoice_number":"1","total_amount":5}',
               '{"invoice_number":"1"}')
    v = F.col("extracted_json")
    got = docs.select(first_of(v, "invoice_number", "invoice_id").alias("r"), n.validation_status(v).alias("s")).collect()
    assert [r.r for r in got][:2] == ["7", "UNKNOWN"]
    assert [r.s for r in got] == ["Missing invoice number", "Missing invoice number", "Invalid total", "Valid", "Missing total"]


@pytest.mark.parametrize("text,want", [("2024-01-15", date(2024, 1, 15)), ("01/15/2024", None), ("2024", None), ("", None), ("2024-13-01", None)])
def test_safe_date(spark, text, want):
    assert one(spark, safe_date, text) == want


def test_strict_date(spark):
    assert one(spark, strict_date, " ") is None
    with pytest.raises(Exception):
        one(spark, strict_date, "01/15/2024")


@pytest.mark.parametrize("text,want", [("12.345", D("12.35")), ("1,234.50", None), ("abc", None), ("1e3", D("1000.00"))])
def test_safe_decimal(spark, text, want):
    assert one(spark, lambda c: safe_decimal(c, 18, 2), text) == want


@pytest.mark.parametrize("text,want", [("$1,200.00", 1200), ("None", 0), (None, 0), ("", 0), ("€5", 0), ("(100)", 0), (" $ 7 ", 7), ("1 2", 0)])
def test_clean_money(spark, text, want):
    assert one(spark, clean_money, text) == want


def test_seconds_cross_boundaries(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 0, 0, 900000), datetime(2024, 1, 1, 0, 0, 2, 100000))], "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ")
    assert df.select(seconds_between(F.col("a"), F.col("b")).alias("s")).first().s == 2


HEADER = "doc_id STRING, VendorName STRING, InvoiceNo STRING, PurchaseOrderNo STRING, InvoiceDate STRING, InvoiceSubtotal STRING, InvoiceTaxAmount STRING, InvoiceTotal STRING, DepositCreditAmount STRING"
DETAIL = "doc_id STRING, LineNumber BIGINT, Description STRING, Quantity STRING, LineTotal STRING"


def header(spark, *rows):
    return spark.createDataFrame([(d, "V", "N", "", day, sub, "0", total, "0") for d, day, sub, total in rows], HEADER)


def test_total_check(spark):
    head = header(spark, ("a", "", "0.3", "9"), ("b", "", "0", "5"), ("c", "", " ", "5"), ("d", "", "", "0"), ("e", "", "0.25", "1"))
    lines = spark.createDataFrame(
        [("a", 1, "x", "1", "0.1"), ("a", 2, "x", "1", "0.2"), ("b", 1, "x", "1", "5"), ("c", 1, "x", "1", "$4.99"),
         ("e", 1, "x", "1", "0.125"), ("e", 2, "x", "1", "0.125")], DETAIL)
    got = {r.doc_id: r for r in q.check_totals(head, lines).collect()}
    assert (got["a"].matches, got["a"].comparison_field) == (True, "InvoiceSubtotal")
    assert (got["b"].matches, got["b"].comparison_field) == (True, "InvoiceTotal")
    assert (got["c"].matches, got["c"].difference) == (False, D("0.01"))
    assert got["d"].matches and got["d"].line_total_sum == 0
    assert got["e"].matches  # cents are rounded after the sum, not before


def test_empty_lines_and_app_types(spark, tmp_path):
    head = header(spark, ("a", "2024-01-15", "1", "1"), ("bad", "15.01.2024", "1", "1"))
    lines = spark.createDataFrame(
        [("a", 1, " ", "0", ""), ("a", 2, "x", "10.5", "19.99"), ("a", 3, None, None, "3"), ("bad", 1, "x", "1", "1")], DETAIL)
    failed = review.save_reviewed(head, lines, str(tmp_path / "t"), "c1")
    assert [(r.doc_id, r.error) for r in failed.collect()] == [("bad", "not a date: 15.01.2024")]
    saved, detail = review.read_reviewed(spark, str(tmp_path / "t"))
    assert saved.count() == 1
    assert sorted((int(r.quantity), int(r.line_total)) for r in detail.collect()) == [(0, 3), (11, 20)]
    review.save_reviewed(head, lines, str(tmp_path / "u"), "c1", preserve_cents=True)
    kept = review.read_reviewed(spark, str(tmp_path / "u"))[1]
    assert sorted((r.quantity, r.line_total) for r in kept.collect()) == [(D(0), D(3)), (D("10.5"), D("19.99"))]


def test_only_committed_documents_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    head = header(spark, ("a", "", "1", "1"))
    lines = spark.createDataFrame([("a", 1, "x", "1", "1")], DETAIL)
    review.save_reviewed(head, lines, path, "c1")
    review.save_reviewed(head, lines, path, "c1")  # a second run replaces the first
    head.limit(1).write.parquet(f"{path}/header/commit_id=c2")  # a save that stopped half way
    assert review.read_reviewed(spark, path)[0].count() == 1


def test_null_texts_are_saved_as_blank(spark, tmp_path):
    rows = spark.createDataFrame([("a", None, None, None, None, None, None, None, None)], HEADER)
    head, lines, failed = review.reviewed_rows(rows, spark.createDataFrame([], DETAIL))
    got = head.first()
    assert (got.vendor_name, got.invoice_date, got.invoice_total) == ("", None, 0)
    assert lines.count() == 0 and failed.count() == 0


def invoices(spark, *rows):
    df = spark.createDataFrame(rows, "invoice_id BIGINT, invoice_number STRING, vendor_name STRING, created_timestamp TIMESTAMP_NTZ")
    return conform(df, INVOICE)


def test_dedupe(spark):
    t = datetime(2024, 1, 1)
    inv = invoices(spark, (1, "A", "v", t), (2, "A", "v", t), (3, None, "v", t), (4, None, "v", t))
    det = conform(spark.createDataFrame([(10, 1), (20, 2), (30, 3), (99, 99)], "invoice_detail_id BIGINT, invoice_id BIGINT"), INVOICE_DETAIL)
    kept, lines = q.dedupe_latest(inv, det)
    assert sorted(r.invoice_id for r in kept.collect()) == [2, 3, 4]
    assert sorted(r.invoice_id for r in lines.collect()) == [2, 3, 99]
    assert sorted(r.invoice_id for r in q.latest_invoices(inv, "collapse").collect()) == [2, 4]
    again, _ = q.dedupe_latest(kept, lines)
    assert again.count() == kept.count()


def test_duplicate_pairs_name_every_member(spark):
    t = datetime(2024, 1, 1)
    inv = invoices(spark, (1, "A", "v", t), (2, "A", "v", t), (5, "A", "v", t), (3, "A", "w", t), (4, None, "v", t), (6, None, "v", t))
    got = sorted((r.invoice_id_1, r.invoice_id_2) for r in q.duplicate_pairs(inv).collect())
    assert got == [(1, 2), (1, 5)]


def test_archive_boundary(spark):
    rows = [(datetime(2024, 1, 1, 11, 59, 59),), (datetime(2024, 1, 1, 12),), (datetime(2024, 1, 1, 12, 0, 1),), (None,)]
    df = spark.createDataFrame(rows, "t TIMESTAMP_NTZ")
    kept, old = runlog.archive_older_than(df, "t", "2024-03-31 12:00:00", 90)
    assert (kept.count(), old.count()) == (3, 1)
    assert old.first().t == datetime(2024, 1, 1, 11, 59, 59)


def test_alert(spark):
    rows = [(datetime(2024, 1, 1, 11, 30 + i), "ERROR") for i in range(3)] + [(datetime(2024, 1, 1, 11), "ERROR")]
    df = spark.createDataFrame(rows, "extraction_timestamp TIMESTAMP_NTZ, processing_status STRING")
    got = runlog.error_alert(df, "2024-01-01 12:00:00").first()
    assert (got.should_alert, got.message) == (True, "There are 3 invoice processing errors in the last hour.")
    calm = runlog.error_alert(df, "2024-02-01 12:00:00").first()
    assert (calm.should_alert, calm.error_count, calm.message) == (False, 0, None)


def test_synonyms():
    model = m.SemanticModel.from_yaml()
    assert model.resolve("SKU").name == "item_code"
    assert model.resolve("invoice_detail.remarks").name == "line_notes"
    with pytest.raises(ValueError):
        model.resolve("remarks")
    with pytest.raises(ValueError):
        model.resolve("seller state")
    with pytest.raises(KeyError):
        model.resolve("colour")


def test_metric_grain(spark):
    inv = conform(spark.createDataFrame([(1, "A", "100"), (2, "B", "50")], "invoice_id BIGINT, invoice_number STRING, total_amount STRING"), INVOICE)
    det = conform(spark.createDataFrame([(i, 1, "EA") for i in range(3)], "invoice_detail_id BIGINT, invoice_id BIGINT, unit_of_measure STRING"), INVOICE_DETAIL)
    tables = {"invoice": inv, "invoice_detail": det}
    model = m.SemanticModel.from_yaml()
    names = ["total_revenue", "total_line_items", "average_line_items_per_invoice", "total_invoices"]
    got = m.semantic_query(model, tables, [], names).first()
    assert tuple(got) == (D("150.00"), 3, 1.5, 2)
    per = {r.unit_of_measure: (r.total_revenue, r.total_line_items) for r in
           m.semantic_query(model, tables, ["uom"], names[:2]).collect()}
    assert per == {"EA": (D("100.00"), 3), None: (D("50.00"), 0)}


def test_character_references(spark):
    from docflow.operators.documents import decode

    rows = [
        ("no reference", "no reference"), ("", ""), (None, None), ("a & b &", "a & b &"), ("&lt;b&gt; &quot;&apos;&amp;&#39;", "<b> \"'&'"),
        ("it&#8217;s &mdash; caf&eacute; &Eacute;", "it\u2019s \u2014 caf\u00e9 \u00c9"), ("&#x1F600;&#X41;&#65;&#x00e9;", "\U0001f600AA\u00e9"),
        ("&#xD800;|&#0;|&#x110000;|&#99999999;", "\ufffd|\ufffd|\ufffd|\ufffd"), ("&#150;&#128;&#129;", "\u2013\u20ac\x81"), ("a&nbsp;b&#160;c&#xa0;d", "a b c d"),
        ("&amp;lt; &amp;#65;", "&lt; &#65;"), ("&unknown; &copy &#65 &#; &#x;", "&unknown; &copy &#65 &#; &#x;"), ("&hearts;&&hearts;", "\u2665&\u2665"),
    ]
    got = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "i INT, t STRING").select("i", decode(F.col("t")).alias("d")).collect()
    assert [r.d for r in sorted(got)] == [want for _, want in rows]


def test_links_in_any_quotes(spark):
    from docflow.operators.documents import parse_documents

    html = """<p>x</p><a class=k href="/a?x=1&amp;y=2">1</a><A HREF = '/b "q"'>2</A><a href=/c>3</a><a data-href="no">4</a><a href=''>5</a><area href="no">"""
    row = parse_documents(spark.createDataFrame([(html,)], "h STRING"), "h").select(
        F.try_variant_get("parsed_content", "$.links", "array<string>").alias("l")).first()
    assert row.l == ["/a?x=1&y=2", '/b "q"', "/c", ""]
