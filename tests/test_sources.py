"""Files, keys and stored tables."""

from pyspark.sql import functions as F

from docflow.operators import documents as d
from docflow.operators.extract import BASIC, RECORDS, extract_fields
from docflow.sources import files as fs, keys, tables as st


def test_listing_and_content(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.pdf").write_bytes(b"abc")
    (tmp_path / "sub" / "b.PDF").write_bytes(b"defgh")
    (tmp_path / "c.txt").write_bytes(b"x")
    listed = fs.list_files(spark, str(tmp_path), fs.PDF)
    assert {(r.file_name, r.file_size) for r in listed.collect()} == {("a.pdf", 3), ("sub/b.PDF", 5)}
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    assert fs.list_files(spark, str(tmp_path)).count() == 3
    assert {bytes(r.content) for r in fs.read_files(spark, str(tmp_path), "*.txt").collect()} == {b"x"}
    assert fs.of_type(fs.list_files(spark, str(tmp_path))).count() == 2


def test_change_feed(spark):
    schema = "file_name STRING, file_url STRING, file_size BIGINT, last_modified TIMESTAMP_NTZ"

    def listing(**sizes):
        rows = [(k, f"s/{k}", v) for k, v in sizes.items()]
        df = spark.createDataFrame(rows, "file_name STRING, file_url STRING, file_size BIGINT")
        return df.withColumn("last_modified", F.lit("2024-01-01").cast("timestamp_ntz")).select("file_name", "file_url", "file_size", "last_modified")

    old, new = listing(a=1, b=1, c=1), listing(b=1, c=2, d=1)
    feed = fs.manifest_diff(old, new)
    assert sorted((r.file_name, r.action, r.file_size) for r in feed.collect()) == [
        ("a", "DELETE", 1), ("c", "DELETE", 1), ("c", "INSERT", 2), ("d", "INSERT", 1)]
    assert sorted(r.file_name for r in fs.inserts(feed).collect()) == ["c", "d"]
    assert fs.manifest_diff(old, old).count() == 0
    empty = spark.createDataFrame([], schema)
    assert fs.manifest_diff(empty, new).count() == 3 and fs.manifest_diff(new, empty).count() == 3
    assert fs.has_new(new, old) and not fs.has_new(old, old)


def test_dense_ids(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 37 % 1000).alias("k"))
    got = keys.dense_ids(df, ["k"], "n", start=5).collect()
    assert sorted((r.k, r.n) for r in got) == [(i, i + 5) for i in range(1000)]
    assert keys.dense_ids(df.limit(0), ["k"], "n").count() == 0


def test_keys_repeat(spark):
    df = spark.createDataFrame([("a.b.pdf", 1), (None, 2)], "name STRING, id BIGINT")
    a = keys.surrogate_key(df, ["name", "id"], "key").collect()
    assert a == keys.surrogate_key(df.repartition(3), ["name", "id"], "key").orderBy("id").collect()
    u = df.select(keys.uuid_key(F.col("name"), F.col("id")).alias("u")).collect()
    assert all(len(r.u) == 36 and r.u.count("-") == 4 for r in u) and u[0] != u[1]
    p = df.limit(1).select(keys.unique_path(F.col("name"), F.col("id"), F.lit("2024-03-09").cast("date")).alias("p")).first().p
    assert p.startswith("invoices/03-09-2024/a.b_") and p.endswith(".pdf") and len(p) == len("invoices/03-09-2024/a.b_12345678.pdf")


def test_backup_and_reset(spark, tmp_path):
    df = spark.range(3)
    assert st.backup(df, str(tmp_path / "b")).count() == 3
    st.append(df, str(tmp_path / "t"))
    st.append(df, str(tmp_path / "t"))
    assert st.read_table(spark, str(tmp_path / "t"), df.schema).count() == 6
    st.reset(spark, str(tmp_path / "t"), df.schema)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 0


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id BIGINT, text STRING")


def test_labels(spark):
    df = texts(spark, "  invoice number :  A 1 \nTotal Amount: 3\nInvoice Number: second", "Invoice Number:\nTotal amount: 4", "x", None)
    got = extract_fields(df, "text", BASIC).withColumn("j", F.to_json("extracted_json")).orderBy("doc_id").collect()
    assert [r.j for r in got] == [
        '{"invoice_number":"A 1","total_amount":"3"}', '{"total_amount":"4"}', '{"error":"no field found"}', '{"error":"no text"}']
    assert [r.processing_status for r in got] == ["SUCCESS", "SUCCESS", "ERROR", "ERROR"]


def test_records(spark):
    df = texts(spark, "Invoice Number: 1\n# 1 | bolt | S | 2 | EA | 3 | 6 | 0\n# 2 | nut\n")
    got = extract_fields(df, "text", RECORDS).select(F.to_json("extracted_json").alias("j")).first().j
    assert got == ('{"invoice_number":"1","line_items":[{"description":"bolt","line_amount":"6","quantity":"2","unit_price":"3"},'
                   '{"description":"nut"}]}')


def test_worker_errors_stay_with_their_document(spark):
    def worker(content, fields):
        if content == "crash":
            raise KeyError("field")
        return {"n": len(content), "fields": sorted(fields)}

    df = texts(spark, "abc", "crash", "de")
    got = extract_fields(df, "text", BASIC, worker=worker, partitions=2).withColumn("j", F.to_json("extracted_json")).orderBy("doc_id").collect()
    assert [r.processing_status for r in got] == ["SUCCESS", "ERROR", "SUCCESS"]
    assert got[0].j == '{"fields":["invoice_number","total_amount"],"n":3}'
    assert got[1].error_message == "KeyError: 'field'"


PAGE = """<!DOCTYPE html><html><head><title>A &amp; B</title><style>p{}</style><script>var x = "<p>no</p>";</script></head>
<body><!-- <p>hidden</p> --><h2>Head <b>bold</b></h2><p>One<br>two &lt;3<ul><li>first</li><li><a href="/x">link</a></li></ul>tail"""


def test_page_blocks(spark):
    df = spark.createDataFrame([(1, PAGE), (2, "<script>only"), (3, None)], "id BIGINT, html STRING")
    got = d.parse_documents(df, "html").withColumn("j", F.to_json("parsed_content")).orderBy("id").collect()
    assert got[0].extracted_text == "Head bold\nOne\ntwo <3\nfirst\nlink\ntail"
    assert '"title":"A & B"' in got[0].j and '"links":["/x"]' in got[0].j
    assert '{"level":2,"text":"Head bold","type":"heading"}' in got[0].j
    assert [r.processing_status for r in got] == ["SUCCESS", "ERROR", "ERROR"]
    assert d.preview(spark.createDataFrame([("f", "x" * 300)], "file_name STRING, extracted_text STRING")).first().text_preview == "x" * 200


def test_parse_worker(spark):
    df = spark.createDataFrame([(1, "abc")], "id BIGINT, html STRING")
    got = d.parse_documents(df, "html", worker=lambda content, fields: {"title": "t", "blocks": [], "content": content.upper()}).first()
    assert (got.extracted_text, got.processing_status) == ("ABC", "SUCCESS")
