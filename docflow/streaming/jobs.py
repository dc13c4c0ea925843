"""Incremental jobs: new files to extractions, extractions to tables, running counts."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from docflow.functions.casts import at
from docflow.operators import stored_index
from docflow.operators.documents import parse_documents
from docflow.operators.extract import extract_fields
from docflow.operators.normalize import parse_header, parse_lines
from docflow.operators.quality import latest_invoices
from docflow.operators.runlog import append_run_log, run_row
from docflow.schemas import FILES, INVOICE, INVOICE_DETAIL, PARSED, RAW_JSON
from docflow.session import PACKED, settings, written
from docflow.sources import batches, numbers
from docflow.sources.files import PDF, stream_documents, stream_files
from docflow.sources.keys import dense_ids, reserve
from docflow.sources.tables import conform, write_batch


ROW_GROUP = 16 << 20  # bytes of a row group of the landing table: a batch of few files is read by more tasks than it has files


def trigger(every: str | None) -> dict:
    """``every`` such as ``'1 minute'`` keeps running; None takes what is there and stops."""
    return {"processingTime": every} if every else {"availableNow": True}


def _now(as_of: str | None):
    return at(as_of) if as_of else F.expr("localtimestamp()")


def start_extract_stream(
    spark: SparkSession, files_dir: str, raw_path: str, checkpoint: str, fields: dict,
    pattern: str = PDF, max_files: int | None = None, every: str | None = None,
    worker: Callable | None = None, as_of: str | None = None, separator: str | None = None,
) -> StreamingQuery:
    """New files to rows of the landing table. The file sink's log makes each row appear once.

    With a ``separator`` a file holds many documents, each a row with a key of its own.
    """
    if separator is None:
        files = stream_files(spark, files_dir, pattern, max_files)
        keyed = files.withColumn("extraction_id", F.xxhash64("file_name", "last_modified"))
    else:
        keyed = stream_documents(spark, files_dir, separator, pattern, max_files).withColumnRenamed("document_id", "extraction_id")
    raw = conform(extract_fields(keyed, "content", fields, worker).withColumn("extraction_timestamp", _now(as_of)), RAW_JSON)
    with settings(spark, {"parquet.block.size": str(ROW_GROUP)}):  # the sink takes it from the session
        return (
            raw.writeStream.format("parquet").outputMode("append").option("compression", PACKED)
            .option("path", raw_path).option("checkpointLocation", checkpoint).trigger(**trigger(every)).start()
        )


def start_landing_stream(
    spark: SparkSession, files_dir: str, store_path: str, checkpoint: str, fields: dict, pattern: str = PDF,
    max_files: int | None = None, every: str | None = None, worker: Callable | None = None, as_of: str | None = None,
    separator: str | None = None, fan: int = 4,
) -> StreamingQuery:
    """As ``start_extract_stream``, with consecutive ids in place of hashed ones, and each document once.

    A document is known by its file's name and time and its text. One that landed before, also in another run over the
    same files, is refused and listed (``refused``). Ids of a batch are reserved before it is written, so a batch that runs
    again has the same ones.
    """
    if separator is None:
        files = stream_files(spark, files_dir, pattern, max_files)
    else:
        files = stream_documents(spark, files_dir, separator, pattern, max_files)
    text = F.col("content") if separator else F.coalesce(F.col("content").cast("string"), F.lit(""))
    named = files.withColumn("_key", F.concat_ws("|", "file_name", F.col("last_modified").cast("string"), F.sha2(text.cast("binary"), 256)))

    base = batches.first_id(spark, f"{store_path}/keys", checkpoint)

    def land(batch: DataFrame, batch_id: int) -> None:
        session, batch_id = batch.sparkSession, base + batch_id
        if numbers.has_batch(session, f"{store_path}/keys", batch_id):
            return
        came = written(batch.dropDuplicates(["_key"]), "came")
        known = numbers.known(session, f"{store_path}/keys", came.select("_key"))
        fresh = came.join(known, "_key", "left_anti")
        first = reserve(session, f"{store_path}/ids", batch_id, fresh.count())
        ids = dense_ids(fresh.select("_key"), ["_key"], "extraction_id", first)
        rows = extract_fields(fresh.join(ids, "_key"), "content", fields, worker).withColumn("extraction_timestamp", _now(as_of))
        refused = came.join(known, "_key", "left_semi").select("file_name", "file_url", "file_size", "last_modified")
        batches.write_tables(session, f"{store_path}/tables", batch_id, raw=conform(rows, RAW_JSON), refused=refused)
        numbers.remember(session, f"{store_path}/keys", batch_id, came.select("_key"))
        batches.roll_up_tables(session, f"{store_path}/tables", fan=fan)
        numbers.roll_up(session, f"{store_path}/keys", fan)

    return named.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(**trigger(every)).start()


def read_landed(spark: SparkSession, store_path: str) -> tuple[DataFrame, DataFrame]:
    """The landing table and the refused documents."""
    found = batches.live(spark, f"{store_path}/tables")
    return (batches.read_from(spark, f"{store_path}/tables", found, "raw", RAW_JSON),
            batches.read_from(spark, f"{store_path}/tables", found, "refused", FILES))


def start_document_stream(
    spark: SparkSession, files_dir: str, parsed_path: str, checkpoint: str, pattern: str = "*",
    kind: str = "html", max_files: int | None = None, every: str | None = None, as_of: str | None = None,
    worker: Callable | None = None,
) -> StreamingQuery:
    """New files to rows of the parsed-document table; a ``worker`` gets the bytes of each file."""
    files = stream_files(spark, files_dir, pattern, max_files)
    parsed = conform(
        parse_documents(files, "content", kind=kind, worker=worker)
        .withColumn("parsed_id", F.xxhash64("file_name", "last_modified"))
        .withColumn("parse_timestamp", _now(as_of)),
        PARSED,
    )
    return (
        parsed.writeStream.format("parquet").outputMode("append")
        .option("path", parsed_path).option("checkpointLocation", checkpoint).trigger(**trigger(every)).start()
    )


def start_parse_stream(
    raw: DataFrame, tables_path: str, checkpoint: str, every: str | None = None, pad: str = "driver", fan: int = 4,
    vacuum: bool = False,
) -> StreamingQuery:
    """New landing rows to headers and lines. Both come from the same batch, read twice from
    its files (cheaper than holding the documents), and are published together; batches are rolled up ``fan`` at a time.
    ``vacuum`` deletes what was rolled up at once: only if nobody reads the tables while the stream runs."""

    base = batches.first_id(raw.sparkSession, tables_path, checkpoint)

    def both(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batches.write_tables(spark, tables_path, base + batch_id, invoice=parse_header(batch), invoice_detail=parse_lines(batch, pad))
        batches.roll_up_tables(spark, tables_path, fan=fan)
        if vacuum:
            batches.vacuum(spark, tables_path)

    return (
        raw.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint).trigger(**trigger(every)).start()
    )


def read_tables(spark: SparkSession, tables_path: str) -> tuple[DataFrame, DataFrame]:
    """Headers and lines of the published batches: never headers without their lines."""
    found = batches.live(spark, tables_path)
    return (batches.read_from(spark, tables_path, found, "invoice", INVOICE),
            batches.read_from(spark, tables_path, found, "invoice_detail", INVOICE_DETAIL))


def start_index_stream(
    parsed: DataFrame, index_path: str, checkpoint: str, every: str | None = None, shards: int | None = None, fan: int = 4
) -> StreamingQuery:
    """New, changed and removed (status REMOVED) documents into the stored search index; ``every`` is the lag it may have."""

    base = batches.first_id(parsed.sparkSession, index_path, checkpoint)

    def add(batch: DataFrame, batch_id: int) -> None:
        stored_index.add(batch.sparkSession, index_path, batch, base + batch_id, shards=shards)
        stored_index.roll_up(batch.sparkSession, index_path, fan)

    return (
        parsed.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(**trigger(every)).start()
    )


def hourly_throughput(raw: DataFrame) -> DataFrame:
    """Extractions per hour."""
    hour = F.date_trunc("hour", F.col("extraction_timestamp")).cast("timestamp_ntz")
    return raw.groupBy(hour.alias("hour")).agg(F.count("*").alias("invoices_processed"))


def error_windows(raw: DataFrame) -> DataFrame:
    """Errors in each hour, moving by five minutes."""
    timed = raw.filter(F.col("processing_status") == "ERROR").select(
        F.col("extraction_timestamp").cast("timestamp").alias("t")
    )
    return timed.groupBy(F.window("t", "1 hour", "5 minutes").alias("w")).agg(F.count("*").alias("error_count")).select(
        F.col("w.end").cast("timestamp_ntz").alias("window_end"), "error_count")


def start_counts(
    df: DataFrame, counts: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, every: str | None = None, fan: int = 2
) -> StreamingQuery:
    """The counts of each micro-batch, to be added up by ``read_counts``: no state, no watermark, so a row counts however
    late it comes and the newest hours are there at once. ``fan`` batches at a time are added up into one."""

    base = batches.first_id(df.sparkSession, path, checkpoint)

    def add(batch: DataFrame, batch_id: int) -> None:
        batches.write_tables(batch.sparkSession, path, base + batch_id, counts=counts(batch))
        roll_up_counts(batch.sparkSession, path, fan)

    return df.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(**trigger(every)).start()


def roll_up_counts(spark: SparkSession, path: str, fan: int = 2) -> int:
    """Every column but the last, which is the count, is a key."""

    def add_up(df: DataFrame) -> DataFrame:
        *keys, count = df.columns
        return df.groupBy(*keys).agg(F.sum(count).alias(count)).coalesce(1)

    return batches.roll_up_tables(spark, path, {"counts": add_up}, fan)


def read_counts(spark: SparkSession, path: str, key: str, count: str) -> DataFrame:
    return batches.read(spark, path, "counts").groupBy(key).agg(F.sum(count).alias(count))


def start_logged(
    df: DataFrame, name: str, write: Callable[[DataFrame, int], None], log_path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """``write(batch, batch_id)`` for each micro-batch and a row of the run log for each run; a run that fails is
    logged with its error before the query stops."""

    def run(batch: DataFrame, batch_id: int) -> None:
        started, spark = datetime.now(timezone.utc).replace(tzinfo=None), batch.sparkSession
        try:
            write(batch, batch_id)
            rows, error = batch.count(), None
        except Exception as exc:
            rows, error = None, exc
        append_run_log(run_row(spark, name, started, datetime.now(timezone.utc).replace(tzinfo=None), rows, error), log_path)
        if error is not None:
            raise error

    return df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**trigger(every)).start()


def start_append(df: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    return (
        df.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint).trigger(**trigger(every)).start()
    )


def start_unique_stream(
    invoices: DataFrame, stored_path: str, checkpoint: str, every: str | None = None, numbers_path: str | None = None, fan: int = 4
) -> StreamingQuery:
    """New invoices whose number was not stored before, one per number.

    The memory are the stored numbers in hash buckets beside the table (``numbers_path``): no state to expire, so a number
    that comes back after any time is found, and a batch reads its own buckets only. Rows without a number are all kept.
    """
    path = numbers_path or f"{stored_path.rstrip('/')}-numbers"
    base = batches.first_id(invoices.sparkSession, path, checkpoint)

    def add(batch: DataFrame, batch_id: int) -> None:
        spark, batch_id = batch.sparkSession, base + batch_id
        if numbers.has_batch(spark, path, batch_id):  # all of it was written before
            return
        fresh = written(latest_invoices(batch), "fresh")
        asked = fresh.select("invoice_number").filter("invoice_number is not null")
        write_batch(fresh.join(numbers.known(spark, path, asked), "invoice_number", "left_anti").select(batch.columns), stored_path, batch_id)
        numbers.remember(spark, path, batch_id, asked)
        numbers.roll_up(spark, path, fan)

    return (
        invoices.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(**trigger(every)).start()
    )


def run_once(starters: list[Callable[[], StreamingQuery]]) -> list[StreamingQuery]:
    """Start each job when the one before it has finished; no new data means no batch."""
    done = []
    for start in starters:
        query = start()
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
        done.append(query)
    return done
