"""Stored tables: landing, backup, reset, publish."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from docflow.functions.casts import at
from docflow.schemas import PARSED, RAW_JSON
from docflow.sources.files import ANY_AGE


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in order and type; columns ``df`` lacks become NULL."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def raw_rows(extracted: DataFrame, as_of: str) -> DataFrame:
    """Landing rows with key, time and status defaults filled in."""
    rows = extracted
    if "extraction_id" not in rows.columns:
        rows = rows.withColumn("extraction_id", F.xxhash64("file_name", "last_modified"))
    rows = rows.withColumn("extraction_timestamp", at(as_of))
    if "processing_status" not in rows.columns:
        rows = rows.withColumn("processing_status", F.lit("SUCCESS"))
    return conform(rows, RAW_JSON)


def parsed_rows(parsed: DataFrame, as_of: str) -> DataFrame:
    rows = parsed
    if "parsed_id" not in rows.columns:
        rows = rows.withColumn("parsed_id", F.xxhash64("file_name", "last_modified"))
    return conform(rows.withColumn("parse_timestamp", at(as_of)), PARSED)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One micro-batch in its own folder; a batch that is run again replaces itself."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def stream_table(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Rows appended to a stored table since the last run of the checkpoint."""
    reader = spark.readStream.schema(schema).option("maxFileAge", ANY_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def backup(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reset(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Empty the table, keep its structure."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
