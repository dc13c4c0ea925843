"""Reading tables, splits by id, and UTF-8 text inside Arrow batches."""

from __future__ import annotations

import ctypes
import uuid
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.session import shared_dir, tune

BATCH_BYTES = "8m"
BROADCAST_ROWS = 1_000_000  # of a few numbers or one word each
LEAN = {"MALLOC_ARENA_MAX": "1", "MALLOC_TRIM_THRESHOLD_": str(1 << 20), "MALLOC_MMAP_THRESHOLD_": str(1 << 20),
        "ARROW_DEFAULT_MEMORY_POOL": "system"}  # environment of Python workers
ROOT = str(Path(__file__).resolve().parents[2])  # workers import the package from here unless it is installed


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the library, and Arrow batches bounded by bytes (texts differ in length by 10^5)."""
    tune(spark)
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def lean(spark: SparkSession) -> SparkSession:
    """``prepare`` for stages that follow one another on the same executors: Python workers stay from stage to stage, and
    give what they free back at once instead of keeping it for their next task."""
    spark.sparkContext.environment.update(LEAN)
    return prepare(spark)


def give_back() -> None:
    """Memory that the driver's Python has freed goes back to the system; between small objects, glibc keeps it otherwise."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and text columns alone; other columns, whatever their names, can't clash with those an operator makes."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def id_bucket(name: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % n


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow string column as bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case: bytes methods know ASCII only."""
    return text.lower().split()


def small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``BROADCAST_ROWS`` rows; otherwise as it is."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: read again instead of computed again, lost executors or not."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/docflow/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame) -> DataFrame:
    """Stored rows (row_key, row): each row of ``docs``, whatever its columns, under a key of its own."""
    row = F.struct([docs[c] for c in docs.columns]).alias("row")
    return written(docs.select(F.monotonically_increasing_id().alias("row_key"), row), "keyed")


def texts_of(rows: DataFrame) -> DataFrame:
    """The texts of ``keyed`` rows, the key as doc_id: operators judge each row alone, also when ids repeat or are null."""
    return rows.select(F.col("row_key").alias("doc_id"), F.col("row").getField("text").alias("text"))
