"""Document folders: listing, change feed, streams of new files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BINARY_FILE = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
PDF = "*.[pP][dD][fF]"
# Spark leaves out files that are older than the newest one by more than this; copies and backfills keep old dates.
ANY_AGE = "100000d"


def file_url(base: str, path: Column) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), path)


def _describe(df: DataFrame, root: str, keep_content: bool) -> DataFrame:
    tail = F.regexp_replace("path", "^.*?" + _quote(root.rstrip("/").split(":", 1)[-1]) + "/", "")
    cols = [
        tail.alias("file_name"),
        F.col("path").alias("file_url"),
        F.col("length").alias("file_size"),
        F.col("modificationTime").cast("timestamp_ntz").alias("last_modified"),
    ]
    return df.select(*cols, *(["content"] if keep_content else []))


def _quote(text: str) -> str:
    return "\\Q" + text + "\\E"


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Listing only: ``content`` is not selected, so no file is read."""
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    return _describe(found, root, keep_content=False)


def read_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Listing with the bytes of each file, for workers."""
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    return _describe(found, root, keep_content=True)


def stream_files(
    spark: SparkSession, root: str, pattern: str = "*", max_files: int | None = None
) -> DataFrame:
    """New files only, each once per checkpoint; ``max_files`` bounds a micro-batch."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("maxFileAge", ANY_AGE)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _describe(reader.load(root), root, keep_content=True)


def stream_documents(
    spark: SparkSession, root: str, separator: str, pattern: str = "*", max_files: int | None = None
) -> DataFrame:
    """New files that hold many documents each, as a row per document: the file columns, ``document_id`` and ``content``.

    A document ends at ``separator`` or the end of the file. Splits of a large file begin at the next separator, so borders
    do not depend on them. The id is a function of the file's name and time and the document's text, so it is the same in
    every run; equal documents of a file share it. White space between documents is none.
    """
    reader = spark.readStream.option("lineSep", separator).option("maxFileAge", ANY_AGE).option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.option("pathGlobFilter", pattern).text(root).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modificationTime"), F.col("value").alias("content"))
    found = _describe(rows.filter(F.col("content").rlike(r"\S")), root, keep_content=True)
    return found.withColumn("document_id", F.xxhash64("file_name", "last_modified", "content"))


def of_type(files: DataFrame, pattern: str = "%.pdf") -> DataFrame:
    return files.filter(F.col("file_name").ilike(pattern))


def manifest_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Change feed between two listings; a changed file is a DELETE and an INSERT."""
    cols = ["file_url", "file_size", "last_modified"]

    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.select("file_name", F.struct(*cols).alias(tag))

    both = side(old, "o").join(side(new, "n"), "file_name", "full_outer")
    moved = ~F.col("o").eqNullSafe(F.col("n"))
    actions = F.array_compact(F.array(
        F.when(F.col("o").isNotNull(), F.struct(F.lit("DELETE").alias("action"), F.col("o").alias("f"))),
        F.when(F.col("n").isNotNull(), F.struct(F.lit("INSERT").alias("action"), F.col("n").alias("f"))),
    ))
    return (
        both.filter(moved)
        .select("file_name", F.explode(actions).alias("a"))
        .select("file_name", *[F.col(f"a.f.{c}").alias(c) for c in cols], F.col("a.action").alias("action"))
    )


def inserts(feed: DataFrame) -> DataFrame:
    return feed.filter(F.col("action") == "INSERT").drop("action")


def pending(files: DataFrame, landed: DataFrame) -> DataFrame:
    """Files no landing row exists for: what a stream would deliver next."""
    return files.join(landed.select("file_name"), "file_name", "left_anti")


def has_new(files: DataFrame, landed: DataFrame) -> bool:
    return not pending(files, landed).isEmpty()


def drop_reuploads(files: DataFrame) -> DataFrame:
    """One row per name and size, the earliest upload; a grouped minimum, so a name
    uploaded many times is reduced before the shuffle."""
    first = F.min(F.struct("last_modified", "file_url")).alias("f")
    return files.groupBy("file_name", "file_size").agg(first).select(
        "file_name", F.col("f.file_url").alias("file_url"), "file_size",
        F.col("f.last_modified").alias("last_modified"),
    )
