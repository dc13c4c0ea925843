"""Session settings and shared working folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on; AQE splits hot join keys at run time even when the
# split costs another exchange further down.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Documents are read whole: columns shredded from them would be made into documents again for every reader.
    "spark.sql.variant.writeShredding.enabled": "false",
    "spark.sql.variant.inferShreddingSchema": "false",
    # Folders of very many files: by default up to 10 000 tasks list them.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
}

# Codec of tables that a job writes for itself or its readers: half the size of the default.
PACKED = "zstd"
# Shuffle files of a statement go with its end, not when the driver next collects garbage.
RELEASED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# For streams of very many small files: a task reads many of them. A file source takes it from the session it was made in,
# when a batch is planned.
MANY_FILES = {"spark.sql.files.openCostInBytes": str(64 << 10)}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for what is written or started inside; a stream keeps a copy of them."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, or a new one for local tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="docflow-")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/docflow/{name}-{uuid.uuid4().hex}"


def store(spark: SparkSession, path: str):
    """The Hadoop file system of a path and what makes paths of it."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read again instead of computed again."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete what a query wrote into ``scratch`` and has read to the end."""
    fs, make = store(spark, path)
    fs.delete(make(path), True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read on from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
