"""Run history, alerts and retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from docflow.functions.casts import ago, at, seconds_between, size_category, size_kb
from docflow.operators.analytics import count_when
from docflow.schemas import RUN_LOG
from docflow.session import cut_lineage
from docflow.sources.tables import conform


def with_duration(log: DataFrame) -> DataFrame:
    return log.withColumn(
        "execution_seconds", seconds_between(F.col("query_start_time"), F.col("completed_time"))
    )


def run_history(log: DataFrame, names: list[str], as_of: str, hours: int = 24, limit: int = 20) -> DataFrame:
    """The latest runs of the given jobs."""
    return (
        with_duration(log.filter(F.col("name").isin(names) & (F.col("scheduled_time") > ago(as_of, "HOUR", hours))))
        .select(
            "name", "state", "scheduled_time", "query_start_time", "completed_time",
            "execution_seconds", "return_value", "error_code", "error_message",
        )
        .orderBy(F.col("scheduled_time").desc(), "name").limit(limit)
    )


def success_rate(log: DataFrame, names: list[str], as_of: str, days: int = 7) -> DataFrame:
    ok = count_when(F.col("state") == "SUCCEEDED")
    rate = F.round(ok.cast("decimal(20,0)") * 100 / F.count("*"), 2).cast("decimal(18,2)")
    recent = log.filter(F.col("name").isin(names) & (F.col("scheduled_time") > ago(as_of, "DAY", days)))
    return recent.groupBy("name").agg(
        F.count("*").alias("total_runs"), ok.alias("successful_runs"),
        count_when(F.col("state") == "FAILED").alias("failed_runs"), rate.alias("success_rate_pct"),
    )


def run_states(log: DataFrame, names: list[str]) -> DataFrame:
    return log.filter(F.col("name").isin(names)).select("name", "state").distinct()


def avg_duration(log: DataFrame, name: str, label: str, as_of: str, days: int = 7) -> DataFrame:
    done = log.filter(
        (F.col("name") == name) & (F.col("state") == "SUCCEEDED")
        & (F.col("scheduled_time") > ago(as_of, "DAY", days))
    )
    return with_duration(done).agg(
        F.lit(label).alias("metric"), F.round(F.avg("execution_seconds"), 6).alias("avg_seconds")
    )


def _runs(log: DataFrame, name: str) -> DataFrame:
    done = log.filter((F.col("name") == name) & (F.col("state") == "SUCCEEDED"))
    return with_duration(done).select(F.date_trunc("MINUTE", "scheduled_time").alias("minute"), "execution_seconds")


def _files(raw: DataFrame) -> DataFrame:
    return raw.select("file_name", "file_size", F.date_trunc("MINUTE", "extraction_timestamp").alias("minute"))


def size_vs_time(raw: DataFrame, log: DataFrame, name: str) -> DataFrame:
    """Files next to the runs of a job scheduled in the minute they were extracted (a job is
    scheduled about once a minute). ``size_summary`` gives the totals without these rows."""
    return _files(raw).join(_runs(log, name), "minute").select(
        "file_name", "file_size", size_kb(F.col("file_size")).alias("size_kb"), "execution_seconds",
        size_category(F.col("file_size")).alias("size_category"),
    )


def size_summary(raw: DataFrame, log: DataFrame, name: str) -> DataFrame:
    """Per size category: matches of files and runs, and their seconds. Both sides are reduced
    to a row per minute before they meet, so a crowded minute costs no more than a quiet one."""
    runs = _runs(log, name).groupBy("minute").agg(
        F.count("*").alias("n_runs"), F.sum("execution_seconds").alias("n_seconds"))
    files = _files(raw).groupBy("minute", size_category(F.col("file_size")).alias("size_category")).agg(
        F.count("*").alias("n_files"))
    return files.join(runs, "minute").groupBy("size_category").agg(
        F.sum(F.col("n_files") * F.col("n_runs")).alias("files"),
        F.sum(F.col("n_files") * F.col("n_seconds")).alias("seconds"),
    )


def run_of_each_file(raw: DataFrame, log: DataFrame, name: str) -> DataFrame:
    """Every file with the last successful run of the job that was scheduled when it was extracted or before; of runs of
    one time the one that began and ended last, and none before the first run."""
    runs = log.filter((F.col("name") == name) & (F.col("state") == "SUCCEEDED"))
    runs = with_duration(runs).select("scheduled_time", "query_start_time", "completed_time", "execution_seconds")
    files = raw.select("file_name", "file_size", "extraction_timestamp")
    return as_of_join(files, runs, "extraction_timestamp", "scheduled_time", ["query_start_time", "completed_time"], "file_name")


def as_of_join(left: DataFrame, right: DataFrame, left_time: str, right_time: str, order: list[str], spread: str) -> DataFrame:
    """``left`` with the columns of the last ``right`` row whose time is not after its own; ``order`` decides among equal times.

    Both sides are sorted together in ranges of time, each range hands the last right row it has to those behind it, so a
    left row is one row however many right rows share its minute. Left rows of one time are spread by ``spread``. Left
    rows without a time have no right row.
    """
    at, none = F.col(right_time), F.lit(None)
    found = F.struct(*[F.col(c) for c in right.columns])
    kind = T.StructType(right.schema.fields)
    rows = right.filter(at.isNotNull()).select(
        at.alias("_time"), F.lit(0).alias("_side"), F.struct(*order).alias("_order"), F.lit(0).cast("bigint").alias("_spread"),
        none.cast(T.StructType(left.schema.fields)).alias("_left"), found.alias("_right"))
    rows = rows.unionByName(left.select(
        F.col(left_time).alias("_time"), F.lit(1).alias("_side"), none.cast(rows.schema["_order"].dataType).alias("_order"),
        F.xxhash64(spread).alias("_spread"), F.struct(*left.columns).alias("_left"), none.cast(kind).alias("_right")))
    keys = ["_time", "_side", "_order", "_spread"]
    placed = cut_lineage(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(
        "_part", F.spark_partition_id()).withColumn("_pos", F.monotonically_increasing_id()))
    # A row per range: the last right row in it, then of all ranges before.
    ends = placed.groupBy("_part").agg(F.max_by(F.when(F.col("_side") == 0, F.col("_right")), F.when(F.col("_side") == 0, F.col("_pos"))).alias("_end"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_part", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    here = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    met = placed.withColumn("_here", F.last("_right", ignorenulls=True).over(here)).filter("_side = 1").join(F.broadcast(carried), "_part")
    last = F.when(F.col("_time").isNotNull(), F.coalesce("_here", "_carried"))
    return met.select("_left.*", last.alias("_run")).select(*left.columns, "_run.*")


def failed_runs(log: DataFrame, limit: int = 5) -> DataFrame:
    return (
        log.filter(F.col("state") == "FAILED")
        .orderBy(F.col("scheduled_time").desc(), "name").limit(limit)
        .select("name", "error_code", "error_message")
    )


def error_alert(raw: DataFrame, as_of: str, hours: int = 1) -> DataFrame:
    recent = raw.filter(
        (F.col("processing_status") == "ERROR") & (F.col("extraction_timestamp") > ago(as_of, "HOUR", hours))
    )
    text = F.concat(
        F.lit("There are "), F.col("error_count").cast("string"),
        F.lit(" invoice processing errors in the last hour."),
    )
    return recent.agg(F.count("*").alias("error_count")).select(
        "error_count", (F.col("error_count") > 0).alias("should_alert"),
        F.when(F.col("error_count") > 0, text).alias("message"),
    )


def archive_older_than(df: DataFrame, ts: str, as_of: str, days: int = 90) -> tuple[DataFrame, DataFrame]:
    """(kept, archived) split by one cut-off, so no row falls between the two."""
    old = F.coalesce(F.col(ts) < ago(as_of, "DAY", days), F.lit(False))
    return df.filter(~old), df.filter(old)


def run_row(spark: SparkSession, name: str, started, completed, rows: int | None, error: Exception | None = None) -> DataFrame:
    """Run-log row of one run; ``rows`` it read, or the error it ended with."""
    values = (
        name, "FAILED" if error else "SUCCEEDED", started, started, completed, None if rows is None else str(rows),
        type(error).__name__ if error else None, str(error) if error else None,
    )
    return conform(spark.createDataFrame([values], (
        "name STRING, state STRING, scheduled_time TIMESTAMP_NTZ, query_start_time TIMESTAMP_NTZ, completed_time TIMESTAMP_NTZ, "
        "return_value STRING, error_code STRING, error_message STRING")), RUN_LOG)


def append_run_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def log_line(spark: SparkSession, as_of: str, task: str, level: str, message: str) -> DataFrame:
    return spark.createDataFrame([(task, level, message)], "task_name STRING, log_level STRING, message STRING").select(
        F.xxhash64(F.lit(as_of), "task_name", "message").alias("log_id"), at(as_of).alias("log_timestamp"),
        "task_name", "log_level", "message",
    )
