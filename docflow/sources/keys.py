"""Surrogate keys that come out the same when a task is run again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docflow.session import cut_lineage, store

# monotonically_increasing_id keeps the row position in its lower 33 bits.
POSITION_BITS = 33


def surrogate_key(df: DataFrame, cols: list[str], name: str) -> DataFrame:
    """BIGINT key from the content of ``cols``; needs no order and no shuffle.

    The hash passes over NULL, so each value goes in with a flag: (a, NULL) and (NULL, a) differ. A stored table whose
    keys must never collide takes ``uuid_key`` or ``dense_ids``; ``quality.declared_checks`` finds a key that is there twice.
    """
    return df.withColumn(name, F.xxhash64(*[x for c in cols for x in (F.col(c).isNull(), F.col(c))]))


def uuid_key(*cols: Column) -> Column:
    """Text key in UUID form, a function of the content."""
    h = F.sha2(F.concat_ws("\u0001", *[F.coalesce(c.cast("string"), F.lit("\u0002")) for c in cols]), 256)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(h, at, n) for at, n in cuts])


def dense_ids(df: DataFrame, order_cols: list[str], name: str, start: int = 1) -> DataFrame:
    """Consecutive ids in the order of ``order_cols`` without a single-task sort.

    Rows are range-partitioned and written to the checkpoint folder once, so positions
    cannot move between the count and the numbering. ``order_cols`` should be unique,
    otherwise equal rows fall into one range.
    """
    placed = (
        df.repartitionByRange(*order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND((1 << POSITION_BITS) - 1))
    )
    placed = cut_lineage(placed)
    # One row per partition: at most spark.sql.shuffle.partitions rows.
    sizes = sorted((r["_part"], r["n"]) for r in placed.groupBy("_part").agg(F.count("*").alias("n")).collect())
    offsets, total = [], start
    for part, n in sizes:
        offsets.append((part, total))
        total += n
    if not offsets:
        return placed.select(*df.columns, F.lit(None).cast("bigint").alias(name))
    small = df.sparkSession.createDataFrame(offsets, "_part INT, _offset BIGINT")
    return placed.join(F.broadcast(small), "_part").select(
        *df.columns, (F.col("_offset") + F.col("_pos")).alias(name)
    )


def reserve(spark: SparkSession, path: str, batch_id: int, n: int) -> int:
    """The first of ``n`` consecutive ids that belong to a batch; the same for a batch that runs again.

    Each batch has a file in the log at ``path``, named after its id, first id and number, and begins where the last one
    before it ended. One stream writes a log; it must ask in the order of its batches.
    """
    fs, make = store(spark, path)
    fs.mkdirs(make(path))
    taken = [tuple(map(int, s.getPath().getName().split("-"))) for s in fs.listStatus(make(path))]
    for batch, first, size in taken:
        if batch == batch_id:
            if size != n:
                raise ValueError(f"batch {batch_id} had {size} rows before, not {n}")
            return first
    first = max((first + size for batch, first, size in taken if batch < batch_id), default=1)
    if any(batch > batch_id for batch, _, _ in taken):
        raise ValueError(f"batch {batch_id} comes after a later one")
    fs.createNewFile(make(f"{path}/{batch_id}-{first}-{n}"))
    return first


def unique_path(name: Column, key: Column, day: Column) -> Column:
    """``invoices/MM-dd-yyyy/<stem>_<8 hex of key>.<ext>``."""
    from docflow.functions.casts import file_extension, file_stem

    short = F.substring(F.sha2(key.cast("string"), 256), 1, 8)
    return F.concat(
        F.lit("invoices/"), F.date_format(day, "MM-dd-yyyy"), F.lit("/"),
        file_stem(name), F.lit("_"), short, F.lit("."), file_extension(name),
    )
