"""Tables that arrive in micro-batches, rolled up while they grow.

A store holds the published intervals [low, high) of batch ids. A batch publishes [id, id + 1) when all its tables are
written; a roll-up writes neighbouring intervals of one level anew as one of the next level and publishes that. Publishing is
an empty file whose name says it all, which appears at once, so a reader sees either the parts or the whole: an interval that
lies inside another published one no longer counts. Folders have names of their own, nothing is written twice in one place,
and a batch that is run again after it was published changes nothing. With ``fan`` f, n batches lie in at most (f - 1) * (log_f(n) + 1)
folders, and a row is rewritten log_f(n) times. ``vacuum`` deletes what no reader that starts now would read.

Batch ids must ascend; one stream writes a store. A roll-up may run beside it, in another process too.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from docflow.session import PACKED, store

MARK = "~"  # between the parts of a log file's name


@dataclass(frozen=True)
class Interval:
    low: int
    high: int
    folder: str
    level: int
    tables: tuple[str, ...]


def _name(one: Interval) -> str:
    return MARK.join([str(one.low), str(one.high), str(one.level), "+".join(one.tables), one.folder])


def _published(spark: SparkSession, path: str) -> list[Interval]:
    fs, make = store(spark, path)
    log = make(f"{path}/log")
    if not fs.exists(log):
        return []
    out = []
    for status in fs.listStatus(log):  # a file per folder, of which ``vacuum`` leaves a few
        low, high, level, tables, folder = status.getPath().getName().split(MARK)
        out.append(Interval(int(low), int(high), folder, int(level), tuple(tables.split("+")) if tables else ()))
    return out


def _outer(found: list[Interval]) -> list[Interval]:
    """Intervals that lie in no other, in order; of equal ones the first by name."""
    out: list[Interval] = []
    for one in sorted(found, key=lambda x: (x.low, -x.high, x.folder)):
        if not out or one.high > out[-1].high:
            out.append(one)
    return out


def live(spark: SparkSession, path: str) -> list[Interval]:
    """What a reader reads, in order of the batches."""
    return _outer(_published(spark, path))


def _publish(spark: SparkSession, path: str, one: Interval) -> None:
    fs, make = store(spark, path)
    fs.mkdirs(make(f"{path}/log"))
    fs.createNewFile(make(f"{path}/log/{_name(one)}"))


def first_id(spark: SparkSession, path: str, checkpoint: str) -> int:
    """What to add to the batch ids of a stream with this checkpoint: a stream whose checkpoint is new begins behind all
    published batches, though its own ids begin at 0 again. Ask before the stream starts."""
    fs, make = store(spark, path)
    runs, key = make(f"{path}/runs"), hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    fs.mkdirs(runs)
    known = [name.split("-") for name in (s.getPath().getName() for s in fs.listStatus(runs))]
    mine = [int(base) for one, base in known if one == key]
    there, at = store(spark, checkpoint)
    offsets = at(f"{checkpoint}/offsets")
    if there.exists(offsets) and len(there.listStatus(offsets)):
        return max(mine, default=0)
    base = max((x.high for x in live(spark, path)), default=0)
    fs.createNewFile(make(f"{path}/runs/{key}-{base}"))
    return base


def write(spark: SparkSession, path: str, batch_id: int, tables: Callable[[str], list[str]]) -> bool:
    """``tables(folder)`` writes the batch's tables into ``folder`` and names them; False if the batch was there already."""
    seen = live(spark, path)
    if any(x.low <= batch_id < x.high for x in seen):
        return False
    if seen and batch_id < seen[-1].high:
        raise ValueError(f"batch {batch_id} comes after batch {seen[-1].high - 1}")
    name = f"batch-{batch_id}-{uuid.uuid4().hex}"
    _publish(spark, path, Interval(batch_id, batch_id + 1, name, 0, tuple(tables(f"{path}/{name}"))))
    return True


def write_tables(spark: SparkSession, path: str, batch_id: int, **tables: DataFrame) -> bool:
    """The tables of a batch, published together."""

    def put(folder: str) -> list[str]:
        for name, df in tables.items():
            df.write.option("compression", PACKED).parquet(f"{folder}/{name}")
        return list(tables)

    return write(spark, path, batch_id, put)


def read(spark: SparkSession, path: str, name: str, schema: T.StructType | str | None = None, low: bool = False) -> DataFrame:
    """A table of all published batches; ``low`` adds the first batch id of the interval a row lies in."""
    return read_from(spark, path, live(spark, path), name, schema, low)


def read_from(spark: SparkSession, path: str, found: list[Interval], name: str, schema=None, low: bool = False) -> DataFrame:
    here = [x for x in found if name in x.tables]
    if not here:
        if schema is None:
            raise ValueError(f"no batch has a table {name}")
        df = spark.createDataFrame([], schema)
        return df.withColumn("low", F.lit(None).cast("bigint")) if low else df
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(*[f"{path}/{x.folder}/{name}" for x in here])
    if not low:
        return df
    lows = F.create_map(*[F.lit(v) for x in here for v in (x.folder, x.low)])
    return df.withColumn("low", lows[F.element_at(F.split("_metadata.file_path", "/"), -3)])


def roll_up(spark: SparkSession, path: str, merge: Callable[[list[Interval], str], list[str]], fan: int = 4) -> int:
    """Combine ``fan`` neighbours of one level as long as there are any; ``merge(intervals, folder)`` writes their tables.

    Returns the number of intervals written. The newest are combined first, so work follows what has come since.
    """
    made = 0
    while True:
        found = live(spark, path)
        starts = [i for i in range(len(found) - fan, -1, -1) if len({x.level for x in found[i:i + fan]}) == 1]
        if not starts:
            return made
        combine(spark, path, found[starts[0]:starts[0] + fan], merge)
        made += 1


def combine(spark: SparkSession, path: str, parts: list[Interval], merge: Callable[[list[Interval], str], list[str]]) -> None:
    """Neighbouring intervals as one."""
    name = f"rolled-{parts[0].low}-{parts[-1].high}-{uuid.uuid4().hex}"
    tables = merge(parts, f"{path}/{name}")
    _publish(spark, path, Interval(parts[0].low, parts[-1].high, name, max(x.level for x in parts) + 1, tuple(tables)))


def roll_up_tables(spark: SparkSession, path: str, combine: dict[str, Callable[[DataFrame], DataFrame]] | None = None, fan: int = 4) -> int:
    """``roll_up`` of each table by itself; ``combine`` may make fewer rows of those of several batches."""

    def merge(parts: list[Interval], folder: str) -> list[str]:
        names = sorted({name for x in parts for name in x.tables})
        for name in names:
            df = read_from(spark, path, parts, name)
            (combine[name](df) if combine and name in combine else df).write.option("compression", PACKED).parquet(f"{folder}/{name}")
        return names

    return roll_up(spark, path, merge, fan)


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the folders inside rolled-up ones and their log rows; returns how many. Readers that began before the
    last roll-up may still read them, so call it when there are none."""
    seen = _published(spark, path)
    kept = {x.folder for x in _outer(seen)}
    fs, make = store(spark, path)
    gone = [x for x in seen if x.folder not in kept]
    for x in gone:  # the log first: a reader must not be sent to a folder that is gone
        fs.delete(make(f"{path}/log/{_name(x)}"), False)
    for x in gone:
        fs.delete(make(f"{path}/{x.folder}"), True)
    return len(gone)
