"""Compare registered queries with their SQL on DuckDB: names, row counts, values."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return ("n", str(v.normalize() + 0) if v else "0")
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("n", str(decimal.Decimal(v).normalize() + 0) if v else "0")
    if isinstance(v, float):
        return ("f", "nan" if math.isnan(v) else repr(round(v, 9) + 0.0))
    if isinstance(v, datetime.datetime):
        return ("t", v.replace(tzinfo=None).isoformat())
    if isinstance(v, datetime.date):
        return ("d", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(plain(x) for x in v))
    return ("s", v)


def rows(columns: list[str], data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in data)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got = df.collect()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = rows(df.columns, got), rows(names, want)
    if a == b:
        return None
    return f"rows {len(got)} vs {len(want)}; only spark {list((a - b).items())[:2]}; only sql {list((b - a).items())[:2]}"


def main(sf_dir: str, prefixes: list[str]) -> int:
    from pyspark.sql import SparkSession

    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g").config("spark.sql.shuffle.partitions", "8").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    oracles = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            why = compare(df, connect(sf_dir), oracles[name]) if name in oracles else f"(no SQL, {df.count()} rows)"
        except Exception as exc:
            why = f"{type(exc).__name__}: {str(exc)[:700]}"
        ok = why is None or why.startswith("(no SQL")
        bad += not ok
        print(f"{'ok  ' if ok else 'BAD '} {name} {time.time() - start:.1f}s {why or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
