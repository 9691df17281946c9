"""Run registered queries against their SQL: ``python -m workload.check [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from workload.oracles import ORACLES
from workload.queries import QUERIES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _rows(names: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(r[i] for i in order) for r in rows)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> str | None:
    """What differs between a query and its SQL, None if nothing does."""
    df = QUERIES[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = _rows(df.columns, got), _rows(names, want)
    if a != b:
        return f"{len(got)} rows, SQL {len(want)}; only here {list((a - b).items())[:2]}; only SQL {list((b - a).items())[:2]}"
    types = {n: str(t) for n, t in zip(names, [d[1] for d in cursor.description], strict=True)}
    ours = dict(df.dtypes)
    pairs = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    wrong = {n: (ours[n], types[n]) for n in names if pairs.get(ours[n]) != types[n]}
    return f"types {wrong}" if wrong else None


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = session(), duck(sf_dir)
    bad = 0
    for name in sys.argv[2:] or list(QUERIES):
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir) if name in ORACLES else "no SQL"
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:24s} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{bad} failed")


if __name__ == "__main__":
    main()
