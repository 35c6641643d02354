"""Runs registered queries in Spark and their SQL in DuckDB and compares all values."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(
            f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')"
        )
    return con


def _bag(names: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(repr(row[i]) for i in order) for row in rows)


def difference(spark: SparkSession, con, query, sql: str, sf_dir: str) -> tuple[int, str]:
    """Row count, and a description of the first difference (empty when equal)."""
    df = query(spark, sf_dir)
    ours = _bag(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = _bag(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return sum(ours.values()), f"columns {sorted(df.columns)} / {sorted(names)}"
    if ours == theirs:
        return sum(ours.values()), ""
    only_ours, only_theirs = ours - theirs, theirs - ours
    return sum(ours.values()), (
        f"{sum(only_ours.values())} / {sum(only_theirs.values())} rows differ, e.g. "
        f"{sorted(only_ours)[:1]} / {sorted(only_theirs)[:1]}"
    )


def main(names: list[str], sf_dir: str = "/root/testdata/sf0.01") -> int:
    from verification.oracle import ORACLE
    from verification.queries import QUERIES
    from wattline.session import local_session

    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for name in names or QUERIES:
        start = time.time()
        if name not in ORACLE:
            print(f"{name}: no oracle, {QUERIES[name](spark, sf_dir).count()} rows")
            continue
        count, text = difference(spark, con, QUERIES[name], ORACLE[name], sf_dir)
        bad += bool(text)
        print(f"{name}: {count} rows, {time.time() - start:.1f}s {text or 'equal'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    sys.exit(main(sys.argv[1:]))
