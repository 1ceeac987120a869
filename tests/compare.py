"""Run registered queries against their SQL and report differences.

    python -m tests.compare [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import time

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as entry
from tickloom import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return ("nan",) if math.isnan(value) else value + 0.0
    return value.replace(tzinfo=None) if hasattr(value, "tzinfo") else value


def _sorted(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def differences(spark: SparkSession, con, folder: str, name: str, sql: str) -> str | None:
    """None when Spark and SQL agree in columns, types, row count and every value."""
    made = entry.queries()[name](spark, folder)
    ours = [tuple(row) for row in made.collect()]
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    kinds = {d[0]: str(d[1]).upper() for d in answer.description}
    theirs = answer.fetchall()
    if sorted(made.columns) != sorted(names):
        return f"columns {sorted(made.columns)} vs {sorted(names)}"
    spark_kinds = {
        "string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "bigint": "BIGINT", "boolean": "BOOLEAN",
        "timestamp": "TIMESTAMP", "date": "DATE",
    }
    odd = {n: (k, kinds[n]) for n, k in made.dtypes if spark_kinds.get(k) != kinds[n]}
    if odd:
        return f"types {odd}"
    left, right = _sorted(made.columns, ours), _sorted(names, theirs)
    if len(left) != len(right):
        return f"{len(left)} rows vs {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(left)} rows differ, first\n   {sorted(names)}\n   {wrong[0][0]}\n   {wrong[0][1]}"
    return None


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = database(folder), entry.oracle_sql(), 0
    for name in args.names or entry.queries():
        start = time.time()
        if name not in sql:
            print(f"rows only {name}: {entry.queries()[name](spark, folder).count()}", flush=True)
            continue
        try:
            wrong = differences(spark, con, folder, name, sql[name])
        except Exception as error:  # noqa: BLE001
            wrong = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += wrong is not None
        print(f"{'ok ' if wrong is None else 'BAD'} {name} {time.time() - start:.1f}s {wrong or ''}", flush=True)
    print(f"{failed} differ; no SQL: {sorted(set(entry.queries()) - set(sql))}; no query: {sorted(set(sql) - set(entry.queries()))}")


if __name__ == "__main__":
    main()
