"""Run a query in Spark and its oracle in DuckDB and compare the rows.

As a script: ``python tests/compare.py [folder] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def oracle_connection(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return int(value) if value == int(value) else round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
         "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP"}


def compare(spark, connection, folder: str, name: str, run, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    df = run(spark, folder)
    names = sorted(df.columns)
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != names:
        return f"columns {names} / {sorted(columns)}"
    kinds = {d[0]: str(d[1]) for d in result.description}
    wrong = [f"{n}: {k} / {kinds[n]}" for n, k in df.dtypes if KINDS.get(k, k) != kinds[n]]
    theirs = Counter(tuple(plain(row[columns.index(n)]) for n in names) for row in result.fetchall())
    ours = Counter(tuple(plain(row[n]) for n in names) for row in df.collect())
    if ours != theirs:
        return (f"{sum(ours.values())} rows / {sum(theirs.values())}; columns {names}\n   only Spark:  {list((ours - theirs).items())[:3]}"
                f"\n   only oracle: {list((theirs - ours).items())[:3]}")
    if not ours:
        return "no rows on either side"
    if wrong:
        return f"types {wrong}"
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    from worktide.plans.catalog import ORACLES, QUERIES

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config(
        "spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(folder)
    names = sys.argv[2:] or list(QUERIES)
    bad = 0
    for name in names:
        began = time.time()
        try:
            if name in ORACLES:
                problem = compare(spark, connection, folder, name, QUERIES[name], ORACLES[name])
            else:
                rows = QUERIES[name](spark, folder).count()
                problem = None if rows else "no rows"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        kind = "oracle" if name in ORACLES else "rows  "
        print(f"{'ok ' if problem is None else 'BAD'} {kind} {time.time() - began:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} fine")


if __name__ == "__main__":
    main()
