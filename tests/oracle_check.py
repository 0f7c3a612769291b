"""Run registered queries next to their DuckDB SQL and compare the rows.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_value(row[i]) for i in order) for row in rows), key=repr)


def difference(spark_df, connection, sql: str, times: list[float] | None = None) -> str | None:
    """None when names, row count and values agree, else what differs first."""
    start = time.time()
    collected = spark_df.collect()
    middle = time.time()
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    fetched = result.fetchall()
    if times is not None:
        times[:] = [middle - start, time.time() - middle]
    ours = rows_of(spark_df.columns, collected)
    theirs = rows_of(names, fetched)
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} against {len(theirs)}"
    for mine, other in zip(ours, theirs):
        if mine != other:
            return f"{str(mine)[:400]} against {str(other)[:400]}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from docquarry.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = build_session(
        "oracle-check", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        times, built = [0.0, 0.0], 0.0
        try:
            df = query(spark, sf_dir)
            built = time.time() - start
            if name in oracles:
                problem = difference(df, connection, oracles[name], times)
            else:
                problem = None
                print(f"  {name}: no SQL, {df.count()} rows")
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} build {built:.2f}s run {times[0]:.2f}s sql {times[1]:.2f}s {problem or ''}", flush=True)
    print("failures", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
