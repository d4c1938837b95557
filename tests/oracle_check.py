"""Run registered queries next to their SQL: python tests/oracle_check.py [sf] [name ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
ROOT = os.environ.get("SIGHTLINE_TESTDATA", "/root/testdata")


def oracle(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _key(value):
    return "null" if value is None else (f"{value!r}")


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_key(row[i]) for i in order) for row in rows)


def compare(spark, connection, name, query, sql, folder):
    """None when equal, else a line that says what differs."""
    frame = query(spark, folder)
    table = frame.toArrow()
    got = [tuple(r.values()) for r in table.to_pylist()]
    result = connection.execute(sql)
    want_names = [d[0] for d in result.description]
    want_types = {d[0]: str(d[1]) for d in result.description}
    want = result.fetchall()
    if sorted(frame.columns) != sorted(want_names):
        return f"columns {sorted(frame.columns)} against {sorted(want_names)}"
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for column, kind in frame.dtypes:
        if same.get(kind) != want_types[column]:
            return f"type of {column}: {kind} against {want_types[column]}"
    a, b = rows_of(frame.columns, got), rows_of(want_names, want)
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"row {x} against {y}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    args = sys.argv[1:]
    folder = f"{ROOT}/{args[0] if args else 'sf0.01'}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sqls, queries = entry.oracle_sql(), entry.queries()
    names = args[1:] or list(queries)
    connection = oracle(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in sqls:
                note = compare(spark, connection, name, queries[name], sqls[name], folder)
            else:
                frame = queries[name](spark, folder)
                rows = frame.collect()
                note = None
                print(f"     rows only: {len(rows)}", [r.asDict() for r in rows[:3]])
        except Exception as failure:  # noqa: BLE001
            note = f"{type(failure).__name__}: {str(failure)[:700]}"
        bad += note is not None
        print(f"{'ok  ' if note is None else 'BAD '} {name} {time.time() - start:.2f}s {note or ''}"[:1200], flush=True)
    print(f"{len(names) - bad} of {len(names)} agree; without SQL: {sorted(set(queries) - set(sqls))}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
