"""Compare every query with its SQL on one scale factor: ``python check.py [sf_dir] [query ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

import queries
from siltstone.session import build_session


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


# Spark type names and the names the checking engine has for them.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "array<float>": "FLOAT[]",
}


def compare(spark, connection, name: str, sf_dir: str) -> str | None:
    """``None`` if rows, names and types agree, else what differs."""
    found = queries.QUERIES[name](spark, sf_dir)
    wanted = connection.sql(queries.ORACLE[name])
    if sorted(found.columns) != sorted(wanted.columns):
        return f"columns {sorted(found.columns)} != {sorted(wanted.columns)}"
    have = {n: TYPES.get(k, k) for n, k in found.dtypes}
    want = dict(zip(wanted.columns, map(str, wanted.types)))
    if have != want:
        return f"types {[(n, have[n], want[n]) for n in have if have[n] != want[n]]}"
    left, right = _rows(found.columns, found.collect()), _rows(wanted.columns, wanted.fetchall())
    if left != right:
        only = [list((a - b).items())[:3] for a, b in ((left, right), (right, left))]
        return f"{sum(left.values())} rows against {sum(right.values())}; only left {only[0]}; only right {only[1]}"
    return None


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = build_session(master="local[8]", spark_ui_enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name in names or queries.ORACLE:
        start = time.time()
        try:
            problem = compare(spark, connection, name, sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} of {len(names or queries.ORACLE)} differ; without SQL: {sorted(set(queries.QUERIES) - set(queries.ORACLE))}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
