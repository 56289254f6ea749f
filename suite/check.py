"""Compare registered queries with their SQL: ``python -m suite.check <folder> [name ...]``."""

from __future__ import annotations

import sys
import time
from datetime import datetime

import duckdb

from parcelspark.session import build_session
from suite import load
from suite.registry import ORACLES, QUERIES, TABLES

SAME_TYPE = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT",
}


def connect(root: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet')")
    return con


def _sortable(row):
    return tuple((v is not None, str(v)) for v in row)


def compare(spark, con, root: str, name: str) -> str:
    """'' when equal, else what differs."""
    df = QUERIES[name](spark, root)
    columns = sorted(df.columns)
    rows = [tuple(r[c] for c in columns) for r in df.collect()]
    if name not in ORACLES:
        return "" if df.columns else "no columns"
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    raw = cursor.fetchall()
    if sorted(names) != columns:
        return f"columns {sorted(set(names) ^ set(columns))}"
    order = [names.index(c) for c in columns]
    expected = [tuple(r[i] for i in order) for r in raw]
    for c, t in df.dtypes:
        want = SAME_TYPE.get(t, t)
        if types[c] != want:
            return f"type of {c}: {t} against {types[c]}"
    if len(rows) != len(expected):
        return f"rows {len(rows)} against {len(expected)}"
    a, b = sorted(rows, key=_sortable), sorted(expected, key=_sortable)
    for got, want in zip(a, b):
        if got != want:
            differing = [(c, x, y) for c, x, y in zip(columns, got, want) if x != y]
            return f"values {differing[:4]} in {got[:6]}"
    return ""


def main(root: str, wanted: list[str]) -> int:
    load()
    spark = build_session("check", master="local[8]", shuffle_partitions=8, driver_memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(root)
    bad = 0
    for name in wanted or list(QUERIES):
        start = time.time()
        try:
            problem = compare(spark, con, root, name)
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        kind = "oracle" if name in ORACLES else "rows"
        print(f"{datetime.now():%H:%M:%S} {'ok ' if not problem else 'BAD'} {kind} {name} {time.time() - start:.1f}s "
              f"{problem}", flush=True)
        bad += bool(problem)
    print(f"{bad} bad")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
