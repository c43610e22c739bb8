"""Run queries in Spark and their SQL in DuckDB on the same Parquet files and compare."""

from __future__ import annotations

import glob
import os

import duckdb
import pyarrow as pa

DUCK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "float": "FLOAT",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def compare(df, connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list[str]]:
    """Rows, and what differs (nothing when equal): names, types, and rows as a multiset."""
    problems = []
    got = df.toArrow()
    want = connection.execute(f"DESCRIBE {sql}").fetchall()
    want_types = {r[0]: r[1] for r in want}
    got_types = {n: DUCK_TYPES.get(t, t) for n, t in df.dtypes}
    if want_types != got_types:
        problems.append(f"schema {sorted(got_types.items())} != {sorted(want_types.items())}")
    if set(want_types) != set(got_types):
        return got.num_rows, problems
    names = ", ".join(f'"{n}"' for n in sorted(want_types))
    connection.register("spark_rows", pa.table(got))
    ours, theirs = f"SELECT {names} FROM spark_rows", f"SELECT {names} FROM ({sql})"
    for label, query in (("only Spark", f"{ours} EXCEPT ALL {theirs}"), ("only SQL", f"{theirs} EXCEPT ALL {ours}")):
        rows = connection.execute(f"SELECT * FROM ({query}) LIMIT 3").fetchall()
        if rows:
            problems.append(f"{label}: {rows}")
    connection.unregister("spark_rows")
    return got.num_rows, problems
