"""Running a registered query and its SQL counterpart on one folder of tables."""

from __future__ import annotations

import glob
import os

import duckdb


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def rows_of(table) -> tuple[list[str], list[tuple]]:
    names = sorted(table.column_names)
    columns = [table[name].to_pylist() for name in names]
    return names, sorted(zip(*columns), key=repr)


def spark_rows(frame):
    return rows_of(frame.toArrow())


def duck_rows(connection, sql):
    return rows_of(connection.sql(sql).to_arrow_table())
