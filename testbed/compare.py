"""Side by side: a registered query in Spark and its SQL in DuckDB, as sorted rows."""

import os

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        name = file.removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{file}')")
    return db


def spark_rows(result: DataFrame) -> tuple[list[str], list[tuple]]:
    return _sorted(result.columns, [tuple(row) for row in result.collect()])


def duckdb_rows(db: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = db.execute(sql)
    return _sorted([column[0] for column in cursor.description], cursor.fetchall())


def _sorted(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lined_up = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(lined_up, key=lambda row: [(v is None, str(v)) for v in row])
