"""Compare a Spark result with the rows DuckDB returns for the matching SQL."""

import datetime
import math

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if value is None:
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    if isinstance(value, int):
        return str(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), rows_of(df.columns, df.collect())


def duck_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    return sorted(columns), rows_of(columns, cursor.fetchall())
