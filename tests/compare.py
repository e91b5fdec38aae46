"""Run a registered query and its SQL equivalent and compare the rows."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str, tables=TABLES) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in tables:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(value):
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return "NULL" if math.isnan(value) else repr(value + 0.0)
    return f"{type(value).__name__}:{value}"


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str:
    """'' when both give the same columns and rows, else a short description."""
    spark_columns, spark_rows = _table(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    sql_columns, sql_rows = _table([d[0] for d in result.description], result.fetchall())
    if spark_columns != sql_columns:
        return f"columns {spark_columns} != {sql_columns}"
    if len(spark_rows) != len(sql_rows):
        return f"{len(spark_rows)} rows != {len(sql_rows)} rows"
    differing = [(a, b) for a, b in zip(spark_rows, sql_rows) if a != b]
    return f"{len(differing)} rows differ, e.g. {differing[0]}" if differing else ""
