"""Runs a registered query in Spark and its SQL in DuckDB and compares the rows."""

import datetime
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0 if value else 0.0)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return f"{type(value).__name__} {value}"


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(df, con, sql):
    """None if equal, else a description of the first difference."""
    cursor = con.execute(sql)
    sql_names = [d[0] for d in cursor.description]
    sql_types = {d[0]: str(d[1]) for d in cursor.description}
    expected = _rows(sql_names, cursor.fetchall())
    if sorted(df.columns) != sorted(sql_names):
        return f"columns {sorted(df.columns)} != {sorted(sql_names)}"
    same = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}
    for field in df.schema:
        kind = field.dataType.simpleString()
        if same.get(kind, sql_types[field.name]) != sql_types[field.name]:
            return f"{field.name}: {kind} != {sql_types[field.name]}"
    actual = _rows(df.columns, df.collect())
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    different = [(a, e) for a, e in zip(actual, expected) if a != e]
    if different:
        return f"{len(different)} of {len(actual)} rows differ, first {different[0]}"
    return None
