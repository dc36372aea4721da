"""Compare a Spark result with DuckDB's as bags of rows."""

import datetime
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(connection, df, sql):
    """Row counts and the first differing rows, if any."""
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    expected = bag(names, cursor.fetchall())
    assert sorted(df.columns) == sorted(names), (sorted(set(df.columns) ^ set(names)))
    actual = bag(df.columns, df.collect())
    missing, extra = expected - actual, actual - expected
    return sum(expected.values()), sum(actual.values()), list(missing.items())[:2], list(extra.items())[:2]
