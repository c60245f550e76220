"""Rows of a Spark result and of its SQL equivalent, in a form that can be compared."""

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(plain(row[i]) for i in order) for row in rows])


def spark_rows(df):
    return sorted(df.columns), sorted_rows(df.columns, df.collect())


def sql_rows(sql, folder):
    with duckdb.connect() as con:
        for name in TABLES:
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
        result = con.execute(sql)
        names = [column[0] for column in result.description]
        return sorted(names), sorted_rows(names, result.fetchall())
