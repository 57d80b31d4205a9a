"""Compares a query with its oracle SQL on the smallest test tables, as the driver does."""

import os

import duckdb

DATA = "/root/testdata/sf0.001"


def connection():
    c = duckdb.connect()
    c.execute("set TimeZone='UTC'")
    for name in os.listdir(DATA):
        c.execute(f"create view {name.split('.')[0]} as select * from '{DATA}/{name}'")
    return c


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shown = lambda v: ("nan" if v != v else repr(round(v, 6) + 0.0)) if isinstance(v, float) else repr(v)
    return sorted("|".join(shown(r[i]) for i in order) for r in rows)


def assert_equal(spark, query, sql):
    df = query(spark, DATA)
    found = canonical([tuple(r) for r in df.collect()], df.columns)
    cursor = connection().execute(sql)
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert found == canonical(cursor.fetchall(), columns)
