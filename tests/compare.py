"""Runs a query and its oracle SQL on the same tables and compares the rows, columns sorted by name."""

import glob
import os


def connect(folder):
    import duckdb

    c = duckdb.connect()
    for f in glob.glob(f"{folder}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return c


def value(v):
    if v is None or v != v:
        return None
    if hasattr(v, "item"):
        v = v.item()
    return round(v, 6) if isinstance(v, float) else v


def rows(columns, data):
    place = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(value(r[i]) for i in place) for r in data), key=lambda r: tuple((x is None, str(x)) for x in r))


def check(spark, query, sql, folder):
    df = query(spark, folder)
    cursor = connect(folder).execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, cursor.fetchall())
