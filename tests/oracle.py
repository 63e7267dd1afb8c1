"""Compare a query with its DuckDB oracle as sorted rows."""

from __future__ import annotations

import datetime
import decimal
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return round(value, 6) + 0.0
    if isinstance(value, datetime.date | datetime.datetime):
        return str(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, directory, build, sql):
    frame = build(spark, directory)
    found = rows_of(frame.columns, frame.collect())
    db = duckdb.connect()
    for name in TABLES:
        if os.path.exists(path := f"{directory}/{name}.parquet"):
            db.execute(f"create view {name} as select * from read_parquet('{path}')")
    answer = db.execute(sql)
    wanted = rows_of([d[0] for d in answer.description], answer.fetchall())
    assert found[0] == wanted[0], (found[0], wanted[0])
    assert len(found[1]) == len(wanted[1]), (len(found[1]), len(wanted[1]))
    for a, b in zip(found[1], wanted[1], strict=True):
        assert a == b, (a, b)
    return len(found[1])
