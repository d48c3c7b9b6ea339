"""Order-insensitive comparison of a registered query with its oracle."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        name, extension = os.path.splitext(file)
        if extension == ".parquet":
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{file}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, decimal.Decimal):
        return str(value)
    return value


KINDS = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def spark_rows(df):
    names = sorted(df.columns)
    kinds = [KINDS[dict(df.dtypes)[n]] for n in names]
    return names, kinds, Counter(tuple(plain(r[n]) for n in names) for r in df.collect())


def oracle_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = [str(d[1]) for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(plain(row[i]) for i in order) for row in cursor.fetchall())
    return [names[i] for i in order], [kinds[i] for i in order], rows
