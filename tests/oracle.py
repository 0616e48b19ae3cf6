"""Rows of a query and of its SQL, made comparable."""

import math
from pathlib import Path

import duckdb

SF_DIR = "/root/testdata/sf0.01"


def connect(sf_dir=SF_DIR):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return float(f"{value:.10g}")
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def spark_rows(df):
    return sorted(df.columns), canonical(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), canonical(columns, cursor.fetchall())
