"""Relational tables over JDBC (S3)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def scan_options(
    url: str, table: str, key: str, low: int, high: int, tasks: int, fetch_rows: int = 10_000
) -> dict[str, str]:
    """Reader options that split ``SELECT * FROM table`` into ``tasks`` ranges of a numeric ``key``."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(low),
        "upperBound": str(max(high, low + 1)),
        "numPartitions": str(tasks),
        "fetchsize": str(fetch_rows),
    }


def read_relation(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    tasks: int = 64,
    bounds: tuple[int, int] | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """S3: the whole table, read by ``tasks`` connections at a time.

    Without ``bounds`` the database is asked for the least and greatest key first: one row. The bounds only place the
    cuts, rows outside them are read too.
    """
    connect = dict(properties or {})
    if bounds is None:
        ends = f"SELECT min({key}) AS low_end, max({key}) AS high_end FROM {table}"
        low, high = spark.read.format("jdbc").options(url=url, query=ends, **connect).load().first()
        bounds = (low or 0, high or 0)
    options = scan_options(url, table, key, *bounds, tasks)
    return spark.read.format("jdbc").options(**options, **connect).load()
