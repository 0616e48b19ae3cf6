"""Joins on the record key.

A key posted n times in each of the three sets yields n*n rows in posts+places and n*n*n in all three; nothing here
removes them. The reports need only how often each combination occurs, so they join frames that ``tally`` has reduced to
one row per key and attribute, and multiply the counts. The map-side combine of ``tally`` also takes the hot key apart
before its first shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FORCE_SPLIT = "spark.sql.adaptive.forceOptimizeSkewedJoin"

def join_places(posts: DataFrame, places: DataFrame, key: str = "ind") -> DataFrame:
    """Inner equi-join, one copy of the key. AQE splits a hot key, both sides being plain shuffles."""
    return posts.join(places, key, "inner")


def join_users(users: DataFrame, posts_places: DataFrame, key: str = "ind") -> DataFrame:
    """Inner equi-join of users to the result of J1, one copy of the key.

    A hot key is split in both joins, in any session: where ``spark.sql.adaptive.forceOptimizeSkewedJoin`` is not set (as
    ``session.SETTINGS`` does), the rows of J1 are rebalanced in between. That is one more shuffle of them, but without it
    Spark would reuse J1's partitions for J2 and split neither.
    """
    if users.sparkSession.conf.get(FORCE_SPLIT, "false") != "true":
        posts_places = posts_places.hint("rebalance")
    return users.join(posts_places, key, "inner")


def tally(df: DataFrame, *keys: str, name: str) -> DataFrame:
    """Number of rows per combination of ``keys``, NULL being a value like any other."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def argmax_rows(df: DataFrame, value: str, ties: str = "all", tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """A2+J3: the rows whose ``value`` is the greatest of all. NULL never matches.

    ``ties="one"`` keeps the first row by ``tiebreak``.
    """
    best = df.agg(F.max(value).alias("_best"))
    top = df.join(F.broadcast(best), F.col(value) == F.col("_best")).drop("_best")  # one row
    return top if ties == "all" else top.orderBy(*tiebreak).limit(1)
