"""The median reports (Q8, Q10, Q11) from stored sketches of each day's posts, in place of the posts themselves.

A day's posts are read once and kept as one sketch per key. A report merges the days' sketches per key, weighs them with
how often the key occurs in users and places, and merges those of a group. What it reads grows with keys and days, not
with posts, and what it shuffles last is one sketch per task, group and bit of a weight.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions.values import AGE_BANDS
from postlens.operators.sketches import SIZE, medians_of, merged_by, sketches_by, weighted_by
from postlens.plans.insights import JOIN_YEARS, banded, by_join_year, user_weights
from postlens.sources.tables import read_table_at

FOLLOWERS = "follower_count"
KIND = "bigint"


def store_sketches(df: DataFrame, path: str, day: str, keys: Sequence[str], value: str, size: int = SIZE) -> None:
    """Append the sketches of ``value`` per day and group to the table at ``path``, a folder per day.

    Records of a day may come in several runs: each adds its own sketches, and a report merges them all. Running twice on
    the same records counts them twice, as an append of the records would.
    """
    made = sketches_by(df.withColumn("day", F.col(day).cast("date")), ["day", *keys], value, size)
    made.write.partitionBy("day").mode("append").parquet(path)


def stored_sketches(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The stored sketches, or those of the days from ``first`` to ``last``: other days' folders are not opened."""
    sketches = read_table_at(spark, path)
    if first is not None:
        sketches = sketches.where(F.col("day") >= F.lit(first).cast("date"))
    if last is not None:
        sketches = sketches.where(F.col("day") <= F.lit(last).cast("date"))
    return sketches


def _medians(sketches: DataFrame, places: DataFrame, users: DataFrame, groups: list[str], size: int) -> DataFrame:
    per_key = merged_by(sketches, ["ind"], KIND, size)
    weighed = per_key.join(user_weights(users, places, groups), "ind").select(*groups, "sketch", "_times")
    return medians_of(weighted_by(weighed, groups, "_times", KIND, size), groups, "median_follower_count", KIND)


def median_followers_by_age_band(
    sketches: DataFrame, places: DataFrame, users: DataFrame, bands=AGE_BANDS, size: int = SIZE
) -> DataFrame:
    """Q8: median follower count per age band, with the number of values it is of."""
    return _medians(sketches, places, banded(users, bands), ["age_group"], size)


def median_followers_by_join_year(
    sketches: DataFrame, places: DataFrame, users: DataFrame, years: tuple[int, int] = JOIN_YEARS, size: int = SIZE
) -> DataFrame:
    """Q10: median of the known follower counts per join year. Years of unknown counts only have a NULL median here."""
    return _medians(sketches, places, by_join_year(users, years), ["post_year"], size)


def median_followers_by_band_and_join_year(
    sketches: DataFrame,
    places: DataFrame,
    users: DataFrame,
    years: tuple[int, int] = JOIN_YEARS,
    bands=AGE_BANDS,
    size: int = SIZE,
) -> DataFrame:
    """Q11: median follower count per age band and join year; NULL where none is known."""
    return _medians(sketches, places, banded(by_join_year(users, years), bands), ["age_group", "post_year"], size)
