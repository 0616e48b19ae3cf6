"""The reports on cleaned posts, places and users (Q4-Q11).

Each takes cleaned frames (only the columns it uses need be there) and returns a lazy frame. Joined reports never build
the joined rows: each side is reduced to one row per key and attribute with a row count, and the counts are multiplied.
The results are those of the plain joins, duplicates included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from postlens.functions.text import lenient_number
from postlens.functions.values import AGE_BANDS, band, in_years, year_of
from postlens.operators.joins import argmax_rows, join_places, join_users, tally
from postlens.operators.rollups import (
    approx_median_by,
    counts_by,
    exact_median_by,
    top_n_per_group,
)

# First and last year, both included, of the reports by post year and by join year.
POST_YEARS = (2018, 2022)
JOIN_YEARS = (2015, 2020)


def top_category_by_country(posts: DataFrame, places: DataFrame) -> DataFrame:
    """Q4: most frequent category per country."""
    counts = _category_counts(posts, tally(places, "ind", "country", name="_times"), ["country"])
    return top_n_per_group(counts, ["country"], "category_count", tiebreak=["category"])


def category_counts_by_year(
    posts: DataFrame, places: DataFrame, years: tuple[int, int] = POST_YEARS
) -> DataFrame:
    """Q5: posts per category and year."""
    dated = in_years(places, "timestamp", *years).withColumn("post_year", year_of("timestamp"))
    return _category_counts(posts, tally(dated, "ind", "post_year", name="_times"), ["post_year"])


def most_followed_by_country(posts: DataFrame, places: DataFrame, users: DataFrame) -> DataFrame:
    """Poster with most followers per country.

    Copies do not change a greatest value: one best post per key is enough, and users only say which keys count.
    """
    best = top_n_per_group(
        posts.select("ind", "poster_name", "follower_count"), ["ind"], "follower_count", tiebreak=["poster_name"]
    )
    known = users.select("ind").distinct()
    located = places.select("ind", "country").distinct()
    rows = best.join(known, "ind").join(located, "ind")
    return top_n_per_group(rows, ["country"], "follower_count", tiebreak=["poster_name"]).select(
        "country", "poster_name", "follower_count"
    )


def most_followed_country(
    posts: DataFrame, places: DataFrame, users: DataFrame, ties: str = "all"
) -> DataFrame:
    """Country of the most followed poster; all countries that tie, or the first by name with ``ties="one"``."""
    per_country = most_followed_by_country(posts, places, users).select("country", "follower_count")
    return argmax_rows(per_country, "follower_count", ties, ("country",))


def top_category_by_age_band(
    posts: DataFrame, places: DataFrame, users: DataFrame, bands=AGE_BANDS
) -> DataFrame:
    """Q7: most frequent category per age band; NULL is the band of everyone else."""
    others = user_weights(banded(users, bands), places, ["age_group"])
    counts = _category_counts(posts, others, ["age_group"])
    return top_n_per_group(counts, ["age_group"], "category_count", tiebreak=["category"])


def median_followers_by_age_band(
    posts: DataFrame, places: DataFrame, users: DataFrame, bands=AGE_BANDS, accuracy: int | None = None
) -> DataFrame:
    """Q8: median follower count per age band; ``accuracy`` as in ``_median_followers``."""
    return _median_followers(posts, places, banded(users, bands), ["age_group"], accuracy)


def median_followers_by_age_band_and_count(
    posts: DataFrame, places: DataFrame, users: DataFrame, bands=AGE_BANDS
) -> DataFrame:
    """Q8 with the follower count as a second key: the median of equal values is the value, so this is the key again."""
    followers = posts.select("ind", "follower_count").distinct()
    groups = banded(users, bands).select("ind", "age_group").distinct().join(places.select("ind").distinct(), "ind")
    pairs = followers.join(groups.hint("rebalance"), "ind").select("age_group", "follower_count").distinct()
    return pairs.withColumn("median_follower_count", F.col("follower_count"))


def users_joined_by_year(users: DataFrame, years: tuple[int, int] = JOIN_YEARS) -> DataFrame:
    """Q9: user rows per join year; a user recorded twice counts twice."""
    return counts_by(by_join_year(users, years), ["post_year"], "ind", "number_users_joined")


def median_followers_by_join_year(
    posts: DataFrame,
    places: DataFrame,
    users: DataFrame,
    years: tuple[int, int] = JOIN_YEARS,
    accuracy: int | None = None,
) -> DataFrame:
    """Q10: median of the known follower counts per join year; ``accuracy`` as in ``_median_followers``."""
    counted = posts.where(F.col("follower_count").isNotNull())
    return _median_followers(counted, places, by_join_year(users, years), ["post_year"], accuracy)


def median_followers_by_band_and_join_year(
    posts: DataFrame,
    places: DataFrame,
    users: DataFrame,
    years: tuple[int, int] = JOIN_YEARS,
    bands=AGE_BANDS,
    accuracy: int | None = None,
) -> DataFrame:
    """Q11: median follower count per age band and join year; NULL where none is known; ``accuracy`` as in
    ``_median_followers``."""
    users = banded(by_join_year(users, years), bands)
    return _median_followers(posts, places, users, ["age_group", "post_year"], accuracy)


def banded(users: DataFrame, bands=AGE_BANDS) -> DataFrame:
    """Users with their age band."""
    is_text = isinstance(users.schema["age"].dataType, StringType)
    age = lenient_number(F.col("age"), "double") if is_text else F.col("age")
    return users.withColumn("age_group", band(age, bands))


def by_join_year(users: DataFrame, years: tuple[int, int] = JOIN_YEARS) -> DataFrame:
    """Users who joined in these years, with the year."""
    return in_years(users, "date_joined", *years).withColumn("post_year", year_of("date_joined"))


def user_weights(users: DataFrame, places: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Per key and group, how often the pair occurs in users joined to places."""
    per_user = tally(users, "ind", *groups, name="_users")
    per_place = tally(places, "ind", name="_places")
    times = F.col("_users").cast("decimal(20,0)") * F.col("_places")
    return per_user.join(per_place, "ind").select("ind", *groups, times.alias("_times"))


def _category_counts(posts: DataFrame, weights: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Non-NULL categories per group and category over posts joined to ``weights``."""
    per_post = counts_by(posts, ["ind", "category"], "category", "_posts")
    total = F.sum(F.col("_posts") * F.col("_times")).cast("bigint")
    return per_post.join(weights, "ind").groupBy(*groups, "category").agg(total.alias("category_count"))


def weighted_followers(posts: DataFrame, places: DataFrame, users: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The follower counts of the three sets joined, per group, with ``_weight``, how often each combination occurs."""
    per_post = tally(posts, "ind", "follower_count", name="_posts")
    # AQE splits a hot key only if both sides come from a shuffle; the weights, joined by the same key, would not
    rows = per_post.join(user_weights(users, places, groups).hint("rebalance"), "ind")
    times = F.col("_posts").cast("decimal(20,0)") * F.col("_times")
    return rows.select(*groups, "follower_count", times.cast("decimal(38,0)").alias("_weight"))


def _median_followers(
    posts: DataFrame, places: DataFrame, users: DataFrame, groups: list[str], accuracy: int | None = None
) -> DataFrame:
    """Lower median of the follower counts per group over the three sets joined; the groups are bands and years.

    With an ``accuracy`` it is the sketch's median over the joined rows themselves, off by 1/accuracy of a group's rows in
    rank: one shuffle of small sketches after the joins, but rows multiply where keys repeat.
    """
    if accuracy is not None:
        rows = join_users(users, join_places(posts.select("ind", "follower_count"), places.select("ind")))
        return approx_median_by(rows, groups, "follower_count", "median_follower_count", accuracy)
    weighted = weighted_followers(posts, places, users, groups)
    return exact_median_by(
        weighted, groups, "follower_count", "median_follower_count", weight="_weight", few_groups=True
    )
