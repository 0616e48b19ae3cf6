"""The joined reports against the plain joins they stand for, on keys that repeat and on a hot key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from postlens.functions.values import band
from postlens.operators.joins import join_places, join_users
from postlens.plans import insights

CATEGORIES = [None, "art", "diy", "travel"]
COUNTRIES = [None, "DE", "FR", "UK"]


def make(spark, seed, hot):
    """Random records; with ``hot``, one key holds a third of the rows of every set."""
    rng = random.Random(seed)

    def key():
        return 0 if hot and rng.random() < 1 / 3 else rng.choice([None, *range(1, 12)])

    def stamp(first, last):
        return f"{rng.randint(first, last)}-{rng.randint(1, 12):02d}-15 10:00:00"

    posts = [
        (key(), rng.choice(CATEGORIES), rng.choice([None, rng.randint(0, 9), rng.randint(-5, 10**6)]), f"p{i % 9}")
        for i in range(90)
    ]
    places = [(key(), rng.choice(COUNTRIES), stamp(2016, 2024)) for _ in range(60)]
    users = [(key(), rng.choice([None, *range(10, 70)]), stamp(2013, 2022)) for _ in range(60)]
    return (
        spark.createDataFrame(posts, "ind int, category string, follower_count int, poster_name string"),
        spark.createDataFrame(places, "ind int, country string, timestamp string").withColumn(
            "timestamp", F.to_timestamp("timestamp")
        ),
        spark.createDataFrame(users, "ind int, age int, date_joined string").withColumn(
            "date_joined", F.to_timestamp("date_joined")
        ),
    )


@pytest.fixture(scope="module", params=[(1, False), (2, True)], ids=["repeated", "hot"])
def data(spark, request):
    posts, places, users = (df.cache() for df in make(spark, *request.param))
    joined = join_users(users, join_places(posts, places))
    joined = joined.withColumn("age_group", band(F.col("age"))).withColumn("joined_year", F.year("date_joined"))
    return posts, places, users, joined.cache()


def same(got, wanted):
    assert got.columns == wanted.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, wanted.collect()))


def first_of(df, key, measure, tiebreak):
    w = Window.partitionBy(key).orderBy(F.col(measure).desc(), F.col(tiebreak).asc())
    return df.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")


def lower_median(df, *keys):
    """The median's definition: sorted values of a group, the one at half its size rounded up."""
    values = F.sort_array(F.collect_list("follower_count"))
    grouped = df.groupBy(*keys).agg(values.alias("v"))
    middle = F.get("v", F.ceil(F.size("v") / 2).cast("int") - 1)
    return grouped.select(*keys, middle.alias("median_follower_count"))


def test_top_category_by_country(data):
    posts, places, _, _ = data
    counts = join_places(posts, places).groupBy("country", "category").agg(F.count("category").alias("category_count"))
    same(insights.top_category_by_country(posts, places), first_of(counts, "country", "category_count", "category"))


def test_category_counts_by_year(data):
    posts, places, _, _ = data
    dated = join_places(posts, places).withColumn("post_year", F.year("timestamp"))
    wanted = dated.where("post_year BETWEEN 2018 AND 2022").groupBy("post_year", "category")
    same(insights.category_counts_by_year(posts, places), wanted.agg(F.count("category").alias("category_count")))


def test_most_followed(data):
    posts, places, users, joined = data
    wanted = first_of(joined, "country", "follower_count", "poster_name")
    wanted = wanted.select("country", "poster_name", "follower_count")
    same(insights.most_followed_by_country(posts, places, users), wanted)
    greatest = wanted.agg(F.max("follower_count")).first()[0]
    same(
        insights.most_followed_country(posts, places, users),
        wanted.where(F.col("follower_count") == greatest).select("country", "follower_count"),
    )


def test_top_category_by_age_band(data):
    posts, places, users, joined = data
    counts = joined.groupBy("age_group", "category").agg(F.count("category").alias("category_count"))
    same(
        insights.top_category_by_age_band(posts, places, users),
        first_of(counts, "age_group", "category_count", "category"),
    )


def test_medians(data):
    posts, places, users, joined = data
    in_range = joined.where("joined_year BETWEEN 2015 AND 2020").withColumnRenamed("joined_year", "post_year")
    same(insights.median_followers_by_age_band(posts, places, users), lower_median(joined, "age_group"))
    same(
        insights.median_followers_by_join_year(posts, places, users),
        lower_median(in_range.where("follower_count IS NOT NULL"), "post_year"),
    )
    same(
        insights.median_followers_by_band_and_join_year(posts, places, users),
        lower_median(in_range, "age_group", "post_year"),
    )
    pairs = joined.select("age_group", "follower_count").distinct()
    same(
        insights.median_followers_by_age_band_and_count(posts, places, users),
        pairs.withColumn("median_follower_count", F.col("follower_count")),
    )


def test_a_hot_key_does_not_meet_itself(spark):
    """30,000 copies of one key on each side: 2.7e13 joined rows, none of which is built."""
    copies = spark.range(30_000)
    posts = copies.select(F.lit(1).alias("ind"), F.lit("art").alias("category"), F.lit(5).alias("follower_count"))
    places = copies.select(F.lit(1).alias("ind"), F.lit("UK").alias("country"))
    users = copies.select(F.lit(1).alias("ind"), F.lit(20).alias("age"))
    assert insights.top_category_by_country(posts, places).collect() == [("UK", "art", 900_000_000)]
    assert insights.top_category_by_age_band(posts, places, users).collect() == [("18-24", "art", 27_000_000_000_000)]
    assert insights.median_followers_by_age_band(posts, places, users).collect() == [("18-24", 5)]


def test_counts_add_up(data):
    posts, places, _, _ = data
    total = insights.category_counts_by_year(posts, places).agg(F.sum("category_count")).first()[0]
    known = join_places(posts, places).where("category IS NOT NULL AND year(timestamp) BETWEEN 2018 AND 2022")
    assert total == known.count()
