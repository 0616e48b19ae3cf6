"""Medians from merged sketches: days, weights, empty groups and the bound on the rank."""

import random

import pytest
from pyspark.sql import functions as F

from postlens.operators import rollups, sketches
from postlens.plans import insights, sketched


def rows_of(df):
    return {tuple(r) for r in df.collect()}


@pytest.mark.parametrize("kind", ["int", "bigint", "double"])
def test_small_groups_are_exact(spark, kind):
    rng = random.Random(1)
    rows = [(rng.choice("abc"), rng.randrange(4), None if rng.random() < 0.1 else rng.randrange(1_000)) for _ in range(900)]
    rows += [("none", 0, None), (None, 0, 7)]
    df = spark.createDataFrame(rows, "k string, day int, v int").withColumn("v", F.col("v").cast(kind))
    daily = sketches.sketches_by(df, ["k", "day"], "v")
    number = "double" if kind == "double" else "bigint"
    got = sketches.medians_of(sketches.merged_by(daily, ["k"], number), ["k"], "m", number)
    assert rows_of(got.select("k", "m")) == rows_of(rollups.exact_median_by(df, ["k"], "v", "m"))
    assert rows_of(got.select("k", "n_values")) == rows_of(df.groupBy("k").agg(F.count("v")))


def test_weights_stand_for_repeated_sketches(spark):
    rows = [(g, v, w) for g, vs in (("a", [(1, 5), (2, 1), (9, 13)]), ("b", [(3, 64), (4, 63)]), ("c", [(5, 1)])) for v, w in vs]
    df = spark.createDataFrame(rows, "k string, v bigint, w bigint")
    own = sketches.sketches_by(df, ["k", "v", "w"], "v")
    got = sketches.medians_of(sketches.weighted_by(own, ["k"], "w", "bigint"), ["k"], "m", "bigint")
    assert rows_of(got) == {("a", 19, 9), ("b", 127, 3), ("c", 1, 5)}


def test_large_weights_and_groups_stay_within_the_bound(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "few").otherwise("hot").alias("k"),
        (F.col("id") % 5).alias("day"),
        F.pmod(F.xxhash64("id"), F.lit(100_003)).alias("v"),
    )
    merged = sketches.merged_by(sketches.sketches_by(df, ["k", "day"], "v"), ["k"], "bigint")
    got = sketches.within_bound(df, sketches.medians_of(merged, ["k"], "m", "bigint"), ["k"], "v", "m")
    assert rows_of(got) == {("few", 20_000, True), ("hot", 40_000, True)}
    heavy = df.withColumn("w", F.pmod("v", F.lit(50)) * 1_000_000_007 + 1)
    own = sketches.sketches_by(heavy, ["k", "w"], "v")
    weighed = sketches.medians_of(sketches.weighted_by(own, ["k"], "w", "bigint"), ["k"], "m", "bigint")
    checked = sketches.within_bound(heavy, weighed, ["k"], "v", "m", "w")
    assert {r.within_bound for r in checked.collect()} == {True}


def test_a_wrong_median_is_not_within(spark):
    df = spark.range(10_000).select(F.lit("a").alias("k"), F.col("id").alias("v"))
    for median, fine in ((5_000, True), (4_999, True), (4_990, True), (4_000, False), (9_999, False), (None, False)):
        told = spark.createDataFrame([("a", median)], "k string, m bigint")
        assert sketches.within_bound(df, told, ["k"], "v", "m").first()["within_bound"] is fine
    empty = df.select("k", F.lit(None).cast("bigint").alias("v"))
    assert sketches.within_bound(empty, spark.createDataFrame([("a", None)], "k string, m bigint"), ["k"], "v", "m").first()["within_bound"]


def test_reports_from_stored_days_are_the_plain_reports(spark, tmp_path):
    """Days come in two runs; few values a group, so that sketches are exact, repeated keys on all sides."""
    rng = random.Random(3)
    posts = spark.createDataFrame(
        [(rng.randrange(12), rng.choice([None, 1, 5, 80, 900]), f"2020-01-0{1 + i % 4} 10:00:00") for i in range(120)],
        "ind bigint, follower_count int, at string",
    )
    places = spark.createDataFrame([(i % 14, "x") for i in range(20)], "ind bigint, country string")
    users = spark.createDataFrame(
        [(i % 12, 15 + 3 * i, f"{2014 + i % 6}-05-05") for i in range(30)], "ind bigint, age int, joined string"
    ).withColumn("date_joined", F.col("joined").cast("timestamp"))
    path = str(tmp_path / "sketches")
    for early in (True, False):
        part = posts.where((F.col("at") < "2020-01-03") == early)
        sketched.store_sketches(part, path, "at", ["ind"], "follower_count")
    kept = sketched.stored_sketches(spark, path)
    for name, groups in (
        ("median_followers_by_age_band", ["age_group"]),
        ("median_followers_by_join_year", ["post_year"]),
        ("median_followers_by_band_and_join_year", ["age_group", "post_year"]),
    ):
        got = getattr(sketched, name)(kept, places, users).where("n_values <= 2000")
        assert rows_of(got.where("n_values > 0").drop("n_values")) == rows_of(
            getattr(insights, name)(posts, places, users).where("median_follower_count IS NOT NULL")
        )
        assert got.columns == [*groups, "n_values", "median_follower_count"]
    some = sketched.stored_sketches(spark, path, "2020-01-02", "2020-01-03")
    assert {str(r.day) for r in some.select("day").distinct().collect()} == {"2020-01-02", "2020-01-03"}
    assert "PartitionFilters: [isnotnull(day" in some._jdf.queryExecution().executedPlan().toString()
