"""The daily batch job: three topics in, cleaned tables and all reports out.

    spark-submit ... -m postlens.plans.daily --topics <root> --out <folder>
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from postlens.operators.cleaning import clean_places, clean_posts, clean_users
from postlens.plans import insights
from postlens.schemas import PLACES_JSON, POSTS_JSON, USERS_JSON
from postlens.session import build_session
from postlens.sources.tables import read_table_at
from postlens.sources.topics import RECORD_FILES, read_topic
from postlens.streaming.ingest import open_stream


def prepare(
    spark: SparkSession,
    topics: Mapping[str, str],
    out: str,
    follower_mode: str = "exact",
    partitions: Sequence[int] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cleaned posts, places and users of the topics ``posts``, ``places`` and ``users``, stored as parquet under ``out``.

    Every partition of a topic is read, unless some are named. Ten reports then read a few columns each instead of parsing
    all JSON ten times; a report by year skips what is outside its years, as files are sorted by the column they filter.
    The tables are not bucketed by key: one hot key would fill one bucket, and so one task of every report.
    """
    cleaned = {
        "posts": clean_posts(read_topic(spark, topics["posts"], POSTS_JSON, partitions), follower_mode),
        "places": clean_places(read_topic(spark, topics["places"], PLACES_JSON, partitions)),
        "users": clean_users(read_topic(spark, topics["users"], USERS_JSON, partitions)),
    }
    by_time = {"posts": [], "places": ["timestamp"], "users": ["date_joined"]}
    for name, df in cleaned.items():
        df = df.sortWithinPartitions(*by_time[name]) if by_time[name] else df
        df.write.mode("overwrite").parquet(f"{out}/{name}")
    posts, places, users = (read_table_at(spark, f"{out}/{name}") for name in cleaned)
    return posts, places, users


def prepare_new(
    spark: SparkSession, topics: Mapping[str, str], out: str, follower_mode: str = "exact"
) -> tuple[tuple[DataFrame, DataFrame, DataFrame], dict[str, int]]:
    """As ``prepare``, but parsing only files that landed since the run before; also how many records each topic had new.

    The topics are read as file streams that take all there is and end. Their checkpoints, under ``out``, know the files
    of earlier runs, and new cleaned rows are appended to the tables, each file's once, also if a run fails half-way and is
    repeated. Files must not be changed after they landed.
    """
    cleaners = {
        "posts": (POSTS_JSON, lambda df: clean_posts(df, follower_mode)),
        "places": (PLACES_JSON, clean_places),
        "users": (USERS_JSON, clean_users),
    }
    landed = {"pathGlobFilter": RECORD_FILES, "recursiveFileLookup": "true"}
    queries = {}
    for name, (schema, clean) in cleaners.items():
        records = open_stream(spark, "json", landed, topics[name], schema)
        writer = clean(records).writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
        queries[name] = writer.option("checkpointLocation", f"{out}/_progress/{name}").start(f"{out}/{name}")
    for query in queries.values():
        query.awaitTermination()
    new = {name: sum(p["numInputRows"] for p in query.recentProgress) for name, query in queries.items()}
    posts, places, users = (_table_so_far(spark, f"{out}/{name}", clean, schema) for name, (schema, clean) in cleaners.items())
    return (posts, places, users), new


def _table_so_far(spark: SparkSession, path: str, clean, schema) -> DataFrame:
    """A table's rows; none where no record has come yet."""
    try:
        return read_table_at(spark, path)
    except AnalysisException:
        return clean(spark.createDataFrame([], schema))


def reports(posts: DataFrame, places: DataFrame, users: DataFrame) -> dict[str, DataFrame]:
    """All reports, none run yet."""
    return {
        "top_category_by_country": insights.top_category_by_country(posts, places),
        "category_counts_by_year": insights.category_counts_by_year(posts, places),
        "most_followed_by_country": insights.most_followed_by_country(posts, places, users),
        "most_followed_country": insights.most_followed_country(posts, places, users),
        "top_category_by_age_band": insights.top_category_by_age_band(posts, places, users),
        "median_followers_by_age_band": insights.median_followers_by_age_band(posts, places, users),
        "median_followers_by_age_band_and_count": insights.median_followers_by_age_band_and_count(posts, places, users),
        "users_joined_by_year": insights.users_joined_by_year(users),
        "median_followers_by_join_year": insights.median_followers_by_join_year(posts, places, users),
        "median_followers_by_band_and_join_year": insights.median_followers_by_band_and_join_year(posts, places, users),
    }


def run(
    spark: SparkSession,
    topics: Mapping[str, str],
    out: str,
    follower_mode: str = "exact",
    partitions: Sequence[int] | None = None,
) -> None:
    """Clean, then write each report to ``<out>/reports/<name>``."""
    _write_reports(prepare(spark, topics, f"{out}/clean", follower_mode, partitions), out)


def run_new(spark: SparkSession, topics: Mapping[str, str], out: str, follower_mode: str = "exact") -> dict[str, int]:
    """As ``run``, parsing only what landed since the last ``run_new`` into ``out``; how many records of each topic."""
    frames, new = prepare_new(spark, topics, f"{out}/clean", follower_mode)
    _write_reports(frames, out)
    return new


def _write_reports(frames: tuple[DataFrame, DataFrame, DataFrame], out: str) -> None:
    for name, df in reports(*frames).items():
        df.write.mode("overwrite").parquet(f"{out}/reports/{name}")


def main() -> None:
    parser = argparse.ArgumentParser(description="Clean three topics and write all reports.")
    parser.add_argument("--topics", required=True, help="folder that holds the topics posts, places and users")
    parser.add_argument("--out", required=True, help="shared folder for cleaned tables and reports")
    parser.add_argument("--follower-mode", default="exact", choices=["exact", "suffix", "none"])
    parser.add_argument("--partitions", type=int, nargs="+", help="topic partitions to read; all if left out")
    parser.add_argument("--new-only", action="store_true", help="parse only files that landed since the last such run")
    args = parser.parse_args()
    topics = {name: f"{args.topics}/{name}" for name in ("posts", "places", "users")}
    spark = build_session("postlens-daily")
    if args.new_only:
        run_new(spark, topics, args.out, args.follower_mode)
    else:
        run(spark, topics, args.out, args.follower_mode, args.partitions)


if __name__ == "__main__":
    main()
