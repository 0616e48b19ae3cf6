"""The reports on the golden records."""

import pytest
from golden import write_topics

from postlens.operators.cleaning import clean_places, clean_posts, clean_users
from postlens.operators.joins import join_places, join_users
from postlens.plans import insights
from postlens.schemas import PLACES_JSON, POSTS_JSON, USERS_JSON
from postlens.sources.topics import read_topic


@pytest.fixture(scope="module")
def topics(tmp_path_factory):
    return write_topics(tmp_path_factory.mktemp("golden") / "topics")


@pytest.fixture(scope="module", params=["exact", "suffix"])
def mode(request):
    return request.param


@pytest.fixture(scope="module")
def frames(spark, topics, mode):
    posts = clean_posts(read_topic(spark, str(topics / "posts"), POSTS_JSON, [0]), mode).cache()
    places = clean_places(read_topic(spark, str(topics / "places"), PLACES_JSON, [0])).cache()
    users = clean_users(read_topic(spark, str(topics / "users"), USERS_JSON, [0])).cache()
    return posts, places, users


def rows(df, *columns):
    assert tuple(df.columns) == columns
    return sorted((tuple(r) for r in df.collect()), key=str)


def expect(*rows):
    return sorted(rows, key=str)


def test_cleaned(frames, mode):
    posts, places, users = ({r["ind"]: r for r in f.collect()} for f in frames)
    third = 12000 if mode == "suffix" else None
    assert [posts[i]["follower_count"] for i in range(1, 10)] == [900, 0, third, 5000, 700, 5000, None, 40, 60]
    assert posts[1]["title"] is posts[1]["description"] is posts[2]["tag_list"] is None
    assert posts[3]["image_src"] is posts[4]["poster_name"] is None
    assert posts[1]["save_location"] == "/data/art"
    assert posts[5]["save_location"] == "/data/None"
    assert users[2]["user_name"] == "B"
    assert places[1]["coordinates"] == [1.5, -2.0]
    assert dict(frames[0].dtypes)["follower_count"] == "int"
    assert dict(frames[1].dtypes) == {
        "ind": "bigint",
        "country": "string",
        "coordinates": "array<double>",
        "timestamp": "timestamp",
    }
    assert dict(frames[2].dtypes)["date_joined"] == "timestamp"


def test_inferred_types_give_the_same_frames(spark, topics, frames, mode):
    posts, places, users = frames
    assert clean_posts(read_topic(spark, str(topics / "posts"), partitions=[0]), mode).exceptAll(posts).isEmpty()
    assert clean_places(read_topic(spark, str(topics / "places"), partitions=[0])).exceptAll(places).isEmpty()
    assert clean_users(read_topic(spark, str(topics / "users"), partitions=[0])).exceptAll(users).isEmpty()


def test_joined_columns(frames):
    posts, places, users = frames
    two = join_places(posts, places)
    assert two.columns == posts.columns + ["country", "coordinates", "timestamp"]
    three = join_users(users, two)
    assert three.columns == ["ind", "user_name", "age", "date_joined"] + two.columns[1:]
    assert three.count() == 9


def test_top_category_by_country(frames):
    posts, places, _ = frames
    got = rows(insights.top_category_by_country(posts, places), "country", "category", "category_count")
    assert got == expect(("DE", "art", 1), ("FR", "diy", 1), ("UK", "art", 3))


def test_category_counts_by_year(frames):
    posts, places, _ = frames
    got = rows(insights.category_counts_by_year(posts, places), "post_year", "category", "category_count")
    assert got == expect(
        (2018, "art", 2), (2019, "travel", 1), (2019, None, 0), (2020, "diy", 2), (2022, "art", 1)
    )


def test_most_followed(frames, mode):
    got = rows(insights.most_followed_by_country(*frames), "country", "poster_name", "follower_count")
    uk = ("UK", "cy", 12000) if mode == "suffix" else ("UK", "ann", 900)
    assert got == expect(("DE", "fay", 5000), ("FR", None, 5000), uk)
    best = expect(("UK", 12000)) if mode == "suffix" else expect(("DE", 5000), ("FR", 5000))
    assert rows(insights.most_followed_country(*frames), "country", "follower_count") == best
    one = rows(insights.most_followed_country(*frames, ties="one"), "country", "follower_count")
    assert one == best[:1]


def test_top_category_by_age_band(frames):
    got = rows(insights.top_category_by_age_band(*frames), "age_group", "category", "category_count")
    assert got == expect(
        ("18-24", "art", 3), ("25-35", "travel", 2), ("36-50", "art", 1), ("+50", "diy", 1), (None, "diy", 1)
    )


def test_median_by_age_band(frames):
    got = rows(insights.median_followers_by_age_band(*frames), "age_group", "median_follower_count")
    assert got == expect(("18-24", 60), ("25-35", 5000), ("36-50", 700), ("+50", None), (None, 40))


def test_median_by_sketch_is_the_exact_one_of_few_rows(frames):
    for name in ("median_followers_by_age_band", "median_followers_by_join_year", "median_followers_by_band_and_join_year"):
        report = getattr(insights, name)
        columns = [c for c in ("age_group", "post_year", "median_follower_count") if c in report(*frames).columns]
        assert rows(report(*frames, accuracy=10_000), *columns) == rows(report(*frames), *columns)


def test_median_by_age_band_and_count(frames, mode):
    df = insights.median_followers_by_age_band_and_count(*frames)
    got = rows(df, "age_group", "follower_count", "median_follower_count")
    third = 12000 if mode == "suffix" else None
    pairs = [("18-24", 0), ("18-24", 60), ("18-24", 900), ("25-35", 5000), ("25-35", third), ("36-50", 700)]
    pairs += [("36-50", 5000), ("+50", None), (None, 40)]
    assert got == expect(*[(band, n, n) for band, n in pairs])


def test_users_joined_by_year(frames):
    got = rows(insights.users_joined_by_year(frames[2]), "post_year", "number_users_joined")
    assert got == expect((2015, 2), (2016, 2), (2017, 2), (2020, 1))


def test_median_by_join_year(frames):
    got = rows(insights.median_followers_by_join_year(*frames), "post_year", "median_follower_count")
    assert got == expect((2015, 60), (2016, 700), (2017, 40), (2020, 0))


def test_median_by_band_and_join_year(frames):
    df = insights.median_followers_by_band_and_join_year(*frames)
    got = rows(df, "age_group", "post_year", "median_follower_count")
    assert got == expect(
        ("18-24", 2015, 60),
        ("18-24", 2020, 0),
        ("25-35", 2016, 5000),
        ("36-50", 2016, 700),
        ("+50", 2017, None),
        (None, 2017, 40),
    )
