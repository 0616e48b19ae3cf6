"""The daily job end to end on the golden topics."""

from golden import write_lines, write_topics

from postlens.plans import daily


def test_daily_job(spark, tmp_path):
    root = write_topics(tmp_path / "topics")
    topics = {name: str(root / name) for name in ("posts", "places", "users")}
    out = str(tmp_path / "out")
    daily.run(spark, topics, out, partitions=[0])
    daily.run(spark, topics, out, partitions=[0])

    def rows(name):
        return {tuple(r) for r in spark.read.parquet(f"{out}/reports/{name}").collect()}

    posts = spark.read.parquet(f"{out}/clean/posts")
    assert posts.count() == 9
    names = daily.reports(posts, *(spark.read.parquet(f"{out}/clean/{n}") for n in ("places", "users")))
    assert len(names) == 10
    assert rows("top_category_by_country") == {("DE", "art", 1), ("FR", "diy", 1), ("UK", "art", 3)}
    assert rows("users_joined_by_year") == {(2015, 2), (2016, 2), (2017, 2), (2020, 1)}
    assert rows("median_followers_by_join_year") == {(2015, 60), (2016, 700), (2017, 40), (2020, 0)}


def test_daily_job_reads_every_partition(spark, tmp_path):
    for name in ("posts", "places", "users"):
        for part in (0, 3):
            write_lines(tmp_path / name / f"partition={part}", [{"index": part, "ind": part}])
    topics = {name: str(tmp_path / name) for name in ("posts", "places", "users")}
    assert [df.count() for df in daily.prepare(spark, topics, str(tmp_path / "all"))] == [2, 2, 2]
    assert [df.count() for df in daily.prepare(spark, topics, str(tmp_path / "one"), partitions=[3])] == [1, 1, 1]
