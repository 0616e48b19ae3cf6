"""Topics written and resumed by offset, untyped records, the live and the incremental jobs, stored tallies."""

import json
import random

import pytest
from pyspark.sql import functions as F

from postlens.functions.records import BROKEN, decode_payload, decode_payload_and_broken
from postlens.plans import daily, insights, live, tallies
from postlens.sinks.publish import append_to_topic, publish, topic_records
from postlens.sources import variants
from postlens.sources.topics import read_topic, read_topic_from, topic_offsets
from postlens.streaming.ingest import broken_payloads, with_payload_counts


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---- topics ----------------------------------------------------------------------------------------------------------


def test_a_topic_is_resumed_from_its_offsets(spark, tmp_path):
    root, schema = str(tmp_path / "topic"), "k bigint, v string"
    assert topic_offsets(spark, root) == {}
    none, start = read_topic_from(spark, root, schema)
    assert none.count() == 0 and start == {}
    rows = spark.range(300).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").cast("string").alias("v"))
    records = rows.select("*", F.to_json(F.struct("k", "v")).alias("value"))
    first = append_to_topic(records.where("CAST(v AS INT) < 200"), root, "k", 4)
    assert sum(first.values()) == 200 and set(first) <= set(range(4))
    got, ends = read_topic_from(spark, root, schema, start)
    assert ends == first and rows_of(got) == rows_of(rows.where("CAST(v AS INT) < 200"))
    second = append_to_topic(records.where("CAST(v AS INT) >= 200"), root, "k", 4)
    assert sum(second.values()) == 300
    got, ends = read_topic_from(spark, root, schema, first)
    assert ends == second and rows_of(got) == rows_of(rows.where("CAST(v AS INT) >= 200"))
    again, ends = read_topic_from(spark, root, schema, second)
    assert again.count() == 0 and ends == second
    assert rows_of(read_topic(spark, root, schema)) == rows_of(rows)
    assert rows_of(read_topic(spark, root, schema, partitions=[0, 1, 2, 3])) == rows_of(rows)
    by_key = spark.read.schema("k bigint, partition int").option("pathGlobFilter", "*.txt").json(root).select("k", "partition").distinct()
    assert by_key.groupBy("k").count().where("count > 1").isEmpty()


def test_an_append_that_failed_half_way_is_not_read(spark, tmp_path):
    root = str(tmp_path / "topic")
    records = spark.range(20).select("id", F.to_json(F.struct("id")).alias("value"))
    ends = append_to_topic(records, root, "id", 2)
    lost = records.select("value", F.lit(0).alias("partition"), F.lit(ends[0]).alias("start"), F.lit("lost").alias("batch"))
    lost.write.mode("append").partitionBy("partition", "start", "batch").text(root)
    assert read_topic_from(spark, root, "id bigint")[0].count() == 20
    append_to_topic(records, root, "id", 2)
    assert read_topic_from(spark, root, "id bigint", ends)[0].count() == 20


def test_what_publish_wrote_is_read_by_default(spark, tmp_path):
    df = spark.range(5).select("id")
    publish(topic_records(df, "t", envelope=False), path=str(tmp_path / "flat"))
    assert rows_of(read_topic(spark, str(tmp_path / "flat"), "id bigint")) == [(i,) for i in range(5)]


def test_untyped_records_are_typed_from_one_reading(spark, tmp_path):
    lines = ['{"a": 1, "b": "x"}', '{"a": 2.5, "c": null, "d": {"e": [1, 2]}}', "{broken", '{"b": "y", "d": {"f": true}}', "{}"]
    (tmp_path / "in" / "partition=0").mkdir(parents=True)
    (tmp_path / "in" / "partition=0" / "x.json").write_text("\n".join(lines))
    records = variants.ingest_records(spark, str(tmp_path / "in"), str(tmp_path / "kept"))
    assert [r.text for r in records.where("text IS NOT NULL").collect()] == ["{broken"]
    schema = variants.gathered_schema(records)
    assert schema.startswith("STRUCT<") and "VOID" not in schema
    typed = variants.typed_records(records)
    assert typed.columns == ["a", "b", "c", "d"] and typed.count() == 5
    assert {(float(r.a) if r.a is not None else None, r.b) for r in typed.collect()} == {(1.0, "x"), (2.5, None), (None, None), (None, "y")}
    assert [r.e for r in typed.select("d.e").where("e IS NOT NULL").collect()] == [[1, 2]]
    assert rows_of(variants.typed_records(records, "STRUCT<a: INT, b: STRING>").where("b IS NOT NULL")) == [(1, "x"), (None, "y")]
    assert variants.typed_records(records.limit(0)).count() == 0


# ---- payloads --------------------------------------------------------------------------------------------------------

POST = {"category": "art", "index": "1", "follower_count": "5", "title": "t"}
GOOD, ODD = json.dumps(POST), json.dumps({"index": "2", "more": 1})
PAYLOADS = [GOOD, ODD, "{broken", "", "[1", "null", None, '"text"']


def stream_of(spark, folder, payloads, name="p0.json"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps({"data": p}) for p in payloads))
    return spark.readStream.schema("data string").json(str(folder))


def test_broken_payloads_are_told_apart(spark):
    df = spark.createDataFrame([(p,) for p in PAYLOADS], "data string")
    schema = "category string, index string"
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(schema)
    told = decode_payload_and_broken(df, schema)
    assert rows_of(told.drop(BROKEN)) == rows_of(decode_payload(df, schema))
    assert "{broken" in {r[BROKEN] for r in told.collect()} and GOOD not in {r[BROKEN] for r in told.collect()}


def test_the_count_of_broken_payloads_is_that_of_the_side_table(spark, tmp_path):
    """And the cleaned rows are what they are without counting."""
    watch = live.Watch()
    spark.streams.addListener(watch)
    try:
        plain = stream_of(spark, tmp_path / "in", PAYLOADS)
        out = {"seen": with_payload_counts(plain, "posts"), "broken": broken_payloads(plain, "posts"), "plain": plain}
        for name, df in out.items():
            writer = df.writeStream.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / f"c-{name}"))
            writer.format("parquet").start(str(tmp_path / name)).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(watch)
    seen, broken = spark.read.parquet(str(tmp_path / "seen")), spark.read.parquet(str(tmp_path / "broken"))
    assert rows_of(seen) == rows_of(spark.read.parquet(str(tmp_path / "plain")))
    assert {r.payload for r in broken.collect()} >= {"{broken", "[1"} and {r.entity for r in broken.collect()} == {"posts"}
    assert watch.counts == {"posts_payloads": {"records": 8, "broken": broken.count()}}


# ---- the live job ----------------------------------------------------------------------------------------------------


def arguments(tmp_path, prefix):
    told = ["--format", "json", "--schema", "data string", "--once", "--out", str(tmp_path / "out"), "--checkpoints", str(tmp_path / "progress")]
    for entity in live.ENTITIES:
        told += [f"--{entity}", f"path={tmp_path / entity}"]
    return [*told, "--table-prefix", prefix]


def test_the_live_job_fills_three_tables(spark, tmp_path):
    for i, entity in enumerate(live.ENTITIES):
        stream_of(spark, tmp_path / entity, [GOOD, "{broken"][: 1 + (i == 0)])
    assert live.main(arguments(tmp_path, "ok_"), spark) == 0
    assert [spark.table(f"ok_{entity}").count() for entity in live.ENTITIES] == [2, 1, 1]
    assert [spark.table(f"ok_{entity}_broken").count() for entity in live.ENTITIES] == [1, 0, 0]
    stream_of(spark, tmp_path / "users", [json.dumps({"ind": "5"})], "p1.json")
    assert live.main(arguments(tmp_path, "ok_"), spark) == 0
    assert [spark.table(f"ok_{entity}").count() for entity in live.ENTITIES] == [2, 1, 2]
    assert not spark.streams.active


def test_one_failing_stream_stops_the_others(spark, tmp_path):
    """Two streams without end, and one whose records a task can't read."""
    for entity in ("posts", "places"):
        stream_of(spark, tmp_path / entity, [GOOD])
    (tmp_path / "users").mkdir()
    (tmp_path / "users" / "p0.parquet").write_text("no parquet file")
    streams = {e: spark.readStream.schema("data string").json(str(tmp_path / e)) for e in ("posts", "places")}
    streams["users"] = spark.readStream.schema("data string").parquet(str(tmp_path / "users"))
    tables = {e: f"failing_{e}" for e in live.ENTITIES}
    queries = live.start_all(streams, str(tmp_path / "out"), str(tmp_path / "progress"), tables)
    assert live.wait_for_all(spark, queries) == 1
    assert not any(q.isActive for q in queries) and sum(q.exception() is not None for q in queries) >= 1


# ---- the daily job over new files ------------------------------------------------------------------------------------


def land(spark, root, name, partition, rows, schema):
    df = spark.createDataFrame(rows, schema)
    df.coalesce(1).write.json(f"{root}/{name}/partition={partition}")


@pytest.fixture(scope="module")
def records():
    rng = random.Random(9)
    post = lambda i: (rng.choice(["art", "diy", None]), f"d{i}", 1, str(rng.choice([5, 80, "k"])), "x", rng.randrange(20), "image", f"p{i}", "Local save in /x", "a,b", f"t{i}", f"u{i}")
    place = lambda i: (rng.choice(["UK", "FR"]), rng.randrange(20), 1.0, 2.0, f"20{17 + i % 7}-01-01T00:00:00")
    user = lambda i: (15 + i, f"20{14 + i % 8}-02-02T00:00:00", "A", rng.randrange(20), f"n{i}")
    return {"posts": [post(i) for i in range(60)], "places": [place(i) for i in range(40)], "users": [user(i) for i in range(40)]}


SCHEMAS = {
    "posts": "category string, description string, downloaded bigint, follower_count string, image_src string, index bigint, is_image_or_video string, poster_name string, save_location string, tag_list string, title string, unique_id string",
    "places": "country string, ind bigint, latitude double, longitude double, timestamp string",
    "users": "age bigint, date_joined string, first_name string, ind bigint, last_name string",
}


def test_a_second_daily_run_parses_only_what_is_new(spark, tmp_path, records):
    topics = {name: f"{tmp_path}/topics/{name}" for name in records}
    new = str(tmp_path / "new")
    for name, rows in records.items():
        land(spark, f"{tmp_path}/topics", name, 0, rows[: len(rows) // 2], SCHEMAS[name])
    assert daily.run_new(spark, topics, new) == {"posts": 30, "places": 20, "users": 20}
    for name, rows in records.items():
        land(spark, f"{tmp_path}/topics", name, 1, rows[len(rows) // 2 :], SCHEMAS[name])
    assert daily.run_new(spark, topics, new) == {"posts": 30, "places": 20, "users": 20}
    daily.run(spark, topics, str(tmp_path / "whole"))
    names = list(daily.reports(*daily.prepare_new(spark, topics, f"{new}/clean")[0]))
    for name in names:
        got, wanted = (rows_of(spark.read.parquet(f"{out}/reports/{name}")) for out in (new, tmp_path / "whole"))
        assert got == wanted and got, name
    assert daily.run_new(spark, topics, new) == {"posts": 0, "places": 0, "users": 0}


# ---- stored tallies --------------------------------------------------------------------------------------------------


def test_tallies_of_three_days_are_the_reports_of_all(spark, tmp_path, records):
    posts, places, users = daily.prepare(
        spark, {n: land_all(spark, tmp_path, n, r) for n, r in records.items()}, str(tmp_path / "clean")
    )
    before = None
    for day in range(3):
        after = str(tmp_path / f"day{day}")
        # on the second day no new users, on the third no new posts
        some = lambda df, key, days: df.where(F.pmod(F.xxhash64(*key), F.lit(len(days))) == days.index(day)) if day in days else df.limit(0)
        tallies.advance(
            spark, before, after, some(posts, ["unique_id"], [0, 1]), some(places, ["ind", "timestamp"], [0, 1, 2]), some(users, ["user_name"], [0, 2])
        )
        before = after
    assert rows_of(tallies.top_category_by_country(spark, before)) == rows_of(insights.top_category_by_country(posts, places))
    assert rows_of(tallies.category_counts_by_year(spark, before)) == rows_of(insights.category_counts_by_year(posts, places))
    assert rows_of(tallies.top_category_by_age_band(spark, before)) == rows_of(insights.top_category_by_age_band(posts, places, users))
    assert rows_of(tallies.users_joined_by_year(spark, before)) == rows_of(insights.users_joined_by_year(users))


def land_all(spark, tmp_path, name, rows):
    land(spark, f"{tmp_path}/all", name, 0, rows, SCHEMAS[name])
    return f"{tmp_path}/all/{name}"
