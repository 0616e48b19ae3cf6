"""Streams: decoding, cleaning, appending, and going on after a stop."""

import json

import golden
import pytest
from pyspark.sql import functions as F

from postlens.operators.cleaning import clean_places, clean_posts, clean_users
from postlens.schemas import PLACES_TEXT, POSTS_TEXT, USERS_TEXT
from postlens.session import fresh_path
from postlens.sources.tables import read_table_at
from postlens.streaming import ingest

RECORDS = {"posts": golden.posts, "places": golden.places, "users": golden.users}
SCHEMAS = {"posts": POSTS_TEXT, "places": PLACES_TEXT, "users": USERS_TEXT}
BATCH = {"posts": lambda df: clean_posts(df, "none"), "places": clean_places, "users": clean_users}


def write_payloads(spark, path, records):
    rows = [(bytearray(line if isinstance(line, bytes) else json.dumps(line).encode()),) for line in records]
    spark.createDataFrame(rows, "data binary").coalesce(1).write.mode("append").parquet(path)


def stream_of(spark, path):
    return ingest.open_stream(spark, "parquet", path=path, schema="data binary")


@pytest.fixture
def places_to_write(spark):
    return {name: fresh_path(spark, f"sink_{name}") for name in RECORDS}


def run(spark, inputs, paths, checkpoints, **more):
    tables = {name: path.rsplit("/", 1)[1].replace("-", "_") for name, path in paths.items()}
    started = ingest.start_ingest(
        {name: stream_of(spark, inputs[name]) for name in inputs},
        {name: tables[name] for name in inputs},
        checkpoints,
        paths=paths,
        trigger={"availableNow": True},
        **more,
    )
    for query in started.values():
        query.awaitTermination()
    return tables, started


def rows(df):
    return sorted(map(repr, df.collect()))


def test_streams_equal_batch_and_resume(spark, places_to_write):
    inputs = {name: fresh_path(spark, f"in_{name}") for name in RECORDS}
    checkpoints = fresh_path(spark, "progress")
    for name, records in RECORDS.items():
        write_payloads(spark, inputs[name], records())
    tables, started = run(spark, inputs, places_to_write, checkpoints)
    assert len({q.id for q in started.values()}) == 3

    for name in RECORDS:
        text = [{k: None if v is None else str(v) for k, v in r.items()} for r in RECORDS[name]()]
        wanted = BATCH[name](spark.createDataFrame(text, SCHEMAS[name]))
        table = spark.table(tables[name])
        assert table.dtypes == wanted.dtypes
        assert rows(table) == rows(wanted)
        assert rows(read_table_at(spark, places_to_write[name])) == rows(wanted)
    assert dict(spark.table(tables["places"]).dtypes)["coordinates"] == "array<string>"
    assert dict(spark.table(tables["users"]).dtypes)["age"] == "string"

    run(spark, inputs, places_to_write, checkpoints)
    assert spark.table(tables["posts"]).count() == 9

    write_payloads(spark, inputs["posts"], [RECORDS["posts"]()[0]])
    run(spark, inputs, places_to_write, checkpoints)
    assert read_table_at(spark, places_to_write["posts"]).count() == 10
    assert read_table_at(spark, places_to_write["users"]).count() == 9


def test_typed_streams_have_the_batch_types(spark, places_to_write):
    inputs = {name: fresh_path(spark, f"in_{name}") for name in RECORDS}
    for name, records in RECORDS.items():
        write_payloads(spark, inputs[name], records())
    tables, _ = run(spark, inputs, places_to_write, fresh_path(spark, "progress"), typed=True)
    assert dict(spark.table(tables["posts"]).dtypes)["ind"] == "bigint"
    assert dict(spark.table(tables["users"]).dtypes)["age"] == "bigint"
    place = spark.table(tables["places"]).where("ind = 1").first()
    assert place["coordinates"] == [1.5, -2.0]


def test_broken_payload_gives_a_row_of_nulls(spark, places_to_write):
    inputs = {"posts": fresh_path(spark, "in_posts")}
    write_payloads(spark, inputs["posts"], [b"{broken", RECORDS["posts"]()[0]])
    tables, _ = run(spark, inputs, places_to_write, fresh_path(spark, "progress"))
    got = spark.table(tables["posts"]).orderBy(F.col("ind").asc_nulls_first()).collect()
    assert len(got) == 2 and all(v is None for v in got[0])


def test_earliest_is_the_default_start():
    class Reader:
        def __init__(self):
            self.said = {}

        def format(self, fmt):
            return self

        def options(self, **options):
            self.said = options
            return self

        def load(self):
            return self.said

    class Session:
        readStream = Reader()

    assert ingest.open_stream(Session, "kafka", {"subscribe": "t"}) == {"startingOffsets": "earliest", "subscribe": "t"}
    assert ingest.open_stream(Session, "kinesis", {"streamName": "s"}) == {
        "initialPosition": "earliest",
        "streamName": "s",
    }
