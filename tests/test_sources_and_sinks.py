"""Topics, published records, and the options of a relational scan."""

import json

from golden import write_lines

from postlens import session
from postlens.schemas import POSTS_JSON
from postlens.sinks.publish import publish, stream_records, topic_records
from postlens.sources.relational import read_relation, scan_options
from postlens.sources.topics import column_names, read_topic


def test_topic_reads_one_partition(spark, tmp_path):
    for part in (0, 1):
        write_lines(tmp_path / f"partition={part}", [{"index": part, "title": "t"}])
    (tmp_path / "partition=0" / "notes.txt").write_text("no record\n")
    first = read_topic(spark, str(tmp_path), POSTS_JSON, partitions=[0])
    assert first.columns == POSTS_JSON.names
    assert [r["index"] for r in first.collect()] == [0]
    assert read_topic(spark, str(tmp_path), POSTS_JSON).count() == 2
    assert read_topic(spark, str(tmp_path)).columns == ["index", "title"]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition" in plan


def test_column_names(spark):
    assert column_names({"a": spark.range(1), "b": spark.range(1).toDF("x")}) == {"a": ["id"], "b": ["x"]}


def test_published_rows_come_back(spark, tmp_path):
    df = spark.sql("SELECT 1 AS ind, timestamp '2019-03-04 05:06:07.5' AS at, CAST(NULL AS STRING) AS gone")
    path = str(tmp_path / "out")
    publish(topic_records(df, "t"), path=path)
    publish(topic_records(df, "t"), path=path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert len(lines) == 2
    assert json.loads(lines[0]) == {
        "records": [{"value": {"ind": 1, "at": "2019-03-04T05:06:07.500000", "gone": None}}]
    }


def test_message_without_envelope(spark):
    df = spark.sql("SELECT 1 AS ind, CAST(NULL AS STRING) AS gone")
    record = topic_records(df, "t", envelope=False).first()
    assert (record.topic, record.value) == ("t", '{"ind":1,"gone":null}')


def test_stream_records_carry_their_key(spark):
    df = spark.range(3)
    records = stream_records(df, "s", df["id"]).collect()
    assert sorted(r.key for r in records) == ["0", "1", "2"]
    assert all(json.loads(r.value)["PartitionKey"] == r.key for r in records)


def test_relational_scan_is_cut_by_key():
    options = scan_options("jdbc:x", "posts", "ind", 0, 11_000, 16)
    assert options["dbtable"] == "posts"
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"]) == ("ind", "0", "11000")
    assert options["numPartitions"] == "16"
    assert scan_options("u", "t", "k", 5, 5, 4)["upperBound"] == "6"


def test_shared_folder_is_the_one_named(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_folder(spark) == named
    assert session.fresh_path(spark, "x").startswith(f"{named}/x-")
    assert session.fresh_path(spark, "x") != session.fresh_path(spark, "x")


class _Reader:
    """Stands in for a session's reader: notes the options of each load, answers the question for the key's ends."""

    def __init__(self, ends):
        self.ends, self.loads, self.said = ends, [], {}

    def format(self, fmt):
        self.said = {"format": fmt}
        return self

    def options(self, **options):
        self.said |= options
        return self

    def load(self):
        self.loads.append(self.said)
        return self

    def first(self):
        return self.ends


class _Session:
    def __init__(self, ends=None):
        self.read = _Reader(ends)


def test_relation_asks_for_the_ends_of_its_key():
    asking = _Session((3, 900))
    read_relation(asking, "jdbc:x", "posts", "ind", tasks=4, properties={"user": "u"})
    ends, scan = asking.read.loads
    assert ends["query"] == "SELECT min(ind) AS low_end, max(ind) AS high_end FROM posts" and ends["user"] == "u"
    assert (scan["lowerBound"], scan["upperBound"], scan["numPartitions"]) == ("3", "900", "4")
    assert scan["format"] == "jdbc" and scan["user"] == "u"


def test_relation_of_known_or_no_ends():
    told = _Session()
    read_relation(told, "jdbc:x", "posts", "ind", bounds=(0, 11_000))
    assert [load["upperBound"] for load in told.read.loads] == ["11000"]
    empty = _Session((None, None))
    read_relation(empty, "jdbc:x", "posts", "ind")
    assert (empty.read.loads[1]["lowerBound"], empty.read.loads[1]["upperBound"]) == ("0", "1")
