"""Live record streams cleaned and appended to tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from postlens.functions.records import BROKEN, decode_payload, decode_payload_and_broken
from postlens.operators.cleaning import clean_places, clean_posts, clean_users
from postlens.schemas import PLACES_TEXT, POSTS_TEXT, USERS_TEXT

# Where a source starts when it has no checkpoint yet: its earliest record. File streams always do.
EARLIEST = {
    "kafka": {"startingOffsets": "earliest"},
    "kinesis": {"initialPosition": "earliest"},
}


def open_stream(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """S6+T4: a record stream from its earliest record. ``options`` win over the defaults.

    Bound a micro-batch there (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``), or the first one takes all there is.
    """
    reader = spark.readStream.format(fmt).options(**{**EARLIEST.get(fmt, {}), **dict(options or {})})
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def append_to_table(
    df: DataFrame,
    table: str,
    checkpoint: str,
    fmt: str = "parquet",
    path: str | None = None,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """K1+T3: append to ``table`` with a checkpoint of its own. No trigger means one micro-batch after the other."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if path:
        writer = writer.option("path", path)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.toTable(table)


def clean_posts_stream(records: DataFrame, typed: bool = False) -> DataFrame:
    """S7+C4: payloads to cleaned posts; a thousands mark is not expanded on this path."""
    return clean_posts(decode_payload(records, POSTS_TEXT), "none", typed)


def clean_places_stream(records: DataFrame, typed: bool = False) -> DataFrame:
    """S7+C5: payloads to cleaned places."""
    return clean_places(decode_payload(records, PLACES_TEXT), typed)


def clean_users_stream(records: DataFrame, typed: bool = False) -> DataFrame:
    """S7+C6: payloads to cleaned users."""
    return clean_users(decode_payload(records, USERS_TEXT), typed)


def start_ingest(
    streams: Mapping[str, DataFrame],
    tables: Mapping[str, str],
    checkpoints: str,
    fmt: str = "parquet",
    paths: Mapping[str, str] | None = None,
    trigger: Mapping[str, object] | None = None,
    typed: bool = False,
) -> dict[str, StreamingQuery]:
    """T1+T2: one independent query per entity (``posts``, ``places``, ``users``), each stateless and map-only."""
    cleaners = {"posts": clean_posts_stream, "places": clean_places_stream, "users": clean_users_stream}
    return {
        entity: append_to_table(
            cleaners[entity](records, typed),
            tables[entity],
            f"{checkpoints.rstrip('/')}/{entity}",
            fmt,
            (paths or {}).get(entity),
            trigger,
        )
        for entity, records in streams.items()
    }


PAYLOADS = {"posts": POSTS_TEXT, "places": PLACES_TEXT, "users": USERS_TEXT}


def with_payload_counts(records: DataFrame, entity: str) -> DataFrame:
    """The records, unchanged; each micro-batch's progress tells under ``<entity>_payloads`` how many it had and how many
    of them were broken. They are decoded to all-NULL rows, which nothing else tells apart from rows of NULL fields."""
    broken = F.col("_decoded")[BROKEN].isNotNull()
    wider = StructType([*PAYLOADS[entity], StructField(BROKEN, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    seen = records.withColumn("_decoded", F.from_json(F.col("data").cast("string"), wider, options))
    seen = seen.observe(f"{entity}_payloads", F.count("*").alias("records"), F.count_if(broken).alias("broken"))
    return seen.drop("_decoded")


def broken_payloads(records: DataFrame, entity: str) -> DataFrame:
    """``entity`` and ``payload`` of the records whose payload is no JSON object, for a table beside the cleaned one."""
    broken = decode_payload_and_broken(records, PAYLOADS[entity]).where(F.col(BROKEN).isNotNull())
    return broken.select(F.lit(entity).alias("entity"), F.col(BROKEN).alias("payload"))
