"""Rows published as JSON records (K2, K3)."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.records import JSON_OPTIONS, row_struct, stream_envelope, topic_envelope
from postlens.sources.topics import LEDGER, RECORD_FILES, topic_offsets


def topic_records(
    df: DataFrame, topic: str, columns=None, present: Column | None = None, envelope: bool = True
) -> DataFrame:
    """K2: one record per row, as ``topic`` and ``value``. Without ``envelope`` the value is the row alone, as a message."""
    row = row_struct(df, columns)
    value = topic_envelope(row, present) if envelope else F.to_json(row, JSON_OPTIONS)
    return df.select(F.lit(topic).alias("topic"), value.alias("value"))


def stream_records(df: DataFrame, stream: str, key: Column, columns=None) -> DataFrame:
    """K3: one record per row, as ``stream``, ``key`` and ``value``.

    Pass the entity key as ``key``. A constant is allowed, but sends every record to one shard.
    """
    return df.select(
        F.lit(stream).alias("stream"),
        key.cast("string").alias("key"),
        stream_envelope(row_struct(df, columns), stream, key).alias("value"),
    )


def publish(
    records: DataFrame, fmt: str = "text", path: str | None = None, options: Mapping[str, str] | None = None
) -> None:
    """Write records out: ``text`` files of their ``value``, or a message format such as ``kafka`` by ``options``."""
    out = records.select("value") if fmt == "text" else records
    writer = out.write.format(fmt).options(**dict(options or {})).mode("append")
    writer.save(path) if path else writer.save()


def append_to_topic(records: DataFrame, root: str, key: str, partitions: int = 8) -> dict[int, int]:
    """K2 into the folders of a topic: ``value`` texts dealt to partitions by a hash of ``key``, at the next offsets.

    A partition's new records lie under ``partition=<p>/start=<offset of the first>/batch=<append>/``, in files of about
    equal size however hot a key is. When all are written, the ledger beside them gets a row per partition; only then does
    ``read_topic_from`` see them, while ``read_topic`` reads every file there is. Returns the offsets that come next. One
    writer at a time; the number of partitions must not change, or keys move.
    """
    spark, batch = records.sparkSession, uuid.uuid4().hex
    ends = topic_offsets(spark, root)
    first = F.create_map(*[F.lit(x) for p in range(partitions) for x in (p, ends.get(p, 0))])
    dealt = records.select("value", F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int").alias("partition"))
    placed = dealt.hint("rebalance", "partition").select(
        "value", "partition", F.element_at(first, F.col("partition")).cast("bigint").alias("start"), F.lit(batch).alias("batch")
    )
    placed.write.mode("append").partitionBy("partition", "start", "batch").text(root)
    written = spark.read.option("pathGlobFilter", RECORD_FILES).schema("value string, partition int, start bigint, batch string").text(root)
    counts = written.where(F.col("batch") == batch).groupBy("partition", "start", "batch").agg(F.count("*").alias("n_records"))
    counts.coalesce(1).write.mode("append").parquet(f"{root}/{LEDGER}")  # a row per partition
    return topic_offsets(spark, root)
