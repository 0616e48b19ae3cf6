"""Topics kept as JSON files under ``<root>/partition=<n>/``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RECORD_FILES = "{*.json,part-*.txt}"
LAYOUT = ("partition", "start", "batch")  # folders of a topic, the last two only where ``append_to_topic`` wrote it
LEDGER = "_offsets"  # hidden from readers of the records by its underscore


def read_topic(
    spark: SparkSession,
    root: str,
    schema: StructType | None = None,
    partitions: Sequence[int] | None = None,
    pattern: str = RECORD_FILES,
) -> DataFrame:
    """S1+S2: the JSON records of a topic, or of some of its ``partitions``, in files named like ``pattern``.

    Reads what other feeds land as ``.json`` and what ``append_to_topic`` and ``publish`` write as ``.txt`` alike.

    The root is read and filtered on its partition column, so unwanted folders are not even opened. Without ``schema`` the
    records' types are inferred, which reads the files twice.
    """
    reader = spark.read.option("pathGlobFilter", pattern)
    records = (reader.schema(schema) if schema is not None else reader).json(root)
    if partitions is not None:
        records = records.where(F.col("partition").isin(*partitions))
    return records.drop(*LAYOUT)


def topic_offsets(spark: SparkSession, root: str) -> dict[int, int]:
    """Per partition the offset that its next record will have; empty before the first append. A row per partition."""
    try:
        ledger = spark.read.parquet(f"{root}/{LEDGER}")
    except AnalysisException:  # nothing was appended yet
        return {}
    ends = ledger.groupBy("partition").agg(F.max(F.col("start") + F.col("n_records")).alias("end"))
    return {r.partition: r.end for r in ends.collect()}


def read_topic_from(
    spark: SparkSession, root: str, schema: StructType, offsets: Mapping[int, int] | None = None
) -> tuple[DataFrame, dict[int, int]]:
    """S1 from where an earlier read ended: the records since ``offsets``, and the offsets to go on from.

    Offsets are those an earlier call returned, so they lie between files; folders before them are not opened. Only
    appends that the ledger tells of are read: one that failed half-way is not, and its repetition is.
    """
    since, ends = dict(offsets or {}), topic_offsets(spark, root)
    reached = F.create_map(*[F.lit(x) for pair in since.items() for x in pair]) if since else None
    wanted = F.lit(0) if reached is None else F.coalesce(F.try_element_at(reached, F.col("partition")), F.lit(0))
    if not ends:
        return spark.createDataFrame([], schema), since
    told = spark.read.parquet(f"{root}/{LEDGER}").where(F.col("start") >= wanted).select("batch").distinct()
    told = told.withColumnRenamed("batch", "_told")
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    layout = StructType([*fields, *StructType.fromDDL("partition int, start bigint, batch string")])
    records = spark.read.option("pathGlobFilter", RECORD_FILES).schema(layout).json(root).where(F.col("start") >= wanted)
    new = records.join(F.broadcast(told), F.col("batch") == F.col("_told"), "left_semi")  # a row per append not yet read
    return new.drop(*LAYOUT), ends


def column_names(frames: Mapping[str, DataFrame]) -> dict[str, list[str]]:
    """Columns of each frame; no job."""
    return {name: df.columns for name, df in frames.items()}
