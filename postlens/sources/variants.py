"""JSON records without a schema, read once (S1 with inference).

``spark.read.json`` without a schema parses the files twice, once to infer and once to read. Here each record is parsed
once, into a VARIANT that is written down; its schema is gathered from the stored values, and so are the typed columns.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.sources.topics import RECORD_FILES
from postlens.sources.tables import read_table_at

RECORD, TEXT = "record", "text"


def ingest_records(spark: SparkSession, root: str, path: str, pattern: str = RECORD_FILES) -> DataFrame:
    """Parse every line of a topic's files into a VARIANT column ``record``, stored at ``path``.

    A line that is no JSON has a NULL ``record`` and stays in ``text``; otherwise ``text`` is NULL.
    """
    lines = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(root)
    parsed = lines.select(F.try_parse_json("value").alias(RECORD), "value")
    kept = parsed.select(RECORD, F.when(F.col(RECORD).isNull(), F.col("value")).alias(TEXT))
    kept.write.mode("errorifexists").parquet(path)
    return read_table_at(spark, path)


def gathered_schema(records: DataFrame) -> str:
    """The DDL of all records' fields together, from one aggregation.

    As in Spark's own inference, fields that are only ever NULL are text and numbers with a fraction are doubles.
    """
    told = records.agg(F.schema_of_variant_agg(RECORD)).first()[0]
    if told is None or not told.startswith("OBJECT<"):
        return ""
    told = re.sub(r"\bVOID\b", "STRING", told.replace("OBJECT<", "STRUCT<"))
    return re.sub(r"\bDECIMAL\(\d+, ?[1-9]\d*\)", "DOUBLE", told)


def typed_records(records: DataFrame, schema: str | None = None) -> DataFrame:
    """The stored records as columns of ``schema``, a struct's DDL; of the gathered one without it.

    A record that lacks a field has NULL there; so has one whose value does not fit the type. What was no JSON gives a row
    of NULLs, as from ``read_topic``.
    """
    schema = schema or gathered_schema(records)
    if not schema:
        return records.sparkSession.createDataFrame([], "record string").drop("record")
    return records.select(F.try_variant_get(RECORD, "$", schema).alias("fields")).select("fields.*")
