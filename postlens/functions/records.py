"""JSON records in and out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType, TimestampType

# A NULL field is written as null, not left out.
JSON_OPTIONS = {"ignoreNullFields": "false"}


def iso_text(column: Column) -> Column:
    """K4: ISO-8601 text of a timestamp; six fraction digits where there is a fraction, none elsewhere."""
    text = F.translate(column.cast("string"), " ", "T")
    seconds_only, with_micros = 19, 26
    return F.when(F.length(text) > seconds_only, F.rpad(text, with_micros, "0")).otherwise(text)


def row_struct(df: DataFrame, columns=None) -> Column:
    """The row as a struct, its timestamps as ISO text."""

    def field(name: str) -> Column:
        is_time = isinstance(df.schema[name].dataType, (TimestampType, TimestampNTZType))
        return (iso_text(F.col(name)) if is_time else F.col(name)).alias(name)

    return F.struct(*[field(name) for name in columns or df.columns])


def topic_envelope(row: Column, present: Column | None = None) -> Column:
    """K2: ``{"records":[{"value":row}]}``. Where ``present`` is not true the row is an empty object."""
    full = F.to_json(F.struct(F.array(F.struct(row.alias("value"))).alias("records")), JSON_OPTIONS)
    if present is None:
        return full
    return F.when(present, full).otherwise('{"records":[{"value":{}}]}')


def stream_envelope(row: Column, stream: str, key: Column) -> Column:
    """K3: ``{"StreamName":..,"Data":row,"PartitionKey":key}``."""
    record = F.struct(
        F.lit(stream).alias("StreamName"), row.alias("Data"), key.cast("string").alias("PartitionKey")
    )
    return F.to_json(record, JSON_OPTIONS)


def routed(table: Column, routes: Mapping[str, str]) -> Column:
    """K5: topic of a table by a small literal map; NULL for a table without one."""
    pairs = [F.lit(part) for pair in routes.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), table)


def decode_payload(df: DataFrame, schema: StructType, column: str = "data") -> DataFrame:
    """Binary JSON payload to columns. A broken payload gives a row of NULLs, extra fields are ignored."""
    return df.select(F.from_json(F.col(column).cast("string"), schema).alias("record")).select("record.*")


BROKEN = "broken_payload"


def decode_payload_and_broken(df: DataFrame, schema: StructType, column: str = "data") -> DataFrame:
    """As ``decode_payload``, a row for each record, with the text of a payload that is no JSON object in ``BROKEN``.

    A NULL payload is not broken: its row is all NULL.
    """
    wider = StructType([*schema, StructField(BROKEN, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    return df.select(F.from_json(F.col(column).cast("string"), wider, options).alias("record")).select("record.*")
