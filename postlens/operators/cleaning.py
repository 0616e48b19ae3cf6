"""Cleaning of the three record sets (C1-C6), the same functions for batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from postlens.functions.text import (
    expand_suffix,
    joined_text,
    lenient_number,
    placeholder_to_null,
    swap_token,
    without_text,
)
from postlens.functions.values import coordinates, lenient_timestamp
from postlens.schemas import PLACES_CLEAN, POSTS_CLEAN, USERS_CLEAN

# How a thousands mark in a follower count is read, before the cast to int.
FOLLOWER_MODES = {
    "exact": lambda c: swap_token(c, "k", "000"),
    "suffix": expand_suffix,
    "none": lambda c: c,
}


def null_placeholders(df: DataFrame) -> DataFrame:
    """E1 over every text column, in one projection."""
    return df.select(
        *[
            placeholder_to_null(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, StringType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def _number(df: DataFrame, name: str, kind: str, wanted: bool = True, column: Column | None = None) -> Column:
    """A column of ``df``, or an expression on it, as a number; as it is where that is not wanted."""
    column = F.col(name) if column is None else column
    if not wanted:
        return column
    is_text = isinstance(df.schema[name].dataType, StringType)
    return lenient_number(column, kind) if is_text else column.try_cast(kind)


def clean_posts(df: DataFrame, follower_mode: str = "exact", typed: bool = False) -> DataFrame:
    """C1 with ``follower_mode="exact"``, C4 with ``"none"``.

    ``exact`` turns the lone text ``k`` into ``000``, so ``12k`` ends as NULL; ``suffix`` reads ``12k`` as 12000.
    ``typed`` casts a text key to bigint, as the batch files hold it.
    """
    is_text = isinstance(df.schema["follower_count"].dataType, StringType)
    followers = FOLLOWER_MODES[follower_mode if is_text else "none"](F.col("follower_count"))
    columns = {
        "follower_count": _number(df, "follower_count", "int", column=followers),
        "save_location": without_text(F.col("save_location")),
        "ind": _number(df, "index", "bigint", typed),
    }
    clean = null_placeholders(df)
    return clean.select(*[columns.get(name, F.col(name)).alias(name) for name in POSTS_CLEAN])


def clean_places(df: DataFrame, typed: bool = False) -> DataFrame:
    """C2 and C5. ``typed`` casts text keys to bigint and text coordinates to double."""
    columns = {
        "ind": _number(df, "ind", "bigint", typed),
        "coordinates": coordinates(
            _number(df, "latitude", "double", typed), _number(df, "longitude", "double", typed)
        ),
        "timestamp": lenient_timestamp(F.col("timestamp")),
    }
    return df.select(*[columns.get(name, F.col(name)).alias(name) for name in PLACES_CLEAN])


def clean_users(df: DataFrame, typed: bool = False) -> DataFrame:
    """C3 and C6. ``typed`` casts text keys and ages to bigint."""
    columns = {
        "ind": _number(df, "ind", "bigint", typed),
        "user_name": joined_text(F.col("first_name"), F.col("last_name")),
        "age": _number(df, "age", "bigint", typed),
        "date_joined": lenient_timestamp(F.col("date_joined")),
    }
    return df.select(*[columns.get(name, F.col(name)).alias(name) for name in USERS_CLEAN])


def with_column_if_absent(df: DataFrame, name: str, column: Column) -> DataFrame:
    """P10: add ``column`` as ``name`` unless the frame has one already."""
    return df if name in df.columns else df.withColumn(name, column)
