"""Explicit schemas of the three record sets, so that no scan pays an inference pass."""

from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _all_text(*names: str) -> StructType:
    return StructType([StructField(name, StringType(), True) for name in names])


def _retyped(schema: StructType, **types) -> StructType:
    return StructType([StructField(f.name, types.get(f.name, f.dataType), True) for f in schema])


# Field names of the incoming records. Live payloads carry every field as text.
POSTS_TEXT = _all_text(
    "category",
    "description",
    "downloaded",
    "follower_count",
    "image_src",
    "index",
    "is_image_or_video",
    "poster_name",
    "save_location",
    "tag_list",
    "title",
    "unique_id",
)
PLACES_TEXT = _all_text("country", "ind", "latitude", "longitude", "timestamp")
USERS_TEXT = _all_text("age", "date_joined", "first_name", "ind", "last_name")

# The same records as the batch JSON files hold them, with numbers as numbers.
POSTS_JSON = _retyped(POSTS_TEXT, downloaded=LongType(), index=LongType())
PLACES_JSON = _retyped(PLACES_TEXT, ind=LongType(), latitude=DoubleType(), longitude=DoubleType())
USERS_JSON = _retyped(USERS_TEXT, age=LongType(), ind=LongType())

# Order of the cleaned columns.
POSTS_CLEAN = [
    "ind",
    "unique_id",
    "title",
    "description",
    "follower_count",
    "poster_name",
    "tag_list",
    "is_image_or_video",
    "image_src",
    "save_location",
    "category",
]
PLACES_CLEAN = ["ind", "country", "coordinates", "timestamp"]
USERS_CLEAN = ["ind", "user_name", "age", "date_joined"]
