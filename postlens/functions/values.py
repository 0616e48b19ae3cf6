"""Typed values: coordinates, timestamps, years and bands."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Band(NamedTuple):
    """Ages ``low`` to ``high``, both included; ``above`` alone is an open band of anything greater."""

    label: str
    low: int | None = None
    high: int | None = None
    above: int | None = None


# Age bands of the reports.
AGE_BANDS = (
    Band("18-24", low=18, high=24),
    Band("25-35", low=25, high=35),
    Band("36-50", low=36, high=50),
    Band("+50", above=50),
)


def coordinates(latitude: Column, longitude: Column) -> Column:
    """E5: latitude and longitude, in that order."""
    return F.array(latitude, longitude)


def lenient_timestamp(column: Column) -> Column:
    """Timestamp, or NULL where the text is none."""
    return F.try_to_timestamp(column)


def band(column: Column, bands=AGE_BANDS) -> Column:
    """Label of the band a value falls into; NULL outside every band."""

    def inside(b: Band) -> Column:
        return column > b.above if b.above is not None else column.between(b.low, b.high)

    first, *rest = bands
    start = F.when(inside(first), first.label)
    return reduce(lambda chain, b: chain.when(inside(b), b.label), rest, start)


def in_years(df: DataFrame, column: str, first: int, last: int) -> DataFrame:
    """E8+F2: rows whose timestamp lies in the years ``first`` to ``last``, both included.

    Said as a range on the timestamp itself, not on ``year(...)``, so that the parquet reader can skip row groups.
    The bounds take the column's own type: a cast on the column would stop the push-down.
    """
    kind = df.schema[column].dataType
    start = F.lit(f"{first:04d}-01-01 00:00:00").cast(kind)
    end = F.lit(f"{last + 1:04d}-01-01 00:00:00").cast(kind)
    return df.where((F.col(column) >= start) & (F.col(column) < end))


def year_of(column: str) -> Column:
    """Calendar year."""
    return F.year(F.col(column))
