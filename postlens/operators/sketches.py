"""Medians by mergeable quantile sketches (A3): sketches are stored rows, merged over days, keys and weights.

A sketch is a binary column of a bounded size (``size`` sets it, some 16 bytes times ``size`` at most), so a report over any
number of days reads one small row per day and group instead of the records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

SIZE = 2_000
SKETCH, VALUES = "sketch", "n_values"
BITS = 63  # of a weight, and of a sketch's count of values


def rank_bound(size: int = SIZE) -> float:
    """How far from its place a median may lie, as a share of the group's values: three times the error that a sketch of
    this size keeps with 99 % confidence."""
    return 3 * 2.296 / size**0.9723


def _kind(df: DataFrame, value: str) -> str:
    whole = isinstance(df.schema[value].dataType, (ByteType, ShortType, IntegerType, LongType))
    return "bigint" if whole else "double"


def sketches_by(df: DataFrame, keys: Sequence[str], value: str, size: int = SIZE) -> DataFrame:
    """A sketch of ``value`` per group: ``keys``, ``sketch`` and ``kind``, the type of number it holds.

    NULL and NaN values are passed over; a group without other values has an empty sketch. Combined on the map side, so a
    hot group sends one sketch a task.
    """
    kind = _kind(df, value)
    made = F.call_function(f"kll_sketch_agg_{kind}", F.col(value).cast(kind), F.lit(size))
    return df.groupBy(*keys).agg(made.alias(SKETCH)).withColumn("kind", F.lit(kind))


def merged_by(sketches: DataFrame, keys: Sequence[str], kind: str, size: int = SIZE) -> DataFrame:
    """The sketches of each group merged into one."""
    merged = F.call_function(f"kll_merge_agg_{kind}", F.col(SKETCH), F.lit(size))
    return sketches.groupBy(*keys).agg(merged.alias(SKETCH)).withColumn("kind", F.lit(kind))


def weighted_by(sketches: DataFrame, keys: Sequence[str], weight: str, kind: str, size: int = SIZE) -> DataFrame:
    """As ``merged_by``, each sketch taken ``weight`` times (a whole number from 0 on that fits a bigint).

    No sketch is repeated: those whose weight has a certain bit are merged into one per group and bit, and from the
    highest bit down the sum so far is merged with itself and with the bit's sketch. That is two merges a bit.
    """
    bit = F.explode(F.expr(f"filter(sequence(0, {BITS - 1}), b -> shiftright(CAST(`{weight}` AS BIGINT), b) & 1 = 1)"))
    by_bit = merged_by(sketches.select(*keys, SKETCH, bit.alias("_bit")), [*keys, "_bit"], kind, size)
    held = F.map_from_entries(F.collect_list(F.struct("_bit", SKETCH)))
    found = by_bit.groupBy(*keys).agg(held.alias("_held"), F.max("_bit").alias("_highest"))
    both = lambda a, b: F.call_function(f"kll_sketch_merge_{kind}", a, b)
    next_bit = lambda told, b: F.when(
        F.try_element_at("_held", b).isNull(), both(told, told)
    ).otherwise(both(both(told, told), F.try_element_at("_held", b)))
    below = F.when(F.col("_highest") > 0, F.sequence(F.col("_highest") - 1, F.lit(0), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    summed = F.aggregate(below, F.element_at("_held", F.col("_highest")), next_bit)
    return found.select(*keys, summed.alias(SKETCH), F.lit(kind).alias("kind"))


def medians_of(sketches: DataFrame, keys: Sequence[str], name: str, kind: str) -> DataFrame:
    """``keys``, ``n_values`` and the lower median as ``name``; NULL where a sketch is empty.

    The count is exact. Up to as many values as the sketch's size the median is too; beyond that its place is off by
    ``rank_bound`` of them at most, but for one case in far more than a million.
    """
    n = F.call_function(f"kll_sketch_get_n_{kind}", F.col(SKETCH))
    middle = F.call_function(f"kll_sketch_get_quantile_{kind}", F.col(SKETCH), F.lit(0.5))
    return sketches.select(*keys, n.alias(VALUES), F.when(n > 0, middle).alias(name))


def within_bound(
    rows: DataFrame, medians: DataFrame, keys: Sequence[str], value: str, median: str, weight: str | None = None,
    bound: float | None = None,
) -> DataFrame:
    """Whether each group's median lies in its place among ``rows``: ``keys``, ``n_values`` of the rows, ``within_bound``.

    The place is exact: how much weight of the group is below the median, and how much up to it. A group without values
    is within if its median is NULL.
    """
    bound = rank_bound() if bound is None else bound
    told = medians.select(*[F.col(k).alias(f"_key_{k}") for k in keys], F.col(median).alias("_median"))
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    met = rows.join(told, same, "left")
    times = F.lit(1).cast("bigint") if weight is None else F.col(weight).cast("bigint")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, times)), F.lit(0))

    counts = met.groupBy(*keys).agg(
        total(F.col(value).isNotNull()).alias(VALUES),
        total(F.col(value) < F.col("_median")).alias("_below"),
        total(F.col(value) <= F.col("_median")).alias("_upto"),
        F.max("_median").alias("_median"),
    )
    place = F.ceil(F.col(VALUES) / 2)
    off = F.greatest(F.col("_below") + 1 - place, place - F.col("_upto"), F.lit(0))
    fine = F.when(F.col(VALUES) == 0, F.col("_median").isNull()).otherwise(off <= bound * F.col(VALUES))
    return counts.select(*keys, VALUES, F.coalesce(fine, F.lit(False)).alias("within_bound"))
