"""Counts, ranks and medians per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, MapType, ShortType, VariantType

# Parts that the range of 32-bit integers is split into by ``exact_median_by``.
PARTS = 65_536
# Marks placed by rank around a median. A sketch of the rows is off by at most 1 / accuracy of them in rank, so two marks
# hold the median and at most 0.0008 of a group's rows between them. Of distinct values with weights the median's rank is
# not known beforehand: of few groups one of 256 parts is kept, at most 0.006 of the values; of many, where long lists of
# marks would weigh more than the rows, each of two rounds keeps one of 32 parts, together 0.0012 of the values.
ROW_ACCURACY, ROW_SHARES = 10_000, (0.4997, 0.5003)
FINE_ACCURACY, FINE_STEPS = 1_000, (128, 64, 32, 16, 8, 4, 2, 1)
VALUE_ACCURACY, VALUE_SHARES, VALUE_ROUNDS = 1_000, tuple(i / 32 for i in range(1, 32)), 2
# Of many groups, those with up to so many distinct values are ranked as they are; marks would weigh as much as the values.
WHOLE_GROUP = 1_000


def counts_by(df: DataFrame, keys: Sequence[str], counted: str, name: str) -> DataFrame:
    """A1: number of non-NULL ``counted`` per group. A NULL key is a group, and counts 0 where it is what is counted."""
    return df.groupBy(*keys).agg(F.count(counted).alias(name))


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], measure: str, n: int = 1, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """W1+F1: the ``n`` rows of each group with the greatest ``measure``, ties settled by ``tiebreak`` ascending.

    Catalyst turns the rank filter into a per-task limit before the shuffle, so a group however large sends at most ``n``
    rows per task (as long as ``n`` is within ``spark.sql.optimizer.windowGroupLimitThreshold``, 1000 by default). For
    more rows than that use ``top_many_per_group``.
    """
    order = [F.col(measure).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in tiebreak]]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") <= n).drop("_rank")


def top_many_per_group(
    df: DataFrame,
    keys: Sequence[str],
    measure: str,
    n: int,
    tiebreak: Sequence[str] = (),
    few_groups: bool = False,
    parts: int = 64,
) -> DataFrame:
    """W1+F1 for a large ``n`` and a numeric ``measure``: the rows of ``top_n_per_group`` without ranking whole groups.

    Per group the ``n``-th greatest value is selected as in ``exact_median_by``: counts between marks say which part of
    the range holds it, and only that part's distinct values are ranked. Rows above it stay without being ordered. Rows
    that tie with it (or, where a group has fewer values, its rows of a NULL measure) are ranked by ``tiebreak`` in two
    steps, by a hash of the row into ``parts`` and then over what each part keeps, so the last task of a group has
    ``parts * n`` of them at most. ``df`` is read three times: write it down first if it is dear. ``few_groups`` as in
    ``exact_median_by``.
    """
    keys = list(keys)
    named = df.select(*keys, F.col(measure).alias("_value"))
    counted = named.groupBy(*keys, "_value").agg(F.expr("sum(CASE WHEN _value IS NULL THEN 0 ELSE 1L END)").alias("_count"))
    nth = f"CASE WHEN sum(_count) = 0 THEN 0 ELSE greatest(CAST(sum(_count) AS DECIMAL(38, 0)) - {n - 1}, 1) END"
    live = _between_marks(counted, keys, few_groups, VALUE_SHARES, VALUE_ACCURACY, VALUE_ROUNDS, nth)
    last = _holding_nth(live, keys, "_value").select(*keys, F.col("_value").alias("_least"))
    told = _told(counted, last, keys, few_groups).groupBy(*keys).agg(
        F.expr("sum(CASE WHEN _value > _least THEN _count ELSE 0 END)").alias("_above"),
        F.sum("_count").alias("_all"),
        F.first("_least").alias("_least"),
    )
    # with fewer values than n all of them stay, and rows of a NULL measure fill up
    told = told.selectExpr(
        *[f"`{k}`" for k in keys],
        f"CASE WHEN _all >= {n} THEN _least END AS _least",
        f"{n} - CASE WHEN _all >= {n} THEN _above ELSE _all END AS _room",
    )
    wide = _told(df, told, keys, few_groups)
    value = F.col(measure)
    sure = F.when(F.col("_least").isNull(), value.isNotNull()).otherwise(F.coalesce(value > F.col("_least"), F.lit(False)))
    tie = value.eqNullSafe(F.col("_least"))
    order = [F.col(c).asc_nulls_first() for c in tiebreak] or [F.lit(0)]
    hashed = [f.name for f in df.schema if f.name not in keys and not isinstance(f.dataType, (MapType, VariantType))]
    salt = F.pmod(F.xxhash64(*hashed), F.lit(parts))
    within = Window.partitionBy(*keys, "_part").orderBy(*order)
    first = wide.where(tie & ~sure).withColumn("_part", salt).withColumn("_rank", F.row_number().over(within))
    first = first.where(F.col("_rank") <= F.least("_room", F.lit(n))).drop("_part", "_rank")
    ranked = first.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    filled = ranked.where(F.col("_rank") <= F.col("_room"))
    return wide.where(sure).select(*df.columns).unionAll(filled.select(*df.columns))


def approx_median_by(
    df: DataFrame, keys: Sequence[str], value: str, name: str, accuracy: int = 10_000
) -> DataFrame:
    """A3: lower median per group by a quantile sketch; off by at most 1/accuracy of the group's rows in rank.

    Every task ships a sketch per group to one final task, so memory there grows with accuracy times tasks; where that is
    too much, or rows carry a weight, use ``exact_median_by``.
    """
    return df.groupBy(*keys).agg(F.percentile_approx(value, 0.5, accuracy).alias(name))


def exact_median_by(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str,
    weight: str | None = None,
    few_groups: bool = False,
    rescan: bool = False,
) -> DataFrame:
    """Lower median of a numeric ``value`` per group, each row counted ``weight`` times (a positive whole number).

    NULL values are passed over; a group with nothing else gives NULL. No group is gathered in one task: distinct values
    are counted, the counts are summed over parts of the value range, and only the values in the part that holds the
    median are ranked. For 32-bit integers that leaves at most ``PARTS`` values per group. For wider types the parts lie
    between marks placed by rank, however the values are spread, and what is ranked is one repeated value or at most 0.006
    of the group's distinct values (with ``rescan`` and no weight 0.0008 of its rows). The marks come from a sketch,
    which only decides how much is left; the counts beside them are exact. Where groups may be many and nothing is
    rescanned, those with up to ``WHOLE_GROUP`` distinct values are ranked without marks.

    ``few_groups`` says that the number of groups is bounded by the meaning of the keys (a band, a year), which allows
    broadcasting one row per group. With ``rescan``, each of the steps reads ``df`` again and combines on the
    map side, so that hardly anything is shuffled: right for few groups of a table's rows, wrong after a join. Without it
    the distinct values are shuffled once and kept.
    """
    keys = list(keys)
    named = df.select(*keys, F.col(value).alias("_value"), *([] if weight is None else [F.col(weight).alias("_weight")]))
    # A weight is wide enough for the product of three row counts.
    times = "1L" if weight is None else "CAST(_weight AS DECIMAL(38, 0))"
    each = F.expr(f"CASE WHEN _value IS NULL THEN 0 ELSE {times} END")
    if rescan:
        counted = named.select(*keys, "_value", each.alias("_count"))
    else:
        counted = named.groupBy(*keys, "_value").agg(F.sum(each).alias("_count"))

    is_small = isinstance(df.schema[value].dataType, (ByteType, ShortType, IntegerType))
    if is_small:
        sums = counted.groupBy(*keys, F.expr(UPPER_BITS).alias("_part")).agg(*_summary())
        rows = f"sum(_count) OVER (PARTITION BY {_listed(keys)})"
        state = _holding_nth(sums.selectExpr("*", f"ceil(CAST({rows} AS DECIMAL(38, 0)) / 2) AS _nth"), keys, "_part")
        live = _inside(counted, state, keys, few_groups)
    elif rescan and weight is None:
        live = _between_marks(counted, keys, few_groups, ROW_SHARES, ROW_ACCURACY, rounds=1)
    elif few_groups:
        live = _between_fine_marks(counted, keys)
    elif rescan:
        live = _between_marks(counted, keys, few_groups, VALUE_SHARES, VALUE_ACCURACY, VALUE_ROUNDS)
    else:
        live = _whole_or_between_marks(counted, keys, HALF if weight else "(sum(_count) + 1) div 2")
    if rescan:
        live = live.groupBy(*keys, "_value").agg(F.sum("_count").alias("_count"), F.max("_nth").alias("_nth"))
    return _holding_nth(live, keys, "_value").select(*keys, F.col("_value").alias(name))


# The upper half of a 32-bit integer.
UPPER_BITS = "shiftright(CAST(_value AS INT), 16)"
# The lower median's place among a group's rows; 0 where no value is known.
HALF = "ceil(CAST(sum(_count) AS DECIMAL(38, 0)) / 2)"
# A value's place on the line of finite doubles; never falls as the value rises, which is all that is asked of it.
PLACE = """CASE
    WHEN isnan(CAST(_value AS DOUBLE)) OR CAST(_value AS DOUBLE) = double('infinity') THEN 1.7976931348623157E308D
    WHEN CAST(_value AS DOUBLE) = double('-infinity') THEN -1.7976931348623157E308D
    ELSE CAST(_value AS DOUBLE) END"""


def _listed(keys: list[str]) -> str:
    return ", ".join(f"`{k}`" for k in keys)


def _summary() -> tuple[Column, ...]:
    return F.sum("_count").alias("_count"), F.min("_value").alias("_low"), F.max("_value").alias("_high")


def _inside(counted: DataFrame, state: DataFrame, keys: list[str], few_groups: bool) -> DataFrame:
    """Counted values within their group's interval; the NULL rows of a group without values stay."""
    told = state.selectExpr(*[f"`{k}`" for k in keys], "_low", "_high", "_nth - _before AS _nth")
    within = "coalesce(_value BETWEEN _low AND _high, _low IS NULL)"
    return _told(counted, told, keys, few_groups, within)


def _told(counted: DataFrame, state: DataFrame, keys: list[str], few_groups: bool, within: str = "true") -> DataFrame:
    """The counted values for which ``within`` holds, with their group's state.

    The condition is wrapped so that Catalyst infers no not-NULL filter for one side: all uses of ``counted`` then have
    the same plan, and its shuffle runs once.
    """
    named = state.selectExpr(*[f"`{k}` AS `_key_{k}`" for k in keys], *[c for c in state.columns if c not in keys])
    if few_groups:
        named = F.broadcast(named)  # one row per band or year
    same_group = " AND ".join(f"`{k}` <=> `_key_{k}`" for k in keys)
    return counted.join(named, F.expr(f"{same_group} AND {within}")).drop(*[f"_key_{k}" for k in keys])


def _between_marks(
    counted: DataFrame,
    keys: list[str],
    few_groups: bool,
    shares: Sequence[float],
    accuracy: int,
    rounds: int,
    nth: str = HALF,
) -> DataFrame:
    """Counted values of the part, between marks at the given shares of the values' ranks, that holds the ``nth``.

    A part goes from above one mark up to the next. The counts up to each mark are summed for all marks at once, so a
    round costs one row per task and group; it is repeated on what is left. The marks are a key of the sums: carried by
    ``first``, an array has every value sorted with its group's marks beside it, and computed anew they may differ. For the
    latter reason a later round takes ``_nth`` from its rows, which the same marks left.
    """
    live = counted.withColumn("_at", F.expr(PLACE))
    for i in range(rounds):
        found = [F.percentile_approx("_at", list(shares), accuracy).alias("_marks")]
        marks = live.groupBy(*keys).agg(*found, *([] if i else [F.expr(nth).alias("_nth")]))
        seen = _told(live, marks, keys, few_groups)
        upto = [F.expr(f"sum(CASE WHEN _at <= _marks[{j}] THEN _count ELSE 0 END)").alias(f"_upto{j}") for j in range(len(shares))]
        sums = seen.groupBy(*keys, "_marks").agg(*upto, F.first("_nth").alias("_wanted"))
        listed = f"array({', '.join(f'_upto{j}' for j in range(len(shares)))})"
        parts = sums.selectExpr(*[f"`{k}`" for k in keys], "_marks", "_wanted", f"{listed} AS _upto")
        parts = parts.selectExpr("*", "size(filter(_upto, x -> x < _wanted)) AS _part")
        state = parts.selectExpr(
            *[f"`{k}`" for k in keys],
            "get(_marks, _part - 1) AS _above",
            "get(_marks, _part) AS _last",
            "_wanted",
            "coalesce(get(_upto, _part - 1), 0) AS _passed",
        )
        within = "coalesce((_above IS NULL OR _at > _above) AND (_last IS NULL OR _at <= _last), false)"
        inside = _told(live, state, keys, few_groups, within)
        live = inside.withColumn("_nth", F.expr(f"{'_nth' if i else '_wanted'} - _passed")).drop("_above", "_last", "_wanted", "_passed")
    return live.select(*keys, "_value", "_count", "_nth")


def _whole_or_between_marks(counted: DataFrame, keys: list[str], nth: str) -> DataFrame:
    """All counted values of groups with up to ``WHOLE_GROUP`` of them; of larger ones what ``_between_marks`` leaves.

    Both sides use every column of ``sizes``, so that it has one plan, too.
    """
    sizes = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("_values"), F.expr(nth).alias("_nth"))
    small = _told(counted, sizes, keys, False, f"_values <= {WHOLE_GROUP}")
    large = _told(counted, sizes, keys, False, f"_values > {WHOLE_GROUP} AND _nth > 0").drop("_values", "_nth")
    live = _between_marks(large, keys, False, VALUE_SHARES, VALUE_ACCURACY, VALUE_ROUNDS, nth)
    return small.select(*keys, "_value", "_count", "_nth").unionAll(live)


def _between_fine_marks(counted: DataFrame, keys: list[str]) -> DataFrame:
    """As ``_between_marks``, in one round of 255 marks for few groups: each value looks its part up by halves."""
    shares = [i / (2 * FINE_STEPS[0]) for i in range(1, 2 * FINE_STEPS[0])]
    placed = counted.withColumn("_at", F.expr(PLACE))
    marks = placed.groupBy(*keys).agg(
        F.percentile_approx("_at", shares, FINE_ACCURACY).alias("_marks"),
        F.expr(HALF).alias("_nth"),
    )
    seen = _told(placed, marks, keys, few_groups=True).withColumn("_part", F.lit(0))
    for step in FINE_STEPS:
        seen = seen.withColumn("_part", F.expr(f"_part + CASE WHEN _at > get(_marks, _part + {step - 1}) THEN {step} ELSE 0 END"))
    sums = seen.groupBy(*keys, "_part").agg(F.sum("_count").alias("_count"), F.first("_nth").alias("_nth"))
    held = _holding_nth(sums, keys, "_part").selectExpr(*[f"`{k}`" for k in keys], "_part AS _held", "_nth - _before AS _nth")
    live = _told(seen.drop("_nth"), held, keys, True, "coalesce(_part = _held, false)")
    return live.select(*keys, "_value", "_count", "_nth")


def _holding_nth(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Per group the row, by ``order``, in which the running count reaches ``_nth``; adds the count before it."""
    window = f"PARTITION BY {_listed(keys)} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    running = df.selectExpr("*", f"coalesce(sum(_count) OVER ({window}), 0) AS _before")
    return running.where("_nth = 0 OR (_before < _nth AND _before + _count >= _nth)")
