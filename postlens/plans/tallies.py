"""Reports by count (Q4, Q5, Q7, Q9) kept up to date from stored tallies, in place of being counted anew.

A state is a folder of narrow tables: how often each key occurs with each attribute in posts (P), places (G) and users, how
often in users joined to places (W), and the counts of the reports. ``advance`` writes the state after some new records
beside the one before it. With D for what is new, the joined reports change by D(P x G) = DP x (G + DG) + P x DG, so no
join ever takes two whole sides, and the old records are not read again. Records are only ever added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions.values import AGE_BANDS, in_years, year_of
from postlens.operators.joins import tally
from postlens.operators.rollups import counts_by, top_n_per_group
from postlens.plans.insights import JOIN_YEARS, POST_YEARS, banded, by_join_year
from postlens.sources.tables import read_table_at

# Tables of a state: what their rows are told apart by. Each has the count ``n`` besides.
POSTS, COUNTRIES, YEARS, PLACES = ("ind", "category"), ("ind", "country"), ("ind", "post_year"), ("ind",)
BANDS, WEIGHTS = ("ind", "age_group"), ("ind", "age_group")
BY_COUNTRY, BY_YEAR, BY_BAND = ("country", "category"), ("post_year", "category"), ("age_group", "category")
JOINED = ("post_year",)
TABLES = {
    "posts": POSTS, "countries": COUNTRIES, "years": YEARS, "places": PLACES, "bands": BANDS, "weights": WEIGHTS,
    "by_country": BY_COUNTRY, "by_year": BY_YEAR, "by_band": BY_BAND, "joined": JOINED,
}
COUNT = "decimal(38,0)"  # of combinations: three sides' row counts multiplied


def _plus(*parts: DataFrame | None, by: Sequence[str]) -> DataFrame:
    """Counts of several tables added up; NULL is a value like any other."""
    told = [p.select(*by, F.col("n").cast(COUNT).alias("n")) for p in parts if p is not None]
    rows = told[0]
    for more in told[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy(*by).agg(F.sum("n").cast(COUNT).alias("n"))


def _times(left: DataFrame | None, right: DataFrame | None, by: Sequence[str]) -> DataFrame | None:
    """Combinations of two tallies with one key, counted by the attributes of both."""
    if left is None or right is None:
        return None
    a, b = left.withColumnRenamed("n", "_a"), right.withColumnRenamed("n", "_b")
    product = (F.col("_a").cast("decimal(20,0)") * F.col("_b").cast("decimal(18,0)")).cast(COUNT)
    return a.join(b, "ind").groupBy(*by).agg(F.sum(product).cast(COUNT).alias("n"))


def advance(
    spark: SparkSession,
    before: str | None,
    after: str,
    posts: DataFrame,
    places: DataFrame,
    users: DataFrame,
    post_years: tuple[int, int] = POST_YEARS,
    join_years: tuple[int, int] = JOIN_YEARS,
    bands=AGE_BANDS,
) -> None:
    """Write to the folder ``after`` the state of ``before`` (none yet: None) with these new cleaned records added.

    Of posts ``ind`` and ``category`` are used, of places ``ind``, ``country`` and ``timestamp``, of users ``ind``, ``age``
    and ``date_joined``; any of them may be empty. ``before`` is left as it is, so a run that failed is repeated from it.
    """
    old = {name: None if before is None else read_table_at(spark, f"{before}/{name}") for name in TABLES}
    new: dict[str, DataFrame | None] = {}
    state: dict[str, DataFrame] = {}

    def store(name: str, *more: DataFrame | None) -> None:
        _plus(old[name], *more, by=TABLES[name]).write.parquet(f"{after}/{name}")
        state[name] = read_table_at(spark, f"{after}/{name}")

    def delta(name: str, rows: DataFrame) -> None:
        """New counts are used more than once: written down beside the state."""
        rows.select(*TABLES[name], F.col("n").cast(COUNT).alias("n")).write.parquet(f"{after}/_new/{name}")
        new[name] = read_table_at(spark, f"{after}/_new/{name}")
        store(name, new[name])

    dated = in_years(places, "timestamp", *post_years).withColumn("post_year", year_of("timestamp"))
    delta("posts", counts_by(posts, POSTS, "category", "n"))  # a NULL category counts 0
    delta("countries", tally(places, *COUNTRIES, name="n"))
    delta("years", tally(dated, *YEARS, name="n"))
    delta("places", tally(places, *PLACES, name="n"))
    delta("bands", tally(banded(users, bands), *BANDS, name="n"))
    weights = [_times(new["bands"], state["places"], BANDS), _times(old["bands"], new["places"], BANDS)]
    delta("weights", _plus(*weights, by=WEIGHTS))
    for name, side, by in (("by_country", "countries", BY_COUNTRY), ("by_year", "years", BY_YEAR), ("by_band", "weights", BY_BAND)):
        store(name, _times(new["posts"], state[side], by), _times(old["posts"], new[side], by))
    store("joined", counts_by(by_join_year(users, join_years), JOINED, "ind", "n"))


def _counts(spark: SparkSession, state: str, name: str, count: str) -> DataFrame:
    return read_table_at(spark, f"{state}/{name}").select(*TABLES[name], F.col("n").cast("bigint").alias(count))


def top_category_by_country(spark: SparkSession, state: str) -> DataFrame:
    """Q4 of all records so far."""
    counts = _counts(spark, state, "by_country", "category_count")
    return top_n_per_group(counts, ["country"], "category_count", tiebreak=["category"])


def category_counts_by_year(spark: SparkSession, state: str) -> DataFrame:
    """Q5 of all records so far."""
    return _counts(spark, state, "by_year", "category_count")


def top_category_by_age_band(spark: SparkSession, state: str) -> DataFrame:
    """Q7 of all records so far."""
    counts = _counts(spark, state, "by_band", "category_count")
    return top_n_per_group(counts, ["age_group"], "category_count", tiebreak=["category"])


def users_joined_by_year(spark: SparkSession, state: str) -> DataFrame:
    """Q9 of all records so far."""
    return _counts(spark, state, "joined", "number_users_joined")
