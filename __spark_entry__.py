"""

Bindings only; all logic is in ``postlens``. The tables play the three roles like this:

* posts: ``events`` (key ``user_id``, many rows per key), ``orders`` or ``lineitem``
* places: ``customer`` with its nation, or ``orders``
* users: ``orders`` (key ``o_custkey``, several rows per key)
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions.records import decode_payload, iso_text, routed, topic_envelope
from postlens.functions.text import joined_text, lenient_int, placeholder_to_null, swap_token, without_text
from postlens.functions.values import band, coordinates, in_years, lenient_timestamp, year_of
from postlens.operators.cleaning import clean_places, clean_posts, clean_users, with_column_if_absent
from postlens.operators.joins import argmax_rows, join_places, join_users
from postlens.operators.rollups import approx_median_by, counts_by, exact_median_by, top_many_per_group, top_n_per_group
from postlens.operators.sampling import OrderIndex, build_index, row_at_offset, rows_at_offsets
from postlens.operators.sketches import medians_of, merged_by, within_bound
from postlens.plans import insights, sketched, tallies
from postlens.session import fresh_path
from postlens.sinks.publish import append_to_topic, publish, stream_records, topic_records
from postlens.sources.tables import read_table_at
from postlens.sources.topics import read_topic, read_topic_from
from postlens.sources.variants import ingest_records, typed_records
from postlens.streaming.ingest import open_stream, start_ingest

YEARS = (1996, 2000)
Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table_at(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---- tables in their roles -------------------------------------------------------------------------------------------


def event_posts(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(
        *more,
        F.col("user_id").alias("ind"),
        F.col("event_type").alias("category"),
        (F.col("value") * 100).cast("int").alias("follower_count"),
        F.concat(F.lit("poster "), F.col("event_id")).alias("poster_name"),
    )


def customer_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    located = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return located.select(F.col("c_custkey").alias("ind"), F.col("n_name").alias("country"))


def order_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("ind"),
        F.floor(F.col("o_totalprice") / 6000).alias("age"),
        F.col("o_orderdate").alias("date_joined"),
    )


def social(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return event_posts(spark, sf_dir), customer_places(spark, sf_dir), order_users(spark, sf_dir)


SOCIAL_SQL = """
WITH posts AS (
    SELECT user_id AS ind, event_type AS category, CAST(trunc(value * 100) AS INTEGER) AS follower_count,
           'poster ' || event_id AS poster_name
    FROM events),
places AS (
    SELECT c_custkey AS ind, n_name AS country FROM customer JOIN nation ON c_nationkey = n_nationkey),
users AS (
    SELECT o_custkey AS ind, CAST(floor(o_totalprice / 6000) AS BIGINT) AS age, o_orderdate AS date_joined
    FROM orders),
joined AS (
    SELECT u.ind, age, date_joined, category, follower_count, poster_name, country,
           CASE WHEN age BETWEEN 18 AND 24 THEN '18-24' WHEN age BETWEEN 25 AND 35 THEN '25-35'
                WHEN age BETWEEN 36 AND 50 THEN '36-50' WHEN age > 50 THEN '+50' END AS age_group,
           CAST(year(date_joined) AS INTEGER) AS post_year
    FROM users u JOIN posts p ON u.ind = p.ind JOIN places g ON u.ind = g.ind)
"""

USER_BAND_SQL = """CASE WHEN user_id BETWEEN 18 AND 24 THEN '18-24' WHEN user_id BETWEEN 25 AND 35 THEN '25-35'
    WHEN user_id BETWEEN 36 AND 50 THEN '36-50' WHEN user_id > 50 THEN '+50' END"""


# ---- raw records made of the tables, dirty in every way the cleaning handles -----------------------------------------


def dirty_posts(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k")
    return events.select(
        F.col("event_type").alias("category"),
        F.when(kind == "error", "No description available").otherwise(F.col("props")).alias("description"),
        F.lit("1").alias("downloaded"),
        F.when(kind == "view", "k")
        .when(kind == "click", F.concat(k, F.lit("k")))
        .when(kind == "error", "User Info Error")
        .otherwise(k)
        .alias("follower_count"),
        F.when(kind == "signup", "Image src error.").otherwise("x").alias("image_src"),
        F.col("event_id").cast("string").alias("index"),
        F.lit("image").alias("is_image_or_video"),
        F.when(kind == "error", "User Info Error").otherwise(F.concat(F.lit("p"), "user_id")).alias("poster_name"),
        F.concat(F.lit("Local save in /data/"), kind).alias("save_location"),
        F.when(kind == "view", "N,o, ,T,a,g,s, ,A,v,a,i,l,a,b,l,e").otherwise("a,b").alias("tag_list"),
        F.when(kind == "click", "No Title Data Available").otherwise(kind).alias("title"),
        F.concat(F.lit("u"), "event_id").alias("unique_id"),
    )


def dirty_posts_sql(followers: str, ind: str = "CAST(event_id AS VARCHAR)") -> str:
    return f"""
    SELECT {ind} AS ind, 'u' || event_id AS unique_id,
        CASE WHEN event_type <> 'click' THEN event_type END AS title,
        CASE WHEN event_type <> 'error' THEN props END AS description,
        {followers} AS follower_count,
        CASE WHEN event_type <> 'error' THEN 'p' || user_id END AS poster_name,
        CASE WHEN event_type <> 'view' THEN 'a,b' END AS tag_list,
        'image' AS is_image_or_video,
        CASE WHEN event_type <> 'signup' THEN 'x' END AS image_src,
        '/data/' || event_type AS save_location, event_type AS category
    FROM events"""


K_SQL = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
PLAIN_FOLLOWERS_SQL = f"CASE WHEN event_type IN ('purchase', 'signup') THEN {K_SQL} END"
EXACT_FOLLOWERS_SQL = f"CASE event_type WHEN 'view' THEN 0 WHEN 'purchase' THEN {K_SQL} WHEN 'signup' THEN {K_SQL} END"
SUFFIX_FOLLOWERS_SQL = (
    f"CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN {K_SQL} * 1000 "
    f"WHEN 'purchase' THEN {K_SQL} WHEN 'signup' THEN {K_SQL} END"
)


def dirty_places(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_type").alias("country"),
        F.col("event_id").cast("string").alias("ind"),
        F.col("user_id").cast("string").alias("latitude"),
        (-F.col("user_id")).cast("string").alias("longitude"),
        F.when(F.col("event_type") == "error", "junk").otherwise(iso_text(F.col("ts"))).alias("timestamp"),
    )


PLACES_SQL = """
    SELECT event_id AS ind, event_type AS country, CAST(user_id AS DOUBLE) AS latitude,
        CAST(-user_id AS DOUBLE) AS longitude, CASE WHEN event_type <> 'error' THEN ts END AS "timestamp"
    FROM events"""


def flat_places(cleaned: DataFrame) -> DataFrame:
    """Coordinates as two columns and the time without zone, to compare with SQL."""
    return cleaned.select(
        "ind",
        "country",
        F.get("coordinates", 0).alias("latitude"),
        F.get("coordinates", 1).alias("longitude"),
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
    )


def dirty_users(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.floor(F.col("o_totalprice") / 6000).cast("string").alias("age"),
        iso_text(F.col("o_orderdate")).alias("date_joined"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("first_name"),
        F.col("o_orderkey").cast("string").alias("ind"),
        F.col("o_orderpriority").alias("last_name"),
    )


USERS_SQL = """
    SELECT o_orderkey AS ind, concat_ws(' ', CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END, o_orderpriority)
        AS user_name, CAST(floor(o_totalprice / 6000) AS BIGINT) AS age, o_orderdate AS date_joined
    FROM orders"""


def flat_users(cleaned: DataFrame) -> DataFrame:
    return cleaned.withColumn("date_joined", F.col("date_joined").cast("timestamp_ntz"))


# ---- streams ---------------------------------------------------------------------------------------------------------


def live_records(spark: SparkSession, sf_dir: str, name: str, raw: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A table's files as a live stream of raw records, each a binary JSON payload in ``data``."""
    rows = open_stream(
        spark,
        "parquet",
        {"maxFilesPerTrigger": "10000"},
        path=f"{sf_dir}/{name}*.parquet",
        schema=table(spark, sf_dir, name).schema,
    )
    return raw(rows).select(F.to_json(F.struct("*")).cast("binary").alias("data"))


def appended(spark: SparkSession, entity: str, records: DataFrame) -> tuple[str, str]:
    """Run one entity's stream to its end; name and path of the table it wrote."""
    path = fresh_path(spark, entity)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    started = start_ingest(
        {entity: records},
        {entity: name},
        fresh_path(spark, "progress"),
        paths={entity: path},
        trigger={"availableNow": True},
        typed=True,
    )
    started[entity].awaitTermination()
    return name, path


def stream_clean_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts."""
    name, _ = appended(spark, "posts", live_records(spark, sf_dir, "events", dirty_posts))
    return spark.table(name)


def stream_clean_append_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places."""
    name, _ = appended(spark, "places", live_records(spark, sf_dir, "events", dirty_places))
    return flat_places(spark.table(name))


def stream_clean_append_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users."""
    name, _ = appended(spark, "users", live_records(spark, sf_dir, "orders", dirty_users))
    return flat_users(spark.table(name))


def table_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table a stream wrote, read by its path."""
    _, path = appended(spark, "posts", live_records(spark, sf_dir, "events", dirty_posts))
    return read_table_at(spark, path)


# ---- reports ---------------------------------------------------------------------------------------------------------


def top_category_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as posts."""
    posts = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("ind"), F.col("o_orderpriority").alias("category")
    )
    return insights.top_category_by_country(posts, customer_places(spark, sf_dir))


def repeated_top_category_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4 where the key repeats on both sides: events as posts, orders by status as places."""
    places = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("ind"), F.col("o_orderstatus").alias("country")
    )
    return insights.top_category_by_country(event_posts(spark, sf_dir), places)


def category_counts_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as posts, orders as dated places."""
    posts = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ind"), F.col("l_returnflag").alias("category")
    )
    places = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ind"), F.col("o_orderdate").alias("timestamp")
    )
    return insights.category_counts_by_year(posts, places, YEARS)


def priority_counts_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E8, F2, A1, A4 on one table."""
    orders = in_years(table(spark, sf_dir, "orders"), "o_orderdate", *YEARS)
    dated = orders.withColumn("post_year", year_of("o_orderdate"))
    return counts_by(dated, ["post_year", "o_orderpriority"], "o_orderpriority", "category_count")


def top_poster_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 on one joined frame: customer with the greatest balance per nation."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    located = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("country"), F.col("c_name").alias("poster_name"), F.col("c_acctbal").alias("follower_count")
    )
    return top_n_per_group(located, ["country"], "follower_count", tiebreak=["poster_name"])


def top_three_posters_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 with n=3."""
    posts = event_posts(spark, sf_dir).select("category", "poster_name", "follower_count")
    return top_n_per_group(posts, ["category"], "follower_count", 3, ["poster_name"])


def country_of_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2, J3 on one frame, keeping ties."""
    return argmax_rows(top_poster_by_country(spark, sf_dir), "follower_count").select("country", "follower_count")


def events_by_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(band(F.col("user_id")).alias("age_group"), "event_type", "value")


def top_type_by_age_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E9, A1, W2 on one table."""
    counts = counts_by(events_by_band(spark, sf_dir), ["age_group", "event_type"], "event_type", "category_count")
    return top_n_per_group(counts, ["age_group"], "category_count", tiebreak=["event_type"])


def median_by_age_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E9 and the exact lower median on one table."""
    events = events_by_band(spark, sf_dir)
    return exact_median_by(events, ["age_group"], "value", "median_follower_count", few_groups=True, rescan=True)


def median_by_band_and_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3, A4: sketch median by two keys, at its default accuracy."""
    events = table(spark, sf_dir, "events").withColumn("age_group", band(F.col("user_id")))
    return approx_median_by(events, ["age_group", "user_id"], "value", "median_follower_count")


def median_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 and the exact median of the known prices per year."""
    known = table(spark, sf_dir, "orders").where(F.col("o_totalprice").isNotNull())
    dated = in_years(known, "o_orderdate", *YEARS).withColumn("post_year", year_of("o_orderdate"))
    return exact_median_by(
        dated, ["post_year"], "o_totalprice", "median_follower_count", few_groups=True, rescan=True
    )


def median_by_band_and_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1, J2, E8, E9 and the exact median: line items with their order's year and their part's size band."""
    orders = in_years(table(spark, sf_dir, "orders"), "o_orderdate", *YEARS)
    dated = orders.select(F.col("o_orderkey").alias("l_orderkey"), year_of("o_orderdate").alias("post_year"))
    sized = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), band(F.col("p_size")).alias("age_group")
    )
    rows = table(spark, sf_dir, "lineitem").join(dated, "l_orderkey").join(sized, "l_partkey")
    return exact_median_by(
        rows, ["age_group", "post_year"], "l_extendedprice", "median_follower_count", few_groups=True
    )


def median_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact median with as many groups as parts."""
    return exact_median_by(table(spark, sf_dir, "lineitem"), ["l_partkey"], "l_extendedprice", "median_price")


def sketched_median_by_return_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 from stored sketches of each shipping day, merged; whether the medians lie where the exact ones would."""
    items = table(spark, sf_dir, "lineitem")
    path = fresh_path(spark, "sketches")
    sketched.store_sketches(items, path, "l_shipdate", ["l_returnflag"], "l_extendedprice")
    merged = merged_by(sketched.stored_sketches(spark, path), ["l_returnflag"], "double")
    return within_bound(items, medians_of(merged, ["l_returnflag"], "m", "double"), ["l_returnflag"], "l_extendedprice", "m")


def sketched_report(
    spark: SparkSession, sf_dir: str, report: Callable[..., DataFrame], groups: list[str], users: Callable[..., DataFrame]
) -> DataFrame:
    """A median report of the stored daily sketches of posts, and whether its medians lie in their place."""
    _, places, everyone = social(spark, sf_dir)
    posts = event_posts(spark, sf_dir, "ts")
    path = fresh_path(spark, "sketches")
    sketched.store_sketches(posts, path, "ts", ["ind"], "follower_count")
    found = report(sketched.stored_sketches(spark, path), places, everyone)
    rows = insights.weighted_followers(posts, places, users(everyone), groups)
    return within_bound(rows, found, groups, "follower_count", "median_follower_count", "_weight")


def sketched_median_followers_by_age_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8 from sketches."""
    return sketched_report(spark, sf_dir, sketched.median_followers_by_age_band, ["age_group"], insights.banded)


def sketched_median_followers_by_join_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q10 from sketches."""
    report = partial(sketched.median_followers_by_join_year, years=YEARS)
    return sketched_report(spark, sf_dir, report, ["post_year"], partial(insights.by_join_year, years=YEARS))


def sketched_median_followers_by_band_and_join_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q11 from sketches."""
    report = partial(sketched.median_followers_by_band_and_join_year, years=YEARS)
    users = lambda everyone: insights.banded(insights.by_join_year(everyone, YEARS))
    return sketched_report(spark, sf_dir, report, ["age_group", "post_year"], users)


def top_items_by_return_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 for an n of thousands."""
    items = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")
    return top_many_per_group(items, ["l_returnflag"], "l_extendedprice", 5_000, ["l_orderkey", "l_linenumber"], few_groups=True)


def joined_per_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9, E8, F2, A1."""
    return insights.users_joined_by_year(order_users(spark, sf_dir), YEARS)


def joined_posts_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 as a frame."""
    posts = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("ind"), F.col("o_orderkey").alias("unique_id"), F.col("o_orderpriority").alias("category")
    )
    return join_places(posts, customer_places(spark, sf_dir))


def joined_users_posts_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 as a frame, duplicates multiplied."""
    posts, places, users = social(spark, sf_dir)
    return join_users(users.select("ind", "age"), join_places(posts.select("ind", "category", "poster_name"), places))


# ---- single operators ------------------------------------------------------------------------------------------------


def sentinel_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1."""
    known = placeholder_to_null(F.col("o_orderpriority"), ["4-NOT SPECIFIED"])
    return table(spark, sf_dir, "orders").select("o_orderkey", known.alias("o_orderpriority"))


def exact_token_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2."""
    swapped = swap_token(F.col("event_type"), "view", "000")
    return table(spark, sf_dir, "events").select("event_id", swapped.alias("event_type"))


def strip_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4."""
    return table(spark, sf_dir, "customer").select("c_custkey", without_text(F.col("c_name"), "Customer#").alias("c_name"))


def lenient_int_of_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7, E3, E10, E11, P7, P9."""
    payloads = table(spark, sf_dir, "events").selectExpr("CAST(props AS BINARY) AS data")
    decoded = decode_payload(payloads, "k string")
    return decoded.groupBy(lenient_int(F.col("k")).alias("k")).agg(F.count("*").alias("times"))


def lenient_int_of_mixed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 where the text is a number with blanks, a fraction, out of range, a thousands mark, negative or none at all."""
    kind, number = F.col("event_id") % 6, F.col("user_id").cast("string")
    text = (
        F.when(kind == 0, F.concat(F.lit(" "), number, F.lit(" ")))
        .when(kind == 1, F.concat(number, F.lit(".7")))
        .when(kind == 2, F.concat(F.lit("30000000"), number))
        .when(kind == 3, F.concat(number, F.lit("k")))
        .when(kind == 4, F.concat(F.lit("-"), number))
        .otherwise("n/a")
    )
    payloads = table(spark, sf_dir, "events").select("event_id", F.to_json(F.struct("event_id", text.alias("k"))).alias("data"))
    return decode_payload(payloads, "event_id bigint, k string").select("event_id", lenient_int(F.col("k")).alias("k"))


def pair_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5."""
    pair = coordinates(F.col("c_acctbal"), F.col("c_nationkey").cast("double"))
    paired = table(spark, sf_dir, "customer").select("c_custkey", pair.alias("pair"))
    return paired.select("c_custkey", F.get("pair", 0).alias("first"), F.get("pair", 1).alias("second"))


def parse_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 on ISO text."""
    parsed = lenient_timestamp(iso_text(F.col("ts"))).cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select("event_id", parsed.alias("ts"))


def join_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E7, with a part missing in some rows."""
    orders = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus"))
    return orders.select("o_orderkey", joined_text(status, F.col("o_orderpriority")).alias("user_name"))


def reorder_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1, P2, P3, P5, P8."""
    customer = table(spark, sf_dir, "customer").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    renamed = customer.withColumnRenamed("c_custkey", "ind").drop("c_nationkey", "c_mktsegment")
    return renamed.select("c_name", "ind", F.col("c_acctbal").alias("balance"))


def columns_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: a column that orders have stays as it is, one that they lack is added."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    kept = with_column_if_absent(orders, "o_custkey", F.lit(0).cast("long"))
    return with_column_if_absent(kept, "is_large", F.col("o_totalprice") > 100_000)


def row_at_one_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4, O2."""
    return row_at_offset(table(spark, sf_dir, "orders"), "o_orderkey", 7)


def row_at_large_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 beyond the offsets a per-task top-n is used for."""
    return row_at_offset(table(spark, sf_dir, "lineitem").select("l_orderkey"), "l_orderkey", 1_200)


def drawn_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One draw per order, offsets repeating and partly past the last customer."""
    draws = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") + 100).alias("offset"))
    return rows_at_offsets(draws, table(spark, sf_dir, "customer").drop("c_mktsegment"), "c_custkey")


def indexed(spark: SparkSession, sf_dir: str) -> OrderIndex:
    """Line items in order of a key with three values: each holds a quarter of the rows at least."""
    items = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")
    return build_index(items, "l_returnflag", fresh_path(spark, "index"), run_rows=5_000)


def row_at_indexed_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4, O2 on a stored index, within the rows of a hot key."""
    return indexed(spark, sf_dir).at(4_321)


def rows_at_indexed_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 on a stored index: a draw per order, repeating and partly past the end."""
    draws = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") * 47).alias("offset"))
    return indexed(spark, sf_dir).at_offsets(draws)


def record_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2, K4, E12."""
    events = table(spark, sf_dir, "events").withColumn(
        "event_type", F.when(F.col("event_type") != "view", F.col("event_type"))
    )
    return topic_records(events, "posts", ["event_id", "ts", "event_type", "value"])


def stream_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3, K4."""
    orders = table(spark, sf_dir, "orders")
    return stream_records(orders, "streaming-orders", F.col("o_custkey"), ["o_orderkey", "o_orderdate", "o_totalprice"])


def topic_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5."""
    topic = routed(F.col("event_type"), {"view": "topic.posts", "click": "topic.places", "signup": "topic.users"})
    return table(spark, sf_dir, "events").select("event_id", topic.alias("topic"))


def json_topic_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as a topic of two partitions, the first read back."""
    root = fresh_path(spark, "topic")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    part = F.when(F.col("event_type") == "error", 1).otherwise(0)
    events.withColumn("partition", part).write.partitionBy("partition").json(root)
    return read_topic(spark, root, events.schema, partitions=[0])


def envelope_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows published as envelopes, the files read back and unpacked."""
    root = fresh_path(spark, "published")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    publish(topic_records(orders, "orders"), path=root)
    records = read_topic(
        spark,
        root,
        "records array<struct<value struct<o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate string>>>",
        partitions=None,
        pattern="*.txt",
    )
    values = records.select(F.inline("records")).select("value.*")
    return values.withColumn("o_orderdate", lenient_timestamp(F.col("o_orderdate")).cast("timestamp_ntz"))


def order_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as topic records, with the key they are dealt by."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    value = topic_envelope(F.struct("o_orderkey", "o_custkey", "o_totalprice"))
    return orders.select("o_custkey", "o_orderkey", value.alias("value"))


ORDER_ENVELOPE = "records array<struct<value struct<o_orderkey bigint, o_custkey bigint, o_totalprice double>>>"


def published_topic_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records dealt to a topic's partitions by key, in two appends; the topic read as any other."""
    root, records = fresh_path(spark, "topic"), order_envelopes(spark, sf_dir)
    append_to_topic(records.where("o_orderkey % 2 = 0"), root, "o_custkey")
    append_to_topic(records.where("o_orderkey % 2 = 1"), root, "o_custkey")
    return read_topic(spark, root, ORDER_ENVELOPE).select(F.inline("records")).select("value.*")


def resumed_topic_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What came since the offsets of an earlier read."""
    root, records = fresh_path(spark, "topic"), order_envelopes(spark, sf_dir)
    append_to_topic(records.where("o_orderkey % 3 = 0"), root, "o_custkey")
    _, offsets = read_topic_from(spark, root, ORDER_ENVELOPE)
    append_to_topic(records.where("o_orderkey % 3 > 0"), root, "o_custkey")
    return read_topic_from(spark, root, ORDER_ENVELOPE, offsets)[0].select(F.inline("records")).select("value.*")


def untyped_topic_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 without a schema, each record parsed once."""
    root = fresh_path(spark, "topic")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    events.write.json(root)
    return typed_records(ingest_records(spark, root, fresh_path(spark, "records")))


# ---- reports kept up to date -----------------------------------------------------------------------------------------


def tallied(spark: SparkSession, sf_dir: str) -> str:
    """The state after two halves of posts, places and users, the second added to the tallies of the first."""
    orders = table(spark, sf_dir, "orders")
    places = orders.select(
        "o_orderkey", F.col("o_custkey").alias("ind"), F.col("o_orderstatus").alias("country"), F.col("o_orderdate").alias("timestamp")
    )
    users = order_users(spark, sf_dir).withColumn("o_orderkey", F.hash("date_joined", "age"))
    posts, before = event_posts(spark, sf_dir, "event_id"), None
    for half in range(2):
        after = fresh_path(spark, "tallies")
        new = [df.where(F.pmod(F.col(key), F.lit(2)) == half) for df, key in ((posts, "event_id"), (places, "o_orderkey"), (users, "o_orderkey"))]
        tallies.advance(spark, before, after, *new, post_years=YEARS, join_years=YEARS)
        before = after
    return before


def tallied_top_category_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4 from tallies."""
    return tallies.top_category_by_country(spark, tallied(spark, sf_dir))


def tallied_category_counts_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5 from tallies."""
    return tallies.category_counts_by_year(spark, tallied(spark, sf_dir))


def tallied_top_category_by_age_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7 from tallies."""
    return tallies.top_category_by_age_band(spark, tallied(spark, sf_dir))


def tallied_joined_per_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9 from tallies."""
    return tallies.users_joined_by_year(spark, tallied(spark, sf_dir))


# ---- the contract ----------------------------------------------------------------------------------------------------

YEAR_RANGE = f"BETWEEN {YEARS[0]} AND {YEARS[1]}"

# name -> (query, SQL). Column names agree.
BINDINGS: dict[str, tuple[Query, str]] = {
    "top_category_by_country": (
        top_category_by_country,
        """SELECT country, category, category_count FROM (
            SELECT n_name AS country, o_orderpriority AS category, count(*) AS category_count
            FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
        QUALIFY row_number() OVER (PARTITION BY country ORDER BY category_count DESC, category) = 1""",
    ),
    "repeated_top_category_by_country": (
        repeated_top_category_by_country,
        """SELECT country, category, category_count FROM (
            SELECT o_orderstatus AS country, event_type AS category, count(*) AS category_count
            FROM events JOIN orders ON user_id = o_custkey GROUP BY 1, 2)
        QUALIFY row_number() OVER (PARTITION BY country ORDER BY category_count DESC, category) = 1""",
    ),
    "category_counts_by_year": (
        category_counts_by_year,
        f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS post_year, l_returnflag AS category,
            count(l_returnflag) AS category_count
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE year(o_orderdate) {YEAR_RANGE} GROUP BY 1, 2""",
    ),
    "priority_counts_by_year": (
        priority_counts_by_year,
        f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS post_year, o_orderpriority,
            count(o_orderpriority) AS category_count
        FROM orders WHERE year(o_orderdate) {YEAR_RANGE} GROUP BY 1, 2""",
    ),
    "top_poster_by_country": (
        top_poster_by_country,
        """SELECT n_name AS country, c_name AS poster_name, c_acctbal AS follower_count
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        QUALIFY row_number() OVER (PARTITION BY n_name ORDER BY c_acctbal DESC, c_name) = 1""",
    ),
    "top_three_posters_by_category": (
        top_three_posters_by_category,
        """SELECT event_type AS category, 'poster ' || event_id AS poster_name,
            CAST(trunc(value * 100) AS INTEGER) AS follower_count
        FROM events
        QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY follower_count DESC, poster_name) <= 3""",
    ),
    "country_of_max": (
        country_of_max,
        """SELECT DISTINCT n_name AS country, c_acctbal AS follower_count
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        WHERE c_acctbal = (SELECT max(c_acctbal) FROM customer)""",
    ),
    "most_followed_by_country": (
        lambda spark, sf_dir: insights.most_followed_by_country(*social(spark, sf_dir)),
        SOCIAL_SQL
        + """SELECT country, poster_name, follower_count FROM joined
        QUALIFY row_number() OVER (PARTITION BY country ORDER BY follower_count DESC, poster_name) = 1""",
    ),
    "most_followed_country": (
        lambda spark, sf_dir: insights.most_followed_country(*social(spark, sf_dir)),
        SOCIAL_SQL
        + """SELECT DISTINCT country, follower_count FROM joined
        WHERE follower_count = (SELECT max(follower_count) FROM joined)""",
    ),
    "top_category_by_age_band": (
        lambda spark, sf_dir: insights.top_category_by_age_band(*social(spark, sf_dir)),
        SOCIAL_SQL
        + """SELECT age_group, category, count(category) AS category_count FROM joined GROUP BY 1, 2
        QUALIFY row_number() OVER (PARTITION BY age_group ORDER BY category_count DESC, category) = 1""",
    ),
    "top_type_by_age_band": (
        top_type_by_age_band,
        f"""SELECT {USER_BAND_SQL} AS age_group, event_type, count(*) AS category_count FROM events GROUP BY 1, 2
        QUALIFY row_number() OVER (PARTITION BY age_group ORDER BY category_count DESC, event_type) = 1""",
    ),
    "median_followers_by_age_band": (
        lambda spark, sf_dir: insights.median_followers_by_age_band(*social(spark, sf_dir)),
        SOCIAL_SQL
        + """SELECT age_group, quantile_disc(follower_count, 0.5) AS median_follower_count FROM joined GROUP BY 1""",
    ),
    "median_followers_by_age_band_and_count": (
        lambda spark, sf_dir: insights.median_followers_by_age_band_and_count(*social(spark, sf_dir)),
        SOCIAL_SQL
        + """SELECT age_group, follower_count, quantile_disc(follower_count, 0.5) AS median_follower_count
        FROM joined GROUP BY 1, 2""",
    ),
    "median_by_age_band": (
        median_by_age_band,
        f"""SELECT {USER_BAND_SQL} AS age_group, quantile_disc(value, 0.5) AS median_follower_count
        FROM events GROUP BY 1""",
    ),
    "median_by_band_and_key": (
        median_by_band_and_key,
        f"""SELECT {USER_BAND_SQL} AS age_group, user_id, quantile_disc(value, 0.5) AS median_follower_count
        FROM events GROUP BY 1, 2""",
    ),
    "joined_per_year": (
        joined_per_year,
        f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS post_year, count(o_custkey) AS number_users_joined
        FROM orders WHERE year(o_orderdate) {YEAR_RANGE} GROUP BY 1""",
    ),
    "median_by_year": (
        median_by_year,
        f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS post_year,
            quantile_disc(o_totalprice, 0.5) AS median_follower_count
        FROM orders WHERE year(o_orderdate) {YEAR_RANGE} GROUP BY 1""",
    ),
    "median_followers_by_join_year": (
        lambda spark, sf_dir: insights.median_followers_by_join_year(*social(spark, sf_dir), years=YEARS),
        SOCIAL_SQL
        + f"""SELECT post_year, quantile_disc(follower_count, 0.5) AS median_follower_count FROM joined
        WHERE post_year {YEAR_RANGE} AND follower_count IS NOT NULL GROUP BY 1""",
    ),
    "median_by_band_and_year": (
        median_by_band_and_year,
        f"""SELECT CASE WHEN p_size BETWEEN 18 AND 24 THEN '18-24' WHEN p_size BETWEEN 25 AND 35 THEN '25-35'
                WHEN p_size BETWEEN 36 AND 50 THEN '36-50' WHEN p_size > 50 THEN '+50' END AS age_group,
            CAST(year(o_orderdate) AS INTEGER) AS post_year, quantile_disc(l_extendedprice, 0.5) AS median_follower_count
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        WHERE year(o_orderdate) {YEAR_RANGE} GROUP BY 1, 2""",
    ),
    "median_followers_by_band_and_join_year": (
        lambda spark, sf_dir: insights.median_followers_by_band_and_join_year(*social(spark, sf_dir), years=YEARS),
        SOCIAL_SQL
        + f"""SELECT age_group, post_year, quantile_disc(follower_count, 0.5) AS median_follower_count FROM joined
        WHERE post_year {YEAR_RANGE} GROUP BY 1, 2""",
    ),
    "median_by_part": (
        median_by_part,
        "SELECT l_partkey, quantile_disc(l_extendedprice, 0.5) AS median_price FROM lineitem GROUP BY 1",
    ),
    "joined_posts_places": (
        joined_posts_places,
        """SELECT o_custkey AS ind, o_orderkey AS unique_id, o_orderpriority AS category, n_name AS country
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "joined_users_posts_places": (
        joined_users_posts_places,
        SOCIAL_SQL + "SELECT ind, age, category, poster_name, country FROM joined",
    ),
    "clean_posts_exact": (
        lambda spark, sf_dir: clean_posts(dirty_posts(table(spark, sf_dir, "events"))),
        dirty_posts_sql(EXACT_FOLLOWERS_SQL),
    ),
    "clean_posts_suffix": (
        lambda spark, sf_dir: clean_posts(dirty_posts(table(spark, sf_dir, "events")), "suffix", typed=True),
        dirty_posts_sql(SUFFIX_FOLLOWERS_SQL, "event_id"),
    ),
    "clean_places": (
        lambda spark, sf_dir: flat_places(clean_places(dirty_places(table(spark, sf_dir, "events")), typed=True)),
        PLACES_SQL,
    ),
    "clean_users": (
        lambda spark, sf_dir: flat_users(clean_users(dirty_users(table(spark, sf_dir, "orders")), typed=True)),
        USERS_SQL,
    ),
    "sentinel_to_null": (
        sentinel_to_null,
        "SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority FROM orders",
    ),
    "exact_token_replace": (
        exact_token_replace,
        "SELECT event_id, CASE WHEN event_type = 'view' THEN '000' ELSE event_type END AS event_type FROM events",
    ),
    "strip_prefix": (
        strip_prefix,
        "SELECT c_custkey, regexp_replace(c_name, 'Customer#', '', 'g') AS c_name FROM customer",
    ),
    "lenient_int": (
        lenient_int_of_payload,
        """SELECT TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS times
        FROM events GROUP BY 1""",
    ),
    "lenient_int_of_mixed_text": (
        lenient_int_of_mixed_text,
        """SELECT event_id, CAST(CASE event_id % 6 WHEN 0 THEN user_id WHEN 1 THEN user_id WHEN 4 THEN -user_id
            WHEN 2 THEN CASE WHEN CAST('30000000' || user_id AS BIGINT) < 2147483648
                THEN CAST('30000000' || user_id AS BIGINT) END END AS INTEGER) AS k
        FROM events""",
    ),
    "pair_array": (
        pair_array,
        "SELECT c_custkey, c_acctbal AS first, CAST(c_nationkey AS DOUBLE) AS second FROM customer",
    ),
    "parse_timestamp": (parse_timestamp, "SELECT event_id, ts FROM events"),
    "join_names": (
        join_names,
        """SELECT o_orderkey, concat_ws(' ', CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END, o_orderpriority)
            AS user_name FROM orders""",
    ),
    "columns_if_absent": (
        columns_if_absent,
        "SELECT o_orderkey, o_custkey, o_totalprice, o_totalprice > 100000 AS is_large FROM orders",
    ),
    "reorder_columns": (
        reorder_columns,
        "SELECT c_name, c_custkey AS ind, c_acctbal + 1 AS balance FROM customer",
    ),
    "sketched_median_by_return_flag": (
        sketched_median_by_return_flag,
        "SELECT l_returnflag, count(l_extendedprice) AS n_values, true AS within_bound FROM lineitem GROUP BY 1",
    ),
    "sketched_median_followers_by_age_band": (
        sketched_median_followers_by_age_band,
        SOCIAL_SQL + "SELECT age_group, count(follower_count) AS n_values, true AS within_bound FROM joined GROUP BY 1",
    ),
    "sketched_median_followers_by_join_year": (
        sketched_median_followers_by_join_year,
        SOCIAL_SQL
        + f"""SELECT post_year, count(follower_count) AS n_values, true AS within_bound FROM joined
        WHERE post_year {YEAR_RANGE} GROUP BY 1""",
    ),
    "sketched_median_followers_by_band_and_join_year": (
        sketched_median_followers_by_band_and_join_year,
        SOCIAL_SQL
        + f"""SELECT age_group, post_year, count(follower_count) AS n_values, true AS within_bound FROM joined
        WHERE post_year {YEAR_RANGE} GROUP BY 1, 2""",
    ),
    "top_items_by_return_flag": (
        top_items_by_return_flag,
        """SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) <= 5000""",
    ),
    "row_at_indexed_offset": (
        row_at_indexed_offset,
        """SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
        ORDER BY l_returnflag, l_orderkey, l_linenumber, l_extendedprice LIMIT 1 OFFSET 4321""",
    ),
    "rows_at_indexed_offsets": (
        rows_at_indexed_offsets,
        """WITH placed AS (
            SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice,
                row_number() OVER (ORDER BY l_returnflag, l_orderkey, l_linenumber, l_extendedprice) - 1 AS place
            FROM lineitem)
        SELECT o_orderkey, o_custkey * 47 AS "offset", l_returnflag, l_orderkey, l_linenumber, l_extendedprice
        FROM orders LEFT JOIN placed ON place = o_custkey * 47""",
    ),
    "row_at_offset": (row_at_one_offset, "SELECT * FROM orders ORDER BY o_orderkey LIMIT 1 OFFSET 7"),
    "row_at_large_offset": (
        row_at_large_offset,
        "SELECT l_orderkey FROM lineitem ORDER BY l_orderkey LIMIT 1 OFFSET 1200",
    ),
    "rows_at_offsets": (
        drawn_rows,
        """SELECT o_orderkey, o_custkey + 100 AS "offset", c_custkey, c_name, c_nationkey, c_acctbal
        FROM orders LEFT JOIN (SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS place FROM customer)
            ON place = o_custkey + 100""",
    ),
    "record_envelope": (
        record_envelope,
        """SELECT 'posts' AS topic, '{"records":[{"value":{"event_id":' || event_id || ',"ts":"'
            || strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN date_part('microsecond', ts) % 1000000 = 0 THEN ''
                ELSE strftime(ts, '.%f') END
            || '","event_type":' || CASE WHEN event_type = 'view' THEN 'null' ELSE '"' || event_type || '"' END
            || ',"value":' || CAST(value AS VARCHAR) || '}}]}' AS value
        FROM events""",
    ),
    "stream_record": (
        stream_record,
        """SELECT 'streaming-orders' AS stream, CAST(o_custkey AS VARCHAR) AS key,
            '{"StreamName":"streaming-orders","Data":{"o_orderkey":' || o_orderkey || ',"o_orderdate":"'
            || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '","o_totalprice":' || CAST(o_totalprice AS VARCHAR)
            || '},"PartitionKey":"' || o_custkey || '"}' AS value
        FROM orders""",
    ),
    "topic_routing": (
        topic_routing,
        """SELECT event_id, topic FROM events LEFT JOIN
            (VALUES ('view', 'topic.posts'), ('click', 'topic.places'), ('signup', 'topic.users')) AS r(name, topic)
            ON event_type = name""",
    ),
    "json_topic_scan": (
        json_topic_scan,
        "SELECT event_id, user_id, event_type, value FROM events WHERE event_type <> 'error'",
    ),
    "published_topic_scan": (published_topic_scan, "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"),
    "resumed_topic_scan": (
        resumed_topic_scan,
        "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 3 > 0",
    ),
    "untyped_topic_scan": (untyped_topic_scan, "SELECT event_id, user_id, event_type, value FROM events"),
    "tallied_top_category_by_country": (
        tallied_top_category_by_country,
        """SELECT country, category, category_count FROM (
            SELECT o_orderstatus AS country, event_type AS category, count(*) AS category_count
            FROM events JOIN orders ON user_id = o_custkey GROUP BY 1, 2)
        QUALIFY row_number() OVER (PARTITION BY country ORDER BY category_count DESC, category) = 1""",
    ),
    "tallied_category_counts_by_year": (
        tallied_category_counts_by_year,
        f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS post_year, event_type AS category, count(event_type) AS category_count
        FROM events JOIN orders ON user_id = o_custkey WHERE year(o_orderdate) {YEAR_RANGE} GROUP BY 1, 2""",
    ),
    "tallied_top_category_by_age_band": (
        tallied_top_category_by_age_band,
        """WITH users AS (SELECT o_custkey AS ind, CAST(floor(o_totalprice / 6000) AS BIGINT) AS age FROM orders),
        counted AS (
            SELECT CASE WHEN age BETWEEN 18 AND 24 THEN '18-24' WHEN age BETWEEN 25 AND 35 THEN '25-35'
                    WHEN age BETWEEN 36 AND 50 THEN '36-50' WHEN age > 50 THEN '+50' END AS age_group,
                event_type AS category, count(*) AS category_count
            FROM users JOIN events ON ind = user_id JOIN orders ON ind = o_custkey GROUP BY 1, 2)
        SELECT age_group, category, category_count FROM counted
        QUALIFY row_number() OVER (PARTITION BY age_group ORDER BY category_count DESC, category) = 1""",
    ),
    "tallied_joined_per_year": (
        tallied_joined_per_year,
        f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS post_year, count(o_custkey) AS number_users_joined
        FROM orders WHERE year(o_orderdate) {YEAR_RANGE} GROUP BY 1""",
    ),
    "envelope_round_trip": (envelope_round_trip, "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders"),
    "stream_clean_append": (stream_clean_append, dirty_posts_sql(PLAIN_FOLLOWERS_SQL, "event_id")),
    "stream_clean_append_places": (stream_clean_append_places, PLACES_SQL),
    "stream_clean_append_users": (stream_clean_append_users, USERS_SQL),
    "table_read_back": (table_read_back, dirty_posts_sql(PLAIN_FOLLOWERS_SQL, "event_id")),
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship report: most popular category per country."""
    return top_category_by_country(spark, "/root/testdata/sf0.001")


try:  # the operators of postlens.llm and the pipeline over them may have been taken away
    import corpus_pipeline
    from postlens.llm import queries as llm_queries
except ModuleNotFoundError:  # or a package that only they need is not installed here
    LLM_QUERIES: dict[str, Query] = {}
    LLM_SQL: dict[str, str] = {}
else:
    LLM_QUERIES = {"pipeline": corpus_pipeline.run, **llm_queries.QUERIES}
    LLM_SQL = llm_queries.SQL


def queries() -> dict[str, Query]:
    return {name: query for name, (query, _) in BINDINGS.items()} | LLM_QUERIES


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in BINDINGS.items()} | LLM_SQL
