"""Joins, rollups and sampling against plain Python on small and skewed data."""

import math
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postlens.operators import joins, rollups, sampling

FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def lower_median(weighted):
    """Of (value, weight) pairs without NULL values; NaN is the greatest."""
    pairs = sorted(weighted, key=lambda p: (math.isnan(p[0]), p[0]))
    need = math.ceil(sum(w for _, w in pairs) / 2)
    for value, weight in pairs:
        need -= weight
        if need <= 0:
            return value
    return None


def medians(rows):
    groups = defaultdict(list)
    for key, value, weight in rows:
        groups[key]
        if value is not None:
            groups[key].append((value, weight))
    return {key: lower_median(pairs) for key, pairs in groups.items()}


def collected(df):
    return {r[0]: r[1] for r in df.collect()}


KEYS = st.one_of(st.none(), st.sampled_from(["a", "b"]))
WEIGHTS = st.integers(1, 5)
KINDS = {
    "int": st.one_of(st.none(), st.integers(-(2**31), 2**31 - 1), st.integers(-3, 3)),
    "bigint": st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1), st.integers(-3, 3)),
    "double": st.one_of(st.none(), st.floats(allow_nan=False), st.floats(-2, 2)),
}


@pytest.mark.parametrize("kind", list(KINDS))
def test_exact_median_is_that_of_sorted_rows(spark, kind):
    @FEW
    @given(st.lists(st.tuples(KEYS, KINDS[kind], WEIGHTS), min_size=1, max_size=40), st.booleans(), st.booleans())
    def check(rows, few_groups, rescan):
        df = spark.createDataFrame(rows, f"k string, v {kind}, w bigint")
        got = collected(rollups.exact_median_by(df, ["k"], "v", "m", "w", few_groups, rescan))
        assert got == medians(rows)
        plain = collected(rollups.exact_median_by(df, ["k"], "v", "m", None, few_groups, not rescan))
        assert plain == medians([(k, v, 1) for k, v, _ in rows])

    check()


@pytest.mark.parametrize("rescan", [False, True])
def test_exact_median_of_special_numbers(spark, rescan):
    inf, nan = float("inf"), float("nan")
    rows = [("a", -inf), ("a", -inf), ("a", 1.0), ("b", nan), ("b", nan), ("b", inf), ("c", -1e308), ("c", 1e308)]
    rows += [("c", 5e-324), ("d", None), ("d", None), ("e", 0.0), ("e", 5e-324)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = collected(rollups.exact_median_by(df, ["k"], "v", "m", rescan=rescan))
    assert math.isnan(got.pop("b"))
    assert got == {"a": -inf, "c": 5e-324, "d": None, "e": 0.0}


@pytest.mark.parametrize("whole", [1, 20, 1_000])
def test_exact_median_of_groups_ranked_whole_and_by_marks(spark, monkeypatch, whole):
    monkeypatch.setattr(rollups, "WHOLE_GROUP", whole)
    rng = random.Random(whole)
    rows = [(k, rng.choice([None, rng.random(), float(rng.randrange(9))]), rng.randrange(1, 4)) for k in range(60) for _ in range(1 + k % 40)]
    rows += [(None, rng.random(), 1) for _ in range(3_000)] + [(-1, float(i % 1_100), 2) for i in range(4_000)] + [(-2, None, 1)] * 3
    df = spark.createDataFrame(rows, "k int, v double, w bigint").repartition(5)
    assert collected(rollups.exact_median_by(df, ["k"], "v", "m")) == medians([(k, v, 1) for k, v, _ in rows])
    assert collected(rollups.exact_median_by(df, ["k"], "v", "m", "w")) == medians(rows)


def test_small_groups_are_ranked_without_marks(spark):
    """No sketch meets their values, and no step sorts values with their group's marks beside them."""
    rows = spark.range(30_000).select((F.col("id") % 1_000).alias("k"), F.rand(3).alias("v"))
    many = rollups.exact_median_by(rows, ["k"], "v", "m")
    many.collect()
    ran = many._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "percentile_approx" not in ran and "_marks" not in ran
    counted = rows.selectExpr("k", "v AS _value", "1L AS _count")
    live = rollups._between_marks(counted, ["k"], False, rollups.VALUE_SHARES, rollups.VALUE_ACCURACY, rollups.VALUE_ROUNDS)
    assert "SortAggregate" not in live._jdf.queryExecution().executedPlan().toString()


def test_exact_median_with_huge_weights(spark):
    heavy = spark.sql("SELECT * FROM VALUES ('a', 1, 4e27BD), ('a', 2, 4e27BD), ('a', 3, 1BD) AS t(k, v, w)")
    df = heavy.withColumn("w", F.col("w").cast("decimal(38,0)"))
    assert collected(rollups.exact_median_by(df, ["k"], "v", "m", "w")) == {"a": 2}


def test_exact_median_of_one_hot_group(spark):
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") * 7919 % 200_003 - 100_000).cast("int").alias("v"),
    )
    got = rollups.exact_median_by(rows, ["k"], "v", "m").where("k = 'hot'").first()["m"]
    values = sorted((i * 7919 % 200_003 - 100_000) for i in range(200_000) if i % 3)
    assert got == values[math.ceil(len(values) / 2) - 1]


def test_approx_median(spark):
    df = spark.createDataFrame([("a", v) for v in (1, 2, 3, 10, None)] + [("b", None)], "k string, v int")
    assert collected(rollups.approx_median_by(df, ["k"], "v", "m")) == {"a": 2, "b": None}


def test_count_of_nothing_known_is_zero(spark):
    df = spark.createDataFrame([("x", None), ("x", None), ("y", "c")], "k string, c string")
    assert {tuple(r) for r in rollups.counts_by(df, ["k", "c"], "c", "n").collect()} == {("x", None, 0), ("y", "c", 1)}


def test_top_n(spark):
    rows = [("a", 1, "z"), ("a", 3, "y"), ("a", 3, "x"), ("a", None, "w"), (None, None, "v"), (None, None, "u")]
    df = spark.createDataFrame(rows, "k string, m int, t string")
    one = {tuple(r) for r in rollups.top_n_per_group(df, ["k"], "m", tiebreak=["t"]).collect()}
    assert one == {("a", 3, "x"), (None, None, "u")}
    three = {tuple(r) for r in rollups.top_n_per_group(df, ["k"], "m", 3, ["t"]).collect()}
    assert three == {("a", 3, "x"), ("a", 3, "y"), ("a", 1, "z"), (None, None, "u"), (None, None, "v")}


def test_argmax_rows(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 4), ("d", None)], "k string, v int")
    assert {r.k for r in joins.argmax_rows(df, "v").collect()} == {"a", "b"}
    assert [r.k for r in joins.argmax_rows(df, "v", "one", ("k",)).collect()] == ["a"]
    assert joins.argmax_rows(df.where("v is null"), "v").count() == 0


def test_repeated_keys_multiply(spark):
    posts = spark.createDataFrame([(1, "p"), (1, "q"), (None, "r")], "ind int, c string")
    places = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "ind int, country string")
    assert joins.join_places(posts, places).count() == 4
    users = spark.createDataFrame([(1, 20), (1, 30), (2, 40)], "ind int, age int")
    assert joins.join_users(users, joins.join_places(posts, places)).count() == 8


def test_number_rows(spark):
    keys = [k * 37 % 1_009 for k in range(1_000)]
    df = spark.createDataFrame([(k,) for k in keys], "k int").repartition(5)
    got = collected(sampling.number_rows(df, "k"))
    assert got == {k: i for i, k in enumerate(sorted(keys))}


@pytest.mark.parametrize("n", [0, 7, 24, 25, 70])
def test_row_at_offset(spark, n):
    df = spark.range(25).select((F.col("id") * 3).alias("k"), F.lit("x").alias("v"))
    wanted = [(n * 3, "x")] if n < 25 else []
    assert sampling.row_at_offset(df, "k", n).collect() == wanted


@pytest.mark.parametrize("n", [999, 1_000, 1_400, 1_499, 1_500, 4_000])
def test_row_at_offset_counts_null_and_repeated_keys(spark, n):
    rows = [(None, i) for i in range(1_500)] + [(i // 2, i) for i in range(2_000)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(7)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert sampling.row_at_offset(df, "k", n).collect() == ordered[n : n + 1]


def test_rows_at_offsets_with_repeated_keys_and_a_shared_name(spark):
    rows = [(None, 1), (None, 2), (3, 1), (3, 2), (3, 2), (9, 0)]
    table = spark.createDataFrame(rows, "ind int, v int")
    draws = spark.createDataFrame([(i, i) for i in range(7)], "ind int, offset int")
    with pytest.raises(ValueError, match="ind"):
        sampling.rows_at_offsets(draws, table, "ind")
    got = sampling.rows_at_offsets(draws, table, "ind", prefix="row_").orderBy("offset").collect()
    assert [(r.row_ind, r.row_v) for r in got] == [*rows, (None, None)]


def test_rows_at_offsets(spark):
    table = spark.range(10).select((F.col("id") * 2).alias("k"), F.concat(F.lit("r"), "id").alias("v"))
    draws = spark.createDataFrame([(0, 3), (1, 3), (2, 9), (3, 10), (4, None)], "draw int, offset int")
    got = sorted(tuple(r) for r in sampling.rows_at_offsets(draws, table, "k").collect())
    assert [g[0] for g in got] == [0, 1, 2, 3, 4]
    assert [g[2:] for g in got] == [(6, "r3"), (6, "r3"), (18, "r9"), (None, None), (None, None)]


def test_aligned_rows_share_their_draws(spark):
    table = spark.range(50).select(F.col("id").alias("k"))
    draws = sampling.draw_offsets(spark, 200, last=60)
    both = sampling.aligned_rows(draws, {"a": (table, "k"), "b": (table.select((F.col("k") + 5).alias("k")), "k")})
    a, b = (collected(both[name].select("draw", "k")) for name in "ab")
    assert len(a) == 200 and set(Counter(a.values())) > {None}
    assert all((a[d] is None) == (b[d] is None) and (a[d] is None or b[d] == a[d] + 5) for d in a)


def test_draws_stay_in_range_and_repeat(spark):
    draws = sampling.draw_offsets(spark, 5_000, sampling.FEED_LAST_OFFSET)
    low, high, kinds = draws.agg(F.min("offset"), F.max("offset"), F.countDistinct("offset")).first()
    assert 0 <= low < 100 and 10_900 < high <= 11_000 and 3_000 < kinds < 5_000
    assert draws.exceptAll(sampling.draw_offsets(spark, 5_000, sampling.FEED_LAST_OFFSET).repartition(3)).isEmpty()


@pytest.mark.parametrize("rescan", [False, True])
def test_what_is_ranked_for_a_median_is_a_small_share(spark, rescan):
    """Dense values at one end and one far off: equal steps of the range would leave all of them in one part."""
    rows = spark.range(400_000).select(
        F.lit("a").alias("k"), (1 + F.col("id") * 1e-12).alias("v"), F.lit(1).alias("_count"), F.col("id")
    ).union(spark.sql("SELECT 'a', 1e300D, 1, 400000L"))
    rows = rows.select("k", F.col("v").alias("_value"), "_count")
    assert 0 < rollups._between_fine_marks(rows, ["k"]).count() <= 0.006 * 400_001
    shares = (rollups.ROW_SHARES, rollups.ROW_ACCURACY, 1) if rescan else (rollups.VALUE_SHARES, rollups.VALUE_ACCURACY, rollups.VALUE_ROUNDS)
    live = rollups._between_marks(rows, ["k"], True, *shares)
    assert 0 < live.count() <= 0.0012 * 400_001
    got = rollups.exact_median_by(rows.withColumnRenamed("_value", "v"), ["k"], "v", "m", few_groups=True, rescan=rescan)
    assert got.first()["m"] == 1 + 200_000 * 1e-12


def plain_top(rows, n):
    """Greatest measure first, NaN above all numbers and None below, then the tie-break."""
    out = []
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        mine.sort(key=lambda r: r[2])
        mine.sort(key=lambda r: (r[1] is not None, r[1] is not None and math.isnan(r[1]), r[1] or 0), reverse=True)
        out += mine[:n]
    return sorted(out, key=repr)


@pytest.mark.parametrize("few_groups", [False, True])
@pytest.mark.parametrize("n", [1, 3, 40, 500])
def test_top_many_is_top_n(spark, n, few_groups):
    nan, inf = float("nan"), float("inf")
    measures = [None, nan, inf, -inf, 0.0, 1.5, *[float(i % 9) for i in range(30)]]
    rows = [(k, measures[(i * 7 + len(k or "")) % len(measures)], f"t{i:03d}") for i in range(200) for k in ("a", "bb", None)]
    rows += [("nulls", None, "x"), ("nulls", None, "w"), ("one", 2.0, "x"), ("few", 2.0, "x"), ("few", None, "b"), ("few", None, "a")]
    df = spark.createDataFrame(rows, "k string, m double, t string")
    got = rollups.top_many_per_group(df, ["k"], "m", n, ["t"], few_groups, parts=3)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, plain_top(rows, n)))


def test_the_index_is_the_table_in_key_order(spark, tmp_path):
    """One key holds a third of the rows and more than a run."""
    rows = [(None, i) for i in range(30)] + [(7, i // 2) for i in range(100)] + [(i, 0) for i in range(170)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(5)
    index = sampling.build_index(df, "k", str(tmp_path / "index"), run_rows=40)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for n in (0, 29, 30, 39, 40, 130, 299, 300, 10_000):
        assert [tuple(r) for r in index.at(n).collect()] == ordered[n : n + 1]
    plan = index.at(130)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_run" in plan and not any(x in plan for x in ("Exchange", "Sort", "Window", "TakeOrdered"))
    fences = sorted(tuple(r) for r in index.fences.select("start", "n_rows", "first_key", "last_key").collect())
    assert [f[:2] for f in fences] == [(i * 40, 40 if i < 7 else 20) for i in range(8)]
    draws = spark.createDataFrame([(i, i * 13 % 320) for i in range(400)], "draw int, offset int")
    got = {r.draw: (r.k, r.v) for r in index.at_offsets(draws).collect()}
    plain = {r.draw: (r.k, r.v) for r in sampling.rows_at_offsets(draws, df, "k").collect()}
    assert got == plain == {i: (ordered[i * 13 % 320] if i * 13 % 320 < 300 else (None, None)) for i in range(400)}
    few = index.at_offsets(draws.where("draw = 3"))
    few.collect()
    assert "dynamicpruning" in few._jdf.queryExecution().executedPlan().toString().lower()
    assert sorted(tuple(r) for r in index.between(5, 8).collect()) == sorted(r for r in rows if r[0] is not None and 5 <= r[0] <= 8)


def test_no_gather_in_the_plan_of_an_offset(spark):
    df = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    draws = spark.range(50).select(F.col("id").alias("draw"), (F.col("id") * 61).alias("offset"))
    for got in (sampling.row_at_offset(df, "k", 1_002), sampling.rows_at_offsets(draws, df, "k")):
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrdered" not in plan and "hashpartitioning(k" not in plan
    assert sampling.row_at_offset(df, "k", 1_002).first()["v"] == sorted((5 if i % 3 == 0 else i, i) for i in range(3_000))[1_002][1]
