"""Rows by their place in key order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, MapType, StructField, StructType, VariantType

from postlens.session import fresh_path

# The last offset that the feed draws, for its own tables, and its seed.
FEED_LAST_OFFSET = 11_000
SEED = 100

# monotonically_increasing_id holds the partition above this many bits, the row within it below.
ROW_BITS = 33
POSITION, RUN = "_position", "_run"
RUN_ROWS = 1_000_000  # of an order index


def placed_rows(df: DataFrame, key: str, path: str) -> DataFrame:
    """The rows of ``df``, written to ``path`` in key order, with ``POSITION``, their 0-based place in it.

    NULL keys come first; rows of one key are in the order of the other columns, so a hot key is cut over many sorted
    partitions like any other stretch of rows. Each row knows its partition and its place there, and a running sum over
    partition sizes (one row per partition) gives where each partition starts: no window runs over the table or over the
    rows of a key. The sorted rows are written before they are read twice, so that a lost executor can't change places.
    """
    df.orderBy(key, *_others(df, key)).withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    stored = df.sparkSession.read.schema(StructType([*df.schema, StructField("_at", LongType())])).parquet(path)
    part, row = F.shiftright("_at", ROW_BITS), F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    before = Window.orderBy("_its_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        stored.groupBy(part.alias("_its_part"))
        .agg(F.count("*").alias("_rows"))
        .select("_its_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    starts = F.broadcast(starts)  # one row per sorted partition
    joined = stored.join(starts, part == F.col("_its_part"))
    return joined.select(*df.columns, (F.col("_start") + row).alias(POSITION))


def number_rows(df: DataFrame, key: str, name: str = "position") -> DataFrame:
    """``key`` and its 0-based place in key order, a row for each row of ``df``; NULL keys come first."""
    return placed_rows(df.select(key), key, fresh_path(df.sparkSession, "places")).withColumnRenamed(POSITION, name)


def _others(df: DataFrame, key: str) -> list[str]:
    return [f.name for f in df.schema if f.name != key and not isinstance(f.dataType, (MapType, VariantType))]


def row_at_offset(df: DataFrame, key: str, n: int) -> DataFrame:
    """The row ``n`` places after the first in key order; no row past the end.

    Places count rows, whatever the key holds: a NULL or repeated key has as many as it has rows, in the order of the
    other columns. For more than one look at a table use ``OrderIndex``.
    """
    placed = placed_rows(df, key, fresh_path(df.sparkSession, "places"))
    return placed.where(F.col(POSITION) == n).drop(POSITION)


class OrderIndex:
    """A table stored in key order as runs of equally many rows, so that a row at an offset is in a run known beforehand.

    ``rows`` are the table's rows with ``POSITION``, in a folder per run; ``fences`` has a row per run: where it starts,
    how many rows it has, and its least and greatest key. An offset opens one folder, a range of keys those whose fences
    it meets.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, run_rows: int):
        self.key, self.run_rows = key, run_rows
        self.rows = spark.read.parquet(f"{path}/rows")
        self.fences = spark.read.parquet(f"{path}/fences")

    def at(self, n: int) -> DataFrame:
        """The row at offset ``n``; none past the end."""
        mine = self.rows.where((F.col(RUN) == n // self.run_rows) & (F.col(POSITION) == n))
        return mine.drop(RUN, POSITION)

    def at_offsets(self, draws: DataFrame, offset: str = "offset", prefix: str = "") -> DataFrame:
        """S5, as ``rows_at_offsets``: only runs that some draw falls in are read, where the draws are few."""
        return _at_draws(draws, self.rows.drop(RUN), offset, prefix, (self.rows, self.run_rows))

    def between(self, low: object, high: object) -> DataFrame:
        """The rows with a key from ``low`` to ``high``, from the runs that can hold one."""
        kind = self.rows.schema[self.key].dataType
        low, high = F.lit(low).cast(kind), F.lit(high).cast(kind)
        met = self.fences.where((F.col("first_key") <= high) & (F.col("last_key") >= low)).select(F.col(RUN).alias("_met"))
        rows = self.rows.join(F.broadcast(met), F.col(RUN) == F.col("_met"), "left_semi")  # one row per run
        return rows.where(F.col(self.key).between(low, high)).drop(RUN, POSITION)


def build_index(df: DataFrame, key: str, path: str, run_rows: int = RUN_ROWS) -> OrderIndex:
    """Write the order index of a table to ``path`` and open it. Sorts the table once; a hot key is cut into runs.

    Runs are cut by position, so all but the last have ``run_rows`` rows whatever the keys are.
    """
    spark = df.sparkSession
    placed = placed_rows(df, key, f"{path}/sorted")
    cut = placed.withColumn(RUN, F.floor(F.col(POSITION) / run_rows).cast("long"))
    cut.write.partitionBy(RUN).parquet(f"{path}/rows")
    stored = spark.read.parquet(f"{path}/rows")
    fences = stored.groupBy(RUN).agg(
        F.min(POSITION).alias("start"), F.count("*").alias("n_rows"), F.min(key).alias("first_key"), F.max(key).alias("last_key")
    )
    fences.write.parquet(f"{path}/fences")
    return OrderIndex(spark, path, key, run_rows)


def draw_offsets(spark: SparkSession, draws: int, last: int, seed: int = SEED) -> DataFrame:
    """``draws`` pseudo-random offsets from 0 to ``last`` with replacement, the same whenever a task is rerun.

    ``last`` is the last place of the table drawn from; its row count less one reaches every row.
    """
    offset = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(last + 1))
    return spark.range(draws).select(F.col("id").alias("draw"), offset.alias("offset"))


def rows_at_offsets(
    draws: DataFrame, table: DataFrame, key: str, offset: str = "offset", prefix: str = ""
) -> DataFrame:
    """Each draw with the table's row at its offset. Repeated draws repeat the row; past the end all is NULL.

    Each wanted row is looked up once; the draws, which may repeat one offset any number of times, meet the result in a
    join whose sides AQE can split. Rows with equal or NULL keys have their places in the order of the other columns.
    ``prefix`` goes before the names of the table's columns, and must where draws and table share a name.
    """
    _no_shared_names(draws, table.columns, prefix)
    return _at_draws(draws, placed_rows(table, key, fresh_path(table.sparkSession, "places")), offset, prefix)


def _no_shared_names(draws: DataFrame, columns: Sequence[str], prefix: str) -> None:
    shared = {c.lower() for c in draws.columns} & {f"{prefix}{c}".lower() for c in columns}
    if shared:
        raise ValueError(f"draws and table share the columns {sorted(shared)}; give a prefix")


def _at_draws(
    draws: DataFrame, placed: DataFrame, offset: str, prefix: str, runs: tuple[DataFrame, int] | None = None
) -> DataFrame:
    columns = [c for c in placed.columns if c != POSITION]
    _no_shared_names(draws, columns, prefix)
    wanted = draws.select(F.col(offset).cast("bigint").alias("_wanted")).distinct()
    found = F.col(POSITION) == F.col("_wanted")
    if runs is not None:  # the run is an equal key of the join, by which Spark prunes folders
        placed, size = runs
        found = found & (F.col(RUN) == F.floor(F.col("_wanted") / size).cast("long"))
    rows = placed.join(wanted, found).select(F.col("_wanted").alias("_offset"), *[F.col(c).alias(f"{prefix}{c}") for c in columns])
    return draws.join(rows, F.col(offset) == F.col("_offset"), "left").drop("_offset")


def aligned_rows(
    draws: DataFrame, tables: Mapping[str, tuple[DataFrame, str]], offset: str = "offset"
) -> dict[str, DataFrame]:
    """S5 over several tables, given as name -> (table, key): the same draws applied to each."""
    return {name: rows_at_offsets(draws, table, key, offset) for name, (table, key) in tables.items()}
