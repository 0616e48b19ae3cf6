"""What several operators of this subpackage share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.session import fresh_path

# Odd multiplier of the rolling word hash with its inverse, and the two multipliers of the 64-bit finaliser.
ROLL = 0x9E3779B97F4A7C15
UNROLL = pow(ROLL, -1, 1 << 64)
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from that table.

    The lineage ends there: a lost executor costs a read, not the work before it.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    """The text, with a null one as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(column: str = "doc_id") -> Column:
    """True for the fifth of the ids that no model may learn labels from."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 5 == 0, F.lit(False))


def mixed(values: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values; wraps around by intent."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(MIX[0])
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX[1])
    x ^= x >> np.uint64(31)
    return x


_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[ord("0") : ord("9") + 1] = True
_IS_WORD[ord("a") : ord("z") + 1] = True
_IS_WORD[128:] = True  # parts of letters outside ASCII
_tables: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n - 1), wrapped to 64 bits; kept for the next text."""
    if base not in _tables or len(_tables[base]) < n:
        factors = np.full(1 << max(16, int(n).bit_length()), base, dtype=np.uint64)
        factors[0] = 1
        _tables[base] = np.cumprod(factors, dtype=np.uint64)
    return _tables[base][:n]


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash for each word of the lower-cased text, in order.

    Words are runs of ASCII letters, digits and anything outside ASCII. All words are hashed at once: a word's
    polynomial hash is the difference of two running sums, shifted to the word's start.
    """
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), dtype=np.uint8)
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = _IS_WORD[data]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(ROLL, len(data)), out=sums[1:])
    # times the inverse power at the word's start, so that its hash does not depend on its place
    return mixed((sums[ends] - sums[starts]) * _powers(UNROLL, len(data))[starts])
