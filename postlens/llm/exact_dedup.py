"""Exact deduplication by a minimal perfect hash over the digests of a history."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm.common import mixed, settle, whole_text

BLANKS = " \t\n\x0b\x0c\r"  # fixed values: the characters that do not count
DIGESTS_PER_BUCKET = 1024
BITS_PER_DIGEST = 1.5

GROUP = T.StructType(
    [
        T.StructField("digest", T.BinaryType()),
        T.StructField("keep_id", T.LongType()),
        T.StructField("keep_points", T.IntegerType()),
        T.StructField("keep_at", T.LongType()),
        T.StructField("group_size", T.LongType()),
    ]
)
INDEX = T.StructType(
    [
        T.StructField("bucket", T.LongType()),
        T.StructField("level_sizes", T.ArrayType(T.LongType())),
        T.StructField("level_bits", T.BinaryType()),
        T.StructField("slots", T.ArrayType(GROUP)),
    ]
)


# ---- the hash of one bucket ------------------------------------------------------------------------------------------


def _words(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(len(digests), 4)


def _place(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Where each digest falls on a level; every level folds the digest in another way."""
    folded = words[:, 0].copy()
    for i in (1, 2, 3):
        folded += words[:, i] * np.uint64(2 * (4 * level + i) + 1)
    return (mixed(folded + np.uint64(level)) % np.uint64(size)).astype(np.int64)


def build_hash(digests: list[bytes]) -> tuple[list[int], bytes, np.ndarray]:
    """Level sizes, the levels' bits and each digest's slot, for distinct digests.

    A digest alone at its place on a level sets that bit and is done; the others go to the next level. A digest's slot is
    the number of bits set before its own, so n digests fill slots 0 to n - 1.
    """
    words, left = _words(digests), np.arange(len(digests))
    sizes, bits, where = [], [], np.zeros(len(digests), dtype=np.int64)
    while len(left):
        size = max(8, int(BITS_PER_DIGEST * len(left)))
        place = _place(words[left], len(sizes), size)
        alone = np.bincount(place, minlength=size) == 1
        done = alone[place]
        where[left[done]] = sum(sizes) + place[done]
        sizes.append(size)
        bits.append(alone)
        left = left[~done]
    every = np.concatenate(bits) if bits else np.zeros(0, dtype=bool)
    slots = (np.cumsum(every) - 1)[where] if len(digests) else where
    return sizes, np.packbits(every).tobytes(), slots


def look_up(sizes: list[int], bits: bytes, digests: list[bytes]) -> np.ndarray:
    """The slot that each digest would have, or -1; a digest outside the history may still get a slot."""
    slots = np.full(len(digests), -1, dtype=np.int64)
    if not len(digests) or not len(sizes):
        return slots
    every = np.unpackbits(np.frombuffer(bits, dtype=np.uint8))[: sum(sizes)].astype(bool)
    ranks, words, left, start = np.cumsum(every) - 1, _words(digests), np.arange(len(digests)), 0
    for level, size in enumerate(sizes):
        place = start + _place(words[left], level, size)
        found = every[place]
        slots[left[found]] = ranks[place[found]]
        left, start = left[~found], start + size
    return slots


# ---- on tables -------------------------------------------------------------------------------------------------------


def normal_digest(column: str = "text") -> Column:
    """SHA-256 of the text without its blanks, as 32 bytes."""
    return F.unhex(F.sha2(F.translate(whole_text(column), BLANKS, ""), 256))


def digested(docs: DataFrame, history: Column) -> DataFrame:
    """One narrow row per document, settled: its digest, code points, id, a locator ``at`` and whether it is history.

    Texts are read once, here; all later steps move digests only.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        normal_digest().alias("digest"),
        F.char_length(whole_text()).alias("points"),
        F.coalesce(history, F.lit(True)).alias("old"),
        F.monotonically_increasing_id().alias("at"),
    )
    return settle(rows, "digests")


def groups_of(rows: DataFrame) -> DataFrame:
    """Equal digests as one row each, with the size of the group and the winner: most code points, then smallest id.

    A null id comes after all others; of rows equal in that too, the first by locator wins.
    """
    order = F.struct((-F.col("points")).alias("fewer"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "at")
    grouped = rows.groupBy("digest").agg(F.min(order).alias("best"), F.count("*").alias("group_size"))
    return grouped.select(
        "digest",
        F.col("best.doc_id").alias("keep_id"),
        (-F.col("best.fewer")).alias("keep_points"),
        F.col("best.at").alias("keep_at"),
        "group_size",
    )


def _bucketed(groups: DataFrame, buckets: int) -> DataFrame:
    return groups.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)))


def build_index(groups: DataFrame, buckets: int) -> DataFrame:
    """The minimal perfect hash of a history's groups, one row per bucket of about ``DIGESTS_PER_BUCKET``.

    Slots hold whole digests and the winner's locator, so a lookup can be checked byte by byte. A table like any other:
    written, read and joined by bucket.
    """

    def build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        sizes, bits, slots = build_hash(list(part["digest"]))
        filled: list = [None] * len(part)
        for slot, row in zip(slots, part[GROUP.names].to_dict("records"), strict=True):
            filled[slot] = {k: None if v is pd.NA else v for k, v in row.items()}
        return pd.DataFrame(
            {"bucket": [key[0]], "level_sizes": [sizes], "level_bits": [bits], "slots": [filled]}
        )

    nullable = _bucketed(groups, buckets).withColumn("keep_id", F.col("keep_id").cast("string"))
    index = T.StructType(
        [f if f.name != "slots" else T.StructField("slots", T.ArrayType(_textual(GROUP))) for f in INDEX]
    )
    built = nullable.groupBy("bucket").applyInPandas(build, index)
    return settle(built, "digest-index")


def _textual(schema: T.StructType) -> T.StructType:
    """Ids as text on the way through pandas, which would make floats of whole numbers beside nulls."""
    return T.StructType([T.StructField(f.name, T.StringType() if f.name == "keep_id" else f.dataType) for f in schema])


def _order(row: dict) -> tuple:
    missing = row["keep_id"] is None
    return (-row["keep_points"], missing, 0 if missing else int(row["keep_id"]), row["keep_at"])


def match(index: DataFrame, arrivals: DataFrame, buckets: int) -> DataFrame:
    """All groups of history and arrivals together.

    An arrival whose digest is byte for byte that of its slot joins the group there: sizes add up, the better winner
    stays. The others, nonmembers, are groups of their own. Both sides hold one row per distinct digest, so no bucket
    grows with the number of copies.
    """

    def merge(key: tuple, new: pd.DataFrame, built: pd.DataFrame) -> pd.DataFrame:
        old = list(built["slots"].iloc[0]) if len(built) else []
        arrived = new[GROUP.names].to_dict("records")
        sizes, bits = (list(built["level_sizes"].iloc[0]), built["level_bits"].iloc[0]) if len(built) else ([], b"")
        slots = look_up(sizes, bits, [row["digest"] for row in arrived])
        out = [dict(row) for row in old]
        for slot, row in zip(slots, arrived, strict=True):
            if slot >= 0 and old[slot]["digest"] == row["digest"]:
                size = out[slot]["group_size"] + row["group_size"]
                out[slot] = {**min(out[slot], row, key=_order), "group_size": size}
            else:
                out.append(row)
        return pd.DataFrame(out, columns=GROUP.names)

    sides = _bucketed(arrivals, buckets).withColumn("keep_id", F.col("keep_id").cast("string")).groupBy("bucket")
    merged = sides.cogroup(index.groupBy("bucket")).applyInPandas(merge, _textual(GROUP))
    return merged.withColumn("keep_id", F.col("keep_id").cast("long"))


def _half(column: str = "doc_id") -> Column:
    """One half of a table, by id, stands for the history when a table is deduplicated by itself."""
    return F.crc32(F.col(column).cast("string")) % 2 == 0


def winners(docs: DataFrame, history: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The documents' digest rows, and one row per distinct text with its winner and size."""
    rows = digested(docs, _half() if history is None else history)
    grouped = settle(
        groups_of(rows.where("old")).withColumn("old", F.lit(True)).unionByName(
            groups_of(rows.where("NOT old")).withColumn("old", F.lit(False))
        ),
        "digest-groups",
    )
    buckets = max(1, -(-grouped.count() // DIGESTS_PER_BUCKET))
    index = build_index(grouped.where("old").drop("old"), buckets)
    return rows, match(index, grouped.where("NOT old").drop("old"), buckets)


def exact_dedup(docs: DataFrame, history: Column | None = None) -> DataFrame:
    """Each document's group of equal texts and whether it is the one that stays.

    Texts are equal when they are so without blanks; a null text counts as empty and empty texts equal each other. Of a
    group, the row with the most code points stays, then the smallest ``doc_id`` (null last), then any one of rows equal
    in both. ``history`` says which rows are the history that arrivals are looked up in; by default half of the ids. The
    result does not depend on it. Columns besides ``doc_id`` and ``text`` are not read. An empty table gives an empty
    result.

    The hot side of the last join, many copies of one text, is left for the engine to split: the other side has one row
    per text.
    """
    rows, best = winners(docs, history)
    joined = rows.join(best.withColumnRenamed("digest", "its_digest"), F.col("digest") == F.col("its_digest"))
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("at") == F.col("keep_at")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_distinct(docs: DataFrame, history: Column | None = None) -> DataFrame:
    """The documents that ``exact_dedup`` keeps, with all their columns.

    Of rows equal in id, text without blanks and code points, the one with the smallest text stays.
    """
    _, best = winners(docs, history)
    own = [F.col(c) for c in docs.columns]
    keyed = docs.select(
        F.struct(*own).alias("row"),
        normal_digest().alias("digest"),
        F.char_length(whole_text()).alias("points"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("-")).alias("id"),
    )
    kept = best.select(
        "digest", F.col("keep_points").alias("points"), F.coalesce(F.col("keep_id").cast("string"), F.lit("-")).alias("id")
    )
    once = keyed.join(kept, ["digest", "points", "id"]).groupBy("digest", "points", "id")
    return once.agg(F.min_by("row", F.coalesce("row.text", F.lit(""))).alias("row")).select("row.*")
