"""Sharding by fixed virtual slots and a versioned map from slots to shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.common import settle, whole_text

SLOTS = 4096
SHARDS = 40
ROW_OVERHEAD = 16  # bytes a row costs besides its text
HOT_ROWS = 64  # a slot of no more rows is left as it is

SlotMap = dict[int, int]  # virtual slot to shard, for every slot


def first_map(shards: int, slots: int = SLOTS) -> SlotMap:
    """Version 1: slots dealt round-robin, without knowing any sizes."""
    return {slot: slot % shards for slot in range(slots)}


def rebalanced(owner: SlotMap, weights: dict[int, int], shards: int) -> SlotMap:
    """The next version of a map: slots move until the shards weigh nearly the same.

    Each step takes the heaviest and the lightest shard and moves the slot whose weight comes nearest to half their
    difference, or swaps nothing more when no move narrows it. Only slots that must move do, so few rows change place.
    The work depends on the number of slots alone, which is fixed.
    """
    owner = dict(owner)
    loads = [0] * shards
    held: list[dict[int, int]] = [{} for _ in range(shards)]
    for slot, shard in owner.items():
        weight = weights.get(slot, 0)
        loads[shard] += weight
        if weight:
            held[shard][slot] = weight
    while True:
        heavy, light = loads.index(max(loads)), loads.index(min(loads))
        gap = loads[heavy] - loads[light]
        movable = [(abs(2 * w - gap), slot) for slot, w in held[heavy].items() if w < gap]
        if not movable:
            return owner
        slot = min(movable)[1]
        weight = held[heavy].pop(slot)
        held[light][slot] = weight
        loads[heavy] -= weight
        loads[light] += weight
        owner[slot] = light


def sized(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Each document's size, checksum, place in the stored table and virtual slot, settled.

    The slot follows from id and text alone, but for rows equal in both of which there are so many that their slot would
    hold several times its part: such rows, as copies of a text that all lack an id, have a slot by their place each.
    """
    rows = settle(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(whole_text()).cast("long") + ROW_OVERHEAD).alias("size"),
            F.crc32(whole_text()).alias("text_crc32"),
            F.monotonically_increasing_id().alias("locator"),
        ).withColumn("virtual_slot", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int")),
        "sized",
    )
    counts = {slot: n for slot, (n, _) in slot_totals(rows).items()}
    fair = sum(counts.values()) / slots
    heavy = [slot for slot, n in counts.items() if n > max(HOT_ROWS, 4 * fair)]
    if not heavy:
        return rows
    same = rows.where(F.col("virtual_slot").isin(heavy)).groupBy("doc_id", "text_crc32").agg(F.count("*").alias("n"))
    hot = same.where(F.col("n") > max(HOT_ROWS / 4, fair)).select(F.col("doc_id").alias("hot_id"), F.col("text_crc32").alias("hot_crc"))
    is_hot = F.col("doc_id").eqNullSafe(F.col("hot_id")) & (F.col("text_crc32") == F.col("hot_crc"))
    joined = rows.join(F.broadcast(hot), is_hot, "left")  # fewer than there are slots, as each has more than a slot's part
    spread = F.pmod(F.xxhash64("doc_id", "text_crc32", "locator"), F.lit(slots)).cast("int")
    slot = F.when(F.col("hot_crc").isNull(), F.col("virtual_slot")).otherwise(spread)
    return settle(joined.withColumn("virtual_slot", slot).drop("hot_id", "hot_crc"), "sized")


def slot_totals(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """Rows and bytes per virtual slot: at most as many rows as there are slots, whatever the table's size."""
    totals = rows.groupBy("virtual_slot").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))
    return {row.virtual_slot: (row.rows, row.bytes) for row in totals.collect()}


def latest(stored: DataFrame | None, shards: int, slots: int) -> tuple[int, SlotMap]:
    """Number and map of the newest stored version, a row per slot; without one, version 1 is dealt round-robin.

    Slots of shards that are no more go round-robin to those there are.
    """
    if stored is None:
        return 1, first_map(shards, slots)
    version = stored.agg(F.max("version")).first()[0]
    if version is None:
        return 1, first_map(shards, slots)
    owner = {r.virtual_slot: r.shard for r in stored.where(F.col("version") == version).collect()}
    if set(owner) != set(range(slots)):
        raise ValueError(f"the stored map has not just the slots 0 to {slots - 1}")
    return version, {slot: shard if shard < shards else slot % shards for slot, shard in owner.items()}


def map_table(spark: SparkSession, versions: dict[int, SlotMap], counts: dict[int, int]) -> DataFrame:
    """The map as a table, settled: a row per version and slot, with the place of the slot's first row in its shard."""
    rows = []
    for version, owner in versions.items():
        filled: dict[int, int] = {}
        for slot in sorted(owner):
            shard = owner[slot]
            rows.append((version, slot, shard, filled.get(shard, 0)))
            filled[shard] = filled.get(shard, 0) + counts.get(slot, 0)
    return settle(spark.createDataFrame(rows, "version int, virtual_slot int, shard int, first_place long"), "slot-map")


def placed_by_map(rows: DataFrame, shards: int, slots: int, stored: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The sized rows with shard and place by the next version of the map, and that map with the version before it."""
    totals = slot_totals(rows)
    before, owner = latest(stored, shards, slots)
    versions = {before: owner, before + 1: rebalanced(owner, {slot: n for slot, (_, n) in totals.items()}, shards)}
    told = map_table(rows.sparkSession, versions, {slot: n for slot, (n, _) in totals.items()})
    newest = told.where(F.col("version") == before + 1)
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32")
    placed = rows.withColumn("place", F.row_number().over(within) - 1).join(F.broadcast(newest), "virtual_slot")
    return placed, told


def slot_map(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, stored: DataFrame | None = None) -> DataFrame:
    """The versions of the map to store: ``version``, ``virtual_slot``, ``shard``, the newest one fitted to ``docs``."""
    return placed_by_map(sized(docs, slots), shards, slots, stored)[1].select("version", "virtual_slot", "shard")


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, stored: DataFrame | None = None
) -> DataFrame:
    """Every document with its shard, under the law ``bytes``: the shards' sizes come out nearly equal.

    A document hashes into one of ``slots`` virtual slots by id and text, so copies of a text are spread; so are rows equal
    in both, where many. The bytes of each slot are added up, and the newest version of the ``stored`` map (see
    ``slot_map``; round-robin without one) is edited until they balance, moving as few slots as that takes: documents of
    all others stay in their shards when the table grows. ``slot`` is the row's place in its shard, gapless from 0: the
    place of its virtual slot, plus its place therein. A null text has no bytes of its own, a very long one counts whole; an
    empty table gives no rows. Columns besides ``doc_id`` and ``text`` are not read. The map has a row per slot and
    version, which bounds what is broadcast.
    """
    placed, _ = placed_by_map(sized(docs, slots), shards, slots, stored)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("first_place") + F.col("place")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        F.col("version").alias("map_version"),
    )
