"""Chat formatting: logged snapshots of growing conversations collapse to the longest ones, which are then rendered.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import settle

TURNS_PER_BLOCK = 256  # by turn number: a unit of the two-step running hash
TURNS_PER_SEGMENT = 512  # rendered turns in one row
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _content_hashes() -> list[Column]:
    """Two independent hashes of a turn's role and text, null and empty told apart."""
    parts = [F.col("role").isNull(), F.col("text").isNull(), F.col("role"), F.col("text")]
    return [F.xxhash64(F.lit(seed), *parts) for seed in ("first", "second")]


def turns_once(conversations: DataFrame) -> DataFrame:
    """One narrow row per conversation, turn and content: ``conv_id``, ``turn``, ``block`` and the hashes ``c1``, ``c2``.

    Rows that repeat a turn with its role and text are one turn logged again; those that differ are turns of their own.
    """
    one, two = _content_hashes()
    once = conversations.select("conv_id", "turn", one.alias("c1"), two.alias("c2")).distinct()
    block = F.coalesce(F.floor(F.col("turn") / TURNS_PER_BLOCK), F.lit(-1))
    return once.select("conv_id", "turn", block.alias("block"), "c1", "c2")


def _before(rows: DataFrame, totals: list[Column]) -> DataFrame:
    """Per block of a conversation, what its earlier blocks come to; the window sees one row per block, not per turn."""
    names = ["earlier_turns", "earlier_1", "earlier_2"][-len(totals) :] if len(totals) == 2 else ["earlier_turns"]
    blocks = rows.groupBy("conv_id", "block").agg(*[t.alias(n) for t, n in zip(totals, names, strict=True)])
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    total = F.bit_xor if len(totals) == 2 else F.sum
    summed = [F.coalesce(total(n).over(earlier), F.lit(0)).alias(n) for n in names]
    return blocks.select(F.col("conv_id").alias("b_conv"), F.col("block").alias("b_block"), *summed)


def _with_before(rows: DataFrame, before: DataFrame) -> DataFrame:
    same = F.col("conv_id").eqNullSafe(F.col("b_conv")) & (F.col("block") == F.col("b_block"))
    return rows.join(before, same).drop("b_conv", "b_block")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """Adds each turn's ``place`` from 0 and ``p1``, ``p2``: the rolling hashes of all turns up to it.

    A turn is hashed with its place, and the prefix is the running exclusive-or, so it depends on the order of turns and
    can be carried from block to block. A very long conversation is thus worked on by block.
    """
    in_block = Window.partitionBy("conv_id", "block").orderBy("turn", "c1", "c2")
    numbered = turns.withColumn("nth", F.row_number().over(in_block) - 1)
    placed = _with_before(numbered, _before(turns, [F.count("*")]))
    placed = placed.withColumn("place", F.col("nth") + F.col("earlier_turns"))
    for i in (1, 2):
        placed = placed.withColumn(f"h{i}", F.xxhash64("place", f"c{i}"))
    placed = settle(placed.drop("nth", "earlier_turns"), "placed-turns")
    rolled = placed
    for i in (1, 2):
        rolled = rolled.withColumn(f"roll{i}", F.bit_xor(f"h{i}").over(in_block))
    rolled = _with_before(rolled, _before(placed, [F.bit_xor("h1"), F.bit_xor("h2")]))
    for i in (1, 2):
        rolled = rolled.withColumn(f"p{i}", F.col(f"roll{i}").bitwiseXOR(F.col(f"earlier_{i}")))
    return rolled.select("conv_id", "turn", "place", "c1", "c2", "p1", "p2")


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """The conversations that no longer one begins with: ``conv_id``, ``n_turns`` and ``n_logged``, how often it was logged.

    Of equal ones, that with the smallest ``conv_id`` stands (null last).
    """
    ends = prefixes.groupBy("conv_id").agg(F.max("place").alias("place"))
    last = prefixes.join(
        ends.select(F.col("conv_id").alias("e_conv"), F.col("place").alias("e_place")),
        F.col("conv_id").eqNullSafe(F.col("e_conv")) & (F.col("place") == F.col("e_place")),
    )
    whole = last.groupBy("place", "p1", "p2").agg(
        F.min(F.struct(F.col("conv_id").isNull().alias("no_id"), "conv_id")).alias("least"), F.count("*").alias("n_logged")
    )
    # prefixes that go on: each turn but the last of a conversation; one row per distinct prefix
    going_on = prefixes.join(
        ends.select(F.col("conv_id").alias("e_conv"), F.col("place").alias("e_place")),
        F.col("conv_id").eqNullSafe(F.col("e_conv")) & (F.col("place") < F.col("e_place")),
        "left_semi",
    )
    kept = whole.join(going_on.select("place", "p1", "p2").distinct(), ["place", "p1", "p2"], "left_anti")
    return kept.select("least.conv_id", (F.col("place") + 1).alias("n_turns"), "n_logged")


def render(conversations: DataFrame, prefixes: DataFrame, kept: DataFrame) -> DataFrame:
    """The kept conversations as text, in segments of ``TURNS_PER_SEGMENT`` turns, which only very long ones exceed."""
    own = kept.select(F.col("conv_id").alias("k_conv"), "n_turns", "n_logged")
    wanted = prefixes.join(own, F.col("conv_id").eqNullSafe(F.col("k_conv")))
    wanted = wanted.select("k_conv", F.col("turn").alias("k_turn"), "place", "c1", "c2", "n_turns", "n_logged")
    one, two = _content_hashes()
    logged = conversations.select("conv_id", "turn", "role", "text", one.alias("l1"), two.alias("l2"))
    same_turn = F.col("conv_id").eqNullSafe(F.col("k_conv")) & F.col("turn").eqNullSafe(F.col("k_turn"))
    same = same_turn & (F.col("l1") == F.col("c1")) & (F.col("l2") == F.col("c2"))
    turns = logged.join(wanted, same).withColumn("segment", F.floor(F.col("place") / TURNS_PER_SEGMENT))
    said = F.struct("place", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rendered = turns.groupBy("conv_id", "segment", "n_turns", "n_logged").agg(F.collect_set(said).alias("said"))
    line = lambda turn: F.concat(F.lit(OPEN), turn.role, F.lit("\n"), turn.text, F.lit(CLOSE))
    return rendered.select(
        "conv_id", "segment", "n_turns", "n_logged", F.concat_ws("", F.transform(F.array_sort("said"), line)).alias("text")
    )


def format_chats(conversations: DataFrame) -> DataFrame:
    """The maximal conversations of a log of snapshots, rendered turn by turn.

    A conversation logged again and again as it grew leaves snapshots that are prefixes of one another; only those that
    are no proper prefix of another stay, and equal ones once. Turns count in the order of ``turn`` (null first), gaps are
    allowed; rows repeating a turn with its role and text count once, and those of one ``turn`` that differ follow one
    another in the order of their hashes. A null ``conv_id`` is an id like any other; a null role renders as ``user``
    and a null text as empty, but both differ from those in comparison. Extra columns are not read; an empty table gives
    no rows. Rows: ``conv_id``, ``segment`` from 0, ``n_turns``, ``n_logged``, ``text``; a conversation's text is that of
    its segments in order.
    """
    prefixes = settle(prefix_hashes(turns_once(conversations)), "turn-prefixes")
    return render(conversations, prefixes, settle(maximal_conversations(prefixes), "maximal"))
