"""Exact top-k search by inner product, with candidates eliminated by a table of pivot distances."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import settle

SCALE = 1024
PIVOTS = 48
PIVOT_SAMPLE = 2048  # vectors that pivots are chosen from, and that queries meet first
ROWS_PER_BLOCK = 2048  # vectors in one candidate block
QUERIES_PER_BLOCK = 2048
BLOCKS_PER_TASK = 2  # candidate blocks that meet one block of queries in one group
BRIEFS_PER_TASK = 4096  # blocks of each side whose bounds are compared in one task
FIRST_CHUNK = 64  # candidates evaluated at first, in the order of their bounds; each further step takes twice as many
FLATTEST = 1e-4  # an axis of the pivots shorter than this, against the longest, is left out
EXACT = float(1 << 52)  # sums below this are exact in doubles
LONGEST = (1 << 63) - 1
LEAST = float(-LONGEST - 1)

BLOCK = (
    "ids binary, hashes binary, parts binary, places binary, squares binary, floors binary, "
    "near binary, far binary, square double, floor double"
)
HIT = "query_id long, query_hash long, vec_id long, score long"


def usable(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id``, integer components ``floor(1024 * x)`` as doubles, and their hash, of the vectors that take part.

    A null vector, or one that holds a null or a non-finite component, takes none; nor does a row without an id.
    """
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform(vector, lambda x: F.rint(F.floor(x.cast("double") * SCALE).cast("double")))
    return table.where(F.col(vector).isNotNull() & F.col("vec_id").isNotNull() & fine).select(
        F.col("vec_id").cast("long").alias("vec_id"), whole.alias("parts")
    ).withColumn("hash", F.xxhash64("parts"))


def _matrix(parts: pd.Series, dims: int) -> np.ndarray:
    """Vectors as rows; a shorter one is filled up with zeros."""
    out = np.zeros((len(parts), dims))
    for i, row in enumerate(parts):
        out[i, : len(row)] = row
    return out


def first_met(vectors: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and components of the ``PIVOT_SAMPLE`` vectors with the least hashed ids."""
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", F.xxhash64("parts")).limit(PIVOT_SAMPLE).toPandas()
    return sample["vec_id"].to_numpy(np.int64), _matrix(sample["parts"], dims)


def choose_pivots(known: np.ndarray, pivots: int) -> np.ndarray:
    """Vectors far from one another: any choice is right, it only decides how much gets eliminated.

    Each pivot is the one farthest from those chosen before.
    """
    chosen = [0]
    near = distances_to(known[:1], known)[:, 0]
    while len(chosen) < min(pivots, len(known)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances_to(known[chosen[-1:]], known)[:, 0])
    return known[chosen]


def distances_to(pivots: np.ndarray, parts: np.ndarray) -> np.ndarray:
    squared = (parts**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * parts @ pivots.T
    return np.sqrt(np.maximum(squared, 0))


def places_from(distances: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """What distances to all pivots tell of a vector's place: coordinates along the pivots' axes, and the height over them.

    The distance of two places is the greatest lower bound of their vectors' distance that the table of distances gives,
    never below the widest gap to a single pivot: known are the components along the pivots' span and the length of the
    rest, and rests may point the same way. The difference of two squared distances is linear in the vector, so the axes
    come from the pivots' singular vectors; leaving a flat one out only lowers the bound.
    """
    spread = pivots[1:] - pivots[0]
    left, lengths, _ = np.linalg.svd(spread, full_matrices=False)
    used = lengths > FLATTEST * lengths.max(initial=0)
    squares = distances**2
    along = (squares[:, :1] - squares[:, 1:] + (spread**2).sum(1)) / 2 @ (left[:, used] / lengths[used])
    height = np.sqrt(np.maximum(squares[:, 0] - (along**2).sum(1), 0))
    return np.column_stack([along, height])


def by_nearest_pivot(vectors: DataFrame, pivots: np.ndarray, dims: int) -> DataFrame:
    """The vectors in the order of their nearest pivot and their distance to it, so that a block holds like ones.

    Vectors at the same place, and repeated rows, are cut over partitions by a seeded draw.
    """

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            apart = distances_to(pivots, _matrix(batch["parts"], dims))
            yield batch.assign(nearest=apart.argmin(1).astype(np.int32), apart=apart.min(1))

    placed = vectors.mapInPandas(place, "vec_id long, parts array<double>, hash long, nearest int, apart double")
    return placed.withColumn("draw", F.rand(1)).repartitionByRange("nearest", "apart", "draw").sortWithinPartitions(
        "nearest", "apart", "draw"
    )


def floors_of(ids: np.ndarray, parts: np.ndarray, met: tuple[np.ndarray, np.ndarray], k: int) -> np.ndarray:
    """For each query the k-th highest score among the vectors it meets first: what its answers score at least."""
    out = np.full(len(ids), LEAST)
    for i, query in enumerate(parts):
        scores = _scores(query, met[1])[met[0] != ids[i]]
        if len(scores) >= k:
            out[i] = float(np.partition(scores, len(scores) - k)[len(scores) - k])
    return out


def pack(
    vectors: DataFrame, pivots: np.ndarray, dims: int, rows: int, met: tuple[np.ndarray, np.ndarray] | None = None, k: int = 0
) -> DataFrame:
    """Blocks of up to ``rows`` vectors with ids, components, squared lengths and places among the pivots.

    In brief a block is its least and greatest distance to every pivot (``near``, ``far``), its greatest squared length and,
    for queries, which come with the vectors they meet first, its least floor.
    """

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), rows):
                part = batch.iloc[start : start + rows]
                ids, parts = part["vec_id"].to_numpy(np.int64), _matrix(part["parts"], dims)
                distances, squares = distances_to(pivots, parts), (parts**2).sum(1)
                floors = floors_of(ids, parts, met, k) if met else np.full(len(ids), LEAST)
                yield pd.DataFrame(
                    {
                        "ids": [ids.tobytes()],
                        "hashes": [part["hash"].to_numpy(np.int64).tobytes()],
                        "parts": [parts.tobytes()],
                        "places": [places_from(distances, pivots).tobytes()],
                        "squares": [squares.tobytes()],
                        "floors": [floors.tobytes()],
                        "near": [distances.min(0).tobytes()],
                        "far": [distances.max(0).tobytes()],
                        "square": [squares.max()],
                        "floor": [floors.min()],
                    }
                )

    packed = vectors.select("vec_id", "parts", "hash").mapInPandas(blocks, BLOCK)
    return settle(packed.withColumn("block", F.monotonically_increasing_id()), "vector-blocks")


def _unpacked(row) -> tuple[np.ndarray, ...]:
    ids, hashes = np.frombuffer(row.ids, dtype=np.int64), np.frombuffer(row.hashes, dtype=np.int64)
    shaped = lambda raw: np.frombuffer(raw).reshape(len(ids), -1)
    return ids, shaped(row.parts), shaped(row.places), np.frombuffer(row.squares), hashes, np.frombuffer(row.floors)


def _highest(squares: np.ndarray, square: float, apart: np.ndarray) -> np.ndarray:
    """Upper bounds of scores, from both squared lengths (or the greatest of a block) and the least squared distance.

    The score is half of both squares less the squared distance. Some slack covers the rounding of roots and sums.
    """
    slack = 1 + 1e-9 * (squares + square)
    bounds = np.minimum((squares + square - apart) / 2 + slack, np.sqrt(squares * square) + slack)
    return np.maximum(bounds, LEAST)


def meetings(candidates: DataFrame, queries: DataFrame) -> DataFrame:
    """The pairs of a ``block`` of candidates and a ``query_block`` that may hold an answer, settled.

    Blocks are at least as far apart as the widest gap between their distances to a pivot. Only that and lengths, in brief,
    are compared here; blocks out of reach of each other are never shipped to one another.
    """
    brief = ["block", "near", "far", "square", "floor"]
    groups = [max(1, -(-blocks.count() // BRIEFS_PER_TASK)) for blocks in (candidates, queries)]

    def spread(blocks: DataFrame, own: int) -> DataFrame:
        names = ["mine", "theirs"]
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups[1 - own] - 1).cast("long")))
        return blocks.select(
            *brief, F.pmod(F.xxhash64("block"), F.lit(groups[own])).cast("long").alias(names[own]), every.alias(names[1 - own])
        )

    def meet(key: tuple, mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"block": [], "query_block": []}, dtype="int64")]
        if len(mine):
            near, far = (np.stack([np.frombuffer(raw) for raw in mine[name]]) for name in ("near", "far"))
            for row in theirs.itertuples():
                gap = np.maximum(near - np.frombuffer(row.far), np.frombuffer(row.near) - far).max(1).clip(0)
                reached = _highest(mine["square"].to_numpy(), row.square, gap**2) >= row.floor
                out.append(pd.DataFrame({"block": mine["block"][reached], "query_block": row.block}))
        return pd.concat(out)

    both = spread(candidates, 0).groupBy("mine", "theirs").cogroup(spread(queries, 1).groupBy("mine", "theirs"))
    return settle(both.applyInPandas(meet, "block long, query_block long"), "vector-meetings")


def _scores(query: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Exact integer inner products, held to the range of a long."""
    if np.sqrt((query**2).sum() * (parts**2).sum(1).max(initial=0)) < EXACT:
        return (parts @ query).astype(np.int64)
    whole = [int(q) for q in query]
    sums = (sum(a * int(b) for a, b in zip(whole, row, strict=True)) for row in parts)
    return np.array([max(-LONGEST - 1, min(LONGEST, s)) for s in sums], dtype=np.int64)


def best_of(
    query_id: int, query: np.ndarray, place: np.ndarray, square: float, held: tuple, k: int, floor: float = LEAST
) -> list[tuple[int, int]]:
    """A query's k best (score, -id) among a group's candidates, those below its floor left out or not.

    The distance to a candidate is at least that of their places among the pivots, so the score has an upper bound.
    Candidates whose bound is below the floor are eliminated; the others are evaluated in the order of that bound until the
    k-th score found exceeds every bound left. ``held`` are the group's ids, components, places and squared lengths, and
    the squared lengths of the places.
    """
    ids, parts, places, squares, spans = held
    bounds = _highest(squares, square, np.maximum(spans + (place**2).sum() - 2 * (places @ place), 0))
    left = np.flatnonzero((bounds >= floor) & (ids != query_id))
    order = left[np.argsort(-bounds[left], kind="stable")]
    best: list[tuple[int, int]] = []
    start, chunk = 0, FIRST_CHUNK
    while start < len(order):
        now = order[start : start + chunk]
        if len(best) == k and best[-1][0] > bounds[now[0]]:
            break
        scores = _scores(query, parts[now])
        if len(best) == k:
            high = scores >= best[-1][0]
            scores, now = scores[high], now[high]
        best = sorted([*best, *zip(scores.tolist(), (-ids[now]).tolist(), strict=True)], reverse=True)[:k]
        start, chunk = start + chunk, 2 * chunk
    return best


def exact_top_k(table: DataFrame, every: int = 100, k: int = 10, pivots: int = PIVOTS) -> DataFrame:
    """The k highest inner products of each query with every other vector, ties to the smaller id.

    Queries are the rows whose ``vec_id`` is divisible by ``every``. Vectors are made whole by ``floor(1024 * x)``; null
    vectors and those with null or non-finite components take no part, shorter and empty ones count as filled up with
    zeros. A query's own id is no candidate, also where it is repeated; other repeated ids are candidates each. Different
    vectors under one query id are queries each, with ranks of their own; equal ones are one query. With fewer than k
    candidates all are returned; an empty table gives no rows. Products beyond a long are held to its range. Extra columns
    are not read.

    Queries and candidates are packed into blocks of like vectors. A query's floor, its k-th score among a sample, and the
    distances of two blocks to the pivots tell which blocks may hold an answer; only these are shipped to one another, as a
    join on pairs of numbers. A task holds one group of blocks, whatever the table's size. Groups give k rows a query,
    which are ranked again. Hot vectors make no hot key, as blocks are cut by row.
    """
    vectors = settle(usable(table), "vectors")
    longest = vectors.agg(F.max(F.size("parts"))).first()[0]
    if longest is None:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dims = max(1, longest)
    met = first_met(vectors, dims)
    chosen = choose_pivots(met[1], pivots)
    candidates = pack(by_nearest_pivot(vectors, chosen, dims), chosen, dims, ROWS_PER_BLOCK)
    asked = vectors.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "parts"])
    queries = pack(by_nearest_pivot(asked, chosen, dims), chosen, dims, QUERIES_PER_BLOCK, met, k)
    groups = max(1, -(-candidates.count() // BLOCKS_PER_TASK))
    pairs = meetings(candidates, queries).withColumn("candidate_group", F.pmod(F.xxhash64("block"), F.lit(groups)))
    whole = ["ids", "hashes", "parts", "places", "squares", "floors"]
    left = candidates.select("block", *whole).join(pairs, "block")
    reached = pairs.select(F.col("query_block").alias("asked_block"), F.col("candidate_group").alias("asked_group")).distinct()
    right = queries.select(F.col("block").alias("asked_block"), *whole).join(reached, "asked_block")

    def search(key: tuple, mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, int, int]] = []
        asked_blocks = [_unpacked(row) for row in theirs.itertuples()]
        held = [_unpacked(row) for row in mine.itertuples()]
        together = [np.concatenate(x) for x in zip(*held, strict=True)][:4]
        for ids, parts, places, squares, hashes, floors in asked_blocks if together else []:
            group = (*together, (together[2] ** 2).sum(1))
            for i in range(len(ids)):
                for score, minus in best_of(int(ids[i]), parts[i], places[i], squares[i], group, k, floors[i]):
                    found.append((int(ids[i]), int(hashes[i]), -minus, score))
        return pd.DataFrame(found, columns=["query_id", "query_hash", "vec_id", "score"])

    hits = left.groupBy("query_block", "candidate_group").cogroup(right.groupBy("asked_block", "asked_group"))
    ranked = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    best = hits.applyInPandas(search, HIT).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
