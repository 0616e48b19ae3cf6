"""Mixing sources to target weights by iterative proportional fitting over source, language and topic."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import settle, whole_text

DIMENSIONS = ("source", "lang", "topic")
# Topics by what a text shows, the first that fits; the rest is prose.
TOPIC_PATTERNS = {
    "license": r"(?i)licen[sc]ed? under|all rights reserved|\blicense\b",
    "contact": r"[\w.+-]+@[\w-]+\.\w+|https?://",
    "table": r"\w+ \| \w+ \| \w+",
}
TEMPERATURE = 0.7  # targets are the observed token shares to this power, which lifts small categories
KEPT_SHARE = 0.6  # of all tokens, what the sample is to hold
SWEEPS = 400  # over arrays of cells
TOLERANCE = 1e-5  # of a margin, relative
HELD = 1e-4  # of all tokens, the residual with which targets count as held
HALVINGS = 12  # in the search for the largest sample that the targets allow
ASKED_AT_MOST = 1e9  # times its tokens; keeps what a full cell is asked for finite

Targets = dict[str, dict[str | None, float]]


def topic_of(text: Column) -> Column:
    topic = F.lit("prose")
    for name, pattern in reversed(TOPIC_PATTERNS.items()):
        topic = F.when(text.rlike(pattern), name).otherwise(topic)
    return topic


def tokened(docs: DataFrame) -> DataFrame:
    """``doc_id``, the three dimensions, ``n_tokens`` and a fixed ``draw`` in [0, 1) of each document, settled.

    Tokens are runs of non-blanks. The draw follows from id and text, so that rows without an id are drawn one by one and
    a rerun draws the same.
    """
    text = whole_text()
    bits = F.shiftrightunsigned(F.xxhash64(F.lit("mix"), F.col("doc_id").cast("string"), F.md5(text)), 11)
    return settle(
        docs.select(
            "doc_id",
            F.col("source").cast("string").alias("source"),
            F.col("lang").cast("string").alias("lang"),
            topic_of(text).alias("topic"),
            F.regexp_count(text, F.lit(r"\S+")).cast("long").alias("n_tokens"),
            F.md5(text).alias("digest"),
            (bits / float(1 << 53)).alias("draw"),
        ),
        "tokened",
    )


def share_targets(tokens: np.ndarray, names: list, given: dict[str | None, float] | None, temperature: float) -> np.ndarray:
    """The target share of each category of a dimension, adding up to 1 over those with tokens.

    Without any given, shares are tempered. Given targets hold as weights among the categories they name; one they don't
    name, also null, keeps its tempered share, and the named ones share the rest. A weight of 0 leaves a category out.
    """
    shares = np.where(tokens > 0, tokens.astype(float) ** temperature, 0.0)
    shares /= shares.sum() or 1.0
    if given is not None:
        named = np.array([name in given for name in names], dtype=bool)
        weights = np.array([max(0.0, float(given.get(name, 0.0))) for name in names]) * (tokens > 0)
        others = np.where(named, 0.0, shares)
        rest = 1 - others.sum() if weights.sum() else 0.0
        shares = others / (others.sum() or 1.0) * (1 - rest) + weights / (weights.sum() or 1.0) * rest
    return shares


def rake(
    tokens: np.ndarray, codes: list[np.ndarray], shares: list[np.ndarray], wanted: float, sweeps: int = SWEEPS
) -> tuple[np.ndarray, bool]:
    """How many tokens of each cell a sample of ``wanted`` tokens holds, and whether all margins hold to ``TOLERANCE``.

    In turn every dimension's categories are scaled to their targets, whereby a cell gives its tokens at most: what a full
    cell lacks is asked of the others of its category in the next sweep. A category is never scaled beyond its target, so
    sweeps close in on it from below. Margins are compared after a sweep, all at once.
    """
    asked = tokens.astype(float)
    goals = [share * wanted for share in shares]
    for _ in range(sweeps):
        for code, goal in zip(codes, goals, strict=True):
            margin = np.bincount(code, np.minimum(tokens, asked), minlength=len(goal))
            scale = np.divide(goal, margin, out=np.zeros(len(goal)), where=margin > 0)
            asked = np.minimum(asked * scale[code], tokens * ASKED_AT_MOST)
        kept = np.minimum(tokens, asked)
        if all(
            (np.abs(np.bincount(code, kept, minlength=len(goal)) - goal) <= TOLERANCE * goal).all()
            for code, goal in zip(codes, goals, strict=True)
        ):
            return kept, True
    return np.minimum(tokens, asked), False


def fitted(tokens: np.ndarray, codes: list[np.ndarray], shares: list[np.ndarray], wanted: float) -> tuple[np.ndarray, bool]:
    """The raked sample of ``wanted`` tokens or, where the targets allow no sample so large, of nearly the most they allow.

    No sample holds more than each category's tokens over its target share; below that the largest is searched by halves.
    Where the targets contradict each other at any size, the sample comes near them and the second value is false.
    """
    room = [np.bincount(code, tokens, minlength=len(share)) for code, share in zip(codes, shares, strict=True)]
    most = min([wanted] + [float((r[s > 0] / s[s > 0]).min()) for r, s in zip(room, shares, strict=True) if (s > 0).any()])
    kept, held = rake(tokens, codes, shares, most)
    if held:
        return kept, True
    best, low, high = None, 0.0, most
    for _ in range(HALVINGS):
        size = (low + high) / 2
        kept, held = rake(tokens, codes, shares, size)
        if held:
            best, low = kept, size
        else:
            high = size
    return (best, True) if best is not None else (rake(tokens, codes, shares, wanted)[0], False)


def raised(tokens: np.ndarray, kept: np.ndarray, wanted: float) -> np.ndarray:
    """``kept`` times the one factor with which the sample holds ``wanted`` tokens, cells in full at most."""
    positive = kept > 0
    if not positive.any() or tokens[positive].sum() <= wanted:
        return np.where(positive, tokens, 0.0)
    full_at = tokens[positive] / kept[positive]
    order = np.argsort(full_at, kind="stable")
    in_full = np.concatenate([[0.0], np.cumsum(tokens[positive][order])[:-1]])
    open_still = np.cumsum(kept[positive][order][::-1])[::-1]
    holds = in_full + open_still * full_at[order]  # tokens of the sample when a cell gets full
    i = int(np.searchsorted(holds, wanted))
    factor = (wanted - in_full[i]) / open_still[i]
    return np.minimum(tokens, kept * factor)


def priced_cells(
    cells: DataFrame, targets: Targets | None, kept_share: float, temperature: float, lower_total: bool
) -> DataFrame:
    """The cells with ``weight``, ``probability``, and in each row the sample's ``sample_share``, ``residual``, ``held``.

    The cells are fitted on the driver, as a few arrays; their number is that of the combinations of categories met, not of
    documents.
    """
    table = cells.orderBy(*DIMENSIONS).toArrow()
    tokens = table["tokens"].to_numpy().astype(float)
    codes, shares = [], []
    for dim in DIMENSIONS:
        coded = table[dim].combine_chunks().dictionary_encode("encode")
        codes.append(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64))
        names = coded.dictionary.to_pylist()
        sums = np.bincount(codes[-1], tokens, minlength=len(names))
        shares.append(share_targets(sums, names, (targets or {}).get(dim), temperature))
    total = tokens.sum()
    kept, held = fitted(tokens, codes, shares, kept_share * total)
    weight = kept / (kept.sum() or 1.0)
    if not lower_total:
        kept = raised(tokens, kept, kept_share * total)
    chance = np.round(np.divide(kept, tokens, out=np.ones(len(tokens)), where=tokens > 0), 9)
    sample = tokens * chance
    whole = sample.sum() or 1.0
    off = [np.abs(np.bincount(code, sample, minlength=len(s)) / whole - s) for code, s in zip(codes, shares, strict=True)]
    residual = max((float(x.max()) for x in off if len(x)), default=0.0)
    facts = [sample.sum() / (total or 1.0), residual, held and residual <= HELD]
    made = {"weight": np.round(weight, 12), "probability": chance}
    made |= {k: np.full(len(tokens), v) for k, v in zip(("sample_share", "residual", "held"), facts, strict=True)}
    names = {f"c_{d}": table[d] for d in DIMENSIONS}
    schema = ", ".join(f"c_{d} string" for d in DIMENSIONS)
    schema += ", weight double, probability double, sample_share double, residual double, held boolean"
    return settle(cells.sparkSession.createDataFrame(pa.table(names | made), schema), "priced")


def mix(
    docs: DataFrame,
    targets: Targets | None = None,
    kept_share: float = KEPT_SHARE,
    temperature: float = TEMPERATURE,
    lower_total: bool = False,
) -> DataFrame:
    """Each document's cell, its calibrated ``probability`` and whether it is ``kept`` in the sample.

    The sample's tokens per source, language and topic are raked to the target shares of the three dimensions; a cell's
    documents are kept with the probability that gives its part of them. Asked for is ``kept_share`` of all tokens. Where
    the targets allow less, as a scarce category has too few tokens, ``lower_total`` says what gives way: the total, so
    that the targets hold; or else the targets, all cells being raised by one factor until ``kept_share`` is reached.
    ``cell_weight`` is the cell's share of the fitted sample before it is raised. Every row states the sample's expected
    share of all tokens (``sample_share``), the largest difference of a category's expected share from its target
    (``residual``), and whether the fit converged and its targets hold to ``HELD`` (``targets_held``).

    A null source or language is a category of its own; a category that given targets don't name keeps its tempered
    share; a document without tokens is kept if its cell is. Repeated rows
    are drawn alike; an empty table gives no rows; columns besides ``doc_id``, ``text``, ``source`` and ``lang`` are not
    read. What comes to the driver is a row per cell; the documents meet their cells in a join, whose hot cells the
    engine may split.
    """
    rows = tokened(docs)
    cells = settle(rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")), "cells")
    priced = priced_cells(cells, targets, kept_share, temperature, lower_total)
    same = [F.col(d).eqNullSafe(F.col(f"c_{d}")) for d in DIMENSIONS]
    joined = rows.join(priced, same[0] & same[1] & same[2])
    return joined.select(
        "doc_id",
        *DIMENSIONS,
        "n_tokens",
        F.col("weight").alias("cell_weight"),
        "probability",
        (F.col("draw") < F.col("probability")).alias("kept"),
        "sample_share",
        "residual",
        F.col("held").alias("targets_held"),
        "digest",
    )


def keep_mixed(
    docs: DataFrame, targets: Targets | None = None, kept_share: float = KEPT_SHARE, lower_total: bool = False
) -> DataFrame:
    """The documents that ``mix`` keeps, with all their columns. Edge cases as there; of rows equal in id and text all
    stay or none."""
    id_key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    kept = mix(docs, targets, kept_share, lower_total=lower_total).where("kept").select(id_key("doc_id").alias("id"), "digest").distinct()
    own = [F.col(c) for c in docs.columns]
    keyed = docs.select(F.struct(*own).alias("row"), id_key("doc_id").alias("id"), F.md5(whole_text()).alias("digest"))
    return keyed.join(kept, ["id", "digest"], "left_semi").select("row.*")
