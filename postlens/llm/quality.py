"""Quality classifier: a regularised quadratic discriminant over statistics of the whole text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import held_out, settle, whole_text, word_hashes

THRESHOLD = 0.3
SHRINKAGE = 0.1  # weight of the class's mean variance against its own covariance
FLOOR = 0.05  # added to every variance, so that a statistic that hardly varies cannot decide alone
SMOOTHING = 50  # words or letters added to a text, so that shares of a short one are not extreme

# Kinds of bytes that are counted.
LOWER, UPPER, DIGIT, BLANK, LINE, STOP, SHOUT, BAR, SYMBOL, HIGH = range(10)
_KIND = np.full(256, SYMBOL, dtype=np.uint8)
for _kind, _bytes in (
    (LOWER, range(ord("a"), ord("z") + 1)),
    (UPPER, range(ord("A"), ord("Z") + 1)),
    (DIGIT, range(ord("0"), ord("9") + 1)),
    (BLANK, b" \t"),
    (LINE, b"\n\r\x0b\x0c"),
    (STOP, b".,;:'\"?-()"),
    (SHOUT, b"!"),
    (BAR, b"|"),
    (HIGH, range(128, 256)),
):
    _KIND[list(_bytes)] = _kind

STATISTICS = [
    "words", "upper", "digits", "lines", "stops", "shouts", "bars", "symbols", "word_length", "distinct", "top_word",
    "repeated", "echoes",
]


def statistics_of(text: str) -> np.ndarray:
    """The transformed statistics of a text: logarithms of sizes and of shares per word or letter."""
    kinds = np.bincount(_KIND[np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)], minlength=10)
    hashes = word_hashes(text)
    n = max(1, len(hashes))
    letters = max(1, kinds[LOWER] + kinds[UPPER] + kinds[HIGH])
    _, counts = np.unique(hashes, return_counts=True)
    repeated = np.count_nonzero(hashes[1:] == hashes[:-1])
    pairs = np.unique(hashes[1:] * np.uint64(3) + hashes[:-1])
    share = lambda x, of: np.log((x + 1) / (of + SMOOTHING))
    return np.array(
        [
            np.log1p(len(hashes)),
            share(kinds[UPPER], letters),
            share(kinds[DIGIT], n),
            share(kinds[LINE], n),
            share(kinds[STOP], n),
            share(kinds[SHOUT], n),
            share(kinds[BAR], n),
            share(kinds[SYMBOL], n),
            np.log(letters / n),
            share(len(counts), n),
            share(counts.max(initial=0), n),
            share(repeated, n),
            share(max(0, len(hashes) - 1 - len(pairs)), n),
        ]
    )


def with_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``stats`` of each document, settled: the only pass over the texts."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            stats = [statistics_of(text) for text in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "stats": stats})

    rows = docs.select(F.col("doc_id").cast("string").alias("id"), whole_text().alias("text"))
    measured = rows.mapInPandas(measure, "id string, stats array<double>")
    return settle(measured.select(F.col("id").cast("long").alias("doc_id"), "stats"), "text-statistics")


# ---- the model -------------------------------------------------------------------------------------------------------


@dataclass
class Discriminant:
    """Per class 0 and 1 its log prior, mean and the Cholesky factor of its shrunk covariance, kept for scoring."""

    log_priors: np.ndarray
    means: np.ndarray
    factors: np.ndarray

    def scores(self, stats: np.ndarray) -> np.ndarray:
        """The probability of class 1, from the difference of the classes' log densities."""
        density = np.empty((2, len(stats)))
        for c in (0, 1):
            apart = np.linalg.solve(self.factors[c], (stats - self.means[c]).T)
            density[c] = self.log_priors[c] - np.log(np.diag(self.factors[c])).sum() - (apart**2).sum(0) / 2
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def discriminant(counts: np.ndarray, sums: np.ndarray, squares: np.ndarray) -> Discriminant:
    """The model from each class's row count, sums and sums of products. A class without rows looks like the other."""
    dims = sums.shape[1]
    means, factors = np.zeros((2, dims)), np.zeros((2, dims, dims))
    for c in (0, 1):
        n, s, q = (x[c] if counts[c] else x.sum(0) for x in (counts, sums, squares))
        means[c] = s / max(n, 1)
        own = q / max(n, 1) - np.outer(means[c], means[c])
        own = (1 - SHRINKAGE) * own + SHRINKAGE * np.diag(np.diag(own))
        factors[c] = np.linalg.cholesky(own + FLOOR * np.eye(dims))
    return Discriminant(np.log((counts + 1) / (counts.sum() + 2)), means, factors)


def fit(stats: DataFrame, labels: DataFrame) -> Discriminant:
    """The model from all labelled rows that are not held out.

    Each task adds up what it has; per class one row of sums comes back, whatever the number of rows.
    """
    dims = len(STATISTICS)

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, 1 + dims + dims * dims))
        for batch in batches:
            x, y = np.stack(batch["stats"]) if len(batch) else np.zeros((0, dims)), batch["quality"].to_numpy()
            for c in (0, 1):
                own = x[y == c]
                total[c] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
        yield pd.DataFrame({"quality": [0, 1], "moments": list(total)})

    known = labels.where(F.col("quality").isin(0, 1) & ~held_out()).select(
        F.col("doc_id").alias("labelled"), F.col("quality").cast("int").alias("quality")
    )
    rows = stats.join(known, F.col("doc_id") == F.col("labelled")).select("stats", "quality")
    parts = rows.mapInPandas(add_up, "quality int, moments array<double>").select(
        "quality", F.posexplode("moments").alias("place", "value")
    )
    total = np.zeros((2, 1 + dims + dims * dims))
    for row in parts.groupBy("quality", "place").agg(F.sum("value").alias("value")).collect():
        total[row.quality, row.place] = row.value
    return discriminant(total[:, 0], total[:, 1 : 1 + dims], total[:, 1 + dims :].reshape(2, dims, dims))


def scored(stats: DataFrame, model: Discriminant) -> DataFrame:
    """``doc_id`` and ``score`` of every row of statistics."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"id": batch["id"], "score": model.scores(np.stack(batch["stats"]))})

    narrow = stats.select(F.col("doc_id").cast("string").alias("id"), "stats")
    return narrow.mapInPandas(score, "id string, score double").select(F.col("id").cast("long").alias("doc_id"), "score")


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Each document's ``score`` for good quality and what follows from it.

    ``labels`` has ``doc_id`` and ``quality`` 0 or 1; other values, and rows held out (crc32 of the id as text, modulo 5,
    is 0), are not learned from. Scores come from statistics of the whole text alone. A null text counts as empty, and
    an empty one is scored like any other. A null id is not held out. Without labels of a class, both classes look alike
    and the score is their prior. Repeated ids are scored each and, if labelled, learned from each; columns besides
    ``doc_id``, ``text`` and ``quality`` are not read. An empty table gives no rows.
    """
    stats = with_statistics(docs)
    rows = scored(stats, fit(stats, labels))
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)
    return rows.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with all their columns. Edge cases as in ``score_quality``.

    The model is fitted in one pass over the texts; the second pass, which keeps or drops, needs no join and no shuffle.
    """
    model = fit(with_statistics(docs), labels)

    def pick(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype="float64")
        return pd.Series(model.scores(np.stack([statistics_of(text) for text in texts])))

    score = F.pandas_udf(pick, "double")
    return docs.where(score(whole_text()) >= THRESHOLD)
