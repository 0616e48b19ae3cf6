"""Periodic runs of words, found online by catchers over completed power-of-two blocks of words."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import ROLL, mixed, whole_text

PERIODS = 4  # a run's length in periods, at least
LEAST = 6  # a run's length in words, at least
ROWS_AT_ONCE = 1024
WORDS_AT_ONCE = 1 << 17  # words of short documents that share one catcher; a longer document has its own
SECOND, THIRD = np.uint64(0xD6E8FEB86659FD93), np.uint64(ROLL)

Words = list[bytes]
Run = tuple[int, int, int]  # start, length, period


class _Grown:
    """An array that takes more values at its end."""

    def __init__(self, kind: type):
        self.held, self.size = np.zeros(256, dtype=kind), 0

    def add(self, values: np.ndarray) -> None:
        if self.size + len(values) > len(self.held):
            wider = np.zeros(max(2 * len(self.held), self.size + len(values)), dtype=self.held.dtype)
            wider[: self.size] = self.held[: self.size]
            self.held = wider
        self.held[self.size : self.size + len(values)] = values
        self.size += len(values)

    @property
    def all(self) -> np.ndarray:
        return self.held[: self.size]


def _named(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The name of two windows one after the other: a hash of their names that is linear in neither."""
    x = first * SECOND + second
    x ^= x >> np.uint64(32)
    x *= THIRD
    x ^= x >> np.uint64(29)
    return x


class SquareCatcher:
    """Finds all runs of a growing sequence of words, given as numbers.

    Level k cuts the sequence into blocks of 2**k words. A completed block is a catcher: it waits for its words to come
    again at a distance of 2**k to 2**(k+1) - 1, and every place is compared with the one block that waits for it there. A
    run of four periods holds two blocks in a row, at the level of its period, that come again at the period's distance.
    At the second of these a square is caught; it is followed to its left end at once and to its right end as words are
    appended. Windows of 2**k words are compared by names, made of the names of their halves, so each appended word costs
    a few steps a level. Multiples of a period give no squares of their own while the run of the period covers them.

    ``longest`` bounds the length of a run that there can be, and with it the levels.
    """

    def __init__(self, longest: int | None = None):
        self.longest = longest
        self.words = _Grown(np.int64)
        self.names: list[_Grown] = []  # by level: names of the windows that begin at each word
        self.again: list[_Grown] = []  # by level: whether the window is the block that waits for it
        self.covered = _Grown(np.int64)  # by word: period of a known run that holds it, else 0
        self.run_of = _Grown(np.int64)  # by word: start of that run
        self.open = np.zeros((3, 0), dtype=np.int64)  # starts, ends and periods of squares that reach the last word
        self.ended: dict[tuple[int, int], int] = {}  # start and end of a run: its period

    def append(self, words: np.ndarray) -> None:
        """Take more words, any number at once."""
        self.words.add(words)
        fresh = np.zeros(len(words), dtype=np.int64)
        self.covered.add(fresh)
        self.run_of.add(fresh)
        n = self.words.size
        most = n if self.longest is None else min(n, self.longest)
        while not self.names or PERIODS << len(self.names) <= most:
            self.names.append(_Grown(np.uint64))
            self.again.append(_Grown(np.bool_))
        for level, names in enumerate(self.names):
            known, all_windows = names.size, n - (1 << level) + 1
            if level == 0:
                names.add(mixed(self.words.all[known:].astype(np.uint64)))
            elif all_windows > known:
                half, below = 1 << (level - 1), self.names[level - 1].all
                names.add(_named(below[known:all_windows], below[known + half : all_windows + half]))
        if self.open.shape[1]:
            starts, ends, periods = self.open
            self._follow(starts, ends + self._right(ends, periods), periods)
        for level in range(len(self.names)):
            low, high, period = self._caught(level)
            if len(low):
                self._follow(low - self._left(low, period), high + self._right(high, period), period, add=True)

    def runs(self) -> list[Run]:
        """Start, length and period of the runs so far, by start and period; one that reaches the last word may grow yet."""
        found = dict(self.ended)
        for start, end, period in zip(*self.open.tolist(), strict=True):
            found[start, end] = min(period, found.get((start, end), period))
        words = self.words.all
        fine = []
        for (start, end), period in found.items():
            if end - start < max(LEAST, PERIODS * period):
                continue
            if np.array_equal(words[start + period : end], words[start : end - period]):  # names only hash the words
                fine.append((start, end - start, period))
        return sorted(fine, key=lambda run: (run[0], run[2]))

    def _caught(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """New squares of the level: first word, end and period of what is known of them."""
        names, again, size = self.names[level].all, self.again[level], 1 << level
        first, last = again.size, len(names)
        nothing = np.zeros(0, dtype=np.int64)
        if last <= first:
            return nothing, nothing, nothing
        blocks = np.arange((first >> level) - 1, (last - 1) >> level) << level
        waiting = np.repeat(names[np.maximum(blocks, 0)], size)[first & (size - 1) :][: last - first]
        new = names[first:] == waiting
        new[: max(0, size - first)] = False  # no block before these
        again.add(new)
        hits = first + np.flatnonzero(new)
        hits = hits[hits >= 2 * size]
        all_hits = again.all
        hits = hits[all_hits[hits - size]]
        hits = hits[~(all_hits[np.maximum(hits - 2 * size, 0)] & (hits >= 2 * size))]
        period = hits - (((hits >> level) - 1) << level)
        low, high = hits - period - size, hits + size
        whole = low >= 0
        low, high, period = low[whole], high[whole], period[whole]
        owner = self.covered.all[low]
        same = (owner > 0) & (self.covered.all[high - 1] == owner) & (self.run_of.all[low] == self.run_of.all[high - 1])
        new_ones = ~(same & (period % np.maximum(owner, 1) == 0))
        return low[new_ones], high[new_ones], period[new_ones]

    def _right(self, at: np.ndarray, period: np.ndarray) -> np.ndarray:
        """How many words from ``at`` on are those a period before."""
        out = np.zeros_like(at)
        for level in reversed(range(len(self.names))):
            names, size = self.names[level].all, 1 << level
            alive = np.arange(len(at))
            while len(alive):
                place = at[alive] + out[alive]
                fits = place < len(names)
                alive, place = alive[fits], place[fits]
                equal = names[place] == names[place - period[alive]]
                alive = alive[equal]
                out[alive] += size
        return out

    def _left(self, at: np.ndarray, period: np.ndarray) -> np.ndarray:
        """How many words before ``at`` are those a period after."""
        out = np.zeros_like(at)
        for level in reversed(range(len(self.names))):
            names, size = self.names[level].all, 1 << level
            alive = np.arange(len(at))
            while len(alive):
                place = at[alive] - out[alive] - size
                fits = place >= 0
                alive, place = alive[fits], place[fits]
                equal = names[place] == names[place + period[alive]]
                alive = alive[equal]
                out[alive] += size
        return out

    def _follow(self, starts: np.ndarray, ends: np.ndarray, periods: np.ndarray, add: bool = False) -> None:
        """Keep the squares that reach the last word; of the others, those that are runs. All are in their final place."""
        is_open = ends == self.words.size
        now = np.stack([starts, ends, periods])[:, is_open]
        if now.shape[1] > 1:  # squares of several multiples of a period: the least is the run's
            now = now[:, np.lexsort((now[2], now[0]))]
            now = now[:, np.diff(now[0], prepend=-1) != 0]
        self.open = np.concatenate([self.open, now], axis=1) if add else now
        long = ends - starts >= np.maximum(LEAST, PERIODS * periods)
        for start, end, period in zip(starts[long].tolist(), ends[long].tolist(), periods[long].tolist(), strict=True):
            if end < self.words.size:
                self.ended[start, end] = min(period, self.ended.get((start, end), period))
            if not self.covered.all[start] or self.covered.all[start] >= period:
                self.covered.all[start:end] = period
                self.run_of.all[start:end] = start


# ---- documents -------------------------------------------------------------------------------------------------------


def words_of(text: str) -> Words:
    """The runs of anything but blanks and the controls from tab to carriage return."""
    return text.encode("utf-8", "surrogatepass").split()


def runs_of(documents: list[Words]) -> list[list[Run]]:
    """The runs of each document. All go into one catcher, with a word between two documents that no other place has."""
    number: dict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    parts, starts, at = [], [], 0
    for i, words in enumerate(documents):
        starts.append(at)
        parts.append(np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words)))
        parts.append(np.array([-1 - i]))
        at += len(words) + 1
    catcher = SquareCatcher(max(map(len, documents), default=0))
    catcher.append(np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64))
    out: list[list[Run]] = [[] for _ in documents]
    for start, length, period in catcher.runs():
        owner = int(np.searchsorted(starts, start, side="right")) - 1
        out[owner].append((start - starts[owner], length, period))
    return out


def collapse(words: Words, runs: list[Run]) -> Words:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    stays = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        stays[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(stays)]


def planted(doc_id: int | None, words: Words) -> Words:
    """A tenth of the documents, by their id, with words from some place on made periodic."""
    if doc_id is None or not words:
        return words
    draw, last = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if last:
        return words
    start = draw % len(words)
    period = 1 + (len(words) - start) // (3 + draw % 8)
    head, cycle = words[:start], words[start : start + period]
    return head + [cycle[i % period] for i in range(len(words) - start)]


Rewrite = Callable[[int | None, Words], Words]


def _searched(
    batches: Iterator[pd.DataFrame], rewrite: Rewrite | None
) -> Iterator[tuple[list[int | None], list[Words], list[list[Run]]]]:
    """Ids, words and runs of some documents at a time, those of like length together."""
    for batch in batches:
        for first in range(0, len(batch), ROWS_AT_ONCE):
            part = batch.iloc[first : first + ROWS_AT_ONCE]
            ids = [i if i is None else int(i) for i in part["id"]]
            documents = [words_of(text) for text in part["text"]]
            if rewrite is not None:
                documents = [rewrite(i, words) for i, words in zip(ids, documents, strict=True)]
            group: list[int] = []
            room = WORDS_AT_ONCE
            for i in sorted(range(len(ids)), key=lambda i: len(documents[i])):
                if group and len(documents[i]) >= room:
                    yield _found(group, ids, documents)
                    group, room = [], WORDS_AT_ONCE
                group.append(i)
                room -= len(documents[i]) + 1
            if group:
                yield _found(group, ids, documents)


def _found(group: list[int], ids: list[int | None], documents: list[Words]):
    held = [documents[i] for i in group]
    return [ids[i] for i in group], held, runs_of(held)


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("string").alias("id"), whole_text().alias("text"))


def periodic_runs(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """``doc_id``, ``start``, ``length`` and ``period`` of every run of every document, a row each.

    A run is a stretch of words with smallest period q, four periods and six words long or more, that no neighbouring word
    continues. Edge cases as in ``run_report``.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ids, _, found in _searched(batches, rewrite):
            flat = [(i, *run) for i, runs in zip(ids, found, strict=True) for run in runs]
            out = pd.DataFrame(flat, columns=["doc_id", "start", "length", "period"])
            yield out.astype({"doc_id": "Int64"})

    return _input(docs).mapInPandas(rows, "doc_id long, start long, length long, period long")


def collapse_runs(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """``doc_id``, ``n_runs`` and ``text``, the kept words joined by one blank: of each run its first period stays."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ids, documents, found in _searched(batches, rewrite):
            texts = [b" ".join(collapse(*pair)).decode("utf-8", "surrogatepass") for pair in zip(documents, found, strict=True)]
            yield pd.DataFrame({"doc_id": pd.array(ids, dtype="Int64"), "n_runs": [len(r) for r in found], "text": texts})

    return _input(docs).mapInPandas(rows, "doc_id long, n_runs long, text string")


REPORT = """doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string,
    collapsed_sha256 string"""


def run_report(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """A row per document: how many runs, the longest one, and digests of all runs and of the collapsed text.

    Of equally long runs the first is told, then that of the smaller period; without a run ``start``, ``length``,
    ``period`` and ``exponent_milli`` are null. A null, empty or blank text has no words and so no run. Null and repeated
    ids pass through, a row each; a null id is never rewritten by ``planted``. Columns besides ``doc_id`` and ``text`` are
    not read; an empty table gives no rows. A text of any length is searched as a whole, in memory of some 17 bytes a word
    and level, of which there are as many as twos in a quarter of its words.
    """
    sha = lambda data: hashlib.sha256(data).hexdigest()

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ids, documents, found in _searched(batches, rewrite):
            best = [max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None) for runs in found]
            told = [[None if r is None else r[i] for r in best] for i in range(3)]
            yield pd.DataFrame(
                {
                    "doc_id": pd.array(ids, dtype="Int64"),
                    "n_runs": [len(runs) for runs in found],
                    "start": pd.array(told[0], dtype="Int64"),
                    "length": pd.array(told[1], dtype="Int64"),
                    "period": pd.array(told[2], dtype="Int64"),
                    "exponent_milli": pd.array([None if r is None else 1000 * r[1] // r[2] for r in best], dtype="Int64"),
                    "runs_sha256": [sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()) for runs in found],
                    "collapsed_sha256": [sha(b" ".join(collapse(*pair))) for pair in zip(documents, found, strict=True)],
                }
            )

    return _input(docs).mapInPandas(rows, REPORT)
