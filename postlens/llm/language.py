"""Language identification by a linear-chain conditional random field over the words of a text."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from sys import maxunicode

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import ROLL, UNROLL, held_out, mixed, whole_text

UNKNOWN = "und"
# Bounds of the sample that the model is fitted on; nothing else is sampled.
LANGUAGES = 200  # most frequent values of ``lang`` that are learned
DOCUMENTS = 12_000  # sampled in all, an equal number of each language where it has as many
DOCUMENTS_EACH = 1_000  # sampled of one language, at most
WORDS_EACH = 60  # consecutive words of a sampled document, cut into pieces
PIECE = 20  # words of one language in a training sequence before another piece may follow
JOINED = 0.75  # chance that a piece goes on with the sequence of the piece before

BUCKETS = 1 << 15  # of hashed affixes and n-grams
AFFIXES, GRAMS = (1, 2, 3), (2, 3)
LEXICON_TIMES = 3  # occurrences in the sample that make a word part of the lexicon
STEPS, RATE, SHRINK = 60, 0.1, 2e-5
SPAN = 64  # words of a block in the two passes
WORDS_AT_ONCE = 1 << 17
LEAST_LOG = -30.0  # an emission's log below the word's best one

BEFORE, AFTER = 0x110000, 0x110001  # marks at both ends of a word
FACTORS = mixed(np.arange(1, 8, dtype=np.uint64)) | np.uint64(1)


# ---- words and their features ----------------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """By code point, whether its Unicode category is that of a letter."""
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(maxunicode + 1)])


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, dtype=np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


@dataclass
class Words:
    """The words of some texts: runs of letters, lower-cased."""

    codes: np.ndarray  # code points of all texts
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray  # words of each text

    def hashes(self) -> np.ndarray:
        n = 1 << max(16, int(len(self.codes)).bit_length())
        sums = np.zeros(len(self.codes) + 1, dtype=np.uint64)
        np.cumsum((self.codes.astype(np.uint64) + np.uint64(1)) * _powers(ROLL, n)[: len(self.codes)], out=sums[1:])
        return mixed((sums[self.ends] - sums[self.starts]) * _powers(UNROLL, n)[self.starts])


def words_in(texts: list[str]) -> Words:
    lowered = [text.lower() for text in texts]
    codes = np.frombuffer("\n".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    edges = np.diff(_letters()[codes].astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    borders = np.cumsum([0, *[len(text) + 1 for text in lowered]])
    return Words(codes, starts, ends, np.diff(np.searchsorted(starts, borders)))


def features(words: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the affixes and n-grams of some of the words, and the place in ``which`` of each one's word."""
    starts, sizes = words.starts[which], words.ends[which] - words.starts[which]
    first = np.cumsum(sizes + 2) - sizes - 2  # where a word, with a mark at both ends, begins
    marked = np.empty(int((sizes + 2).sum()), dtype=np.uint64)
    owner = np.repeat(np.arange(len(which)), sizes + 2)
    place = np.arange(len(marked)) - first[owner]
    inside = (place > 0) & (place <= sizes[owner])
    marked[inside] = words.codes[starts[owner[inside]] + place[inside] - 1]
    marked[first], marked[first + sizes + 1] = BEFORE, AFTER
    found, owners = [], []

    def gather(kind: int, size: int, at: np.ndarray, of: np.ndarray) -> None:
        key = np.full(len(at), kind * 8 + size, dtype=np.uint64)
        for i in range(size):
            key = (key + marked[at + i]) * FACTORS[i]
        found.append((mixed(key) % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(of)

    for size in GRAMS:
        fits = np.flatnonzero(place + size <= sizes[owner] + 2)
        gather(0, size, fits, owner[fits])
    for size in AFFIXES:
        long = np.flatnonzero(sizes >= size)
        gather(1, size, first[long] + 1, long)
        gather(2, size, first[long] + 1 + sizes[long] - size, long)
    return np.concatenate(found), np.concatenate(owners)


# ---- the model -------------------------------------------------------------------------------------------------------


@dataclass
class Model:
    languages: list[str]
    lexicon: np.ndarray  # sorted hashes of the lexicon's words
    known: np.ndarray  # weights of a lexicon word by language; the last row is for all other words
    hashed: np.ndarray  # weights of a bucket by language
    start: np.ndarray  # log weights of a text's first label
    moves: np.ndarray  # log weights of a label by the one before

    def place(self, hashes: np.ndarray) -> np.ndarray:
        """The row of ``known`` of each word."""
        if not len(self.lexicon):
            return np.zeros(len(hashes), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
        return np.where(self.lexicon[at] == hashes, at, len(self.lexicon))

    def emissions(self, rows: np.ndarray, bucket: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Sums of weights by distinct word and language."""
        out = self.known[rows].copy()
        for k in range(len(self.languages)):
            out[:, k] += np.bincount(owner, weights=self.hashed[bucket, k], minlength=len(rows))
        return out


def passes(model: Model, emitted: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward weights of every word and label, each scaled to sum to one, and the emissions' factors.

    All texts are one chain; at the words marked in ``first`` the label does not depend on the one before. The chain is
    cut into blocks of ``SPAN`` words. A block's words are first multiplied into one matrix, all blocks at once; these
    carry the weights from block to block; then all blocks are gone through at once again. So one very long text costs
    no more steps than many short ones.
    """
    n, k = emitted.shape
    blocks = -(-n // SPAN)
    move, begin = np.exp(model.moves - model.moves.max()), np.exp(model.start - model.start.max())
    factor = np.exp(np.maximum(emitted - emitted.max(1, keepdims=True), LEAST_LOG))
    held = np.ones((blocks * SPAN, k))
    held[:n] = factor
    held = held.reshape(blocks, SPAN, k)
    fresh = np.ones(blocks * SPAN, dtype=bool)
    fresh[:n] = first
    fresh = fresh.reshape(blocks, SPAN, 1)

    whole = np.tile(np.eye(k), (blocks, 1, 1))
    for t in range(SPAN):
        moved = np.where(fresh[:, t, :, None], whole.sum(2, keepdims=True) * begin, whole @ move)
        whole = moved * held[:, t, None, :]
        whole /= whole.max((1, 2), keepdims=True)
    into, out_of = np.empty((blocks, k)), np.empty((blocks, k))
    carried = np.full(k, 1 / k)
    for b in range(blocks):
        into[b] = carried
        carried = carried @ whole[b]
        carried = carried / carried.sum()
    carried = np.full(k, 1 / k)
    for b in reversed(range(blocks)):
        out_of[b] = carried
        carried = whole[b] @ carried
        carried = carried / carried.sum()

    forward, backward = np.empty_like(held), np.empty_like(held)
    now = into
    for t in range(SPAN):
        now = np.where(fresh[:, t], now.sum(1, keepdims=True) * begin, now @ move) * held[:, t]
        now = now / now.sum(1, keepdims=True)
        forward[:, t] = now
    now = out_of
    for t in reversed(range(SPAN)):
        backward[:, t] = now
        ahead = now * held[:, t]
        now = np.where(fresh[:, t], (ahead * begin).sum(1, keepdims=True), ahead @ move.T)
        now = now / now.sum(1, keepdims=True)
    return forward.reshape(-1, k)[:n], backward.reshape(-1, k)[:n], factor


def posteriors(forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
    both = forward * backward
    return both / both.sum(1, keepdims=True)


def slopes(model: Model, emitted: np.ndarray, first: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradient of the labels' log likelihood by each word's emissions, by the start weights and by the moves."""
    forward, backward, factor = passes(model, emitted, first)
    k = len(model.languages)
    likely = posteriors(forward, backward)
    by_word = -likely
    by_word[np.arange(len(labels)), labels] += 1
    by_start = by_word[first].sum(0)
    inner = np.flatnonzero(~first)
    move = np.exp(model.moves - model.moves.max())
    ahead = factor[inner] * backward[inner]
    scale = ((forward[inner - 1] @ move) * ahead).sum(1)
    expected = move * (forward[inner - 1].T @ (ahead / scale[:, None]))
    seen = np.bincount(labels[inner - 1] * k + labels[inner], minlength=k * k).reshape(k, k)
    return by_word, by_start, seen - expected


def fit(pieces: pd.DataFrame, seed: int = 0) -> Model:
    """The field fitted to pieces of text, each in one language (``lang``, ``text``), by full-batch gradient steps.

    The pieces are put in a random order, and most follow on the one before: the moves between languages are learned
    from such code-switched sequences.
    """
    languages = sorted(pieces["lang"].unique())
    order = np.random.default_rng(seed).permutation(len(pieces))
    texts, lang = pieces["text"].to_numpy()[order], pieces["lang"].to_numpy()[order]
    words = words_in(list(texts))
    labels = np.repeat(np.searchsorted(languages, lang), words.counts)
    starts = np.cumsum(words.counts) - words.counts
    own = np.random.default_rng(seed + 1).random(len(texts)) >= JOINED
    first = np.zeros(len(labels), dtype=bool)
    first[starts[own & (words.counts > 0)]] = True
    first[:1] = True
    hashes, which, of, times = np.unique(words.hashes(), return_index=True, return_inverse=True, return_counts=True)
    bucket, owner = features(words, which)
    lexicon, k = hashes[times >= LEXICON_TIMES], len(languages)
    model = Model(languages, lexicon, np.zeros((len(lexicon) + 1, k)), np.zeros((BUCKETS, k)), np.zeros(k), np.zeros((k, k)))
    rows = model.place(hashes)
    weights = [model.known, model.hashed, model.start, model.moves]
    mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, STEPS + 1):
        by_word, by_start, by_move = slopes(model, model.emissions(rows, bucket, owner)[of], first, labels)
        by_known, by_hashed = np.zeros_like(model.known), np.zeros_like(model.hashed)
        for j in range(k):
            distinct = np.bincount(of, weights=by_word[:, j], minlength=len(hashes))
            by_known[:, j] = np.bincount(rows, weights=distinct, minlength=len(by_known))
            by_hashed[:, j] = np.bincount(bucket, weights=distinct[owner], minlength=BUCKETS)
        for i, (weight, slope) in enumerate(zip(weights, (by_known, by_hashed, by_start, by_move), strict=True)):
            slope = slope / len(labels) - SHRINK * weight
            mean[i] = 0.9 * mean[i] + 0.1 * slope
            square[i] = 0.999 * square[i] + 0.001 * slope**2
            weight += RATE * (mean[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.999**step)) + 1e-8)
    return model


# ---- on tables -------------------------------------------------------------------------------------------------------


def training_pieces(docs: DataFrame) -> pd.DataFrame:
    """Pieces of consecutive words of a bounded sample of the documents that labels may be learned from.

    Documents are drawn by a hash of their id, about as many of each language; ``DOCUMENTS``, ``DOCUMENTS_EACH`` and
    ``WORDS_EACH`` bound what comes to the driver. The words begin at a hashed place of the text.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    usable = usable.select(F.col("lang").cast("string").alias("lang"), F.col("doc_id").cast("string").alias("id"), whole_text().alias("text"))
    counts = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    if not counts:
        return pd.DataFrame({"lang": [], "text": []})
    each = min(DOCUMENTS_EACH, DOCUMENTS // len(counts))
    chances = {r["lang"]: int(min(1.0, each / r["count"]) * (1 << 30)) for r in counts}
    chance = F.try_element_at(F.create_map(*[F.lit(x) for pair in chances.items() for x in pair]), F.col("lang"))
    draw = F.xxhash64("id")
    drawn = usable.withColumn("draw", draw).where(F.pmod("draw", F.lit(1 << 30)) < chance)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple[str, int, str]] = []
            for lang, draw, text in zip(batch["lang"], batch["draw"], batch["text"], strict=True):
                words = words_in([text])
                n = len(words.starts)
                at = (draw >> 30) % max(1, n - WORDS_EACH + 1)
                spell = lambda i, words=words: "".join(map(chr, words.codes[words.starts[i] : words.ends[i]]))
                told = [spell(i) for i in range(at, min(n, at + WORDS_EACH))]
                out += [(lang, draw, " ".join(told[i : i + PIECE])) for i in range(0, len(told), PIECE)]
            if out:
                yield pd.DataFrame(out, columns=["lang", "draw", "text"])

    most = 2 * each * len(counts) * -(-WORDS_EACH // PIECE)
    pieces = drawn.mapInPandas(cut, "lang string, draw long, text string")
    return pieces.orderBy("draw", "lang", "text").limit(most).toPandas()[["lang", "text"]]


def learned(docs: DataFrame) -> Model | None:
    """The model of these documents; none where no row may be learned from."""
    pieces = training_pieces(docs)
    return fit(pieces) if len(pieces) else None


def _labelled(model: Model, batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    """Some rows at a time, the number of words of each, and for each word the probabilities of the languages."""
    for batch in batches:
        sizes = batch["text"].str.len().to_numpy()
        group = np.cumsum(sizes) // (6 * WORDS_AT_ONCE)  # whole texts, of about so many letters together
        for start in np.flatnonzero(np.diff(group, prepend=-1)):
            end = np.searchsorted(group, group[start], side="right")
            part = batch.iloc[start:end]
            words = words_in(part["text"].tolist())
            if not len(words.starts):
                yield part, words.counts, np.zeros((0, len(model.languages)))
                continue
            hashes, which, of = np.unique(words.hashes(), return_index=True, return_inverse=True)
            emitted = model.emissions(model.place(hashes), *features(words, which))[of]
            first = np.zeros(len(of), dtype=bool)
            begins = np.cumsum(words.counts) - words.counts
            first[begins[words.counts > 0]] = True
            forward, backward, _ = passes(model, emitted, first)
            yield part, words.counts, posteriors(forward, backward)


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("string").alias("id"), held_out().alias("held_out"), whole_text().alias("text"))


def identify_languages(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every document.

    Each word's probabilities of the languages come from the field's forward and backward passes over the whole text; their
    mean over the words is the document's share of each language, the greatest share its prediction and score (of equal
    ones the first by name). Without a ``model`` one is fitted to these documents, from the text and non-null ``lang`` of
    a bounded sample of the rows that are not held out. A text that is null or has no letter gives ``und`` with score 0; so
    does every text where nothing can be learned. Null and repeated ids pass through, a row each; null ids are neither
    learned from nor held out. Texts are read whole, of any length. Columns besides ``doc_id``, ``text`` and ``lang`` are
    not read. An empty table gives no rows. Each row is worked on alone, so nothing is shuffled. What is broadcast is the
    model, some 2**15 weights and a lexicon of the sample for each of at most ``LANGUAGES`` languages.
    """
    model = learned(docs) if model is None else model
    if model is None:
        return docs.select("doc_id", held_out().alias("held_out"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def identify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for part, counts, likely in _labelled(model, batches):
            owner = np.repeat(np.arange(len(part)), counts)
            sums = np.stack([np.bincount(owner, weights=likely[:, k], minlength=len(part)) for k in range(len(names) - 1)], axis=1)
            shares = np.round(sums / np.maximum(counts, 1)[:, None], 9)
            best = np.where(counts > 0, shares.argmax(1), len(names) - 1)
            score = np.minimum(1.0, np.where(counts > 0, shares.max(1), 0.0))
            ids = pd.array([None if i is None else int(i) for i in part["id"]], dtype="Int64")
            yield pd.DataFrame({"doc_id": ids, "held_out": part["held_out"].to_numpy(), "lang_pred": names[best], "score": score})

    return _input(docs).mapInPandas(identify, "doc_id long, held_out boolean, lang_pred string, score double")


def language_spans(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id``, ``first_word``, ``last_word``, ``lang`` and mean ``score`` of each stretch of words in one language.

    Words are numbered from 0 within a document; each has the language that its probabilities favour. A text without
    letters has no stretch. Edge cases as in ``identify_languages``.
    """
    model = learned(docs) if model is None else model
    schema = "doc_id long, first_word long, last_word long, lang string, score double"
    if model is None:
        return docs.sparkSession.createDataFrame([], schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        names = np.array(model.languages, dtype=object)
        for part, counts, likely in _labelled(model, batches):
            if not len(likely):
                continue
            owner = np.repeat(np.arange(len(part)), counts)
            best = likely.argmax(1)
            begins = np.flatnonzero((np.diff(best, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
            sizes = np.diff(begins, append=len(best))
            text_start = (np.cumsum(counts) - counts)[owner[begins]]
            ids = [part["id"].iloc[i] for i in owner[begins]]
            yield pd.DataFrame(
                {
                    "doc_id": pd.array([None if i is None else int(i) for i in ids], dtype="Int64"),
                    "first_word": begins - text_start,
                    "last_word": begins + sizes - 1 - text_start,
                    "lang": names[best[begins]],
                    "score": np.add.reduceat(likely.max(1), begins) / sizes,
                }
            )

    return _input(docs).mapInPandas(spans, schema)
