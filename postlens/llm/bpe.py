"""BPE encoding and decoding; merges are found with a segment tree over the ranks of adjacent pairs."""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import whole_text

# What is white space to the tokenizer, the pattern that cuts normalised text into words, and the suffix of
# a word's last symbol.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


# Letters and numbers of Unicode 16, first and last code point of each range, and lower-case forms, for
# Python versions whose own tables end before it.
NEWER = {
    "L": [
        (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
        (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
        (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
        (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
    ],
    "N": [
        (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
        (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
    ],
}
NEWER_LOWER = {
    0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB,
    0xA7DC: 0x019B, **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}


def _category(first: str) -> str:
    """The ranges of the characters whose Unicode category begins with a letter, as the inside of a pattern's class."""
    has = np.array([unicodedata.category(chr(c))[0] == first for c in range(sys.maxunicode + 1)] + [False])
    for start, end in NEWER[first]:
        has[start : end + 1] = True
    edges = np.flatnonzero(np.diff(has.astype(np.int8), prepend=0)).reshape(-1, 2)
    return "".join(f"\\U{start:08x}-\\U{end - 1:08x}" for start, end in edges)


def _piece() -> re.Pattern:
    letter, number = _category("L"), _category("N")
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{SPACE}{letter}{number}]+")


PIECE = _piece()
ASCII_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
WORD_END = "</w>"

KNOWN_CHUNKS = 400_000  # encoded chunks a task keeps; past that it starts anew, which costs time only
CHUNKS_AT_ONCE = 20_000
TEXTS_AT_ONCE = 128
NONE = np.iinfo(np.int64).max
FEW_WORDS = 48  # words whose trees advance one after the other: array calls pay for many at once


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable Latin-1 ones for themselves, the rest from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Bpe:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        vocabulary = told["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.token = {i: t for t, i in (vocabulary | self.special).items()}
        self.decimal = {i: str(i) for i in self.token}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        symbols = byte_symbols()
        self.inner = np.array([vocabulary[s] for s in symbols], dtype=np.int64)
        self.final = np.array([vocabulary[s + WORD_END] for s in symbols], dtype=np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in told["model"]["merges"]]
        pairs = np.array([(vocabulary[a] << 32) + vocabulary[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(pairs, kind="stable")
        self.pairs, self.ranks = pairs[order], order
        self.merged = np.array([vocabulary[a + b] for a, b in merges], dtype=np.int64)
        self.rank_of = dict(zip(self.pairs.tolist(), self.ranks.tolist(), strict=True))
        self.merged_of = self.merged.tolist()
        self.ids: dict[str, str] = {}
        self.texts: dict[str, str] = {}

    # ---- words -------------------------------------------------------------------------------------------------------

    def _keys(self, left: np.ndarray, right: np.ndarray, place: np.ndarray, width: int) -> np.ndarray:
        """What the tree compares: rank first, then place; ``NONE`` where the pair does not merge."""
        pair = (left << 32) + right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        known = (self.pairs[at] == pair) & (left >= 0) & (right >= 0)
        return np.where(known, self.ranks[at] * width + place, NONE)

    def _merge(self, symbols: np.ndarray) -> None:
        """Merge each row's symbols in place, until no pair of a row merges; -1 marks what is no symbol.

        Row by row a segment tree holds the keys of the adjacent pairs: leaves at ``width`` and on, the least key at 1.
        Each round takes every row's root, merges there, and renews three leaves and the nodes above them.
        """
        rows, width = symbols.shape
        after = np.tile(np.arange(1, width + 1), (rows, 1))
        before = np.tile(np.arange(-1, width - 1), (rows, 1))
        tree = np.full((rows, 2 * width), NONE, dtype=np.int64)
        places = np.arange(width - 1)
        tree[:, width : 2 * width - 1] = self._keys(symbols[:, :-1], symbols[:, 1:], places, width)
        node = width
        while node > 1:
            tree[:, node // 2 : node] = np.minimum(tree[:, node : 2 * node : 2], tree[:, node + 1 : 2 * node : 2])
            node //= 2
        row = np.arange(rows)
        while True:
            row = row[tree[row, 1] != NONE]
            if not len(row):
                return
            rank, place = np.divmod(tree[row, 1], width)
            gone = after[row, place]
            follower, leader = after[row, gone], before[row, place]
            new = self.merged[rank]
            symbols[row, place], symbols[row, gone] = new, -1
            after[row, place] = follower
            inner, outer = follower < width, leader >= 0
            before[row[inner], follower[inner]] = place[inner]
            next_symbol = np.where(inner, symbols[row, np.minimum(follower, width - 1)], -1)
            last_symbol = np.where(outer, symbols[row, np.maximum(leader, 0)], -1)
            tree[row, width + gone] = NONE
            tree[row, width + place] = self._keys(new, next_symbol, place, width)
            tree[row[outer], width + leader[outer]] = self._keys(last_symbol, new, leader, width)[outer]
            touched = [width + gone, width + place, width + np.where(outer, leader, place)]
            while touched[0][0] > 1:
                for i in range(3):
                    up = touched[i] >> 1
                    tree[row, up] = np.minimum(tree[row, 2 * up], tree[row, 2 * up + 1])
                    touched[i] = up

    def _merge_one(self, symbols: list[int]) -> list[int]:
        """What ``_merge`` does, for one row and in plain whole numbers: a word of any length in some steps a merge."""
        n = len(symbols)
        width = 1 << max(1, (n - 1).bit_length())
        none, rank_of, merged_of = int(NONE), self.rank_of, self.merged_of
        tree = [none] * (2 * width)
        for i in range(n - 1):
            rank = rank_of.get((symbols[i] << 32) + symbols[i + 1])
            if rank is not None:
                tree[width + i] = rank * width + i
        for node in range(width - 1, 0, -1):
            a, b = tree[2 * node], tree[2 * node + 1]
            tree[node] = a if a < b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(place: int, key: int) -> None:
            node = width + place
            if tree[node] == key:
                return
            tree[node] = key
            node >>= 1
            while node:
                a, b = tree[2 * node], tree[2 * node + 1]
                least = a if a < b else b
                if tree[node] == least:
                    return
                tree[node] = least
                node >>= 1

        def renew(place: int, left: int, right: int) -> None:
            rank = rank_of.get((left << 32) + right)
            put(place, none if rank is None else rank * width + place)

        while tree[1] != none:
            rank, place = divmod(tree[1], width)
            gone = after[place]
            follower, leader, new = after[gone], before[place], merged_of[rank]
            symbols[place], symbols[gone], after[place] = new, -1, follower
            put(gone, none)
            if follower < n:
                before[follower] = place
                renew(place, new, symbols[follower])
            else:
                put(place, none)
            if leader >= 0:
                renew(leader, symbols[leader], new)
        return [s for s in symbols if s >= 0]

    def encode_words(self, words: list[str]) -> dict[str, list[int]]:
        """The token ids of each distinct word. Words of like length share one array."""
        out: dict[str, list[int]] = {}
        sized: dict[int, list[tuple[str, bytes]]] = {}
        for word in words:
            raw = word.encode("utf-8", "surrogatepass")
            sized.setdefault(max(1, (len(raw) - 1).bit_length()), []).append((word, raw))
        for bits, group in sized.items():
            step = max(1, (1 << 21) >> bits)  # bounds the arrays
            for start in range(0, len(group), step):
                part = group[start : start + step]
                if len(part) < FEW_WORDS:
                    for word, raw in part:
                        inner = self.inner[np.frombuffer(raw, np.uint8)].tolist()
                        inner[-1] = int(self.final[raw[-1]])
                        out[word] = self._merge_one(inner)
                    continue
                lengths = np.array([len(raw) for _, raw in part])
                symbols = np.full((len(part), 1 << bits), -1, dtype=np.int64)
                symbols[np.arange(1 << bits) < lengths[:, None]] = self.inner[np.frombuffer(b"".join(r for _, r in part), np.uint8)]
                last = np.array([raw[-1] for _, raw in part])
                symbols[np.arange(len(part)), lengths - 1] = self.final[last]
                self._merge(symbols)
                stays = symbols >= 0
                ends, flat, begin = np.cumsum(stays.sum(1)).tolist(), symbols[stays].tolist(), 0
                for (word, _), end in zip(part, ends, strict=True):
                    out[word] = flat[begin:end]
                    begin = end
        return out

    # ---- texts -------------------------------------------------------------------------------------------------------

    def chunks(self, text: str) -> list[str]:
        """The text cut at white space and around special tokens: nothing reaches from one chunk into the next."""
        pieces = self.cut.split(text) if "<|" in text else [text]
        out: list[str] = []
        for i, piece in enumerate(pieces):
            if i % 2:
                out.append(piece)
            elif re.search("[\x1c-\x1f]", piece):  # these are no white space to the tokenizer
                out += [c for c in re.split(f"[{SPACE}]+", piece) if c]
            else:
                out += piece.split()
        return out

    def learn(self, chunks: Iterable[str]) -> None:
        """Encode chunks that are not known, a bounded number at once."""
        new = list(chunks)
        for start in range(0, len(new), CHUNKS_AT_ONCE):
            part = new[start : start + CHUNKS_AT_ONCE]
            cut = {c: normal_words(c) for c in part if c not in self.special}
            known = self.encode_words(list({w for words in cut.values() for w in words}))
            for chunk in part:
                ids = [self.special[chunk]] if chunk in self.special else [i for w in cut[chunk] for i in known[w]]
                self.ids[chunk] = " ".join(map(self.decimal.__getitem__, ids))
                self.texts[chunk] = " ".join(map(self.token.__getitem__, ids))

    def encoded(self, texts: list[str]) -> list[tuple[str, str]]:
        """For each text its ids in decimal and its decoded form, both joined by blanks.

        The chunks that are new in all of these texts are encoded together, so that the trees of many words advance at
        once. Once ``KNOWN_CHUNKS`` are kept, all are forgotten.
        """
        if len(self.ids) > KNOWN_CHUNKS:
            self.ids.clear()
            self.texts.clear()
        cut = [self.chunks(text) for text in texts]
        self.learn({chunk for chunks in cut for chunk in chunks if chunk not in self.ids})
        id_of, text_of = self.ids.__getitem__, self.texts.__getitem__
        return [(" ".join(map(id_of, chunks)), " ".join(map(text_of, chunks))) for chunks in cut]

    def decoded(self, ids: Iterable[int]) -> str:
        """The tokens joined by blanks, as the file names no decoder; an unknown id adds nothing."""
        return " ".join(self.token[i] for i in ids if i in self.token)


def normal_words(chunk: str) -> list[str]:
    """A chunk's words: composed, lower-cased character by character, and cut by the pattern."""
    if chunk.isascii():
        return ASCII_PIECE.findall(chunk.lower())
    return PIECE.findall(unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower().translate(NEWER_LOWER))


@lru_cache(maxsize=4)
def loaded(path: str) -> Bpe:
    """The tokenizer of a file, read once in each worker."""
    return Bpe(path)


# ---- on tables -------------------------------------------------------------------------------------------------------




def _each(path: str, batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list[int | None], list[tuple[str, str]]]]:
    bpe = loaded(path)
    for batch in batches:
        for start in range(0, len(batch), TEXTS_AT_ONCE):
            part = batch.iloc[start : start + TEXTS_AT_ONCE]
            yield [i if i is None else int(i) for i in part["id"]], bpe.encoded(part["text"].tolist())


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("string").alias("id"), whole_text().alias("text"))


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``ids``, the token ids of the whole text as an array of int.

    As the tokenizers library encodes with the file at ``path`` without adding special tokens; those in a text are tokens
    all the same. A null or empty text, or one of white space, has none; a text of any length is encoded whole, also one
    that is a single word. Null and repeated ids pass through; columns
    besides ``doc_id`` and ``text`` are not read. Each row is worked on alone, so nothing is shuffled.
    """

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ids, found in _each(path, batches):
            yield pd.DataFrame({"doc_id": pd.array(ids, dtype="Int64"), "ids": [list(map(int, t.split())) for t, _ in found]})

    return _input(docs).mapInPandas(encode, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``text`` of rows with ``ids``: the tokens joined by blanks. Null ids give an empty text."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = loaded(path)
        for batch in batches:
            texts = [bpe.decoded(ids.tolist() if ids is not None else []) for ids in batch["ids"]]
            yield pd.DataFrame({"doc_id": batch["id"].astype("Int64"), "text": texts})

    return encoded.select(F.col("doc_id").cast("string").alias("id"), "ids").mapInPandas(decode, "doc_id long, text string")


def token_digests(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """What ``encode_documents`` and ``decode_documents`` give, as counts and digests: no ids leave the task.

    ``with_ids`` adds the ``ids`` themselves. Edge cases as in ``encode_documents``.
    """

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sha = lambda text: hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
        for ids, found in _each(path, batches):
            told = {
                "doc_id": pd.array(ids, dtype="Int64"),
                "n_tokens": [t.count(" ") + 1 if t else 0 for t, _ in found],
                "ids_sha256": [sha(t) for t, _ in found],
                "decoded_sha256": [sha(d) for _, d in found],
            }
            if with_ids:
                told["ids"] = [np.array(t.split(), dtype=np.int32) for t, _ in found]
            yield pd.DataFrame(told)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return _input(docs).mapInPandas(digest, schema)
