"""Ranked lexical search by scanning the documents with an Aho-Corasick automaton of the items' terms."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import settle, whole_text

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GUARD = " "  # stands around every term, in the patterns as in the text
ENTRIES_PER_BLOCK = 50_000  # terms of items that one automaton and one scan of the documents take, on average
CELLS_AT_ONCE = 1 << 22  # scores held at once in a task
EXACT = 1 << 53  # sums of whole numbers below this are exact in doubles

# One byte each: A-Z lower-cased, letters, digits and parts of characters outside ASCII as they are, all else the guard.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else ord(GUARD) for b in range(256)
)


def guarded(text: str) -> tuple[str, int]:
    """The text's terms, each between guards, neighbours sharing one, and how many they are."""
    terms = text.encode("utf-8", "surrogatepass").translate(_FOLD).split()
    joined = b" ".join(terms).decode("utf-8", "surrogatepass")
    return f"{GUARD}{joined}{GUARD}", len(terms)


def automaton(terms: list[str]) -> ahocorasick.Automaton:
    """The automaton of the guarded terms; each puts out its number. As guards don't occur in terms, a match is a whole
    term, and no two matches end at one place."""
    out = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        out.add_word(f"{GUARD}{term}{GUARD}", number)
    out.make_automaton()
    return out


def terms_of(column: str) -> Column:
    """The terms of a text column, A-Z lower-cased, in order."""
    return F.regexp_extract_all(F.translate(whole_text(column), UPPER, LOWER), F.lit(TERM), F.lit(0))


def item_terms(items: DataFrame, entries: int) -> DataFrame:
    """``item_id``, ``term``, ``times`` and the item's ``block``, settled.

    Texts under one id are one item together, rows equal in id and text count once. Blocks are drawn by a hash of the id,
    so many that one holds ``entries`` terms of items on average; an item is never cut.
    """
    said = items.select(F.col("item_id").alias("item_id"), whole_text().alias("text")).distinct()
    counted = said.select("item_id", F.explode(terms_of("text")).alias("term")).groupBy("item_id", "term")
    counted = settle(counted.agg(F.count("*").alias("times")), "item-terms")
    blocks = max(1, -(-counted.count() // entries))
    return counted.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))


def scanned(docs: DataFrame, terms: list[str]) -> DataFrame:
    """A row per document, settled: ``doc_id``, its length ``n`` in terms, the numbers of the searched terms in it, and
    how often each occurs. The text is read once, and nothing of it but these counts is kept."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        searched = automaton(shared.value)
        for batch in batches:
            for start in range(0, len(batch), 1024):
                part = batch.iloc[start : start + 1024]
                lengths, numbers, times = [], [], []
                for text in part["text"]:
                    told, n = guarded(text)
                    found = Counter(map(itemgetter(1), searched.iter(told)) if shared.value else ())
                    lengths.append(n)
                    numbers.append(np.fromiter(found.keys(), np.int32, len(found)))
                    times.append(np.fromiter(found.values(), np.int64, len(found)))
                yield pd.DataFrame({"id": part["id"], "n": lengths, "numbers": numbers, "times": times})

    rows = docs.select(F.col("doc_id").cast("string").alias("id"), whole_text().alias("text"))
    out = rows.mapInPandas(scan, "id string, n long, numbers array<int>, times array<long>")
    return settle(out.select(F.col("id").cast("long").alias("doc_id"), "n", "numbers", "times"), "term-counts")


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    """A term's whole-number weight by the number of documents that hold it."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)


def best_documents(counts: DataFrame, queries: list[tuple[int, dict[int, int]]], weight: np.ndarray, n: int, total: int, k: int) -> DataFrame:
    """Each task's ``k`` best documents of each query: ``query``, ``doc_id``, ``score``.

    A query is its number and how often it holds each term. The scores of some documents and all queries are one product
    of whole numbers, in doubles as long as no sum reaches 2**53. Only what reaches the k-th score so far is kept.
    """
    shared = counts.sparkSession.sparkContext.broadcast((queries, weight))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked, weight = shared.value
        wanted = np.zeros((len(asked), len(weight)))
        for i, (_, times) in enumerate(asked):
            wanted[i, list(times)] = list(times.values())
        most = wanted.sum(1).max(initial=0) * float(weight.max(initial=0)) * 1_000_000
        wanted = wanted if most < EXACT else wanted.astype(np.int64).astype(object)
        numbers = np.array([number for number, _ in asked])
        step = max(1, min(4096, CELLS_AT_ONCE // max(1, len(asked) + len(weight))))
        held = [np.zeros(0, dtype=np.int64) for _ in range(4)]  # query, score, id, whether it has none
        floor = np.ones(len(asked), dtype=np.int64)
        for batch in batches:
            for start in range(0, len(batch), step):
                part = batch.iloc[start : start + step]
                sizes = part["numbers"].map(len).to_numpy()
                if not sizes.sum():
                    continue
                term, tf = (np.concatenate(part[c].to_numpy()).astype(np.int64) for c in ("numbers", "times"))
                owner = np.repeat(np.arange(len(part)), sizes)
                m = 75 + 25 * part["n"].to_numpy(np.int64) * n // total
                parts = weight[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[owner]))
                cells = np.zeros((len(weight), len(part)), dtype=wanted.dtype)
                cells[term, owner] = parts
                scores = (wanted @ cells).astype(np.int64)
                query, doc = np.nonzero(scores >= floor[:, None])
                ids = part["id"].to_numpy()[doc]
                none = pd.isna(ids)
                new = [query, scores[query, doc], np.where(none, 0, ids).astype(np.int64), none.astype(np.int64)]
                held = [np.concatenate(pair) for pair in zip(held, new, strict=True)]
                if len(held[0]) > 4 * k * max(1, len(asked)):
                    held, floor = _best(held, floor, k)
        held, _ = _best(held, floor, k)
        ids = pd.array(held[2], dtype="Int64")
        ids[held[3] == 1] = pd.NA
        yield pd.DataFrame({"query": numbers[held[0]], "doc_id": ids, "score": held[1]})

    rows = counts.where(F.size("numbers") > 0).select(F.col("doc_id").cast("string").alias("id"), "n", "numbers", "times")
    return rows.mapInPandas(score, "query long, doc_id long, score long")


def _best(held: list[np.ndarray], floor: np.ndarray, k: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The k best rows of each query, and the least score that can still get among them."""
    query, score, ids, none = held
    order = np.lexsort((ids, none, -score, query))
    held = [x[order] for x in held]
    place = np.arange(len(order)) - np.searchsorted(held[0], held[0])
    held = [x[place < k] for x in held]
    floor = floor.copy()
    last = place[place < k] == k - 1
    floor[held[0][last]] = held[1][last]
    return held, floor


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, entries: int = ENTRIES_PER_BLOCK) -> DataFrame:
    """The ``k`` highest-scoring documents of each item: ``item_id``, ``rank``, ``doc_id``, ``score``.

    Terms are runs of ASCII letters and digits and of anything outside ASCII, with A-Z lower-cased. A term of the item
    adds ``weight * (10**9 * tf div (1000 * tf + 12 * m))`` as often as the item holds it, where ``m`` is
    ``75 + 25 * n * N div L``. Only scores above 0 count; equal ones go by ``doc_id``, null ids last.

    The items are searched in blocks of a bounded number of terms; each block scans all documents once, with its terms in
    one broadcast automaton, and no index of the documents is made. What comes to the driver is a block's terms and their
    counts of documents, a bounded number as well; an item by itself is a row and is not cut. A task keeps ``k`` documents
    an item.

    A null or empty text has no term: such an item has no rows, such a document scores 0 and counts for neither N nor L.
    Texts under one ``item_id`` (also a null one) are one item, rows equal in id and text count once; rows with repeated
    ``doc_id`` are documents each. Texts are scanned whole, of any length. Columns besides ids and texts are not read.
    Empty tables give no rows.
    """
    spark = docs.sparkSession
    told = item_terms(items, entries)
    out = spark.createDataFrame([], told.select("item_id").schema.add("doc_id", "long").add("score", "long"))
    for (block,) in sorted(told.select("block").distinct().collect()):
        mine = told.where(F.col("block") == block)
        rows = [(r.item_id, r.term, r.times) for r in mine.select("item_id", "term", "times").collect()]
        terms = sorted({term for _, term, _ in rows})
        number = {term: i for i, term in enumerate(terms)}
        counts = scanned(docs, terms)
        n, total = counts.where("n > 0").agg(F.count("*"), F.sum("n")).first()
        if not n:
            return out.select("item_id", F.lit(0).alias("rank"), "doc_id", "score")
        df = np.zeros(len(terms), dtype=np.int64)
        for i, documents in counts.select(F.explode("numbers").alias("i")).groupBy("i").count().collect():
            df[i] = documents
        queries: dict[object, dict[int, int]] = {}
        for item, term, times in rows:
            queries.setdefault(item, {})[number[term]] = times
        ids = list(queries)
        best = best_documents(counts, [(i, queries[item]) for i, item in enumerate(ids)], weights(df, n), n, total, k)
        names = spark.createDataFrame(list(enumerate(ids)), told.select(F.lit(0).cast("long").alias("query"), "item_id").schema)
        out = out.union(best.join(F.broadcast(names), "query").select("item_id", "doc_id", "score"))  # a block's items
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
