"""Ranked search: the automaton's counts, and the ranking against a plain one."""

import math
import re

import pytest
from pyspark.sql import functions as F

from postlens.llm import lexical

LOWERED = str.maketrans(lexical.UPPER, lexical.LOWER)


def plain_terms(text):
    return re.findall(lexical.TERM, (text or "").translate(LOWERED))


def plain_search(docs, items, k):
    """Item, rank, document and score of the contract's formulas, one document and item at a time."""
    found = [(i, plain_terms(text)) for i, text in docs]
    held = [(i, terms) for i, terms in found if terms]
    n, total = len(held), sum(len(terms) for _, terms in held)
    out = []
    for item in {i for i, _ in items}:
        terms = [t for i, text in set(items) if i == item for t in plain_terms(text)]
        weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * sum(t in w for _, w in held) + 1))) for t in set(terms)}
        scored = []
        for doc, words in held:
            m = 100 - 25 + 25 * len(words) * n // total
            score = sum(weight[t] * (10**9 * words.count(t) // (1000 * words.count(t) + 12 * m)) for t in terms)
            if score > 0:
                scored.append((-score, doc is None, doc))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, rank, doc, -minus) for rank, (minus, _, doc) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def test_automaton_counts_whole_terms():
    terms = ["a", "ab", "b", "é中", "9"]
    searched = lexical.automaton(terms)
    text = "A ab,abb-B b b\x00aa Éé中 é中 É 9 99"
    told, n = lexical.guarded(text)
    assert n == len(plain_terms(text)) == 12
    found = [i for _, i in searched.iter(told)]
    assert {t: found.count(i) for i, t in enumerate(terms)} == {t: plain_terms(text).count(t) for t in terms}
    assert lexical.guarded("") == ("  ", 0) == lexical.guarded(" .,\n")


@pytest.mark.parametrize("entries", [lexical.ENTRIES_PER_BLOCK, 12])
def test_search_is_the_plain_ranking(spark, edge_docs, entries):
    """In one block of items and in many, with ties, repeated words, ids and rows, and null ids on both sides."""
    rows = [(i, f"alpha beta w{i % 5} " + "beta " * (i % 4)) for i in range(60)] + [(i, "Gamma delta") for i in (91, 90, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x"))
    docs = docs.unionByName(edge_docs.where("doc_id NOT IN (6, 7)").select("doc_id", "text").withColumn("score", F.lit("y")))
    asked = [(1, "beta BETA w3 unseen"), (1, "beta BETA w3 unseen"), (2, "delta"), (3, None), (4, "..."), (5, "the fox CC"), (6, "river")]
    asked += [(None, "alpha w1"), (7, "gamma"), (7, "w2 w2"), (8, "nothing")]
    items = spark.createDataFrame(asked, "item_id long, text string").withColumn("doc_id", F.lit(7))
    got = sorted((tuple(r) for r in lexical.ranked_search(docs, items, 6, entries).collect()), key=repr)
    assert got == plain_search([(r.doc_id, r.text) for r in docs.collect()], asked, 6)
    assert [r[2] for r in got if r[0] == 2] == [90, 91, None]


def test_search_on_the_small_table(spark):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    items = items.limit(8)
    got = sorted((tuple(r) for r in lexical.ranked_search(docs, items).collect()), key=repr)
    wanted = plain_search([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()], 20)
    assert got == wanted


def test_very_long_texts_and_large_scores(spark):
    rows = [(1, "x " * 400_000 + "y"), (2, "y"), (3, "z")]
    asked = [(1, "y " * 300_000), (2, "x")]
    docs, items = (spark.createDataFrame(r, s) for r, s in ((rows, "doc_id long, text string"), (asked, "item_id long, text string")))
    got = sorted(tuple(r) for r in lexical.ranked_search(docs, items).collect())
    n, total = 3, 400_003
    weight = {"x": math.floor(1000 * math.log(8 / 3)), "y": math.floor(1000 * math.log(8 / 5))}
    one = lambda tf, size: 10**9 * tf // (1000 * tf + 12 * (75 + 25 * size * n // total))
    wanted = [(1, 1, 2, 300_000 * weight["y"] * one(1, 1)), (1, 2, 1, 300_000 * weight["y"] * one(1, 400_001))]
    assert got == [*wanted, (2, 1, 1, weight["x"] * one(400_000, 400_001))]


def test_empty_tables(spark, no_docs):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    some = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    blank = spark.createDataFrame([(1, None), (2, "..")], "doc_id long, text string")
    for docs, asked in ((no_docs, items), (some, items.limit(0)), (blank, items)):
        out = lexical.ranked_search(docs, asked)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0
