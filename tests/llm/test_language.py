"""Language identification: the two passes against enumeration, the gradient, accuracy and edge cases."""

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from postlens.llm import language


def small_model(k=3, seed=0):
    rng = np.random.default_rng(seed)
    return language.Model(list("abc")[:k], np.zeros(0, np.uint64), rng.normal(size=(1, k)), np.zeros((language.BUCKETS, k)), rng.normal(size=k), rng.normal(size=(k, k)))


def path_weights(model, emitted):
    """The log weight of every labelling of one text."""
    out = {}
    for labels in itertools.product(range(len(model.languages)), repeat=len(emitted)):
        total = model.start[labels[0]] + sum(model.moves[a, b] for a, b in itertools.pairwise(labels))
        out[labels] = total + sum(e[y] for e, y in zip(emitted, labels, strict=True))
    return out


def plain_posteriors(model, emitted):
    told = path_weights(model, emitted)
    whole = sum(map(np.exp, told.values()))
    out = np.zeros_like(emitted)
    for labels, total in told.items():
        out[np.arange(len(labels)), labels] += np.exp(total) / whole
    return out


def test_passes_are_the_sum_over_all_labellings():
    model, rng = small_model(), np.random.default_rng(1)
    sizes = [1, 5, 2, 7, 6, 1, 1, 7] * 6  # texts across the borders of blocks
    emitted = rng.normal(size=(sum(sizes), 3)) * 2
    first = np.zeros(sum(sizes), dtype=bool)
    first[np.cumsum(sizes) - sizes] = True
    forward, backward, _ = language.passes(model, emitted, first)
    wanted = np.concatenate([plain_posteriors(model, part) for part in np.split(emitted, np.cumsum(sizes)[:-1])])
    assert np.allclose(language.posteriors(forward, backward), wanted)


def test_slopes_are_the_gradient():
    model, rng = small_model(), np.random.default_rng(2)
    emitted, labels = rng.normal(size=(6, 3)), np.array([0, 2, 1, 1, 0, 2])
    first = np.array([True, False, False, True, False, False])

    def likelihood(model, emitted):
        total = 0.0
        for part in (slice(0, 3), slice(3, 6)):
            told = path_weights(model, emitted[part])
            total += told[tuple(labels[part])] - np.log(sum(map(np.exp, told.values())))
        return total

    slopes = language.slopes(model, emitted, first, labels)
    for array, slope in zip((emitted, model.start, model.moves), slopes, strict=True):
        for place in np.ndindex(array.shape):
            kept = array[place]
            array[place] = kept + 1e-5
            above = likelihood(model, emitted)
            array[place] = kept - 1e-5
            below = likelihood(model, emitted)
            array[place] = kept
            assert abs((above - below) / 2e-5 - slope[place]) < 1e-6


def test_words_and_features():
    words = language.words_in(["Ab1c É_ß", "", "x'y ½²", "中文 ab"])
    spelt = ["".join(map(chr, words.codes[s:e])) for s, e in zip(words.starts, words.ends, strict=True)]
    assert spelt == ["ab", "c", "é", "ß", "x", "y", "中文", "ab"] and words.counts.tolist() == [4, 0, 2, 2]
    assert len(set(words.hashes().tolist())) == 7 and words.hashes()[0] == words.hashes()[7]
    bucket, owner = language.features(words, np.array([0, 1, 7]))
    by_word = [sorted(bucket[owner == i].tolist()) for i in range(3)]
    assert by_word[0] == by_word[2]
    assert [len(b) for b in by_word] == [3 + 2 + 4, 2 + 1 + 2, 9]  # bigrams, trigrams, affixes


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(small):
    return language.learned(small)


def test_held_out_accuracy(small, model):
    rows = language.identify_languages(small, model).join(small.select("doc_id", "lang"), "doc_id").collect()
    unseen = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and len(unseen) > 150
    assert np.mean([r.lang == r.lang_pred for r in unseen]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_held_out_are_not_learned(small, model):
    hidden = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, "xx").otherwise(F.col("lang"))
    again = language.learned(small.withColumn("lang", hidden).withColumn("source", F.lit("other")).repartition(5))
    assert again.languages == model.languages
    assert np.allclose(again.hashed, model.hashed) and np.allclose(again.moves, model.moves)


def test_code_switched_text(spark, small, model):
    """Halves of documents of two languages in one text: the spans meet where the languages do."""
    clean = small.where("length(text) BETWEEN 600 AND 4000").orderBy("doc_id").collect()
    by_lang = {lang: [r.text[:500].rsplit(" ", 1)[0] for r in clean if r.lang == lang][:12] for lang in ("en", "fr", "de", "es")}
    texts, wanted = [], []
    for (a, first), (b, second) in itertools.permutations(by_lang.items(), 2):
        for one, two in zip(first, second, strict=False):
            counts = language.words_in([one, two]).counts
            texts.append(f"{one} {two}")
            wanted.append([a] * counts[0] + [b] * counts[1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    told = [[None] * len(w) for w in wanted]
    for r in language.language_spans(docs, model).collect():
        told[r.doc_id][r.first_word : r.last_word + 1] = [r.lang] * (r.last_word - r.first_word + 1)
    assert [len(t) for t in told] == [len(w) for w in wanted] and all(None not in t for t in told)
    right = np.mean([a == b for t, w in zip(told, wanted, strict=True) for a, b in zip(t, w, strict=True)])
    assert right > 0.95


def test_edges(spark, edge_docs, no_docs, model):
    wide = edge_docs.withColumn("held_out", F.lit("clash")).withColumn("lang_pred", F.lit(1))
    got = language.identify_languages(wide, model).collect()
    assert len(got) == 13
    assert {r.lang_pred for r in got if r.doc_id in (3, 4, 5)} == {"und"} and {r.score for r in got if r.doc_id in (3, 4, 5)} == {0.0}
    assert all(r.lang_pred == "en" for r in got if r.doc_id in (0, 1, 2))
    assert len({(r.lang_pred, r.score) for r in got if r.doc_id == 0}) == 1
    assert {r.held_out for r in got if r.doc_id is None} == {False}
    assert language.identify_languages(no_docs).count() == 0 == language.language_spans(no_docs).count()
    nothing = language.identify_languages(edge_docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in nothing.collect()} == {("und", 0.0)}
    one = language.identify_languages(edge_docs)
    assert {r.lang_pred for r in one.collect()} == {"en", "und"}


def test_many_languages_and_a_hot_one(spark):
    rows = [(i, f"{chr(97 + i % 20) * 4} {chr(97 + i % 20) * 3}x " * 12, f"l{i % 20:02d}") for i in range(2_000)]
    rows += [(10_000 + i, "hot words here " * 20, "hot") for i in range(4_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    pieces = language.training_pieces(docs)
    assert pieces.groupby("lang").size().max() <= 2 * language.DOCUMENTS // 21 * 3
    got = language.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("lang = lang_pred").count()
    assert got == 6_000


def test_fit_needs_no_more_than_one_piece():
    model = language.fit(pd.DataFrame({"lang": ["a"], "text": ["one two"]}))
    assert model.languages == ["a"]
