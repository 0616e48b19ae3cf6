"""License scan by votes of word pairs on the diagonals between a document and the templates, with verified spans.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import settle, whole_text

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 2  # words in a rolling gram, the length of the shortest phrase
GAP = 3  # diagonals on either side of a span's middle: words put in or left out within it
LEAST_COVER = 0.75  # share of a template's grams that a span has to show in order

# Base phrases, every place of which counts, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Notices and whole bodies of common licenses, and their labels; words as the scan cuts them.
TEMPLATES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under a creative commons attribution": "cc-by",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    # the permission notice and disclaimer of the MIT license
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice "
    "and this permission notice shall be included in all copies or substantial portions of the software the software is "
    "provided as is without warranty of any kind express or implied including but not limited to the warranties of "
    "merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright "
    "holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise "
    "arising from out of or in connection with the software or the use or other dealings in the software": "mit",
    # the permission and disclaimer of the ISC license
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
    "provided that the above copyright notice and this permission notice appear in all copies the software is provided as "
    "is and the author disclaims all warranties with regard to this software including all implied warranties of "
    "merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential "
    "damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract "
    "negligence or other tortious action arising out of or in connection with the use or performance of this "
    "software": "isc",
}


def words_of() -> Column:
    """The words of the whole text, A-Z lower-cased, in order."""
    return F.regexp_extract_all(F.translate(whole_text(), UPPER, LOWER), F.lit(WORD), F.lit(0))


def template_grams(spark: SparkSession, templates: dict[str, str] | None = None) -> DataFrame:
    """A row per gram of each phrase and template: its place, its words and their hash.

    Templates are given constants of any length; the table has a row per word of them.
    """
    rows = []
    for base, phrases in ((True, BASE), (False, TEMPLATES if templates is None else templates)):
        for phrase, label in phrases.items():
            words = phrase.split()
            if len(words) < GRAM:
                raise ValueError(f"a template of fewer than {GRAM} words: {phrase!r}")
            for i in range(len(words) - GRAM + 1):
                rows.append((len(rows) - i, base, label, len(words) - GRAM + 1, i, words[i], words[i + 1]))
    grams = spark.createDataFrame(rows, "template int, base boolean, label string, n_grams int, place int, t0 string, t1 string")
    return grams.withColumn("gram", F.xxhash64("t0", "t1"))


def gram_hits(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """A row per document, settled: ``doc_id``, ``key`` (digest of the text), ``n_words`` and ``hits``.

    Hits are the places of the text's grams whose hash is that of some template gram, with their two words. The text is
    cut into words once, and grams that no template has are left out within the row.
    """
    known = [row.gram for row in grams.select("gram").distinct().collect()]  # constants
    words = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(whole_text()).alias("key"), words_of().alias("words"))
    pairs = F.when(F.size("words") >= GRAM, F.sequence(F.lit(0), F.size("words") - GRAM)).otherwise(F.array().cast("array<int>"))
    word = lambda i: F.get("words", i)
    at = F.filter(pairs, lambda i: F.xxhash64(word(i), word(i + 1)).isin(known))
    found = F.transform(at, lambda i: F.struct(i.alias("at"), word(i).alias("w0"), word(i + 1).alias("w1")))
    return settle(words.select("doc_id", "key", F.size("words").cast("long").alias("n_words"), found.alias("hits")), "license-hits")


def votes(hits: DataFrame, grams: DataFrame) -> DataFrame:
    """Per distinct text (``key``), template and diagonal the places of the template's grams found there, as ``seen``.

    A hit is joined with the templates by hash and compared word by word. Rows repeating a text add nothing, and votes are
    gathered before they are shuffled. A diagonal has as many votes as its template has grams, at most.
    """
    each = hits.select("key", F.explode("hits").alias("hit")).select("key", "hit.*").withColumn("hash", F.xxhash64("w0", "w1"))
    same = (F.col("hash") == F.col("gram")) & (F.col("w0") == F.col("t0")) & (F.col("w1") == F.col("t1"))
    met = each.join(F.broadcast(grams), same)  # constants
    by = ["key", "template", "base", "label", "n_grams", (F.col("at") - F.col("place")).alias("diagonal")]
    return met.groupBy(*by).agg(F.collect_set("place").alias("seen"))


def in_order(places: Column) -> Column:
    """Length of the longest rising run of places, for matches sorted by where they are in the text.

    For each length so far the least place that a run of that length can end in is kept; the next match goes where it
    lowers one of them, or makes a longer run.
    """

    def put(ends: Column, place: Column) -> Column:
        below = F.size(F.filter(ends, lambda end: end < place))
        after = F.greatest(F.size(ends) - below - 1, F.lit(0))
        return F.concat(F.slice(ends, F.lit(1), below), F.array(place), F.slice(ends, below + 2, after))

    return F.size(F.aggregate(places, F.array().cast("array<int>"), put))


def spans(voted: DataFrame) -> DataFrame:
    """Verified spans: ``key``, ``template``, ``label``, ``start`` of the span's middle diagonal, and ``cover``.

    A span gathers the votes on a diagonal and on those up to twice ``GAP`` away, so it is a stretch of the text no longer
    than the template and four times ``GAP``. Its cover is the share of the template's grams that stand there in the
    template's order. The middle is any diagonal with votes enough that a span of ``LEAST_COVER`` could have it: spread
    over ``2 * GAP + 1`` neighbours, one of them has that share of the votes. Diagonals are dealt to bands of this reach,
    so each meets the votes of three bands only, however many a long text has.
    """
    reach = 2 * GAP
    width = 2 * reach + 1
    band = F.floor(F.col("diagonal") / width).cast("int")
    needed = F.ceil(F.lit(LEAST_COVER) * F.col("n_grams") / (2 * GAP + 1))
    middles = voted.where(F.size("seen") >= needed).select(
        "key", "template", "label", "n_grams", F.col("diagonal").alias("start"), F.explode(F.array(band - 1, band, band + 1)).alias("band")
    )
    near = voted.select(
        F.col("key").alias("its_key"), F.col("template").alias("its_template"), band.alias("its_band"), "diagonal", "seen"
    )
    same = (F.col("key") == F.col("its_key")) & (F.col("template") == F.col("its_template")) & (F.col("band") == F.col("its_band"))
    met = middles.join(near, same & (F.abs(F.col("diagonal") - F.col("start")) <= reach))
    matches = F.transform("seen", lambda place: F.struct((F.col("diagonal") + place).alias("at"), (-place).alias("minus")))
    gathered = met.groupBy("key", "template", "label", "n_grams", "start").agg(F.flatten(F.collect_list(matches)).alias("matches"))
    # sorted by place in the text; of one place the later gram first, so that a run takes one of them
    places = F.transform(F.array_sort("matches"), lambda match: -match["minus"])
    return gathered.select("key", "template", "label", "start", (in_order(places) / F.col("n_grams")).alias("cover"))


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """Each document's license marks.

    ``n_base`` counts the places of base phrases: diagonals with every gram of the phrase. ``first_word`` and
    ``last_word`` are the least and greatest of their starts. ``labels`` adds those of templates of which a verified span
    covers ``LEAST_COVER``; ``score`` is the best cover of any span, 1 where a base phrase stands, else 0.
    ``templates`` are texts with their labels, of any length; ``TEMPLATES`` unless given. A null or empty text has no words
    and no labels; a very long one is scanned whole. Equal texts get equal rows; null or repeated ids are allowed, as texts
    are told apart by their digest. Columns besides ``doc_id`` and ``text`` are not read. An empty table gives no rows. The
    templates are constants, which bounds what is broadcast.
    """
    grams = template_grams(docs.sparkSession, templates)
    rows = gram_hits(docs, grams)
    voted = settle(votes(rows, grams), "license-votes")
    based = voted.where(F.col("base") & (F.size("seen") == F.col("n_grams"))).groupBy("key").agg(
        F.count("*").alias("n_base"),
        F.min("diagonal").alias("first_word"),
        F.max("diagonal").alias("last_word"),
        F.collect_set("label").alias("base_found"),
    )
    spanned = spans(voted.where("NOT base")).groupBy("key").agg(
        F.collect_set(F.when(F.col("cover") >= LEAST_COVER, F.col("label"))).alias("found"),
        F.max("cover").alias("best"),
    )
    marks = based.join(spanned, "key", "full").withColumnRenamed("key", "marked")
    none = F.array().cast("array<string>")
    joined = rows.select("doc_id", "key", "n_words").join(marks, F.col("key") == F.col("marked"), "left")
    base = F.coalesce("base_found", none)
    n_base = F.coalesce("n_base", F.lit(0).cast("long"))
    return joined.select(
        "doc_id",
        "n_words",
        n_base.alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("found", none))), ",").alias("labels"),
        F.greatest(F.when(n_base > 0, 1.0).otherwise(0.0), F.coalesce("best", F.lit(0.0))).alias("score"),
    )
