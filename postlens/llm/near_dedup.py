"""Near-duplicate classes by Order MinHash, beside it rarest shingles of short texts, verified by banded alignment."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import mixed, settle, whole_text, word_hashes

WORDS = 5  # of a shingle
SIMILAR = (4, 9)  # aligned shingles to both texts' shingles: m / (a + b - m) >= 0.8 is m / (a + b) >= 4 / 9
SKETCHES = 36
MINIMA = 5  # shingles in a sketch
SHORT = 28  # shingles up to which a text finds its like by single shingles, without a miss
SHORT_PARTNER = 35  # shingles that a text can have which is like a short one: 1.25 times as many
CELLS_AT_ONCE = 1 << 21
ODD_WORDS = 32  # of 64 bits, in the sketch that bounds how much two texts differ
ROUNDS, CENTRAL_ROUNDS = 4, 2  # of comparisons with leaders, before what is left is compared pair by pair
LABEL, PLACE = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)

_FACTORS = mixed(np.arange(1, SKETCHES + 1, dtype=np.uint64)) | np.uint64(1)


# ---- one text --------------------------------------------------------------------------------------------------------


def labelled_shingles(text: str) -> np.ndarray:
    """Hashes of the text's five-word shingles in order, each with the number of its occurrence, so that all differ.

    A text of fewer words has one shingle of them all; one without words has none.
    """
    words = word_hashes(text)
    if not len(words):
        return words
    size = min(WORDS, len(words))
    count = len(words) - size + 1
    shingles = np.zeros(count, dtype=np.uint64)
    for i in range(size):
        shingles += words[i : i + count] * _FACTORS[i]
    shingles = mixed(shingles)
    order = np.argsort(shingles, kind="stable")
    fresh = np.ones(count, dtype=bool)
    fresh[1:] = shingles[order[1:]] != shingles[order[:-1]]
    if not fresh.all():
        places = np.arange(count)
        nth = places - np.maximum.accumulate(np.where(fresh, places, 0))
        shingles[order] = mixed(shingles[order] + nth.astype(np.uint64) * LABEL)
    return shingles




def sketches(shingles: np.ndarray) -> np.ndarray:
    """Per sketch one key: the ``MINIMA`` shingles least under its hash, in the order of the text.

    Two texts share a key if the same shingles are least in both and stand in the same order, so a sketch is sensitive to
    the order of words. At a similarity of 0.8 a sketch of long texts agrees with probability 0.8 ** 5, one of 36 all but
    surely. Minima are drawn without replacement, so texts of few shingles agree less often; see ``rarest_shingles``.
    """
    n = len(shingles)
    if not n:
        return np.zeros(0, dtype=np.int64)
    least = min(MINIMA, n)
    keys = np.empty(SKETCHES, dtype=np.uint64)
    step = max(1, CELLS_AT_ONCE // n)
    for start in range(0, SKETCHES, step):
        factors = _FACTORS[start : start + step]
        hashed = shingles[None, :] * factors[:, None]
        at = _least(hashed, least)
        at.sort(axis=1)
        key = np.arange(start, start + len(factors), dtype=np.uint64)
        for i in range(least):
            key = mixed(key * PLACE + shingles[at[:, i]])
        keys[start : start + len(factors)] = key
    return keys.view(np.int64)


def _least(hashed: np.ndarray, least: int) -> np.ndarray:
    """Places of each row's least values. Most cells are ruled out by a bound that the least ones hardly ever exceed."""
    rows, n = hashed.shape
    if n > 16 * least:
        low = hashed < np.uint64(int(4 * least / n * 2**64))
        row, place = np.nonzero(low)
        first = np.searchsorted(row, np.arange(rows + 1))
        if np.diff(first).min() >= least:
            order = np.lexsort((hashed[row, place], row))
            return place[order[first[:-1, None] + np.arange(least)[None, :]]]
    return np.argpartition(hashed, least - 1, axis=1)[:, :least] if n > least else np.tile(np.arange(n), (rows, 1))


def aligned(a: np.ndarray, b: np.ndarray) -> int:
    """Shingles on the best alignment of two texts, within the band outside which none can reach the threshold.

    As no shingle repeats within a text, an alignment is a rising run of matched places, and the longest is the best.
    """
    band = (len(a) + len(b)) // SIMILAR[1] + 1
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    near = np.abs(at_a - at_b) <= band
    at_a, at_b = at_a[near], at_b[near]
    run = at_b[np.argsort(at_a)]
    if (run[1:] > run[:-1]).all():
        return len(run)
    tails: list[int] = []
    for place in run.tolist():
        i = bisect_left(tails, place)
        tails[i : i + 1] = [place]
    return len(tails)


def odd_bits(shingles: np.ndarray) -> np.ndarray:
    """``ODD_WORDS`` words of 64 bits; a bit tells whether an odd number of the shingles is hashed to it.

    A shingle that only one of two texts has changes one bit, one that both have changes none: the bits in which two texts
    differ are at most the shingles in which they do.
    """
    hashed = mixed(shingles + PLACE)
    times = np.bincount((hashed % np.uint64(64 * ODD_WORDS)).astype(np.int64), minlength=64 * ODD_WORDS)
    return np.packbits((times & 1).astype(np.uint8), bitorder="little").view(np.uint64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = SIMILAR[0] * (len(a) + len(b))
    if not len(a) or not len(b) or SIMILAR[1] * min(len(a), len(b)) < both:
        return False
    return SIMILAR[1] * aligned(a, b) >= both


# ---- on tables -------------------------------------------------------------------------------------------------------


def _id_key(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("-"))


def sketched(docs: DataFrame) -> DataFrame:
    """A row per document, settled: ``doc_id``, ``node`` (digest of the text), its count of shingles and its keys.

    ``few`` holds the shingles of texts of up to ``SHORT_PARTNER``, for ``rarest_shingles``: sketches of short texts may
    miss, and those keys, beside them, do not.
    """

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 512):
                part = batch.iloc[start : start + 512]
                found = [labelled_shingles(text) for text in part["text"]]
                yield pd.DataFrame(
                    {
                        "id": part["id"],
                        "node": part["node"],
                        "shingles": [len(x) for x in found],
                        "keys": [sketches(x) for x in found],
                        "few": [(x if len(x) <= SHORT_PARTNER else x[:0]).view(np.int64) for x in found],
                    }
                )

    rows = docs.select(
        F.col("doc_id").cast("string").alias("id"), F.md5(whole_text()).alias("node"), whole_text().alias("text")
    )
    out = rows.mapInPandas(sketch, "id string, node string, shingles int, keys array<long>, few array<long>")
    return settle(out.select(F.col("id").cast("long").alias("doc_id"), "node", "shingles", "keys", "few"), "sketches")


def distinct_nodes(rows: DataFrame) -> DataFrame:
    """One row per distinct text: a number ``num``, its least ``doc_id``, how often it occurs, its keys and few shingles."""
    same = [F.first(c).alias(c) for c in ("shingles", "keys", "few")]
    once = rows.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), *same)
    return settle(once.withColumn("num", F.monotonically_increasing_id()), "nodes")


def rarest_shingles(nodes: DataFrame) -> DataFrame:
    """``num``, ``shingles`` and as ``key`` each of the rarest shingles of the texts of up to ``SHORT_PARTNER``.

    Texts that are similar share at least 0.8 of either one's shingles. With all shingles in one order, the first that both
    have is then among the first fifth, and one more, of each: so the keys miss no pair of such texts. The order is that of
    rarity in these texts, by which a common line is a key only of texts that hardly have another shingle.
    """
    said = nodes.where(F.size("few") > 0).select("num", "shingles", F.explode("few").alias("shingle"))
    common = said.groupBy("shingle").agg(F.count("*").alias("texts")).where("texts > 1")
    common = common.withColumnRenamed("shingle", "its_shingle")
    counted = said.join(common, F.col("shingle") == F.col("its_shingle"), "left")
    rarity = F.struct(F.coalesce("texts", F.lit(1)).alias("texts"), "shingle")
    ordered = counted.groupBy("num", "shingles").agg(F.array_sort(F.collect_list(rarity)).alias("ordered"))
    first = F.slice("ordered", F.lit(1), (F.floor(F.col("shingles") / 5) + 1).cast("int"))
    return ordered.select("num", "shingles", F.explode(first).alias("rare")).select("num", "shingles", F.col("rare.shingle").alias("key"))


def bucket_members(nodes: DataFrame) -> DataFrame:
    """``key``, ``num`` and ``shingles`` of the texts, for the keys that several of them share."""
    rows = nodes.select("num", "shingles", F.explode("keys").alias("key")).unionByName(rarest_shingles(nodes))
    shared = rows.groupBy("key").agg(F.min("num").alias("first"), F.max("num").alias("last"))
    shared = shared.where(F.col("first") < F.col("last")).select(F.col("key").alias("its_key"))
    return settle(rows.join(shared, F.col("key") == F.col("its_key")).drop("its_key"), "members")


def texts_of(members: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """``num`` and ``text`` of the texts in a bucket, a row each, settled; each from a row with the text's least id.

    The documents are gone through for this once; all later steps read texts from here.
    """
    located = nodes.select("num", "node", _id_key("first_id").alias("id")).join(members.select("num").distinct(), "num")
    texts = docs.select(F.md5(whole_text()).alias("node"), _id_key().alias("id"), whole_text().alias("text"))
    once = texts.join(located, ["node", "id"]).groupBy("node", "id", "num").agg(F.first("text").alias("text"))
    return settle(once.select("num", "text"), "texts")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs of numbers ``a`` and ``b`` whose texts are similar, settled, with their labels ``low`` and ``high``."""

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[int, np.ndarray] = {}

        def shingles(num: int, text: str) -> np.ndarray:
            if num not in known:
                if len(known) >= 64:
                    known.clear()
                known[num] = labelled_shingles(text)
            return known[num]

        for batch in batches:
            rows = zip(batch["a"], batch["text_a"], batch["b"], batch["text_b"], strict=True)
            good = [similar(shingles(a, text_a), shingles(b, text_b)) for a, text_a, b, text_b in rows]
            yield batch.loc[np.array(good, dtype=bool), ["a", "b", "low", "high"]]

    first = texts.select(F.col("num").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("num").alias("b"), F.col("text").alias("text_b"))
    held = pairs.join(first, "a").join(second, "b").select("a", "b", "low", "high", "text_a", "text_b")
    return settle(held.mapInPandas(align, "a long, b long, low long, high long"), "links")


def components(links: DataFrame) -> DataFrame:
    """``num`` and ``label``, the least number of its component, for all numbers that have a link.

    Labels spread to neighbours and jump to their label's own label, so rounds grow with the logarithm of the longest
    chain. Every round is written out; nothing but the count of changes comes to the driver.
    """
    edges = settle(links.union(links.select("b", "a")).toDF("src", "dst"), "edges")
    labels = settle(edges.groupBy("src").agg(F.least("src", F.min("dst")).alias("label")).toDF("num", "label"), "labels")
    while True:
        heard = edges.join(labels, F.col("dst") == F.col("num")).groupBy("src").agg(F.min("label").alias("heard"))
        told = labels.join(heard, F.col("num") == F.col("src")).select("num", "label", F.least("label", "heard").alias("near"))
        up = labels.select(F.col("num").alias("up"), F.col("label").alias("above"))
        jumped = told.join(up, F.col("near") == F.col("up")).select("num", "label", F.least("near", "above").alias("new"))
        jumped = settle(jumped, "labels")
        changed = jumped.where(F.col("new") < F.col("label")).count()
        labels = jumped.select("num", F.col("new").alias("label"))
        if not changed:
            return labels


def joined_classes(links: DataFrame) -> DataFrame:
    """For each label that the links join to a lesser one: the label as ``num``, the least it is joined to as ``label``.

    Links of earlier rounds are in the labels already, so a round only works on the links between classes that it found.
    """
    return components(links.select("low", "high").toDF("a", "b")).where(F.col("num") != F.col("label"))


def relabelled(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """The rows with their ``label`` replaced by the one that it is joined to."""
    new = joined.select(F.col("num").alias("its_label"), F.col("label").alias("new"))
    now = rows.join(new, F.col("label") == F.col("its_label"), "left")
    return now.withColumn("label", F.coalesce("new", "label")).drop("its_label", "new")


def _lengths_fit(n: str, m: str) -> Column:
    return SIMILAR[1] * F.least(n, m) >= SIMILAR[0] * (F.col(n) + F.col(m))


def _untried(pairs: DataFrame, tried: DataFrame | None) -> DataFrame:
    return pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")


def with_degrees(members: DataFrame, links: DataFrame) -> DataFrame:
    """Adds the links that a text has to its ``degree``."""
    degree = links.select(F.explode(F.array("a", "b")).alias("its_num")).groupBy("its_num").agg(F.count("*").alias("links"))
    now = members.join(degree, F.col("num") == F.col("its_num"), "left")
    return now.withColumn("degree", F.col("degree") + F.coalesce("links", F.lit(0))).drop("its_num", "links")


def open_members(members: DataFrame) -> DataFrame:
    """The members of the buckets that more than one component still meets in, settled."""
    split = members.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    split = split.where(F.col("low") < F.col("high")).select(F.col("key").alias("its_key"))
    return settle(members.join(split, F.col("key") == F.col("its_key")).drop("its_key"), "open-members")


def with_shared(members: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sets ``shared``, a bound on how many shingles a text can align with any other open one: those not its own alone.

    A text changed in many places has many shingles that no other has. It can be ruled out by itself, without comparing
    it with the rest of its group. Also returns the ``odd_bits`` of the open texts by ``num``, settled.
    """
    texts = settle(texts.join(members.select("num").distinct(), "num"), "open-texts")

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for num, text in zip(batch["num"], batch["text"], strict=True):
                yield pd.DataFrame({"num": num, "shingle": labelled_shingles(text).view(np.int64)})

    def summed_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"num": batch["num"], "odd": [odd_bits(labelled_shingles(text)).view(np.int64) for text in batch["text"]]})

    owners = texts.mapInPandas(spread, "num long, shingle long").groupBy("shingle").agg(
        F.min("num").alias("low"), F.max("num").alias("high")
    )
    lone = owners.where(F.col("low") == F.col("high")).groupBy(F.col("low").alias("its_num")).agg(F.count("*").alias("lone"))
    joined = members.join(lone, F.col("num") == F.col("its_num"), "left")
    joined = joined.withColumn("shared", F.col("shingles") - F.coalesce("lone", F.lit(0))).drop("its_num", "lone")
    enough = 5 * F.col("shared") >= SIMILAR[0] * F.col("shingles")  # no partner lowers the need below this
    odd = settle(texts.mapInPandas(summed_up, "num long, odd array<long>"), "odd-bits")
    return settle(joined.where(enough), "shared-members"), odd


def open_pairs(members: DataFrame, odd: DataFrame) -> DataFrame:
    """Distinct pairs within a bucket and of different components that no bound rules out, with their labels.

    Similar texts differ in at most a ninth of the shingles of both: 9 (a + b - 2m) <= a + b. Their lengths, the shingles
    that only one text has, and the bits in which their sketches differ must allow that. The last bound is close for texts
    of up to some thousand shingles, so hardly a pair is left for comparison that is not linked.
    """
    held = members.join(odd.withColumnRenamed("num", "its_num"), F.col("num") == F.col("its_num"))
    bits = lambda name: [F.col("odd")[i].alias(f"{name}{i}") for i in range(ODD_WORDS)]
    named = lambda *names: [F.col(c).alias(n) for c, n in zip(("num", "shingles", "label", "shared"), names, strict=True)]
    left = held.select("key", *named("a", "n", "l", "s"), *bits("x"))
    right = held.select("key", *named("b", "m", "r", "t"), *bits("y"))
    differ = sum((F.bit_count(F.col(f"x{i}").bitwiseXOR(F.col(f"y{i}"))) for i in range(ODD_WORDS)), F.lit(0))
    alone = F.col("n") - F.col("s") + F.col("m") - F.col("t")
    both = F.col("n") + F.col("m")
    can = (SIMILAR[1] * F.least("n", "m", "s", "t") >= SIMILAR[0] * both) & (9 * F.greatest(differ, alone) <= both)
    apart = (F.col("a") < F.col("b")) & (F.col("l") != F.col("r")) & can
    labels = [F.least("l", "r").alias("low"), F.greatest("l", "r").alias("high")]
    return left.join(right, (left["key"] == right["key"]) & apart).select("a", "b", *labels).distinct()


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents' sketch rows, and per distinct text its class: ``node``, ``label``, ``first_id``, ``copies``.

    Texts that share a key are candidates. First, in a few rounds, each is compared with one leader of each of its buckets,
    which joins dense groups with few comparisons. Then the pairs that share a bucket but are in different components
    still, and that no exact bound rules out, are compared too: so every candidate pair is verified, within one class, or
    known not to be similar.
    """
    rows = sketched(docs)
    nodes = distinct_nodes(rows)
    members = bucket_members(nodes)
    texts = texts_of(members, nodes, docs)
    tried = labels = odd = None
    own = members.withColumns({"label": F.col("num"), "degree": F.lit(0).cast("long"), "shared": F.col("shingles").cast("long")})
    for turn in range(ROUNDS):
        # the leader of a bucket is its text with most links so far, the middle of a dense group; in the last rounds any
        middle = -F.col("degree") if turn < CENTRAL_ROUNDS else F.xxhash64("key", "num", F.lit(turn))
        order = F.struct(middle.alias("far"), F.xxhash64("num", F.lit(turn)).alias("any"), "num", "label", "shingles")
        led = own.join(own.groupBy("key").agg(F.min(order).alias("first")), "key")
        new = (F.col("label") != F.col("first.label")) & _lengths_fit("shingles", "first.shingles")
        both = lambda c: (F.least(c, f"first.{c}"), F.greatest(c, f"first.{c}"))
        pairs = led.where(new).select(*both("num"), *both("label")).toDF("a", "b", "low", "high")
        pairs = settle(_untried(pairs.distinct(), tried), "pairs")
        links = verified(pairs, texts)
        tried = pairs.select("a", "b") if tried is None else tried.union(pairs.select("a", "b"))
        joined = joined_classes(links)
        labels = joined if labels is None else relabelled(labels, joined).union(joined)
        own = relabelled(own, joined)
        own = open_members(with_degrees(own, links) if turn < CENTRAL_ROUNDS - 1 else own)
        if turn == CENTRAL_ROUNDS - 1:
            own, odd = with_shared(own, texts)
    rest = settle(_untried(open_pairs(own, odd), tried), "pairs")
    links = verified(rest, texts)
    if not links.isEmpty():
        joined = joined_classes(links)
        labels = relabelled(labels, joined).union(joined)
    found = nodes.join(labels, "num", "left").select("node", F.coalesce("label", "num").alias("label"), "first_id", "copies")
    return rows, settle(found, "classes")


def _per_class(found: DataFrame) -> DataFrame:
    """Per class its least id, its size and the text that stays, that of the least id."""
    best = F.min(F.struct(F.col("first_id").isNull().alias("no_id"), "first_id", "node")).alias("best")
    return found.groupBy("label").agg(best, F.sum("copies").alias("class_size"), F.count("*").alias("class_texts"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Each document with its class of near duplicates: ``class_id``, the least ``doc_id`` of the class, and sizes.

    Two texts are linked if the best alignment of their five-word shingles (lower-cased words, repeated shingles told
    apart by occurrence) covers 0.8 of all their shingles together; classes are the connected components, and equal texts
    share one. A null text counts as empty; texts without words are only like equal ones. Null ids come last in a class,
    a class of null ids alone has a null ``class_id``; rows with repeated ids are classed each by its text. Columns
    besides ``doc_id`` and ``text`` are not read. An empty table gives no rows.
    """
    rows, found = classes(docs)
    per_class = _per_class(found).select("label", F.col("best.first_id").alias("class_id"), "class_size", "class_texts")
    of_node = found.select(F.col("node").alias("its_node"), "label").join(per_class, "label")
    of_node = settle(of_node, "node-classes")
    joined = rows.select("doc_id", "node").join(of_node, F.col("node") == F.col("its_node"))
    return joined.select("doc_id", "class_id", "class_size", "class_texts")


def keep_one_per_class(docs: DataFrame) -> DataFrame:
    """The documents with the least id of each class, with all their columns; one row of rows equal in id and text.

    Edge cases as in ``near_duplicates``: a null id comes last in its class, a null text counts as empty.
    """
    _, found = classes(docs)
    kept = settle(_per_class(found).select("best.node", _id_key("best.first_id").alias("id")), "kept")
    own = [F.col(c) for c in docs.columns]
    keyed = docs.select(F.struct(*own).alias("row"), F.md5(whole_text()).alias("node"), _id_key().alias("id"))
    once = keyed.join(kept, ["node", "id"]).groupBy("node", "id").agg(F.first("row").alias("row"))
    return once.select("row.*")
