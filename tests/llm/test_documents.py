"""Operators over documents: edge cases, and each query against a plain version of it."""

import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postlens.llm import bpe, exact_dedup, license_scan, mixing, near_dedup, quality, sharding

SF_DIR = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_perfect_hash_is_minimal_and_finds_its_own():
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(2_000)]
    sizes, bits, slots = exact_dedup.build_hash(digests)
    assert sorted(slots.tolist()) == list(range(2_000))
    assert (exact_dedup.look_up(sizes, bits, digests) == slots).all()
    assert exact_dedup.look_up(*exact_dedup.build_hash([])[:2], digests[:2]).tolist() == [-1, -1]


@pytest.mark.parametrize("history", [None, True, False])
def test_exact_dedup(edge_docs, history):
    history = None if history is None else F.lit(history)
    got = exact_dedup.exact_dedup(edge_docs, history).collect()
    assert len(got) == 13
    fox = [r for r in got if r.group_size == 5]
    assert len(fox) == 5 and {r.keep_id for r in fox} == {2} and sum(r.kept for r in fox) == 1
    empty = [r for r in got if r.group_size == 4]
    assert {r.keep_id for r in empty} == {5} and sum(r.kept for r in empty) == 1
    assert sum(r.kept for r in got) == 6
    kept = exact_dedup.keep_distinct(edge_docs, history)
    assert kept.columns == edge_docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 5, 6, 7, 8, 9]


def test_empty_tables(no_docs, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert exact_dedup.exact_dedup(no_docs).count() == 0 == exact_dedup.keep_distinct(no_docs).count()
    assert near_dedup.near_duplicates(no_docs).count() == 0
    assert sharding.shard_documents(no_docs).count() == 0
    assert mixing.mix(no_docs).count() == 0 == mixing.keep_mixed(no_docs).count()
    assert quality.score_quality(no_docs, labels).count() == 0 == quality.keep_good(no_docs, labels).count()
    assert bpe.token_digests(no_docs, PATH).count() == 0
    assert license_scan.scan_licenses(no_docs).count() == 0


def plain_words(text):
    return re.findall(license_scan.WORD, (text or "").translate(str.maketrans(license_scan.UPPER, license_scan.LOWER)))


def test_license_scan(edge_docs, docs):
    for table in (edge_docs, docs):
        got = license_scan.scan_licenses(table)
        assert got.columns[:6] == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
        wanted = []
        for row in table.collect():
            words = plain_words(row.text)
            places = [
                (i, label)
                for phrase, label in license_scan.BASE.items()
                for i in range(len(words))
                if words[i : i + len(phrase.split())] == phrase.split()
            ]
            at = [i for i, _ in places]
            names = ",".join(sorted({label for _, label in places}))
            wanted.append((row.doc_id, len(words), len(places), min(at, default=None), max(at, default=None), names))
        assert sorted((tuple(r)[:6] for r in got.collect()), key=repr) == sorted(wanted, key=repr)
        assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) for r in got.collect())


def test_license_spans_survive_an_inserted_word(spark):
    texts = ["licensed under the same apache license version 2 0", "licensed under the rules", "Released under the MIT License."]
    got = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r.doc_id: r.labels for r in got.collect()} == {0: "apache-2.0", 1: "", 2: "mit"}


def plain_marks(text, templates):
    """Labels and score by every diagonal of every template, the longest rising run found by trying all."""
    words = plain_words(text)
    found, best = set(), 0.0
    for phrase, label in templates.items():
        grams = phrase.split()
        n = len(grams) - 1
        hits = [(i, j) for i in range(len(words) - 1) for j in range(n) if words[i : i + 2] == grams[j : j + 2]]
        by_diagonal = {}
        for i, j in hits:
            by_diagonal.setdefault(i - j, []).append((i, j))
        for middle, own in by_diagonal.items():
            if len(own) < math.ceil(license_scan.LEAST_COVER * n / (2 * license_scan.GAP + 1)):
                continue
            near = sorted((i, j) for i, j in hits if abs(i - j - middle) <= 2 * license_scan.GAP)
            runs = []
            for i, j in near:
                runs.append((1 + max((r for r, (a, b) in runs if a < i and b < j), default=0), (i, j)))
            cover = max(r for r, _ in runs) / n
            best = max(best, cover)
            if cover >= license_scan.LEAST_COVER:
                found.add(label)
    return found, best


BODY = max((t for t, label in license_scan.TEMPLATES.items() if label == "mit"), key=len)


def test_license_labels_are_those_of_the_plain_scan(spark, edge_docs):
    """Whole bodies, with words put in, left out and exchanged; reversed, scattered, cut and repeated."""
    rng = random.Random(8)
    texts, words = [], BODY.split()
    for phrase in license_scan.TEMPLATES:
        own = phrase.split()
        for _ in range(6):
            other = list(own)
            for at in sorted(rng.sample(range(len(own)), rng.randrange(0, 1 + len(own) // 6)), reverse=True):
                other[at : at + 1] = rng.choice(([], ["new"], [other[at], "new"]))
            texts.append(" ".join(["some", "words", *other, "of", "the", "software"] * rng.randrange(1, 3)))
        texts.append(" ".join(reversed(own)))
        texts.append(" filler ".join(f"{a} {b}" for a, b in zip(own, own[1:], strict=False)))
        texts.append(" ".join(own[: len(own) // 2]))
    texts.append(" ".join("x" if i % 9 == 0 else w for i, w in enumerate(words)))
    texts.append("of the software to use " * 300)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan_licenses(docs).collect()}
    for i, text in enumerate(texts):
        labels, best = plain_marks(text, license_scan.TEMPLATES)
        base = {label for phrase, label in license_scan.BASE.items() if f" {phrase} " in f" {text} "}
        assert set(got[i].labels.split(",")) - {""} == labels | base, text
        assert got[i].score == pytest.approx(1.0 if base else best), text


def test_a_body_counts_only_in_its_order(spark):
    words = BODY.split()
    assert len(words) > 150
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    texts = [BODY, " ".join([*words[:80], "inserted", *words[80:]]), " ".join(reversed(pairs)), " ".join(reversed(words))]
    got = {r.doc_id: r for r in license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got[0].labels == got[1].labels == "mit" and got[0].score == 1.0 and got[1].score > 0.98
    assert got[2].labels == got[3].labels == "" and got[2].score < 0.5


def test_a_template_of_any_length(spark):
    words = [f"w{i % 97}x{i}" for i in range(400)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[200:] + words[:200])), (3, None)], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in license_scan.scan_licenses(docs, {" ".join(words): "long"}).collect()}
    assert got == {1: ("long", 1.0), 2: ("", 199 / 399), 3: ("", 0.0)}


def test_bpe_is_the_library(edge_docs, docs):
    library = Tokenizer.from_file(PATH)
    for table in (edge_docs, docs):
        digests = {tuple(r) for r in bpe.token_digests(table, PATH).collect()}
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        wanted = set()
        for row in table.collect():
            ids = library.encode(row.text or "", add_special_tokens=False).ids
            wanted.add((row.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
        assert digests == wanted
    encoded = bpe.encode_documents(edge_docs, PATH)
    assert {len(r.ids) for r in encoded.where("doc_id IN (3, 4, 5)").collect()} == {0}
    assert bpe.decode_documents(encoded.where("doc_id = 9"), PATH).first().text.startswith("all</w> rights</w>")


def test_bpe_on_random_text():
    library, own = Tokenizer.from_file(PATH), bpe.Bpe(PATH)
    rng = random.Random(3)
    alphabet = "aaabcdeth 's!?1\x1c\x85\u00a0éÉΣσßIİ½٣_-\n<|endoftext|>中文🙂́"
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(800)] + ["ab" * 3_000]
    for text, (ids, _) in zip(texts, own.encoded(texts), strict=True):
        assert ids == " ".join(map(str, library.encode(text, add_special_tokens=False).ids)), repr(text)


def test_bpe_knows_every_code_point():
    """Alone between letters, and between signs: whether it is a letter, a number or neither, and its lower-case form."""
    library, own = Tokenizer.from_file(PATH), bpe.Bpe(PATH)
    points = [c for c in [*range(0x80, 0x40000), *range(0xE0000, 0xE0200), 0xF0000, 0x10FFFD] if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}b!{chr(c)}! " for c in points[i : i + 16]) for i in range(0, len(points), 16)]
    for start in range(0, len(texts), 512):
        part = texts[start : start + 512]
        wanted = library.encode_batch(part, add_special_tokens=False)
        for text, (ids, _), told in zip(part, own.encoded(part), wanted, strict=True):
            assert ids == " ".join(map(str, told.ids)), [hex(ord(c)) for c in text if ord(c) > 127]


def test_one_very_long_word_takes_no_longer_than_many_short_ones():
    library, own, rng = Tokenizer.from_file(PATH), bpe.Bpe(PATH), random.Random(7)
    start = time.perf_counter()
    for word in ("".join(rng.choices("acgt", k=100_000)), "ab" * 20_000, "中文字" * 8_000):
        assert own.encoded([word])[0][0] == " ".join(map(str, library.encode(word, add_special_tokens=False).ids))
    assert time.perf_counter() - start < 30
    words = list({"".join(rng.choices("abcdeé", k=rng.randrange(1, 40))) for _ in range(300)})
    many = own.encode_words(words)
    assert all(own.encode_words([w])[w] == many[w] for w in words)


def test_sharding(edge_docs, docs):
    for table in (edge_docs, docs):
        rows = sharding.shard_documents(table, shards=5).collect()
        assert len(rows) == table.count()
        for shard in range(5):
            assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert all(r.size == len(texts[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) for r in rows)
    loads = [sum(r.size for r in rows if r.shard == s) for s in range(5)]
    assert max(loads) < 1.1 * min(loads)


def test_copies_without_an_id_are_spread(spark):
    rows = [(None, "x" * 80)] * 4_000 + [(7, "y" * 80)] * 1_000 + [(i, f"z{i}") for i in range(4_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard_documents(docs, shards=5).collect()
    loads = [sum(r.size for r in got if r.shard == s) for s in range(5)]
    assert max(loads) < 1.05 * min(loads)
    for shard in range(5):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    most = max(sum(r.virtual_slot == s for r in got) for s in {r.virtual_slot for r in got})
    assert most < 64


def test_a_stored_map_is_edited_when_the_table_grows(spark):
    """Shards are those of a plain assignment by the map, and all but few documents stay where they were."""
    rows = [(i, "word " * (i % 40)) for i in range(6_000)]
    small, large = (spark.createDataFrame(rows[:n], "doc_id long, text string") for n in (5_000, 6_000))
    stored = sharding.slot_map(small, 8)
    before = {r.doc_id: r for r in sharding.shard_documents(small, 8).collect()}
    owner = {r.virtual_slot: r.shard for r in stored.where("version = 2").collect()}
    assert len(owner) == sharding.SLOTS and all(owner[r.virtual_slot] == r.shard for r in before.values())
    after = {r.doc_id: r for r in sharding.shard_documents(large, 8, stored=stored).collect()}
    anew = {r.doc_id: r for r in sharding.shard_documents(large, 8).collect()}
    moved = sum(before[i].shard != after[i].shard for i in before)
    assert 0 < moved < 0.05 * len(before) and moved < sum(before[i].shard != anew[i].shard for i in before)
    assert {r.map_version for r in after.values()} == {3}
    loads = [sum(r.size for r in after.values() if r.shard == s) for s in range(8)]
    assert max(loads) < 1.02 * min(loads)
    plain = {}
    for r in sorted(after.values(), key=lambda r: (r.virtual_slot, r.doc_id)):
        assert plain.setdefault(r.shard, 0) == r.slot
        plain[r.shard] += 1
    fewer = sharding.shard_documents(large, 6, stored=stored).collect()
    assert {r.shard for r in fewer} == set(range(6))


def test_rebalancing_moves_few_slots():
    weights = {s: 100 + s % 7 for s in range(400)}
    before = sharding.rebalanced(sharding.first_map(10, 400), weights, 10)
    weights[3] += 900
    after = sharding.rebalanced(before, weights, 10)
    assert 0 < sum(before[s] != after[s] for s in before) < 20


def test_quality(edge_docs, spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.score_quality(docs, labels).join(labels, "doc_id").collect()
    unseen = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([(r.score >= 0.3) == (r.quality == 1) for r in unseen]) > 0.97
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 0).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality.score_quality(docs, flipped).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in rows)
    edge = quality.score_quality(edge_docs, labels).collect()
    assert len(edge) == 13 and all(0 <= r.score <= 1 for r in edge)
    few = labels.where("quality = 1").withColumn("extra", F.lit(1))
    assert quality.score_quality(edge_docs, few).count() == 13


def test_quality_scores_are_those_of_a_plain_discriminant(spark):
    """Class densities written out with determinants and inverses, over all labelled rows that are not held out."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    stats = {r.doc_id: quality.statistics_of(r.text or "") for r in docs.collect()}
    learn = {r.doc_id: r.quality for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 and r.doc_id in stats}
    parts = []
    for label in (0, 1):
        rows = np.array([stats[i] for i, q in learn.items() if q == label])
        spread = np.cov(rows.T, bias=True)
        spread = 0.9 * spread + 0.1 * np.diag(np.diag(spread)) + quality.FLOOR * np.eye(len(spread))
        parts.append((np.log((len(rows) + 1) / (len(learn) + 2)), rows.mean(0), np.linalg.inv(spread), np.linalg.slogdet(spread)[1]))

    def plain(x):
        low, high = (p - d / 2 - (x - m) @ inverse @ (x - m) / 2 for p, m, inverse, d in parts)
        return 1 / (1 + np.exp(np.clip(low - high, -700, 700)))

    got = {r.doc_id: r.score for r in quality.score_quality(docs, labels).collect()}
    assert got.keys() == stats.keys()
    assert all(abs(got[i] - plain(x)) < 1e-6 for i, x in stats.items())


def test_near_duplicates_are_the_components(docs, edge_docs):
    texts = {r.doc_id: near_dedup.labelled_shingles(r.text or "") for r in docs.collect()}
    label = {i: i for i in texts}
    same = {}
    for r in docs.collect():
        same.setdefault(r.text, r.doc_id)
    links = [(same[r.text], r.doc_id) for r in docs.collect()]
    links += [(a, b) for a in texts for b in texts if a < b and near_dedup.similar(texts[a], texts[b])]
    for _ in range(len(texts)):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    got = near_dedup.near_duplicates(docs).collect()
    assert {r.doc_id: r.class_id for r in got} == label
    edge = near_dedup.near_duplicates(edge_docs).collect()
    assert len(edge) == 13
    assert sorted(r.doc_id for r in edge if r.class_id == 0 and r.doc_id is not None) == [0, 0, 1, 2]
    assert {r.class_id for r in edge if r.doc_id in (6, 7)} == {6}
    assert near_dedup.keep_one_per_class(edge_docs).columns == edge_docs.columns


def test_short_near_duplicates_are_all_found(spark):
    """Texts of 8 to 39 words, each with one that has a word more, or two a few words apart; all beside a common line."""
    rng = random.Random(5)
    texts, pairs = [], []
    for i in range(900):
        words = [f"w{rng.randrange(10**9)}" for _ in range(8 + i % 32)]
        other = [*words, "more"] if i % 3 else ["more", *words]
        if len(words) > 15:
            other = other[: len(other) - (len(words) - 4) // 10] if i % 2 else [*other, *"abcdefgh"[: (len(words) - 4) // 5 - 1]]
        pairs.append((len(texts), len(texts) + 1))
        texts += [" ".join(words), " ".join(other)]
    held = [near_dedup.similar(*(near_dedup.labelled_shingles(texts[i]) for i in pair)) for pair in pairs]
    assert all(held)
    line = "one line that very many of the texts have in common"
    texts += [f"{line} w{i} x{i} y{i} z{i}" for i in range(300)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(table).collect()}
    assert [got[a] for a, b in pairs] == [a for a, _ in pairs] == [got[b] for a, b in pairs]
    assert all(got[i] == i for i in range(2 * len(pairs), len(texts)))
    nodes = near_dedup.distinct_nodes(near_dedup.sketched(table.where(f"doc_id >= {2 * len(pairs)}")))
    assert near_dedup.rarest_shingles(nodes).groupBy("key").count().where("count > 1").isEmpty()


def test_alignment_needs_order():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    swapped = words[150:] + words[:150]
    edited = list(words)
    for i in rng.sample(range(300), 5):
        edited[i] = "new"
    shingles = [near_dedup.labelled_shingles(" ".join(w)) for w in (words, swapped, edited)]
    assert near_dedup.similar(shingles[0], shingles[2])
    assert not near_dedup.similar(shingles[0], shingles[1])


def test_chain_of_links_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    assert {r.num: r.label for r in near_dedup.components(links).collect()} == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_raking_meets_its_margins(docs, edge_docs):
    targets = {"lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}}
    rows = mixing.mix(docs, targets).collect()
    assert len(rows) == docs.count()
    cells = {(r.source, r.lang, r.topic): r.cell_weight for r in rows}
    seen = {r.lang for r in rows}
    named = {k: v for k, v in targets["lang"].items() if k in seen}
    for lang, share in named.items():
        assert abs(sum(w for c, w in cells.items() if c[1] == lang) - share / sum(named.values())) < 0.01
    tokens = sum(r.n_tokens for r in rows)
    assert abs(sum(r.n_tokens * r.probability for r in rows) / tokens - mixing.KEPT_SHARE) < 0.01
    assert mixing.mix(edge_docs).count() == 13
    assert mixing.keep_mixed(docs, targets).count() == sum(r.kept for r in rows)


def test_what_a_mixed_row_says_of_its_text(spark, edge_docs):
    """Tokens and topic by a plain reading, the draw by what it decides: kept below the probability, each row the same."""
    rows = spark.createDataFrame(
        [(i, t, "s", "en") for i, t in enumerate(["Licenced under x", "a@b.cd is", "x | y | z", "x  y\tz", "", None, "see http://x"])],
        "doc_id long, text string, source string, lang string",
    )
    for docs in (rows, edge_docs.select("doc_id", "text", "source", "lang")):
        texts = {}
        for r in docs.collect():
            texts.setdefault(r.doc_id, set()).add(r.text or "")
        got = mixing.mix(docs).collect()
        assert len(got) == docs.count()
        for r in got:
            fits = [t for t in texts[r.doc_id] if hashlib.md5(t.encode()).hexdigest() == r.digest]
            assert len(fits) == 1 and r.n_tokens == len(re.findall(r"\S+", fits[0], re.ASCII))
            kinds = [name for name, pattern in mixing.TOPIC_PATTERNS.items() if re.search(pattern, fits[0])]
            assert r.topic == (kinds or ["prose"])[0]
        again = {(r.doc_id, r.digest, r.kept, r.probability) for r in mixing.mix(docs.repartition(3)).collect()}
        assert again == {(r.doc_id, r.digest, r.kept, r.probability) for r in got}
        drawn = {(r.id, r.digest): r.draw for r in mixing.tokened(docs).select(F.col("doc_id").alias("id"), "digest", "draw").collect()}
        assert all(r.kept == (drawn[r.doc_id, r.digest] < r.probability) for r in got)
    assert [r.topic for r in sorted(mixing.mix(rows).collect(), key=lambda r: r.doc_id)] == ["license", "contact", "table", "prose", "prose", "prose", "contact"]


@pytest.mark.parametrize("hot", [False, True])
def test_the_sample_holds_its_targets(spark, hot):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    if hot:
        docs = docs.withColumn("source", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, "hot").otherwise(F.col("source")))
    lang = {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}
    rows = mixing.mix(docs, {"lang": lang}, lower_total=True).collect()
    total, sampled = sum(r.n_tokens for r in rows), sum(r.n_tokens * r.probability for r in rows)
    for dim in mixing.DIMENSIONS:
        had, got = {}, {}
        for r in rows:
            had[r[dim]] = had.get(r[dim], 0) + r.n_tokens
            got[r[dim]] = got.get(r[dim], 0) + r.n_tokens * r.probability / sampled
        tempered = {k: n**mixing.TEMPERATURE for k, n in had.items()}
        wanted = lang if dim == "lang" else {k: n / sum(tempered.values()) for k, n in tempered.items()}
        assert max(abs(got[k] - wanted[k]) for k in had) < 1e-3, dim
    assert all(r.targets_held and r.residual < 1e-3 for r in rows)
    assert abs(rows[0].sample_share - sampled / total) < 1e-6 and 0.2 < rows[0].sample_share <= mixing.KEPT_SHARE


def test_a_fit_under_full_cells():
    codes = [np.array([0, 0, 1, 1]), np.array([0, 1, 0, 1])]
    tokens, even = np.array([10.0, 90.0, 60.0, 40.0]), np.array([0.5, 0.5])
    kept, held = mixing.fitted(tokens, codes, [even, even], 120.0)
    assert held and kept[0] == 10 and np.allclose(kept, [10, 50, 50, 10], rtol=1e-4)
    kept, held = mixing.fitted(tokens, codes, [even, even], 180.0)  # 140 is the most: the two mixed cells are equal, and one has 60
    assert held and abs(kept.sum() - 140) < 0.1
    assert np.isclose(mixing.raised(tokens, kept, 180.0).sum(), 180)
    lone = [np.array([0, 1]), np.array([0, 1])]  # one cell a category: the two targets contradict each other
    assert not mixing.fitted(np.array([50.0, 50.0]), lone, [even, np.array([0.8, 0.2])], 60.0)[1]


def test_languages_without_a_target_keep_their_share(spark):
    langs = ["en", "de", "it", None]
    rows = [(i, f"some plain words {i} " * (1 + i % 5), "only it" if langs[i % 4] == "it" else "s", langs[i % 4]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = mixing.mix(docs, {"lang": {"en": 0.75, "de": 0.25, "fr": 0.5}}, lower_total=True).collect()
    sampled = sum(r.n_tokens * r.probability for r in got)
    share = {k: sum(r.n_tokens * r.probability for r in got if r.lang == k) / sampled for k in langs}
    had = {k: sum(r.n_tokens for r in got if r.lang == k) ** mixing.TEMPERATURE for k in langs}
    assert share["it"] > 0.2 and share[None] > 0.2
    named = 1 - (had["it"] + had[None]) / sum(had.values())
    wanted = mixing.share_targets(np.array([5, 5, 5, 0]), ["en", "de", None, "it"], {"en": 0.75, "de": 0.25}, 1.0)
    assert np.allclose(wanted, [0.5, 1 / 6, 1 / 3, 0])
    assert abs(share["en"] / share["de"] - 3) < 0.1 and abs(share["en"] + share["de"] - named) < 0.05
    assert mixing.share_targets(np.array([5, 5]), ["en", "it"], {"en": 1.0, "it": 0.0}, 1.0).tolist() == [1, 0]


def test_odd_bits_bound_the_difference():
    rng = random.Random(4)
    for size in (3, 40, 400, 4_000):
        words = [f"w{rng.randrange(10**9)}" for _ in range(size)]
        for edits in (0, 1, size // 20, size // 3):
            other = list(words)
            for i in rng.sample(range(size), min(size, edits)):
                other[i : i + 1] = rng.choice(([], ["new"], ["new", "newer"]))
            a, b = (near_dedup.labelled_shingles(" ".join(w)) for w in (words, other))
            x, y = near_dedup.odd_bits(a), near_dedup.odd_bits(b)
            assert len(x) == near_dedup.ODD_WORDS
            assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))
            assert len(a) > 40 or np.bitwise_count(x ^ y).sum() >= 0.8 * len(np.setxor1d(a, b)) - 1


def test_two_dense_groups_that_resemble_each_other(spark):
    """Copies with up to seven words changed, of two texts of which one is the other with a sixth of its words changed."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    second = [f"v{i}" if i % 6 == 0 and i < 60 else w for i, w in enumerate(base)]
    texts = []
    for source in (base, second):
        for i in range(150):
            words = list(source)
            for at in rng.sample(range(120), i % 8):
                words[at] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    shingles = [near_dedup.labelled_shingles(t) for t in texts]
    label = list(range(len(texts)))
    links = [(a, b) for a in range(len(texts)) for b in range(a) if near_dedup.similar(shingles[a], shingles[b])]
    for _ in range(20):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    assert [got[i] for i in range(len(texts))] == label
    assert len(set(label)) > 2


def test_rounds_go_on_from_the_classes_found(spark, monkeypatch):
    """No round works again on links within a class, and the documents are gone through for their texts once."""
    rng = random.Random(7)
    words, texts = [f"w{i}" for i in range(120)], []
    for i in range(60):  # a drift, in which texts that are far apart are not similar
        words[i] = f"v{i}"
        texts.append(" ".join(w if rng.random() < 0.99 else f"x{rng.randrange(10**6)}" for w in words))
    texts += [texts[0], "", None]
    rounds, written = [], []
    solve, settle = near_dedup.components, near_dedup.settle

    def watched(links):
        rounds.append([(r.a, r.b) for r in links.select("a", "b").collect()])
        return solve(links)

    monkeypatch.setattr(near_dedup, "components", watched)
    monkeypatch.setattr(near_dedup, "settle", lambda df, label: written.append(label) or settle(df, label))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    shingles = [near_dedup.labelled_shingles(t or "") for t in texts]
    label = list(range(len(texts)))
    links = [(a, b) for a in range(len(texts)) for b in range(a) if (texts[a] or "") == (texts[b] or "") or near_dedup.similar(shingles[a], shingles[b])]
    for _ in range(len(texts)):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert [got[i] for i in range(len(texts))] == label
    found = {}
    for pairs in rounds:
        assert all(found.get(a, a) == a and found.get(b, b) == b and a != b for a, b in pairs)
        for _ in range(len(texts)):
            for a, b in pairs:
                low = min(found.get(a, a), found.get(b, b))
                found |= {a: low, b: low}
    assert len(rounds[0]) > 0
    assert written.count("texts") == 1
