"""Periodic runs: the catcher against brute force, and the report's edge cases."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from postlens.llm import periodic_runs as pr


def plain_runs(words):
    """Every maximal stretch of every period, kept if no smaller period holds for the whole stretch."""
    n, best = len(words), {}
    for q in range(1, n // pr.PERIODS + 1):
        at = q
        while at < n:
            end = at
            while end < n and words[end] == words[end - q]:
                end += 1
            if end - at + q >= max(pr.LEAST, pr.PERIODS * q):
                best.setdefault((at - q, end), q)
            at = end + 1
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def caught(words, cuts=()):
    catcher = pr.SquareCatcher()
    for part in np.split(np.array(words, dtype=np.int64), sorted(cuts)):
        catcher.append(part)
    return catcher.runs()


pieces = st.lists(
    st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 9), st.integers(0, 3)), max_size=7
)


@settings(max_examples=300, deadline=None)
@given(pieces, st.data())
def test_catcher_is_brute_force(parts, data):
    words = [w for cycle, times, more in parts for w in cycle * times + cycle[:more]]
    wanted = plain_runs(words)
    assert caught(words) == wanted
    cuts = data.draw(st.lists(st.integers(0, len(words)), max_size=6))
    assert caught(words, cuts) == wanted


def test_word_by_word():
    rng = random.Random(2)
    for _ in range(60):
        words = []
        while len(words) < 90:
            cycle = [rng.randrange(3) for _ in range(rng.randrange(1, 20))]
            words += (cycle * rng.randrange(1, 7))[: rng.randrange(1, 80)]
        catcher = pr.SquareCatcher()
        for i, word in enumerate(words):
            catcher.append(np.array([word]))
            if i % 10 == 0:
                assert catcher.runs() == plain_runs(words[: i + 1])
        assert catcher.runs() == plain_runs(words)


def test_words_that_defeat_a_rolling_hash_and_long_runs():
    thue = [0]
    while len(thue) < 2**13:
        thue += [1 - w for w in thue]
    assert caught(thue) == []
    assert caught([7] * 200_000) == [(0, 200_000, 1)]
    long = list(range(30_000)) * 5
    assert caught([*long, 3, 1, *([5, 6] * 9)]) == [(0, 150_000, 30_000), (150_002, 18, 2)]
    assert caught([*long, 0, 1]) == [(0, 150_002, 30_000)]


def test_documents_do_not_touch():
    held = [b"a b".split() * 3, b"a b".split() * 3, [], b"x x x x x x".split(), b"x x x".split()]
    assert pr.runs_of(held) == [plain_runs(words) for words in held] == [[], [], [], [(0, 6, 1)], []]
    assert pr.runs_of([]) == []


def plain_report(doc_id, text, rewrite=None):
    words = [w for w in (text or "").encode().split()]
    words = rewrite(doc_id, words) if rewrite else words
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda data: hashlib.sha256(data).hexdigest()
    told = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *told, sha("".join("%d,%d,%d\n" % r for r in runs).encode()), sha(kept))


def plain_planted(doc_id, words):
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_report_on_the_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    wanted = {plain_report(r.doc_id, r.text, plain_planted) for r in docs.collect()}
    got = {tuple(r) for r in pr.run_report(docs, pr.planted).collect()}
    assert got == wanted
    assert sum(r[1] > 0 for r in got) > 5


def test_edges(edge_docs, no_docs):
    got = sorted((tuple(r) for r in pr.run_report(edge_docs).collect()), key=repr)
    short = edge_docs.where("length(text) < 1000 OR text IS NULL").collect()
    assert [r for r in got if not r[1]] == sorted((plain_report(r.doc_id, r.text) for r in short), key=repr)
    assert [r[:6] for r in got if r[1]] == [(i, 1, 0, 30_000, 1, 30_000_000) for i in (6, 7)]
    texts = {r.doc_id: r.text for r in pr.collapse_runs(edge_docs).where("doc_id IN (3, 4, 5, 6, 7)").collect()}
    assert texts == {3: "", 4: "", 5: "", 6: "word end", 7: "word end more"}
    rows = pr.periodic_runs(edge_docs)
    assert rows.columns == ["doc_id", "start", "length", "period"] and rows.count() == 2
    for table in (pr.run_report(no_docs), pr.periodic_runs(no_docs), pr.collapse_runs(no_docs)):
        assert table.count() == 0


@pytest.mark.parametrize("blanks", ["\x0b", "\x1c", "\xa0", "\x85"])
def test_only_the_six_blanks_part_words(blanks):
    assert len(pr.words_of(f"a{blanks}b")) == (2 if blanks == "\x0b" else 1)
