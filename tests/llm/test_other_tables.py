"""Operators over pages, embeddings and conversations, the pipeline, and the queries that have SQL."""

import math

import numpy as np
import oracle
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from postlens.llm import chat, queries, topk, url_filter


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_is_its_sql(spark, name):
    got = oracle.spark_rows(queries.QUERIES[name](spark, oracle.SF_DIR))
    assert got == oracle.sql_rows(oracle.connect(), queries.SQL[name])


def test_top_k_edges(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [0.5]), (3, None), (4, [float("nan"), 1.0]), (5, [1.0, None])]
    rows += [(100, [3.0, -1.0]), (100, [3.0, -1.0]), (7, []), (None, [1.0, 1.0]), (8, [float("inf"), 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = [tuple(r) for r in topk.exact_top_k(table, k=3).orderBy("query_id", "rank").collect()]
    unit = 1024 * 1024
    assert got[:3] == [(0, 1, 1, 5 * unit), (0, 2, 100, unit), (0, 3, 100, unit)]
    assert got[3:] == [(100, 1, 2, 3 * unit // 2), (100, 2, 0, unit), (100, 3, 1, unit)]
    assert topk.exact_top_k(table.limit(0)).count() == 0


def test_every_query_is_answered(spark):
    """Two vectors under one query id, one of them twice; and a table of empty vectors only."""
    rows = [(100, [1.0, 0.0]), (100, [0.0, 1.0]), (100, [0.0, 1.0]), (1, [2.0, 0.0]), (2, [0.0, 3.0]), (100, None)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in topk.exact_top_k(table).collect())
    unit = 1024 * 1024
    assert got == sorted([(100, 1, 1, 2 * unit), (100, 2, 2, 0), (100, 1, 2, 3 * unit), (100, 2, 1, 0)])
    empty = spark.createDataFrame([(100, []), (200, []), (7, [])], "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in topk.exact_top_k(empty).collect())
    assert got == [(100, 1, 7, 0), (100, 2, 200, 0), (200, 1, 7, 0), (200, 2, 100, 0)]


@pytest.mark.parametrize("clusters", [1, 12])
def test_top_k_is_brute_force_on_few_and_many_blocks(spark, monkeypatch, clusters):
    """Small blocks; one place or twelve far from each other, a third of the rows one vector, ids repeated."""
    for name, size in (("ROWS_PER_BLOCK", 40), ("QUERIES_PER_BLOCK", 7), ("BRIEFS_PER_TASK", 9), ("PIVOT_SAMPLE", 300)):
        monkeypatch.setattr(topk, name, size)
    random = np.random.default_rng(5)
    centres = random.normal(size=(clusters, 8)) * 6
    vectors = centres[random.integers(0, clusters, 1500)] + random.normal(size=(1500, 8)) * 0.2
    vectors[::3] = centres[0]
    ids = [int(i) % 1400 for i in range(1500)]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors, strict=True)], "vec_id long, embedding array<double>")
    whole = [tuple(int(np.floor(1024 * x)) for x in v) for v in vectors]
    asked = {(i, v) for i, v in zip(ids, whole, strict=True) if i % 100 == 0}
    wanted = []
    for query, own in asked:
        scores = sorted((-sum(a * b for a, b in zip(own, v, strict=True)), i) for i, v in zip(ids, whole, strict=True) if i != query)
        wanted += [(query, rank, i, -minus) for rank, (minus, i) in enumerate(scores[:10], 1)]
    got = [tuple(r) for r in topk.exact_top_k(table).collect()]
    assert sorted(got) == sorted(wanted)


def test_blocks_out_of_reach_do_not_meet(spark):
    """Of two far places only the one of the queries is shipped to them."""
    random = np.random.default_rng(6)
    sides = np.where(np.arange(6000)[:, None] < 3000, 1.0, -1.0) * np.eye(16)[0] * 20
    vectors = sides + random.normal(size=(6000, 16)) * 0.1
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    given = topk.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    met = topk.first_met(given, 16)
    pivots = topk.choose_pivots(met[1], 8)
    candidates = topk.pack(topk.by_nearest_pivot(given, pivots, 16), pivots, 16, 100)
    asked = given.where("vec_id < 3000 AND vec_id % 100 = 0")
    queries = topk.pack(topk.by_nearest_pivot(asked, pivots, 16), pivots, 16, 100, met, 10)
    met_blocks = {r.block for r in topk.meetings(candidates, queries).collect()}
    own = {r.block for r in candidates.collect() if np.frombuffer(r.ids, dtype=np.int64).min() < 3000}
    assert met_blocks <= own and 0 < len(own) < candidates.count()


@pytest.mark.parametrize("pivots", [1, 2, 7, 40])
def test_places_bound_distances_at_least_as_well_as_single_pivots(pivots):
    """Between the widest gap and the true distance, also where pivots repeat or are more than dimensions."""
    random = np.random.default_rng(pivots)
    vectors = np.floor(random.normal(size=(60, 10)) * 1024)
    table = np.vstack([vectors[: pivots - pivots // 3], vectors[: pivots // 3]])
    distances = topk.distances_to(table, vectors)
    places = topk.places_from(distances, table)
    for i, j in random.integers(0, 60, (200, 2)):
        bound, true = np.linalg.norm(places[i] - places[j]), np.linalg.norm(vectors[i] - vectors[j])
        assert np.abs(distances[i] - distances[j]).max() - 0.01 <= bound <= true + 0.01


def test_urls(spark):
    urls = [None, "", "no scheme", "HTTP://WWW.Spam.Org/a/?x#y", "https://spam.org/a.html", "a://b://c/d", "http://x.net?q", "http://x.net/q"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("rule", F.lit(1))
    listed = spark.createDataFrame([("spam.org/a",), ("spam.org/a",), (None,)], "listed_url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, listed).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("www.spam.org", "/a/", None, "block") and got[4] == ("spam.org", "/a.html", None, "block")
    assert got[5][:2] == ("b:", "//c/d")
    assert got[6] == ("x.net", "", None, "allow") and got[7] == ("x.net", "/q", "net/", "block")
    assert url_filter.filter_urls(pages.limit(0), listed.limit(0)).count() == 0


def test_the_list_comes_from_what_pages_hold(spark):
    """Junk html lists all spellings of its URL; clean html none, on whatever host; names list without any html."""
    junk, clean = "<p>one*** two### three&amp;&amp;&amp; four%%%", "<p>" + "a plain word ** of 5% " * 20
    rows = [("http://www.a.org/x.html?y", junk), ("https://a.org/x/", clean), ("http://a.org/y", clean), (None, junk), ("junk", junk)]
    rows += [("http://b.spam-farm.c.org/" + "z" * 100_000, None), ("http://c.org/", ""), ("http://d.org/", clean + " ***")]
    rows += [("http://e.org/#t", "***"), ("http://e.org", None), ("http://e.org", None)]
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    pages = pages.withColumns({"host": F.lit("x"), "listed_url": F.lit("y"), "canonical": F.lit("z")})
    listed = url_filter.urls_to_list(pages)
    assert sorted({r.listed_url for r in listed.collect()}) == ["a.org/x", "b.spam-farm.c.org/" + "z" * 100_000, "e.org"]
    blocked = {r.page_id for r in url_filter.filter_urls(pages, listed).collect() if r.verdict == "block"}
    assert blocked == {0, 1, 5, 8, 9, 10}
    assert url_filter.urls_to_list(pages.limit(0)).count() == 0
    assert "b.spam-farm" not in str(url_filter.urls_to_list(pages, names=[]).collect())


def test_the_filter_drops_no_page_and_stops_most(spark):
    """A listed page is always possible, few others are, and what is listed is exactly the join."""
    pages = spark.range(20_000).selectExpr("id AS page_id", "concat('http://h', id % 50, '.org/', id) AS url")
    listed = pages.where("page_id % 7 = 0").selectExpr("concat('h', page_id % 50, '.org/', page_id) AS listed_url")
    got = url_filter.filter_urls(pages, listed).selectExpr("page_id % 7 = 0 AS bad", "possible", "listed").collect()
    assert len(got) == 20_000
    assert all(r.listed == r.bad and (r.possible or not r.bad) for r in got)
    assert sum(r.possible and not r.bad for r in got) < 200


def test_chats(spark):
    rows = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "yes"), (2, 1, "assistant", "yes")]
    rows += [(3, 5, "user", "hi"), (3, 9, "assistant", "yes"), (4, 0, "user", "hi"), (4, 1, "assistant", "no")]
    rows += [(None, None, None, None), (5, 0, "user", ""), (6, 0, "user", None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("place", F.lit(1))
    got = {r.conv_id: (r.n_turns, r.n_logged, r.text) for r in chat.format_chats(table).collect()}
    line = "<|im_start|>{}\n{}<|im_end|>\n".format
    assert got[2] == (2, 2, line("user", "hi") + line("assistant", "yes"))
    assert set(got) == {None, 2, 4, 5, 6}
    assert got[5][2] == got[6][2] == got[None][2] == line("user", "")
    assert chat.format_chats(table.limit(0)).count() == 0


def test_differing_rows_of_a_turn_all_stay(spark):
    rows = [(1, 0, "user", "A"), (1, 0, "user", "A2"), (1, 1, "assistant", "B"), (1, 1, "assistant", "B2"), (1, 1, "assistant", "B2")]
    rows += [(2, *r[1:]) for r in reversed(rows)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.format_chats(table).collect()
    assert [(r.conv_id, r.n_turns, r.n_logged) for r in got] == [(1, 4, 2)]
    said = [line.split("\n")[1] for line in got[0].text.split("<|im_end|>\n")[:-1]]
    assert sorted(said[:2]) == ["A", "A2"] and sorted(said[2:]) == ["B", "B2"]


def test_a_long_conversation_goes_over_blocks_and_segments(spark):
    turns = 2 * chat.TURNS_PER_SEGMENT + 10
    long = spark.range(turns).selectExpr("1L AS conv_id", "id AS turn", "'user' AS role", "CAST(id AS STRING) AS text")
    short = long.where("turn < 700").withColumn("conv_id", F.lit(0).cast("long"))
    got = chat.format_chats(long.union(short)).orderBy("segment").collect()
    assert [r.conv_id for r in got] == [1] * math.ceil(turns / chat.TURNS_PER_SEGMENT)
    assert "".join(r.text for r in got).count("<|im_start|>") == turns


def test_pipeline(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    seen, before = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        seen = corpus_pipeline.settle(stage(spark, seen, "/root/testdata/sf0.001"), "test-stage")
        assert seen.columns == before, name
        assert seen.exceptAll(docs).isEmpty()
    assert 0 < corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() == seen.count() < docs.count()


def test_pipeline_stages_on_edge_cases(spark, edge_docs, no_docs):
    """Null ids, texts and sources, repeated rows, a very long text, clashing columns; and no rows at all."""
    sf_dir = "/root/testdata/sf0.001"
    seen, empty = edge_docs, no_docs
    for name, stage in corpus_pipeline.STAGES:
        given = [tuple(r) for r in seen.collect()]
        seen = corpus_pipeline.settle(stage(spark, seen, sf_dir), "test-stage")
        empty = corpus_pipeline.settle(stage(spark, empty, sf_dir), "test-stage")
        assert empty.count() == 0
        if name != "bpe":
            assert seen.columns == edge_docs.columns == empty.columns
            assert {tuple(r) for r in seen.collect()} <= set(given), name
        else:
            assert seen.count() == len(given)
            assert all(r.n_tokens == len(r.ids) for r in seen.collect())


def test_pipeline_ends_in_the_ids(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    library = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    for r in rows:
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids
