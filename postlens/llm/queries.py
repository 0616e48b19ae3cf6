"""The registered queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from postlens.llm.bpe import token_digests
from postlens.llm.chat import format_chats
from postlens.llm.common import read
from postlens.llm.exact_dedup import exact_dedup
from postlens.llm.language import identify_languages
from postlens.llm.lexical import ranked_search
from postlens.llm.license_scan import scan_licenses
from postlens.llm.mixing import mix
from postlens.llm.near_dedup import near_duplicates
from postlens.llm.periodic_runs import planted, run_report
from postlens.llm.quality import score_quality
from postlens.llm.sharding import shard_documents
from postlens.llm.topk import exact_top_k
from postlens.llm.url_filter import filter_urls, urls_to_list

TOKENIZER = "word_bpe_49k.json"
# Languages to given weights, others than these, sources and topics to their tempered shares.
MIX_TARGETS = {"lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}}
Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(read(spark, sf_dir, "conversations"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"), MIX_TARGETS, lower_total=True).drop("digest")


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(read(spark, sf_dir, "embeddings"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return filter_urls(pages, urls_to_list(pages)).drop("possible", "listed")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(read(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(read(spark, sf_dir, "documents"), planted)


QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_bpe": op2_bpe,
    "op3_quality": op3_quality,
    "op4_chat": op4_chat,
    "op5_near_dedup": op5_near_dedup,
    "op6_sharding": op6_sharding,
    "op7_mixing": op7_mixing,
    "op8_top_k": op8_top_k,
    "op9_url_filter": op9_url_filter,
    "op10_license_scan": op10_license_scan,
    "op11_lexical_search": op11_lexical_search,
    "op12_language_id": op12_language_id,
    "op13_periodic_runs": op13_periodic_runs,
}

SQL: dict[str, str] = {
    "op1_exact_dedup": r"""WITH t AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS normal,
                length(coalesce(text, '')) AS points
            FROM documents)
        SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY normal) AS group_size,
            first_value(doc_id) OVER best = doc_id AS kept, sha256(normal) AS text_sha256
        FROM t WINDOW best AS (PARTITION BY normal ORDER BY points DESC, doc_id)""",
    "op4_chat": """WITH c AS (
            SELECT conv_id, list({'r': role, 't': text} ORDER BY turn) AS said FROM conversations GROUP BY conv_id),
        once AS (SELECT min(conv_id) AS conv_id, said, count(*) AS n_logged FROM c GROUP BY said)
        SELECT conv_id, 0 AS segment, len(said) AS n_turns, n_logged, list_aggregate(['<|im_start|>' || s.r || chr(10)
                || s.t || '<|im_end|>' || chr(10) FOR s IN said], 'string_agg', '') AS text
        FROM once a WHERE NOT EXISTS (FROM c b WHERE b.said[1] = a.said[1] AND len(b.said) > len(a.said)
            AND b.said[1:len(a.said)] = a.said)""",
    "op8_top_k": """WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS parts FROM embeddings
            WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding,
                lambda x: x IS NOT NULL AND isfinite(x)))),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.parts, c.parts) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
            vec_id, score
        FROM scored QUALIFY rank <= 10""",
    "op9_url_filter": r"""WITH a AS (
            SELECT page_id, len(regexp_extract_all(html, '[*]{3}|#{3}|[$]{3}|%{3}|(?:&amp;){3}')) AS marks,
                len(regexp_extract_all(html, ' ')) AS blanks,
                CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
        b AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw FROM a),
        c AS (
            SELECT *, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
            FROM b),
        d AS (
            SELECT *, regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(\.html?|/+)$', '') AS canonical
            FROM c),
        listed AS (
            SELECT DISTINCT canonical FROM d WHERE host <> '' AND (
                regexp_matches(host, '(^|\.)(ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm)\.')
                OR marks > 0 AND 10 * marks >= blanks)),
        e AS (
            SELECT *, CASE
                WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
                WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
                WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
                WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
            FROM d)
        SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END AS verdict
        FROM e""",
    "op11_lexical_search": r"""WITH terms AS (
            SELECT place, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM (SELECT *, row_number() OVER () AS place FROM documents)),
        sizes AS (SELECT place, doc_id, count(*) AS n FROM terms GROUP BY place, doc_id),
        whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
        asked AS (
            SELECT item_id, term, count(*) AS times FROM (
                SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                FROM (SELECT DISTINCT item_id, text FROM benchmark))
            GROUP BY item_id, term),
        counted AS (
            SELECT place, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM asked) GROUP BY place, term),
        weighed AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM counted, whole GROUP BY term),
        scored AS (
            SELECT item_id, doc_id, place,
                CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total)))) AS BIGINT) AS score
            FROM asked JOIN counted USING (term) JOIN weighed USING (term) JOIN sizes USING (place), whole
            GROUP BY item_id, doc_id, place)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
            doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= 20""",
}
