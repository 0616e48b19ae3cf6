"""The corpus pipeline: stages over the documents, each written as a table before the next reads it.

In every stage a null or empty text is a text without words, a text of any length is worked on whole, and null or repeated
ids are allowed. All stages but the last return whole rows with the columns they were given, whatever these are called; an
empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.bpe import token_digests
from postlens.llm.common import read, settle
from postlens.llm.exact_dedup import keep_distinct
from postlens.llm.mixing import keep_mixed
from postlens.llm.near_dedup import keep_one_per_class
from postlens.llm.quality import keep_good
from postlens.llm.queries import MIX_TARGETS, TOKENIZER

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; it learns from the labels of these documents.

    Without labels of both classes nothing can be learned, and all stay. Rows repeated under one id are scored each.
    """
    return keep_good(docs, read(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays: the longest, then that of the least id; a null id comes last. All
    empty texts are one group."""
    return keep_distinct(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, that of the least id; a null id comes last. Texts without
    words are only like equal ones."""
    return keep_one_per_class(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with languages at their target weights, sources and topics tempered, as large as these allow.

    A null source or language is a value like any other; documents without tokens weigh nothing.
    """
    return keep_mixed(docs, MIX_TARGETS, lower_total=True)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with their counts and digests; a row per document, without tokens an empty array."""
    return token_digests(docs, public_tokenizers.path(TOKENIZER), with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("exact dedup", exact_dedup_stage),
    ("near dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

ORACLE_SQL = None  # models, samples and token ids are beyond SQL; tests hold each stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
