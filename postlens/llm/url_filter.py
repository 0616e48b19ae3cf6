"""URL filtering by rules and by a list of URLs behind a blocked Bloom filter."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import settle

# Host, path and verdict of each rule.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
# Names in a host whose URLs are listed, whatever their pages hold: the bad hosts of the test data.
LISTED_NAMES = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
# A sign repeated three times is a junk mark; a page with one for every tenth blank, or more, is shown bad by what it holds.
JUNK_MARK = r"[*]{3}|#{3}|[$]{3}|%{3}|(?:&amp;){3}"
BLANKS_PER_MARK = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

WORDS_PER_BLOCK = 8  # of 64 bits each
BITS_PER_URL = 16
PROBES = 8


def after_scheme(url: str = "url") -> Column:
    """What follows the first ``://``; empty where there is none."""
    at = F.instr(F.col(url), "://")
    return F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise(F.lit(""))


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``; both empty for a null url or one without ``://``."""
    rest = F.coalesce(after_scheme(), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + 1), r"^[^?#]*", 0)
    return pages.withColumns({"host": F.translate(host, UPPER, LOWER), "path": path})


def canonical_url() -> Column:
    """One form for the spellings of a page: no scheme, query, fragment, leading ``www.`` or ``m.``, ending or final slash."""
    host = F.regexp_replace("host", r"^(www|m)\.", "")
    return F.concat(host, F.regexp_replace("path", r"(\.html?|/+)$", ""))


def rule_columns(rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict, or nulls. Rules are constants, so this stays one expression."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, kind in sorted(rules, key=lambda r: len(r[0] + r[1])):  # the longest is asked first
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        name = F.when(fits, host + path).otherwise(name)
        verdict = F.when(fits, kind).otherwise(verdict)
    return name, verdict


# ---- the blocked Bloom filter ----------------------------------------------------------------------------------------


def blocks_for(n_listed: int) -> int:
    return max(1, -(-n_listed * BITS_PER_URL // (64 * WORDS_PER_BLOCK)))


def block_of(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def masks_of(url: Column) -> list[Column]:
    """The bits a URL sets in its block, as one mask per word: ``PROBES`` pieces of 9 bits from two further hashes."""
    hashes = [F.xxhash64(F.lit(f"probe {i}"), url) for i in range(-(-PROBES // 7))]
    bits = [F.shiftrightunsigned(hashes[i // 7], 9 * (i % 7)).bitwiseAND(F.lit(511)) for i in range(PROBES)]
    words = [F.shiftrightunsigned(bit, 6) for bit in bits]
    set_bits = [F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int")) for bit in bits]
    return [
        reduce(
            Column.bitwiseOR,
            [F.when(word == i, one).otherwise(F.lit(0).cast("long")) for word, one in zip(words, set_bits, strict=True)],
        )
        for i in range(WORDS_PER_BLOCK)
    ]


def build_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """A row per block that has bits: ``block`` and its words ``w0`` to ``w7``. Built by or-ing masks, map-side first."""
    masked = listed.select(
        block_of(F.col("listed_url"), blocks).alias("block"),
        *[mask.alias(f"w{i}") for i, mask in enumerate(masks_of(F.col("listed_url")))],
    )
    return masked.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS_PER_BLOCK)])


def with_possible_hit(pages: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """Adds ``possible``: whether the filter has all bits of the page's canonical URL.

    The filter is a table of blocks and joined by block, so it may grow with the list; only a small one gets broadcast,
    which the engine decides by its size.
    """
    masked = pages.withColumn("its_block", block_of(F.col("canonical"), blocks))
    joined = masked.join(bloom, F.col("its_block") == F.col("block"), "left")
    has_all = [
        F.col(f"w{i}").bitwiseAND(mask) == mask for i, mask in enumerate(masks_of(F.col("canonical")))
    ]
    possible = F.coalesce(reduce(Column.__and__, has_all), F.lit(False))
    return joined.select(*pages.columns, possible.alias("possible"))


# ---- the operator ----------------------------------------------------------------------------------------------------


def filter_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """Each page's host, path, fitting rule and verdict.

    ``listed`` has one column ``listed_url`` of canonical URLs, repeats and nulls allowed. The longest fitting rule
    decides. Where none fits, a page is blocked if its canonical URL is listed: the Bloom filter passes all such pages and
    a few others on to a hash join with the list, which is exact. Pages the filter stops never reach that join. A null or
    malformed url has empty host and path and a canonical URL of its own, the empty one. Columns besides ``page_id`` and
    ``url`` are not read.
    """
    listed = settle(listed.where("listed_url IS NOT NULL").select("listed_url").distinct(), "listed")
    blocks = blocks_for(listed.count())
    rule, ruled = rule_columns(rules)
    narrow = with_host_and_path(pages.select("page_id", "url"))
    narrow = narrow.select("page_id", "host", "path", canonical_url().alias("canonical"), rule.alias("rule"), ruled.alias("ruled"))
    tested = settle(with_possible_hit(narrow, build_filter(listed, blocks), blocks), "tested")
    stopped = tested.where("NOT possible").withColumn("listed_url", F.lit(None).cast("string"))
    passed = tested.where("possible").join(listed, F.col("canonical") == F.col("listed_url"), "left")
    method = F.when(F.col("listed_url").isNotNull(), "block").otherwise("allow")
    return stopped.unionByName(passed).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", method).alias("verdict"),
        "possible",
        F.col("listed_url").isNotNull().alias("listed"),
    )


def shown_bad(html: str = "html") -> Column:
    """Whether a page's html is full of junk marks. Asked of the whole html; a null or empty one shows nothing."""
    text = F.coalesce(F.col(html), F.lit(""))
    marks, blanks = F.regexp_count(text, F.lit(JUNK_MARK)), F.regexp_count(text, F.lit(" "))
    return (marks > 0) & (marks * BLANKS_PER_MARK >= blanks)


def urls_to_list(pages: DataFrame, names: list[str] = LISTED_NAMES) -> DataFrame:
    """Canonical URLs of bad pages, as a list for ``filter_urls``; repeats stay in.

    A page is bad if its host has one of the names between its dots, or if its html shows it. As the list holds canonical
    URLs, all spellings of a bad page's URL are listed with it, also those whose own html was clean when it was read. A url
    without a host names no page and is not listed. Columns besides ``url`` and ``html`` are not read.
    """
    read = with_host_and_path(pages.select("url", "html"))
    bad = shown_bad()
    if names:
        bad = F.col("host").rlike(rf"(^|\.)({'|'.join(names)})\.") | bad
    return read.where((F.col("host") != "") & bad).select(canonical_url().alias("listed_url"))
