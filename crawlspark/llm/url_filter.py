"""Operator 5: judge URLs by rules, then by a list behind a blocked Bloom filter and an exact join."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.common import saved

WORDS = 8  # 64-bit words in a block; a URL sets one bit in each
BITS_PER_URL = 16
MAX_BLOCKS = 2**18  # 16 MB: the largest filter that is sent to the executors

# Odd multipliers, one for each word of a block. Fixed: filters are comparable between runs.
SALTS = [0x47B6137B, 0x44974D91, 0x0824AD5B, 0x2248A6D5, 0x705495C7, 0x2DF1424B, 0x1EFC4947, 0x5C6BFB31]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRACKING = r"^(utm_[a-z]+|ref|gclid|fbclid)="


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str  # with its leading slash

    @property
    def name(self) -> str:
        return self.host + self.path


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty for null or without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """Up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.translate(F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """A URL without scheme, default port, trailing slashes, fragment and tracking parameters.

    The host is in lower case and the other parameters are sorted. Empty for null or without ``://``.
    """
    host = F.regexp_replace(host_of(url), r":(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def matching_rule(host: Column, path: Column, rules: Iterable[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null. The rules are a short policy list."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def bloom_filter(keys: DataFrame, column: str, max_blocks: int = MAX_BLOCKS) -> np.ndarray:
    """Blocked Bloom filter of the distinct strings in ``column``: an array of blocks x 8 words.

    Every key sets one bit in each word of one block. The blocks are summed up on the executors and
    only the finished filter, never over ``max_blocks`` x 64 bytes, reaches the driver. Beyond that
    size it passes more false hits, which the exact join removes.
    """
    wanted = keys.count() * BITS_PER_URL // (64 * WORDS)
    blocks = 1
    while blocks < min(wanted, max_blocks):
        blocks *= 2
    hashed = F.xxhash64(column)
    low = hashed.bitwiseAND(F.lit(0x7FFFFFFF))
    block = F.shiftrightunsigned(hashed, 32).bitwiseAND(F.lit(blocks - 1))
    bit = [
        F.expr(f"shiftleft(1L, cast(shiftright((__low * {salt}L) & 4294967295L, 26) as int))") for salt in SALTS
    ]
    rows = (
        keys.select(block.alias("block"), low.alias("__low"))
        .select("block", *(b.alias(f"w{i}") for i, b in enumerate(bit)))
        .groupBy("block")
        .agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)))
        .toArrow()
    )
    words = np.zeros((blocks, WORDS), np.uint64)
    at = rows["block"].to_numpy()
    for i in range(WORDS):
        words[at, i] = rows[f"w{i}"].to_numpy().view(np.uint64)
    return words


def probe(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """True where all bits of a hash are set in its block."""
    low = hashes.astype(np.int64) & 0x7FFFFFFF
    block = words[(hashes.view(np.uint64) >> np.uint64(32)).astype(np.int64) & (len(words) - 1)]
    hit = np.ones(len(hashes), bool)
    for i, salt in enumerate(SALTS):
        bit = ((low * salt) & 0xFFFFFFFF) >> 26
        hit &= (block[:, i] >> bit.astype(np.uint64)) & np.uint64(1) == 1
    return hit


def filter_urls(
    pages: DataFrame, listed: DataFrame, rules: Iterable[Rule], max_blocks: int = MAX_BLOCKS
) -> DataFrame:
    """``page_id, host, path, rule, verdict, maybe_listed`` of every row of ``pages(page_id, url)``.

    The longest rule that fits decides. Without one, a page is blocked if its canonical URL is that
    of a row of ``listed(url)``: a Bloom filter passes possible hits, and an exact join decides them.
    Repeated rows are judged one by one; a null url or one without ``://`` has an empty host and path,
    fits no rule and is allowed. Empty tables give empty results; other columns are not read.
    """
    keys = saved(
        listed.select(canonical(F.col("url")).alias("key")).filter("key <> ''").distinct(), "listed-urls"
    )
    filter_bits = pages.sparkSession.sparkContext.broadcast(bloom_filter(keys, "key", max_blocks))

    @F.pandas_udf("boolean")
    def possible(hashes: pd.Series) -> pd.Series:
        return pd.Series(probe(filter_bits.value, hashes.to_numpy(np.int64)))

    url = F.col("url")
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    judged = (
        pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("key"))
        .withColumns({"rule": rule, "ruled": verdict})
        .withColumn("maybe_listed", possible(F.xxhash64("key")) & F.col("rule").isNull() & (F.col("key") != ""))
    )
    found = judged.filter("maybe_listed").join(keys.withColumn("listed", F.lit(True)), "key", "left")
    rest = judged.filter("not maybe_listed").withColumn("listed", F.lit(False))
    return found.unionByName(rest).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
        "maybe_listed",
    )
