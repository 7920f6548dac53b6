"""Catalogs of any size: an inverted index from text pieces to rules, joined with the pieces of pages.

Nothing here is a constant of a plan. A rule is listed under the rarest piece of the texts that all its
matches contain. Pages give the pieces that the index may hold, as a bit filter of bounded size tells;
a join on the piece gives candidates, and every page gets the list of its candidates, which are
checked in its row. Rules without sure texts are held against all pages, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bytes of a piece: the largest size that a rule's texts have
PIECE_SIZES = (8, 4, 2)

# Words of 64 bits of the filter: 16 bits for a rule, 8 MB at most
MIN_WORDS_LOG2, MAX_WORDS_LOG2 = 10, 20

# Positions of a text that are looked at together
POSITIONS_AT_ONCE = 1 << 20

# Rules in one list beside a page
RULES_PER_LIST = 2_000

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def pieces(text: bytes, size: int) -> Iterator[np.ndarray]:
    """Hashes of all byte runs of a size, a bounded number at a time; different runs have different ones."""
    raw = np.frombuffer(text, np.uint8)
    for start in range(0, len(raw) - size + 1, POSITIONS_AT_ONCE):
        part = raw[start : start + POSITIONS_AT_ONCE + size - 1]
        runs = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(part, size))
        values = runs.view(f"<u{size}").ravel().astype(np.uint64) * _FACTOR + np.uint64(size)
        values = (values ^ (values >> np.uint64(31))) * _FACTOR
        yield values ^ (values >> np.uint64(29))


def rule_pieces(texts: list[str]) -> np.ndarray:
    """Distinct pieces of a rule's texts, of the largest size they have."""
    whole = [t.encode() for t in texts]
    size = next(s for s in PIECE_SIZES if s <= max(map(len, whole)))
    return np.unique(np.concatenate([p for t in whole for p in pieces(t, size)]))


def piece_index(rules: DataFrame) -> DataFrame:
    """``piece, rule``: every rule of ``rules(rule, texts)`` under the piece that the fewest rules share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [rule_pieces(texts) for texts in batch["texts"].to_pylist()]
            rows = np.repeat(batch["rule"].to_numpy(), [len(f) for f in found])
            every = np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(every), pa.array(rows)], ["piece", "rule"])

    every = rules.select("rule", "texts").mapInArrow(run, "piece long, rule long")
    shared = every.groupBy("piece").agg(F.count("*").alias("n"))
    rarest = F.min_by("piece", F.struct("n", "piece")).alias("piece")
    return every.join(shared, "piece").groupBy("rule").agg(rarest).select("piece", "rule")


def piece_filter(index: DataFrame, rules: int) -> np.ndarray:
    """Words of bits that tell which pieces the index may hold; they are put together by Spark."""
    log2 = min(max(int(rules).bit_length() - 2, MIN_WORDS_LOG2), MAX_WORDS_LOG2)
    bit = F.expr("shiftleft(1L, cast(piece & 63 as int))")
    words = (
        index.groupBy(F.shiftrightunsigned("piece", 64 - log2).alias("at")).agg(F.bit_or(bit).alias("word")).toArrow()
    )
    held = np.zeros(1 << log2, np.uint64)
    held[words["at"].to_numpy()] = words["word"].to_numpy().view(np.uint64)
    return held


def page_pieces(text: bytes, words: np.ndarray) -> np.ndarray:
    """Distinct pieces of a whole page that the filter lets through."""
    shift = np.uint64(64 - (len(words).bit_length() - 1))
    kept = [np.zeros(0, np.uint64)]
    for size in PIECE_SIZES:
        for found in pieces(text, size):
            listed = (words[found >> shift] >> (found & np.uint64(63))) & np.uint64(1)
            kept.append(np.unique(found[listed.astype(bool)]))
    return np.unique(np.concatenate(kept))


def candidates(pages: DataFrame, index: DataFrame, rules: int, text: str) -> DataFrame:
    """``_row, rule``: rules whose piece is in the page, each once for a page."""
    words = pages.sparkSession.sparkContext.broadcast(piece_filter(index, rules))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # one page at a time, not a list of them
            found = [page_pieces((t.as_py() or "").encode(), words.value) for t in batch[text]]
            rows = np.repeat(batch["_row"].to_numpy(), [len(f) for f in found])
            every = np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(every)], ["_row", "piece"])

    hits = pages.select("_row", text).mapInArrow(run, "_row long, piece long")
    return hits.join(index, "piece").select("_row", "rule")


def _holds(rule: Column, text: Column) -> Column:
    """Whether a page has a rule's texts and matches its regular expression."""
    sure = F.forall(F.coalesce(rule["texts"], F.array().cast("array<string>")), lambda t: F.contains(text, t))
    return sure & (rule["regex"].isNull() | F.rlike(text, rule["regex"]))


def _matches(lists: DataFrame, text: str) -> DataFrame:
    """``_row, app_name, app_type`` of the rules in ``listed`` that the page beside them matches."""
    held = F.filter("listed", lambda rule: _holds(rule, F.col(text)))
    apps = F.array_distinct(F.transform(held, lambda r: F.struct(r["app_name"], r["app_type"])))
    return lists.select("_row", F.explode(apps).alias("a")).select(
        "_row", F.col("a.app_name").alias("app_name"), F.col("a.app_type").alias("app_type")
    )


def indexed_matches(
    pages: DataFrame, rules: DataFrame, text: str, headers: str | None, saved
) -> DataFrame:
    """``_row, app_name, app_type``, distinct, of ``pages(_row, text, headers)`` for ``rules`` of any number.

    ``rules`` have ``app_name, app_type, header_name, regex, texts``; ``saved`` writes a table and reads it
    back. A page with very many candidates has them in several lists. Null pages match nothing.
    """
    rules = saved(rules.distinct().withColumn("rule", F.monotonically_increasing_id()), "rules")
    body = rules.where(F.col("app_type") != "headers")
    sure = body.where(F.size("texts") > 0)
    entry = F.struct("app_name", "app_type", "regex", "texts").alias("entry")

    index = saved(piece_index(sure), "piece-index")
    wanted = candidates(pages, index, index.count(), text).join(sure.select("rule", entry), "rule")
    many = F.ceil(F.count("*").over(Window.partitionBy("_row")) / F.lit(RULES_PER_LIST))
    part = F.pmod(F.xxhash64("rule"), many)
    lists = (
        wanted.withColumn("part", part).groupBy("_row", "part").agg(F.collect_list("entry").alias("listed")).drop("part")
    )
    found = [_matches(lists.join(pages.select("_row", text), "_row"), text)]

    unsure = saved(body.where(F.coalesce(F.size("texts"), F.lit(0)) <= 0).select("rule", entry), "unsure")
    blocks = -(-unsure.count() // RULES_PER_LIST)
    if blocks:
        block = F.pmod(F.xxhash64("rule"), F.lit(blocks)).alias("block")
        listed = unsure.groupBy(block).agg(F.collect_list("entry").alias("listed"))
        numbers = F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))
        each = pages.select("_row", text, F.explode(numbers).alias("block"))
        found.append(_matches(each.join(listed, "block"), text))

    if headers is not None:
        named = rules.where(F.col("app_type") == "headers").select("app_name", "app_type", "header_name", "regex")
        sent = pages.select("_row", F.explode(headers).alias("header_name", "header_value"))
        hit = sent.join(named, "header_name").where(F.rlike("header_value", F.col("regex")))
        found.append(hit.select("_row", "app_name", "app_type"))

    united = found[0]
    for more in found[1:]:
        united = united.unionByName(more)
    return saved(united.distinct(), "found")
