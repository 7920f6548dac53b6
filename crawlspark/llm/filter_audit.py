"""Operator 13: how document filters act in every order, by a recursive enumeration over mask cells."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlspark.llm.common import bound_batches, saved

LETTERS = "ABCDE"
#: The letter of the filter for repeated texts, which no text can be judged for alone
COPIES = "E"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 3
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_SYMBOLS = re.compile(rb"[#$%&*|]")


def fails(text: bytes, points: int) -> int:
    """Bits of the filters A, B, C, D that a whole text in UTF-8 of so many code points fails."""
    words = text.split()
    few = len(words) < MIN_WORDS
    repetitive = 100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)
    loud = 100 * (len(text) - len(text.translate(None, _UPPER))) > MAX_UPPER_PERCENT * points
    return few | repetitive << 1 | loud << 2 | (_SYMBOLS.search(text) is not None) << 3


def judged(docs: DataFrame) -> DataFrame:
    """``doc_id, part, mask, digest`` for every row of ``docs(doc_id, text, lang)``; the digest tells texts apart."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"]
            points = pc.utf8_length(texts).to_pylist()
            held = texts.cast(pa.binary() if texts.type == pa.string() else pa.large_binary())
            masks, digests = [], []
            for i in range(batch.num_rows):
                text = held[i].as_py()
                masks.append(fails(text, points[i]))
                digests.append(hashlib.sha256(text).digest())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["part"], pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
                ["doc_id", "part", "mask", "digest"],
            )

    read = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce("lang", F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return read.mapInArrow(run, "doc_id long, part string, mask int, digest binary")


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with ``good`` and ``toxic``: whether any label row of the doc_id says so. Null ids have none."""
    marks = (
        labels.filter(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(
            F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
            F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
        )
    )
    named = rows.filter(F.col("doc_id").isNotNull()).join(marks, "doc_id", "left").fillna(False, ["good", "toxic"])
    # rows without an id would all meet in one task of the join
    return named.unionByName(
        rows.filter(F.col("doc_id").isNull()).withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    )


def mask_cells(rows: DataFrame, copies_bit: int) -> DataFrame:
    """``part, mask, good, toxic, n``: rows counted by what they fail; a text's later copies fail ``copies_bit`` too.

    A row is a copy if a row with a smaller doc_id has its text. Copies are counted in groups, so a text
    that a third of all rows hold comes to a few rows before any two of its groups meet.
    """
    cell = ["part", "mask", "good", "toxic"]
    by_id = rows.groupBy("digest", *cell, "doc_id").agg(F.count("*").alias("n"))
    by_text = by_id.groupBy("digest", *cell, F.col("doc_id").isNull().alias("anonymous")).agg(
        F.sum("n").alias("n"), F.min(F.struct("doc_id", F.col("n").alias("rows"))).alias("first")
    )
    smallest = F.min("first.doc_id").over(Window.partitionBy("digest"))
    originals = F.when(F.col("anonymous"), F.col("n")).when(F.col("first.doc_id") == F.col("smallest"), F.col("first.rows"))
    split = by_text.withColumn("smallest", smallest).withColumn("originals", F.coalesce(originals, F.lit(0).cast("long")))
    both = F.array(
        F.struct(F.col("mask").alias("m"), F.col("originals").alias("k")),
        F.struct(F.col("mask").bitwiseOR(copies_bit).alias("m"), (F.col("n") - F.col("originals")).alias("k")),
    )
    return (
        split.select("part", "good", "toxic", F.explode(both).alias("x"))
        .filter("x.k > 0")
        .groupBy("part", F.col("x.m").alias("mask"), "good", "toxic")
        .agg(F.sum("x.k").alias("n"))
    )


# Every row of the walk is a prefix of filter orders in one part: `before` holds the bits applied ahead of the
# last filter, `bit` that filter's. A level joins the cells of the part and counts them for its step.
_WALK = """
WITH RECURSIVE walk(part, prefix, step, before, bit, kept, removed, redundant, unique_fails, good_lost, toxic_lost) AS (
  SELECT part, '', 0, 0, 0, 0L, 0L, 0L, 0L, 0L, 0L FROM {cells}
  UNION ALL
  SELECT part, prefix || letter, step, before, bit,
    aggregate(cells, 0L, (s, c) -> s + if(c.mask & (before | bit) = 0, c.n, 0L)),
    aggregate(cells, 0L, (s, c) -> s + if(c.mask & before = 0 AND c.mask & bit <> 0, c.n, 0L)),
    aggregate(cells, 0L, (s, c) -> s + if(c.mask & before <> 0 AND c.mask & bit <> 0, c.n, 0L)),
    aggregate(cells, 0L, (s, c) -> s + if(c.mask = bit, c.n, 0L)),
    aggregate(cells, 0L, (s, c) -> s + if(c.mask & before = 0 AND c.mask & bit <> 0 AND c.good, c.n, 0L)),
    aggregate(cells, 0L, (s, c) -> s + if(c.mask & before = 0 AND c.mask & bit <> 0 AND c.toxic, c.n, 0L))
  FROM (
    SELECT w.part, w.prefix, w.step + 1 AS step, w.before | w.bit AS before, next.bit, next.letter, k.cells
    FROM walk w
    JOIN {cells} k ON k.part = w.part
    LATERAL VIEW explode(filter(k.letters, l -> (w.before | w.bit) & l.bit = 0)) AS next
  )
)
SELECT * FROM walk WHERE step > 0
"""
_COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def walk_orders(cells: DataFrame, letters: Sequence[str]) -> DataFrame:
    """Counts of every step of every order of the filters, from ``cells(part, mask, good, toxic, n)``.

    Bit i of a mask belongs to ``letters[i]``. A recursive query extends prefixes by their unused
    letters, so what orders share at their beginning is counted once: 325 prefixes for 5 letters and
    120 orders. Rows grow with the parts and the factorial of the letters alone.
    """
    spark = cells.sparkSession
    bits = F.array(*(F.struct(F.lit(c).alias("letter"), F.lit(1 << i).alias("bit")) for i, c in enumerate(letters)))
    by_part = saved(
        cells.groupBy("part")
        .agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("cells"))
        .withColumn("letters", bits),
        "cells",
    )
    # the prefixes of a part, the empty one included; the session's bound on recursive rows must let them through
    prefixes = total = 1
    for left in range(len(letters), 0, -1):
        total *= left
        prefixes += total
    needed = (prefixes + 1) * by_part.count()
    limit = "spark.sql.cteRecursionRowLimit"
    if 0 <= int(spark.conf.get(limit)) < needed:
        spark.conf.set(limit, str(needed))
    steps = saved(spark.sql(_WALK, cells=by_part), "steps")

    orders = steps.filter(F.col("step") == len(letters)).select("part", F.col("prefix").alias("filter_order"))
    each = orders.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters))))).withColumn(
        "prefix", F.expr("substr(filter_order, 1, step)")
    )
    found = saved(each.join(steps.drop("step"), ["part", "prefix"]).withColumn("letter", F.expr("right(prefix, 1)")), "orders")
    shapley = found.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return found.join(shapley, ["part", "letter"]).select("part", "filter_order", "step", *_COUNTS, "shapley")


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, filter_order, step`` and the counts of that step for ``docs(doc_id, text, lang)``.

    Filters are A (under 200 words), B (under half of the words distinct), C (over 3 % of the code points
    are A-Z), D (one of ``#$%&*|``) and E (a smaller doc_id anywhere has the same text). A part is a lang;
    null counts as the empty string. ``kept, removed, redundant, unique_fails, good_lost, toxic_lost`` and
    ``shapley`` (the filter's removals over all orders) count rows, zeros included.

    Null texts are empty. Rows that repeat a doc_id count each and are no copies of each other; rows
    without a doc_id are no copies and make none, and have no label. A document is good or toxic if any
    of its label rows says 1. Long texts are read whole, in small batches. An empty table has no part and
    gives no rows; other columns, whatever their names, are not read.
    """
    rows = saved(judged(docs), "judged")
    cells = saved(mask_cells(with_labels(rows, labels), 1 << LETTERS.index(COPIES)), "mask-cells")
    return walk_orders(cells, LETTERS)
