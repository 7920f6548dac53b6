"""Operator 8: SimHash fingerprints, linked by multi-index hashing, grouped by connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.common import bound_batches, components, saved

SHINGLE = 3
SEED = 42
MAX_BITS = 3  # fingerprints link at so many differing bits or fewer
HALF_BITS = 32
#: Buckets with more fingerprints are compared in blocks, which report a spanning forest, not pairs.
DENSE = 64
BLOCK = 2_048
HASHES_AT_ONCE = 65_536


def fingerprint(text: str | None, words: int = SHINGLE) -> int:
    """64-bit SimHash of a whole text: a bit is set if it is set in over half of the shingles' hashes.

    A-Z count as a-z; shingles are counted as often as they occur; with fewer words the whole sequence
    is the one shingle; without words the fingerprint is zero.
    """
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(found) - words + 1)
    last = ends[words - 1 :] if len(found) >= words else ends[-1:]
    spans = list(zip(starts[:n].tolist(), last.tolist(), strict=True))
    set_in = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for i in range(0, n, HASHES_AT_ONCE):
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in spans[i : i + HASHES_AT_ONCE]])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        set_in += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_in > n).tobytes())


def fingerprints(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed long) for every row."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, words) for t in batch["text"].to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(fps)], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def _half(fp: Column, segment: int) -> Column:
    return (F.shiftrightunsigned(fp, HALF_BITS) if segment else fp.bitwiseAND(F.lit(0xFFFFFFFF))).cast("long")


def forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of fingerprints that join just what the links between ``left`` and ``right`` join.

    A left fingerprint is paired with every right one that no earlier one has reached, and with one
    earlier left fingerprint of each group it meets, which become one group: fewer pairs than members.
    """
    near = np.bitwise_count(left[:, None] ^ right[None, :]) <= MAX_BITS
    near &= left[:, None] != right[None, :]
    a, b = [left[:0]], [left[:0]]
    group = np.arange(len(left))
    reached_by = np.full(len(right), -1)
    for i in np.flatnonzero(near.any(axis=1)):
        hit = np.flatnonzero(near[i])
        new = hit[reached_by[hit] < 0]
        met = np.unique(group[reached_by[hit[reached_by[hit] >= 0]]])
        a.append(np.full(len(new) + len(met), left[i]))
        b += [right[new], left[met]]
        group[np.isin(group, met)] = i
        reached_by[new] = i
    return np.concatenate(a), np.concatenate(b)


def _block_links(rows: pd.DataFrame) -> pd.DataFrame:
    fps, second = rows["fp"].to_numpy(np.int64), rows["second"].to_numpy(bool)
    a, b = forest(fps[~second], fps[second])
    return pd.DataFrame({"a": a, "b": b})


def near_links(nodes: DataFrame) -> DataFrame:
    """Pairs ``a, b`` that join just those of the distinct fingerprints ``nodes(fp)`` which 3 or fewer bits join.

    Of two fingerprints that differ in at most 3 bits, one half differs in at most 1. So each
    fingerprint is kept in a table for each half and fetches, by its own half and the 32 that differ
    from it in one bit, the others; whole distances are then verified. Buckets in which many
    fingerprints crowd, as those of near copies do, are compared with each other in blocks dealt over
    all tasks, and each pair of blocks reports a spanning forest: no bucket meets in one task and its
    pairs are never rows. A pair of a crowded and another bucket is fetched from the other.
    """
    each = F.array(*(F.struct(F.lit(s).alias("seg"), _half(F.col("fp"), s).alias("half")) for s in (0, 1)))
    halves = saved(nodes.select("fp", F.explode(each).alias("x")).select("fp", "x.*"), "halves")
    sizes = halves.groupBy("seg", "half").agg(F.count("*").alias("n")).filter(F.col("n") > DENSE)
    dense = saved(
        sizes.select("seg", "half", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int").alias("blocks")), "dense"
    )
    ball = F.array(F.lit(0).cast("long"), *(F.lit(1 << i).cast("long") for i in range(HALF_BITS)))

    def reach(df: DataFrame) -> DataFrame:
        return df.withColumn("to", F.explode(F.transform(ball, lambda bit: F.col("half").bitwiseXOR(bit))))

    light = halves.join(dense, ["seg", "half"], "left_anti").select("seg", F.col("half").alias("to"), F.col("fp").alias("b"))
    differ = F.bit_count(F.col("fp").bitwiseXOR(F.col("b")))
    fetched = (
        reach(halves)
        .join(light, ["seg", "to"])
        .filter((F.col("fp") != F.col("b")) & (differ <= MAX_BITS))
        .select(F.col("fp").alias("a"), "b")
    )

    other = dense.select("seg", F.col("half").alias("to"), F.col("blocks").alias("to_blocks"))
    tasks = (
        reach(dense)
        .join(other, ["seg", "to"])
        .filter("half <= to")
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("to_blocks") - 1)))
        .filter("half < to or i <= j")
    )
    key = ["seg", "half", "to", "i", "j"]
    member = halves.join(dense, ["seg", "half"]).withColumn(
        "block", F.pmod(F.xxhash64("fp"), F.col("blocks").cast("long")).cast("int")
    )
    tasks = saved(tasks.select(*key), "dense-tasks")
    sides = [
        member.select("seg", F.col("half").alias(own), F.col("block").alias(part), "fp")
        .join(tasks, ["seg", own, part])
        .select(*key, "fp", F.lit(own == "to").alias("second"))
        for own, part in (("half", "i"), ("to", "j"))
    ]
    crowded = sides[0].unionByName(sides[1]).groupBy(*key).applyInPandas(_block_links, "a long, b long")
    return fetched.unionByName(crowded)


def near_duplicates(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs(doc_id, text)``.

    Fingerprints that differ in 3 bits or fewer link; component_id is the smallest doc_id that links
    reach. Equal fingerprints, so all copies, are one node of the graph. Null and empty texts have the
    fingerprint zero and link like others. Repeated rows are rows of their own in one component; a null
    doc_id keeps its row and is never a component_id unless its component has no other. An empty table
    gives an empty result; other columns are not read.
    """
    fps = saved(fingerprints(docs, words), "fingerprints")
    nodes = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = saved(components(near_links(nodes)).withColumnRenamed("node", "fp"), "components")
    linked = nodes.join(roots, "fp")
    smallest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    grouped = linked.join(smallest, "root").select("fp", "component_id")
    named = nodes.join(grouped, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id"))
    # written first, so that the join below stands alone and a fingerprint with many rows can be split
    named = saved(named, "named")
    return fps.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` that their group keeps: the one with the smallest doc_id, once if rows repeat it.

    Rows without a doc_id that have no other in their group stay as one row for each distinct text.
    """
    found = saved(near_duplicates(docs, words), "groups")
    keep = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    kept = docs.alias("d").join(keep.alias("k"), F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")), "left_semi")
    named = kept.filter(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"])
    return named.unionByName(kept.filter(F.col("doc_id").isNull()).dropDuplicates(["text"]))
