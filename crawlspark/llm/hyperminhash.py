"""Operator 12: near duplicates by HyperMinHash sketches, verified on whole sets of shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.common import bound_batches, components, saved

WORDS = 3
#: Sets link if 100 x intersection >= PERCENT x union.
PERCENT = 85
#: A sketch has so many buckets, a power of two; each keeps the least hash that falls into it as a register.
BUCKETS = 128
#: A register is the number of leading zeros and the so many bits after the first one.
MANTISSA = 10
#: Bands of equal registers: a pair at 0.85 shares none of 24 bands of 4 in 2 of a hundred million cases.
BANDS, ROWS = 24, 4
#: Pairs whose estimated similarity is lower are not verified: 0.2 is over six deviations of an estimate at 0.85.
SLACK = 0.2
#: Members of a cluster, and their bytes, that a task holds against others at once.
BLOCK = 2_048
BLOCK_BYTES = 1 << 24
#: Rows of two numbers that are broadcast at most.
KEYS_BROADCAST = 4_000_000
#: Words whose hashes a task keeps at once.
WORDS_KEPT = 200_000
SEED = 42
_FACTORS = np.random.default_rng(SEED).integers(0, 2**63, 2 * WORDS + 8, np.uint64) * np.uint64(2) + np.uint64(1)
#: For every bucket the order in which an empty one looks for another's register.
_DONORS = np.random.default_rng(SEED + 1).permuted(np.tile(np.arange(BUCKETS), (BUCKETS, 1)), axis=1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on all bits of ``x``; one to one."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _WordHashes(dict):
    """64-bit hashes of words, each computed once while it is kept."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word, SEED)
        return found


def shingles(text: str | None, hashes: dict[bytes, int] | None = None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text.

    A-Z count as a-z; a text with fewer words is one shingle, which equals no other text's longer one; a
    text without words has none.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = _WordHashes() if hashes is None else hashes
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(WORDS, len(words))
    total = np.full(len(words) - size + 1, _FACTORS[-size], np.uint64)
    for i in range(size):
        total += _mixed(each[i : len(words) - size + 1 + i] * _FACTORS[i])
    return np.unique(_mixed(total))


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a sorted set of hashes that is not empty: one 16-bit register for every bucket.

    The leading bits of a hash name its bucket, the rest is the number whose least value the bucket keeps,
    as a count of leading zeros and a mantissa. An empty bucket takes the register of the first other one
    in its own fixed order, so every register is equal in two sets with a probability of their similarity.
    """
    bits = BUCKETS.bit_length() - 1
    starts = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(64 - bits)
    first = np.searchsorted(hashes, starts)
    filled = np.append(first[1:], len(hashes)) > first
    rest = (hashes[np.minimum(first, len(hashes) - 1)] << np.uint64(bits)) | np.uint64(1)
    zeros = np.clip(64 - np.frexp(rest.astype(np.float64))[1], 0, 63)
    # the first one itself is not stored
    mantissa = ((rest << zeros.astype(np.uint64)) << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    found = (zeros.astype(np.uint16) << np.uint16(MANTISSA)) | mantissa.astype(np.uint16)
    empty = np.flatnonzero(~filled)
    if len(empty):
        order = _DONORS[empty]
        found[empty] = found[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    return found


def chance_equal(sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Probability that registers of two sets without a common hash are equal all the same.

    The least of n hashes spread over the buckets has nearly the density r exp(-r x) with r = n / BUCKETS;
    both must fall into one of the 2**MANTISSA cells of one octave of leading zeros.
    """
    a, b = (np.maximum(np.asarray(s, np.float64) / BUCKETS, 1.0) for s in (sizes_a, sizes_b))
    total = np.zeros(np.broadcast(a, b).shape)
    for octave in range(64):
        low = 0.5 ** (octave + 1)
        total += low * (np.exp(-(a + b) * low) - np.exp(-(a + b) * 2 * low))
    return total * a * b / (a + b) / 2**MANTISSA


def estimates(left: np.ndarray, right: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Estimated similarity of rows of registers, with equal registers by chance taken out."""
    equal = (left == right).mean(axis=-1)
    chance = chance_equal(sizes_a, sizes_b)
    return (equal - chance) / (1 - chance)


def linked(both, size_a, size_b):
    """Whether sets of these sizes with so many common hashes link, in whole numbers."""
    return 100 * both >= PERCENT * (size_a + size_b - both)


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, row_key, node, n, sketch`` for every row; equal sets of n shingles are one node.

    ``row_key`` is a hash of the id and the text, by which a row's text is found again.
    """
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WordHashes()
        for batch in batches:
            nodes, sizes, held = [], [], []
            texts = batch["text"]
            for i in range(batch.num_rows):
                found = shingles(texts[i].as_py(), words)
                nodes.append(xxhash.xxh64_intdigest(found.tobytes(), SEED))
                sizes.append(len(found))
                held.append(registers(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"], batch["row_key"], pa.array(np.array(nodes, np.uint64).view(np.int64)),
                    pa.array(sizes, pa.int64()), pa.array(held, pa.binary()),
                ],
                ["doc_id", "row_key", "node", "n", "sketch"],
            )

    return _keyed(docs).mapInArrow(run, "doc_id long, row_key long, node long, n long, sketch binary")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row_key"))


def _matrix(column: pa.Array | list[bytes]) -> np.ndarray:
    held = column if isinstance(column, list) else column.to_pylist()
    return np.frombuffer(b"".join(held), np.uint16).reshape(len(held), BUCKETS)


def leader_pairs(nodes: DataFrame) -> DataFrame:
    """Distinct pairs ``a, b`` of a node and the least other node of a bucket they share; saved."""
    width = 2 * ROWS
    bands = F.array(*(F.xxhash64(F.lit(k), F.substring("sketch", 1 + k * width, width)) for k in range(BANDS)))
    members = nodes.select(F.col("node").alias("a"), F.explode(bands).alias("bucket"))
    least = members.groupBy("bucket").agg(F.min("a").alias("b"), F.count("*").alias("m")).filter("m > 1")
    return saved(members.join(least, "bucket").filter("a <> b").select("a", "b").distinct(), "leaders")


def encoded(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Whole sets of nodes told by those of their leaders, for ``pairs(a, b)`` of a node and a leader; saved.

    ``missing`` are the places in the leader's sorted set that a's lacks, ``extra`` its hashes that the
    leader's lacks: for near copies a small part of the set. ``na, nb`` are the sizes, ``near`` tells whether
    the two link. Texts are read again for the nodes of pairs alone; a pair carries the text of one end to
    the other's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WordHashes()
        leader, last = np.zeros(0, np.uint64), None
        for batch in batches:
            a, b, left, right = (batch[c] for c in ("a", "b", "left", "right"))
            rows = []
            for i in range(batch.num_rows):
                # rows of one leader mostly come together
                if b[i].as_py() != last:
                    leader, last = shingles(right[i].as_py(), words), b[i].as_py()
                own = shingles(left[i].as_py(), words)
                missing = np.flatnonzero(~np.isin(leader, own, assume_unique=True)).astype(np.int32)
                extra = np.setdiff1d(own, leader, assume_unique=True)
                both = len(own) - len(extra)
                near = linked(both, len(own), len(leader))
                rows.append((len(own), len(leader), missing.tobytes(), extra.tobytes(), bool(near)))
            na, nb, missing, extra, near = zip(*rows, strict=True) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    a, b, pa.array(na, pa.int64()), pa.array(nb, pa.int64()), pa.array(missing, pa.binary()),
                    pa.array(extra, pa.binary()), pa.array(near, pa.bool_()),
                ],
                ["a", "b", "na", "nb", "missing", "extra", "near"],
            )

    bound_batches(docs.sparkSession, 500)
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = saved(ends.join(nodes.select("node", "row_key"), "node"), "wanted")
    # few keys spare all other texts the way through a shuffle
    few = wanted.count() <= KEYS_BROADCAST
    texts = _keyed(docs).join(F.broadcast(wanted) if few else wanted, "row_key").groupBy("node").agg(F.first("text").alias("text"))
    texts = saved(texts, "texts")
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("left")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("right")), "b"
    )
    schema = "a long, b long, na long, nb long, missing binary, extra binary, near boolean"
    return saved(both.select("a", "b", "left", "right").mapInArrow(run, schema), "encoded")


class _Tokens:
    """Lists of numbers of many rows, of which each may be held against all."""

    def __init__(self, lists: list[np.ndarray]) -> None:
        self.lists = lists
        self.ends = np.cumsum([0, *map(len, lists)])
        self.all = np.concatenate(lists) if lists else np.zeros(0, np.int64)

    def common(self, own: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """How many of ``own`` every row holds; ``marks`` is all false before and after."""
        marks[own] = True
        counts = np.concatenate(([0], np.cumsum(marks[self.all])))[self.ends]
        marks[own] = False
        return np.diff(counts)


def cluster_links(rows: pd.DataFrame) -> tuple[list[int], list[int]]:
    """Links between open and all members of one leader's cluster that join what all such links join.

    Sketches are compared first; where the estimate leaves a link possible, the whole sets decide: with the
    leader's size n, missing places M and extras E, two sets share n - |M1| - |M2| + |M1 & M2| + |E1 & E2|.
    """
    node, group, size = (rows[c].to_numpy(np.int64) for c in ("node", "grp", "na"))
    opens = np.flatnonzero(rows["open"].to_numpy(bool))
    others = np.flatnonzero(rows["other"].to_numpy(bool))
    if not len(opens) or len(np.unique(group)) < 2:
        return [], []
    sketch = _matrix(list(rows["sketch"]))
    leader = int(rows["nb"].iloc[0])
    missing = [np.frombuffer(x, np.int32) for x in rows["missing"]]
    extra = [np.frombuffer(x, np.uint64) for x in rows["extra"]]
    numbers, ids = np.unique(np.concatenate(extra), return_inverse=True)
    extra = np.split(ids, np.cumsum([len(x) for x in extra])[:-1])
    lacking, added = _Tokens([missing[i] for i in others]), _Tokens([extra[i] for i in others])
    lacks = np.diff(lacking.ends)
    marks = [np.zeros(leader, bool), np.zeros(len(numbers), bool)]
    # groups of this call as they are joined
    now = {int(g): int(g) for g in np.unique(group)}

    def find(g: int) -> int:
        while now[g] != g:
            g = now[g]
        return g

    a, b = [], []
    for i in opens:
        n, m = size[i], size[others]
        may = (group[others] != group[i]) & (100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m))
        at = np.flatnonzero(may)
        if not len(at):
            continue
        at = at[estimates(sketch[others[at]], sketch[i], m[at], n) >= PERCENT / 100 - SLACK]
        if not len(at):
            continue
        both = leader - len(missing[i]) - lacks + lacking.common(missing[i], marks[0]) + added.common(extra[i], marks[1])
        for hit in others[at[linked(both[at], n, m[at])]]:
            x, y = find(int(group[i])), find(int(group[hit]))
            if x != y:
                now[max(x, y)] = min(x, y)
                a.append(int(node[i]))
                b.append(int(node[hit]))
    return a, b


def _block_links(rows: pd.DataFrame) -> pd.DataFrame:
    a, b = [], []
    for _, cluster in rows.groupby("b", sort=False):
        more = cluster_links(cluster)
        a += more[0]
        b += more[1]
    return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


def _open_links(found: DataFrame, grouped: DataFrame) -> DataFrame:
    """Links between the members of clusters that are not in their leader's group yet and all other members.

    ``found`` are the encoded members of the clusters, ``grouped(node, sketch, grp)`` the nodes. Small clusters
    go to tasks together, a large one is dealt over many: its members in blocks, each held against every
    block of its open members. What comes back joins groups, never more rows than there are groups in a block.
    """
    leaders = grouped.select(F.col("node").alias("b"), F.col("grp").alias("main"))
    placed = found.withColumnRenamed("a", "node").join(grouped, "node").join(leaders, "b")
    placed = placed.withColumn("open", F.col("grp") != F.col("main"))
    weight = F.octet_length("missing") + F.octet_length("extra") + F.octet_length("sketch")

    def blocks(rows: Column, size: Column) -> Column:
        return F.greatest(F.ceil(rows / F.lit(BLOCK)), F.ceil(size / F.lit(BLOCK_BYTES))).cast("int")

    is_open = F.col("open").cast("long")
    sizes = placed.groupBy("b").agg(
        F.count("*").alias("m"),
        F.sum(weight.cast("long")).alias("size"),
        F.sum(is_open).alias("opens"),
        F.sum(weight.cast("long") * is_open).alias("open_size"),
    )
    # the leader's own group needs no look, nor does a single open member beside it
    sizes = sizes.filter("opens > 0 and m > 1").select(
        "b",
        "size",
        blocks(F.col("m"), F.col("size")).alias("blocks"),
        blocks(F.col("opens"), F.col("open_size")).alias("open_blocks"),
    )
    sizes = saved(sizes, "clusters")
    total = sizes.filter("blocks = 1").agg(F.sum("size")).first()[0] or 0
    tasks = -(-total // BLOCK_BYTES) + 1
    dealt = placed.join(sizes.drop("size"), "b").select(
        "b", "node", "na", "nb", "missing", "extra", "sketch", "grp", "open", "blocks", "open_blocks",
        F.pmod(F.xxhash64(F.lit(1), "node"), F.col("blocks")).cast("int").alias("block"),
        F.pmod(F.xxhash64(F.lit(2), "node"), F.col("open_blocks")).cast("int").alias("open_block"),
    )
    small = dealt.filter("blocks = 1").select(
        "*",
        F.lit(None).cast("long").alias("of"),
        F.pmod(F.xxhash64("b"), F.lit(tasks)).cast("int").alias("i"),
        F.lit(0).alias("j"),
        F.lit(True).alias("other"),
    )
    large = dealt.filter("blocks > 1").withColumn("of", F.col("b"))
    as_other = large.withColumns(
        {"i": F.col("block"), "j": F.explode(F.sequence(F.lit(0), F.col("open_blocks") - 1)), "other": F.lit(True)}
    ).withColumn("open", F.lit(False))
    as_open = large.filter("open").withColumns(
        {"i": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), "j": F.col("open_block"), "other": F.lit(False)}
    )
    parts = small.unionByName(as_other).unionByName(as_open).drop("blocks", "open_blocks", "block", "open_block")
    return saved(parts.groupBy("of", "i", "j").applyInPandas(_block_links, "a long, b long").distinct(), "open-links")


def near_groups(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """``(node, root)`` of the ``nodes(node, n, row_key, sketch)`` that links join with others.

    All members of a bucket belong to the cluster of its leader, so nodes that share a bucket share a cluster,
    and a node has few leaders. Members are verified with their leaders, which joins most near copies;
    then members outside their leader's group are held against all others of the cluster. No pair but that
    of member and leader, and links that join groups, is ever a row.
    """
    pairs = leader_pairs(nodes)
    found = encoded(pairs, nodes, docs)
    links = found.filter("near").select("a", "b")
    roots = saved(components(links), "groups-first")
    grouped = nodes.join(roots, "node", "left").select("node", "sketch", F.coalesce("root", "node").alias("grp"))
    more = _open_links(found.drop("near"), saved(grouped, "grouped"))
    if more.isEmpty():
        return roots
    joined = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)
    return saved(components(joined), "groups-last")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text)``.

    Texts link if 85 % or more of the union of their sets of three-word shingles is in both;
    ``component_id`` is the smallest doc_id that links reach, ``kept`` whether it is the row's own. Bands
    of HyperMinHash registers bring together what may be similar, the estimate without chance collisions
    leaves out pairs that are far from it, and the whole sets decide.

    Texts without words, null ones too, have no shingles and stand alone. Repeated rows are rows of their
    own in one component and share its verdict. A null doc_id keeps its row and names a component only
    if no member has an id; the row is kept then. Long texts are sketched whole, in small batches. An empty
    table gives an empty result; other columns, whatever their names, are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = saved(sketches(docs), "sketches")
    nodes = found.filter("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("first"),
        F.min("row_key").alias("row_key"),
        F.first("n").alias("n"),
        F.first("sketch").alias("sketch"),
    )
    nodes = saved(nodes, "nodes")
    roots = near_groups(nodes, docs)
    linked = nodes.select("node", "first").join(roots, "node")
    smallest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    named = saved(linked.join(smallest, "root").select("node", "component_id"), "named")
    firsts = nodes.select("node", "first").join(named, "node", "left")
    # written first, so that the join below stands alone and a node with many rows can be split
    firsts = saved(firsts.select("node", F.coalesce("component_id", "first").alias("component_id")), "firsts")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.join(firsts, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        own.alias("component_id"),
        F.col("doc_id").eqNullSafe(own).alias("kept"),
    )
