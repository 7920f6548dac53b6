"""Operator 11: prefix trie of rebuilt conversations from composable fingerprints."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlspark.llm.common import crc_of, saved

#: Rebuilt conversations begin with turns of the one whose id is the next lower multiple of this.
FAMILY = 100
#: A rebuilt conversation takes fewer first turns than this from another one.
HEADS = 6
#: Moduli of the fingerprints: products stay below 2**62.
PRIMES = (2_147_483_647, 2_147_483_629, 2_147_483_587)
#: Powers are products of table entries, one for each 8 bits of the exponent.
DIGIT = 256
DIGITS = 4
#: Ids of one row of an end's list.
IDS_AT_ONCE = 8_192
TRIES = 4
KEY = ["depth", "fa", "fb"]


def _base(prime: int, seed: int) -> int:
    draw = hashlib.sha256(f"{prime} {seed}".encode()).digest()
    return 1_000_003 + int.from_bytes(draw[:8]) % (prime - 2_000_006)


def power(base: int, exponent: Column, prime: int) -> Column:
    """``base ** exponent`` modulo ``prime`` for exponents from 0 to 2**32."""
    out = None
    for i in range(DIGITS):
        step = pow(base, DIGIT**i, prime)
        held = F.lit([pow(step, d, prime) for d in range(DIGIT)]).cast("array<long>")
        factor = F.get(held, F.shiftright(exponent, 8 * i).bitwiseAND(DIGIT - 1).cast("int"))
        out = factor if out is None else out * factor % F.lit(prime)
    return out


def segment_totals(df: DataFrame, segment: str, order: Sequence[str], values: Sequence[str], purpose: str) -> DataFrame:
    """``df`` with ``<value>_before`` (the sum over earlier rows of its segment) for every value; saved.

    Rows are sorted by range of segment and order over many tasks, so a segment with a third of all rows
    lies in many. Each task sums its part of a segment and adds the totals of the earlier parts.
    """
    held = saved(
        df.repartitionByRange(segment, *order).withColumn("__range", F.spark_partition_id()), f"{purpose}-ranges"
    )
    parts = held.groupBy("__range", segment).agg(*(F.sum(v).alias(f"__{v}") for v in values))
    earlier = Window.partitionBy(segment).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "__range", segment, *(F.coalesce(F.sum(f"__{v}").over(earlier), F.lit(0)).alias(f"__{v}") for v in values)
    )
    inside = Window.partitionBy("__range", segment).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    kept = df.columns
    out = held.withColumns({f"{v}_before": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values}).join(
        offsets, ["__range", segment]
    )
    return saved(
        out.select(*kept, *((F.col(f"{v}_before") + F.col(f"__{v}")).alias(f"{v}_before") for v in values)), purpose
    )


def positioned(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, ref, chars`` for every turn that has a conv_id; saved.

    ``ref`` stands for role and text: it is their SHA-256, the role with its length ahead. ``pos`` counts
    from 0 by turn, null first; equal turns go by ``ref``.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.sha2(whole, 256)).alias("ref"),
        F.length(text).cast("long").alias("chars"),
        F.lit(1).cast("long").alias("one"),
    )
    placed = segment_totals(turns, "conv_id", ["turn", "ref"], ["one"], "turns")
    return placed.select("conv_id", F.col("one_before").alias("pos"), "ref", "chars")


def turn_value(seed: int, i: int) -> Column:
    """A turn's number modulo the i-th prime."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(i), "ref"), F.lit(PRIMES[i]))


def prefix_products(turns: DataFrame, seed: int) -> DataFrame:
    """``turns`` with ``h0, h1, h2``, the fingerprint of all turns up to and with this one, and ``b0, b1, b2``, up to it; saved.

    A turn t at position i is the product t * B**i; a sequence is the pair of its length and the sum of its
    turns' products, and (n, H) followed by (m, G) is (n + m, H + B**n * G).
    """
    terms = {
        f"t{i}": turn_value(seed, i) * power(_base(p, seed), F.col("pos"), p) % F.lit(p) for i, p in enumerate(PRIMES)
    }
    summed = segment_totals(turns.withColumns(terms), "conv_id", ["pos"], list(terms), "products")
    return summed.select(
        *turns.columns,
        *(((F.col(f"t{i}_before") + F.col(f"t{i}")) % F.lit(p)).alias(f"h{i}") for i, p in enumerate(PRIMES)),
        *((F.col(f"t{i}_before") % F.lit(p)).alias(f"b{i}") for i, p in enumerate(PRIMES)),
    )


def _node(fingerprint: Sequence[Column]) -> list[Column]:
    return [(F.shiftleft(fingerprint[0], 31).bitwiseOR(fingerprint[1])).alias("fa"), fingerprint[2].alias("fb")]


def memberships(products: DataFrame, seed: int) -> DataFrame:
    """``conv_id, depth, fa, fb, ref, chars, length`` and ``pa, pb``, the parent's ``fa, fb``; saved.

    A row for every turn of every rebuilt conversation, and one of depth 0. A rebuilt conversation is
    the product of a head of its family's first conversation and of a rest of its own. Heads are looked
    up; a rest's products follow from the conversation's own by taking the head's away and shifting
    the difference by the head's length. No turn is copied and no text is read.
    """
    prints = [F.col(f"h{i}") for i in range(len(PRIMES))]
    turn = F.struct("pos", "ref", "chars", *prints)
    near = products.filter(F.col("pos") < HEADS - 1).groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("first"))
    sizes = products.groupBy("conv_id").agg(F.count("*").alias("own"))
    each = saved(sizes.join(near, "conv_id"), "conversations")
    head = F.pmod(crc_of(F.col("conv_id")), F.lit(HEADS))
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    bases = each.filter(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("family"), F.col("first").alias("base")
    )
    plain = each.withColumns({"family": family, "h": head}).join(bases, "family", "left")
    base = F.slice(F.coalesce("base", F.expr("slice(first, 1, 0)")), F.lit(1), F.col("h").cast("int"))
    cut = F.least("h", "own")
    zero = F.lit(0).cast("long")

    def at(turns: Column, count: Column, i: int) -> Column:
        """The fingerprint of so many first turns."""
        return F.when(count == 0, zero).otherwise(F.get(turns, (count - 1).cast("int"))[f"h{i}"])

    shaped = plain.withColumn("base", base).withColumn("taken", F.size("base").cast("long"))
    shaped = shaped.withColumns(
        {f"own{i}": at(F.col("first"), cut, i) for i in range(len(PRIMES))}
        | {f"head{i}": at(F.col("base"), F.col("taken"), i) for i in range(len(PRIMES))}
    )
    length = F.col("taken") + F.col("own") - cut
    shaped = saved(shaped.withColumn("length", length).drop("first", "family"), "rebuilt")

    none = F.lit(None).cast("binary")
    root = F.struct(zero.alias("pos"), none.alias("ref"), zero.alias("chars"), *(zero.alias(f"h{i}") for i in range(len(PRIMES))))
    # the head's turns, the root ahead of them; x is a node, y the one above it
    path = F.concat(F.array(root), F.transform("base", lambda x: x.withField("pos", x["pos"] + 1)))
    steps = F.transform(F.sequence(F.lit(0), F.size(path) - 1), lambda i: F.struct(F.get(path, i).alias("x"), F.get(path, i - 1).alias("y")))
    heads = (
        shaped.select("conv_id", "length", F.explode(steps).alias("s"))
        .select("conv_id", "length", "s.x", "s.y")
        .select(
            "conv_id",
            F.col("x.pos").alias("depth"),
            *_node([F.col(f"x.h{i}") for i in range(len(PRIMES))]),
            F.col("x.ref").alias("ref"),
            F.col("x.chars").alias("chars"),
            "length",
            *(c.alias(n) for c, n in zip(_node([F.col(f"y.h{i}") for i in range(len(PRIMES))]), ("pa", "pb"), strict=True)),
        )
    )

    def rebuilt(i: int, own: Column) -> Column:
        """Fingerprint of the head followed by the own turns from the cut on, of which ``own`` is the product with all before."""
        p = PRIMES[i]
        back = [pow(_base(p, seed), -j, p) for j in range(HEADS)]
        # the head is never longer than the cut but for conversations that end before it
        shift = F.get(F.lit(back).cast("array<long>"), (F.col("h") - F.col("taken")).cast("int"))
        return (F.col(f"head{i}") + F.pmod(own - F.col(f"own{i}"), F.lit(p)) * shift % F.lit(p)) % F.lit(p)

    rest = products.join(shaped.drop("base", "own"), "conv_id").filter(F.col("pos") >= F.col("h"))
    rests = rest.select(
        "conv_id",
        (F.col("taken") + F.col("pos") - F.col("h") + 1).alias("depth"),
        *_node([rebuilt(i, F.col(f"h{i}")) for i in range(len(PRIMES))]),
        "ref",
        "chars",
        "length",
        *(c.alias(n) for c, n in zip(_node([rebuilt(i, F.col(f"b{i}")) for i in range(len(PRIMES))]), ("pa", "pb"), strict=True)),
    )
    return saved(heads.unionByName(rests), "memberships")


def _hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of every node's lists joined by commas, of rows sorted by node and place; holds one list at a time."""
    node, state = None, None
    for batch in batches:
        done = []
        for *key, ids in zip(*(batch[c].to_pylist() for c in (*KEY, "ids")), strict=True):
            if key != node:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256(ids)
            else:
                state.update(b"," + ids)
        yield _end_rows(done)
    if node is not None:
        yield _end_rows([(*node, state.hexdigest())])


def _end_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [*KEY, "ends_sha256"])


def _join_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of up to ``IDS_AT_ONCE`` ids of one node, comma-joined, of rows sorted by node and id."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        key = np.column_stack([batch[c].to_numpy() for c in KEY])
        starts = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1))))
        bounds = np.unique(np.concatenate((starts, np.arange(0, n, IDS_AT_ONCE), [n])))
        ids = batch["conv_id"].to_pylist()
        joined = [",".join(map(str, ids[a:b])).encode() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        at = pa.array(bounds[:-1])
        yield pa.RecordBatch.from_arrays(
            [*(batch[c].take(at) for c in KEY), batch["conv_id"].take(at), pa.array(joined, pa.binary())],
            [*KEY, "place", "ids"],
        )


def end_hashes(members: DataFrame) -> DataFrame:
    """``depth, fa, fb, ends_sha256`` of the nodes at which conversations end; saved.

    The ids of a node are sorted over many tasks, which join them into lists; one task hashes the lists
    of a node in turn, as they come, since a hash cannot be put together from parts.
    """
    ends = members.filter(F.col("depth") == F.col("length")).select(*KEY, "conv_id")
    spread = ends.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    lists = saved(spread.mapInArrow(_join_runs, "depth long, fa long, fb long, place long, ids binary"), "end-lists")
    in_turn = lists.repartition(*KEY).sortWithinPartitions(*KEY, "place")
    return saved(in_turn.mapInArrow(_hash_runs, "depth long, fa long, fb long, ends_sha256 string"), "ends")


def _trie(turns: DataFrame, seed: int) -> DataFrame | None:
    """All nodes with their figures, or None if two sequences have one fingerprint."""
    members = memberships(prefix_products(turns, seed), seed)
    nodes = saved(
        members.groupBy(*KEY).agg(
            F.min("conv_id").alias("conv_id"),
            F.count("*").alias("n_convs"),
            F.first("chars").alias("chars"),
            F.first("pa").alias("pa"),
            F.first("pb").alias("pb"),
            # equal last turns under equal nodes: by induction all members have equal turns
            (
                F.min("ref").eqNullSafe(F.max("ref"))
                & F.min("pa").eqNullSafe(F.max("pa"))
                & F.min("pb").eqNullSafe(F.max("pb"))
            ).alias("equal"),
        ),
        "nodes",
    )
    if not nodes.filter("not equal").isEmpty():
        return None
    above = [(F.col("depth") - 1).alias("depth"), F.col("pa").alias("fa"), F.col("pb").alias("fb")]
    children = nodes.filter("depth > 0").groupBy(*above).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    # the nodes whose smallest member is one conversation are the lower end of its path
    nodes = nodes.withColumn("worth", (F.col("n_convs") - 1) * F.col("chars"))
    nodes = segment_totals(nodes, "conv_id", ["depth"], ["worth"], "worths")
    leaf = F.col("n_children") == 0
    owners = saved(
        nodes.groupBy("conv_id").agg(F.sum("worth").alias("worths"), F.max(leaf.cast("long")).alias("leaves")), "owners"
    )
    # a node's subtree is what its members own, but for what its first member owns above the node
    sums = saved(
        members.join(owners, "conv_id").groupBy(*KEY).agg(F.sum("worths").alias("worths"), F.sum("leaves").alias("n_leaves")),
        "sums",
    )
    full = saved(nodes.join(sums, KEY).join(end_hashes(members), KEY, "left"), "full")
    parents = full.select(
        F.col("depth").alias("up"), F.col("fa").alias("pa"), F.col("fb").alias("pb"), F.col("conv_id").alias("parent_conv_id")
    )
    return (
        full.withColumn("up", F.col("depth") - 1)
        .join(parents, ["up", "pa", "pb"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            (F.col("worths") - F.col("worth_before")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of the rebuilt ``conversations(conv_id, turn, role, text)``, a row for every node.

    ``conv_id`` is the smallest member and ``parent_conv_id`` the parent's (null for the root); ``depth``,
    ``n_convs``, ``n_children``, ``n_leaves``; ``saved_tokens`` is the code points that the subtree's members
    share; ``ends_sha256`` hashes the ids of the members that end at the node.

    Conversation c is rebuilt from the first h turns of c - c % 100 and its own from its h-th on, with h =
    crc32(c) % 6. Nodes are depths and fingerprints; members of a node must agree in the last turn's
    reference and in the parent, else all is done anew with other bases. No step collects the members of
    a node or walks the trie level by level.

    Turns without a conv_id belong to no conversation. A null turn comes first, equal turns go by the hash
    of role and text; repeated rows are turns of their own. Null roles and texts are empty. Long texts are
    read once, for their hash and length. An empty table has no root and gives no rows; other columns,
    whatever their names, are not read.
    """
    turns = positioned(conversations)
    for seed in range(TRIES):
        found = _trie(turns, seed)
        if found is not None:
            return found
    raise RuntimeError("fingerprints of different sequences are equal under all bases")
