import hashlib
import random
import zlib

import pytest

from crawlspark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, ref string, pos string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def by_hand(data):
    """Rows of the trie by rebuilding every conversation."""
    turns = {}
    for conv_id, turn, role, text in data:
        if conv_id is not None:
            turns.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))

    def ref(t):
        return hashlib.sha256(f"{len(t[2])}:{t[2]}{t[3]}".encode()).hexdigest()

    turns = {c: [t[2:] for t in sorted(ts, key=lambda t: (t[0], t[1], ref(t)))] for c, ts in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        family = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(turns.get(family, [])[:h] + own[h:])
    members = {}
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
    rows = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        ends = ",".join(str(c) for c in sorted(convs) if rebuilt[c] == path)
        rows.append(
            (
                min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs),
                sum(len(p) == len(path) + 1 for p in below), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(rows, key=str)


def trie(spark, data):
    found = prefix_trie.conversation_trie(spark.createDataFrame([(*d, 7, "x", "y") for d in data], SCHEMA))
    assert found.columns == COLUMNS
    return sorted((tuple(r) for r in found.collect()), key=str)


def talks(seed, n=60):
    rng = random.Random(seed)
    data = []
    for _ in range(n):
        c = rng.choice([0, 100, 200, 300, 0, 100]) + rng.choice([0, 1, 2, rng.randrange(100)])
        for t in range(rng.choice([1, 2, 4, 7, 9])):
            data.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "user", None, ""]), rng.choice(["a", "b", "é" * 5, None, "long text"])))
    rng.shuffle(data)
    return data


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_is_that_of_rebuilt_texts(spark, seed):
    data = talks(seed)
    assert trie(spark, data) == by_hand(data)


@pytest.mark.parametrize(
    "data",
    [
        [],
        [(None, 0, "user", "a")],
        [(7, 0, None, None), (7, 0, None, None), (-7, None, "", ""), (-107, 3, "a", "b"), (-100, 1, "c", "d")],
        # no turns are left: the family's first conversation is absent and all own turns are replaced
        [(c, 0, "user", "a") for c in range(101, 140)],
        # one conversation, deep, beside copies of a short one
        [(0, t, "user", f"turn {t % 3}") for t in range(700)] + [(c, 0, "user", "turn 0") for c in range(1, 80)],
    ],
)
def test_odd_tables(spark, data):
    assert trie(spark, data) == by_hand(data)


def test_very_long_text(spark):
    data = [(100, 0, "user", "é" * 4_000_000), (100, 1, "user", "b"), (105, 0, "x", "y")]
    assert trie(spark, data) == by_hand(data)


def test_equal_fingerprints_are_noticed(spark, monkeypatch):
    plain = prefix_trie.turn_value
    monkeypatch.setattr(prefix_trie, "turn_value", lambda seed, i: plain(seed, i) * 0 + 5 if seed == 0 else plain(seed, i))
    data = talks(3, n=20)
    turns = prefix_trie.positioned(spark.createDataFrame([(*d, 7, "x", "y") for d in data], SCHEMA))
    assert prefix_trie._trie(turns, 0) is None
    assert trie(spark, data) == by_hand(data)


def test_powers(spark):
    from pyspark.sql import functions as F

    exponents = [0, 1, 2, 255, 256, 65_535, 65_536, 10**6, 2**32 - 1]
    df = spark.createDataFrame([(e,) for e in exponents], "e long")
    for p in prefix_trie.PRIMES:
        rows = df.select("e", prefix_trie.power(12345, F.col("e"), p).alias("x")).collect()
        assert [r["x"] for r in rows] == [pow(12345, r["e"], p) for r in rows]
        assert all(p % d for d in range(2, 46_341))


def test_totals_of_a_segment_that_many_tasks_share(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(rng.choice([1, 1, 1, 2, 3]), i, rng.randrange(100)) for i in range(2_000)]
    found = prefix_trie.segment_totals(spark.createDataFrame(rows, "s int, i int, v long"), "s", ["i"], ["v"], "test")
    seen = {}
    for r in sorted(found.collect(), key=lambda r: r["i"]):
        assert r["v_before"] == seen.get(r["s"], 0)
        seen[r["s"]] = seen.get(r["s"], 0) + r["v"]
    assert sum(seen.values()) == sum(r[2] for r in rows)


def test_hashes_of_many_ends(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_AT_ONCE", 7)
    members = spark.range(1_000).selectExpr("id % 3 as depth", "id % 2 as fa", "5L as fb", "id as conv_id", "id % 3 as length")
    found = {(r["depth"], r["fa"]): r["ends_sha256"] for r in prefix_trie.end_hashes(members).collect()}
    for (depth, fa), digest in found.items():
        ids = ",".join(str(i) for i in range(1_000) if i % 3 == depth and i % 2 == fa)
        assert digest == hashlib.sha256(ids.encode()).hexdigest()
    assert len(found) == 6
