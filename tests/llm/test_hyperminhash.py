import random

import numpy as np
import pytest

from crawlspark.llm import hyperminhash as hmh

SCHEMA = "doc_id long, text string, node string, n string, sketch string, a string, bucket string"


def by_hand(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if len(words) < 3:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(words, words[1:], words[2:], strict=False))


def brute(docs):
    """Rows of the query by all pairs."""
    sets = [by_hand(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    smallest = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            smallest[find(i)] = min(smallest.get(find(i), doc_id), doc_id)
    out = []
    for i, (doc_id, _) in enumerate(docs):
        component = smallest.get(find(i)) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return sorted(out, key=str)


def found(spark, docs, rows):
    return rows(hmh.near_duplicates(spark.createDataFrame([(*d, *["x"] * 5) for d in docs], SCHEMA)))


def families(seed, sizes=(4, 12, 30, 200, 900), count=40):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    out = []
    for _ in range(count):
        base = rng.choices(words, k=rng.choice(sizes))
        out.append(base)
        for _ in range(rng.choice([0, 1, 3, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4, len(base) // 20, len(base) // 30])):
                if rng.random() < 0.7:
                    copy[rng.randrange(len(copy))] = rng.choice(words)
                else:
                    copy.append(rng.choice(words))
            out.append(copy)
    texts = [" ".join(w) for w in out]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_those_of_all_pairs(spark, rows, seed):
    docs = families(seed)
    assert found(spark, docs, rows) == brute(docs)


def test_large_clusters_are_compared_in_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(hmh, "BLOCK", 4)
    docs = families(3, sizes=(40, 100), count=25)
    assert found(spark, docs, rows) == brute(docs)


def test_large_family_that_is_no_group(spark, rows):
    # one text with a third of its words replaced each time: shared buckets by the hundred, hardly a link
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    docs = []
    for i in range(400):
        copy = list(base)
        for at in rng.sample(range(60), rng.choice([1, 2, 3, 4])):
            copy[at] = f"x{rng.randrange(10**6)}"
        docs.append((i, " ".join(copy)))
    assert found(spark, docs, rows) == brute(docs)


@pytest.mark.parametrize(
    "docs",
    [
        [(3, "A b  c d"), (2, "a B c\td"), (2, "a b c d"), (7, "one"), (6, "ONE"), (5, "one two"), (9, None), (8, ""), (8, " \n")],
        [(None, "a b c d"), (None, "a b c d"), (None, ""), (4, "é é é é"), (None, "É é é é"), (1, "q r s"), (None, "q r s")],
        [(5, "a b c"), (5, "d e f"), (4, "d e f"), (6, "a b c")],
        [],
    ],
)
def test_odd_rows(spark, rows, docs):
    result = found(spark, docs, rows)
    if docs and docs[0][0] == 5:
        # two texts under one id are two rows; each has the component of its text
        assert result == sorted([(5, 1, 5, True), (5, 1, 4, False), (4, 1, 4, True), (6, 1, 5, False)], key=str)
    else:
        assert result == brute(docs)


def test_long_text(spark, rows):
    words = [str(i * 7919 % 1_000_003) for i in range(600_000)]
    docs = [(1, " ".join(words)), (2, " ".join(words[20_000:])), (3, " ".join(words[:300_000]))]
    assert [r[2] for r in found(spark, docs, rows)] == [1, 1, 3]


def test_shingles_are_the_sets():
    texts = [t for _, t in families(4)] + ["a", "a a", "a a a", "a a a a", "b a", "a b", "", "a\x0bb"]
    sizes = [len(hmh.shingles(t)) for t in texts]
    assert sizes == [len(by_hand(t)) for t in texts]
    assert len({hmh.shingles(t).tobytes() for t in texts}) == len({by_hand(t) for t in texts})


def test_registers_by_hand():
    rng = np.random.default_rng(1)
    for n in (1, 5, 60, 4000):
        hashes = np.unique(rng.integers(0, 2**64, n, np.uint64))
        least = {}
        for h in hashes.tolist():
            bucket, rest = h >> 57, (h << 7 & (1 << 64) - 1) | 1
            least[bucket] = min(least.get(bucket, rest), rest)
        result = hmh.registers(hashes)
        for bucket, rest in least.items():
            bits = f"{rest:064b}"
            zeros = len(bits) - len(bits.lstrip("0"))
            mantissa = bits[zeros + 1 :].ljust(10, "0")[:10]
            assert result[bucket] == zeros << 10 | int(mantissa, 2)
        for bucket in set(range(128)) - set(least):
            donor = next(d for d in hmh._DONORS[bucket] if d in least)
            assert result[bucket] == result[donor]


def test_chance_collisions_are_as_estimated(monkeypatch):
    # with a short mantissa chance collisions are frequent enough to count
    monkeypatch.setattr(hmh, "MANTISSA", 2)
    rng = np.random.default_rng(2)
    for n, m in ((2_000, 2_000), (20_000, 3_000)):
        pairs = [[np.sort(rng.integers(0, 2**64, k, np.uint64)) for k in (n, m)] for _ in range(300)]
        equal = np.mean([(hmh.registers(a) == hmh.registers(b)).mean() for a, b in pairs])
        assert abs(equal - hmh.chance_equal(np.array([n]), np.array([m]))[0]) < 0.004
    shared = [rng.integers(0, 2**64, 3_000, np.uint64) for _ in range(200)]
    sketch = [[hmh.registers(np.sort(np.append(s, rng.integers(0, 2**64, 1_000, np.uint64)))) for _ in "ab"] for s in shared]
    left, right = (np.array([s[i] for s in sketch]) for i in (0, 1))
    sizes = np.full(200, 4_000)
    assert abs(hmh.estimates(left, right, sizes, sizes).mean() - 0.6) < 0.01


@pytest.mark.parametrize("words", [8, 20, 60, 400])
def test_links_share_a_band(words):
    """Pairs just over the limit, thousands of them: none is without a common band or under the estimate's limit."""
    rng = np.random.default_rng(words)
    lost = 0
    for _ in range(3_000):
        more = int(words * 15 / 85)
        a = rng.integers(0, 2**64, words + more, np.uint64)
        x, y = hmh.registers(np.sort(a)), hmh.registers(np.sort(a[: words]))
        bands = (x == y)[: hmh.BANDS * hmh.ROWS].reshape(-1, hmh.ROWS).all(axis=1)
        estimate = hmh.estimates(x[None], y[None], np.array([words + more]), np.array([words]))[0]
        lost += not bands.any() or estimate < hmh.PERCENT / 100 - hmh.SLACK
    assert lost == 0
