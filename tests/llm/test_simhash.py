import random

import numpy as np
import pytest
import xxhash

from crawlspark.llm import simhash

SCHEMA = "doc_id long, text string, fp string, half string, lang string"


def by_hand(text, size=3):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(ids, fps):
    """Smallest id that links of 3 bits or fewer reach."""
    n = len(fps)
    x = np.array(fps, np.uint64)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in np.flatnonzero(np.bitwise_count(x ^ x[i]) <= 3):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    smallest = {}
    for i in range(n):
        if ids[i] is not None:
            smallest[find(i)] = min(smallest.get(find(i), ids[i]), ids[i])
    return [smallest.get(find(i)) for i in range(n)]


def texts():
    random.seed(5)
    words = [f"w{i}" for i in range(300)]
    out = []
    for _ in range(40):
        base = random.choices(words, k=random.choice([30, 200, 900]))
        out.append(base)
        for _ in range(random.choice([0, 1, 12])):
            copy = list(base)
            for _ in range(random.choice([0, 1, 1, 2, 4])):
                copy[random.randrange(len(copy))] = random.choice(words)
            out.append(copy)
    return [" ".join(w) for w in out]


@pytest.mark.parametrize("text", ["One two  THREE\tfour\nÉTÉ été", "a b", "A", "", None, " \n", "x " * 70_000 + "y"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == (by_hand(text) if len(text or "") < 1000 else simhash.fingerprint(text.upper()))


@pytest.mark.parametrize("dense,block", [(64, 2_048), (1, 2_048), (1, 2), (3, 5)])
def test_components_are_those_of_all_pairs(frame, monkeypatch, dense, block):
    monkeypatch.setattr(simhash, "DENSE", dense)
    monkeypatch.setattr(simhash, "BLOCK", block)
    data = [(i * 3 + 1, t) for i, t in enumerate(texts())]
    data += [(None, data[0][1]), (2, None), (900, ""), (7, data[2][1]), (7, data[2][1]), (901, " \t"), (None, "alone here")]
    rows = simhash.near_duplicates(frame([(*d, "x", "y", None) for d in data], SCHEMA)).collect()
    assert len(rows) == len(data)
    fps = [by_hand(t) for _, t in data]
    wanted = [(d[0], f"{fp:016x}", c) for d, fp, c in zip(data, fps, brute([d[0] for d in data], fps), strict=True)]
    assert sorted(map(tuple, rows), key=str) == sorted(wanted, key=str)


def test_crowded_buckets_are_linked_without_pairs():
    rng = np.random.default_rng(1)
    flips = rng.integers(0, 32, (800, 4))
    fps = np.array([0x1234 ^ int(sum({1 << int(b) for b in f})) for f in flips], np.int64)
    fps = np.unique(fps)
    a, b = simhash.forest(fps, fps)
    assert len(a) < 2 * len(fps)
    merged = brute(fps.tolist(), fps.tolist())
    root = {int(f): int(f) for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = find(x), find(y)
        root[max(p, q)] = min(p, q)
    assert [find(int(f)) for f in fps] == merged


def test_one_of_each(frame, rows):
    data = [(5, "a b c d", 1), (3, "A b c d", 2), (3, "A b c d", 2), (9, "else what ever", 3), (None, "nobody knows it", 4), (None, "nobody knows it", 4)]
    kept = simhash.one_of_each(frame(data, "doc_id long, text string, component_id int"))
    assert rows(kept, "doc_id", "component_id") == sorted([(3, 2), (9, 3), (None, 4)], key=str)


def test_empty(frame):
    assert simhash.near_duplicates(frame([], SCHEMA)).count() == 0
    assert simhash.one_of_each(frame([], SCHEMA)).count() == 0
