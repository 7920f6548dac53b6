import random
from collections import defaultdict

import pytest

from crawlspark.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, taken int, lang string"


def targets(sizes, weights=(5, 2, 1), share=1.5, epochs=2):
    """By rounds of sharing, as one would by hand."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), dict.fromkeys(order, 0.0)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > epochs * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = epochs * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def documents(n, sources, seed=0):
    random.seed(seed)
    return [(i, " ".join(["w"] * random.choice([0, 1, 5, 40])), random.choice(sources)) for i in range(n)]


@pytest.mark.parametrize(
    "data",
    [
        documents(300, ["b", "a", "ß", "Z", None] + ["hot"] * 9),
        documents(40, [f"s{i}" for i in range(30)]),
        [(1, "one two", "a")],
        [(1, None, None), (2, "", "a")],
        [(5, "x y z", "a")] * 30 + [(6, "x y", "b"), (None, "q", "b"), (None, "q", "b")],
        [],
    ],
)
def test_mix(frame, data):
    docs = frame([(*d, "9", 9, "en") for d in data], SCHEMA).repartition(3)
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(data)
    sizes = defaultdict(int)
    for _, text, source in data:
        sizes[source] += len((text or "").split())
    wanted = targets(sizes) if data else {}
    taken, ties = defaultdict(int), defaultdict(set)
    for r in rows:
        assert r["size"] == len((r["text"] or "").split()) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(wanted[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        ties[r["doc_id"], r["text"], r["source"]].add(r["taken"])
    assert all(len(x) == 1 for x in ties.values())
    slack = max([0, *(len([1 for d in data if d == x]) for x in data)])
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= (1 if slack <= 1 else slack)
    again = mixing.mix(docs.repartition(7)).select("doc_id", "source", "taken")
    assert sorted(map(str, again.collect())) == sorted(map(str, (mixing.mix(docs).select("doc_id", "source", "taken")).collect()))


def test_whole_documents(frame):
    data = documents(200, ["a", "b", "c", "c", "c"])
    docs = frame([(*d, "9", 9, "en") for d in data], SCHEMA)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert {r["size"] for r in mixed.collect()} == {"9"}
    words, sizes = defaultdict(int), defaultdict(int)
    for _, text, source in data:
        sizes[source] += len(text.split())
    for r in mixed.collect():
        words[r["source"]] += len(r["text"].split())
    for source, target in targets(sizes).items():
        assert abs(words[source] - target) <= 20.5
    counts = defaultdict(int)
    for r in mixed.collect():
        counts[r["doc_id"]] += 1
    assert max(counts.values()) <= 2


def test_runs_in_the_jvm_alone(frame, plan):
    docs = frame([(*d, "9", 9, "en") for d in documents(20, ["a", "b"])], SCHEMA)
    assert "Python" not in plan(mixing.mix(docs)) and "Arrow" not in plan(mixing.mix(docs))
