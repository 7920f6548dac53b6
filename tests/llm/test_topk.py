import math
import random

import numpy as np
import pytest

from crawlspark.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string"


def brute(data, k=5):
    rows = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in data if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, x in rows:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in rows if i != q and len(y) == len(x))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out, key=str)


def vectors(n, dim=6):
    random.seed(n)
    return [(i, [random.choice([random.uniform(-1, 1), 0.0, 0.5]) for _ in range(dim)]) for i in range(n)]


@pytest.mark.parametrize("block", [4_096, 16])
def test_like_brute_force(frame, rows, monkeypatch, block):
    monkeypatch.setattr(topk, "LISTS", block)
    monkeypatch.setattr(topk, "VECTORS", 70)
    monkeypatch.setattr(topk, "QUERIES", 3)
    data = [(i, [np.float32(x).item() for x in v]) for i, v in vectors(320)]
    data += [(400, [0.1]), (401, [-0.2]), (450, [float("nan")] * 6), (500, None), (None, data[0][1]), (550, [None] * 6), (600, [float("inf")] * 6)]
    data += [data[0], data[7], data[7], (650, [])]
    data = [(i, v and [x if x is None else np.float32(x).item() for x in v]) for i, v in data]
    found = topk.top_k(frame([(*d, 1, "x", "y") for d in data], SCHEMA))
    assert rows(found) == brute(data)
    assert found.schema["rank"].dataType.simpleString() == "int"


def test_few_and_none(frame, rows):
    assert rows(topk.top_k(frame([(0, [1.0], 1, "", ""), (3, [2.0], 1, "", "")], SCHEMA))) == [(0, 1, 3, 131072)]
    assert topk.top_k(frame([], SCHEMA)).count() == 0


def test_ties_go_to_the_smaller_id(frame, rows):
    found = topk.top_k(frame([(i, [0.5, 0.5], 1, "", "") for i in range(40)], SCHEMA))
    assert [r[2] for r in sorted(map(tuple, found.collect()))] == [1, 2, 3, 4, 5]


def test_bounds_hold_at_every_depth():
    rng = np.random.default_rng(0)
    x = rng.integers(-200, 200, (60, 8)).astype(float)
    q = rng.integers(-200, 200, (5, 8)).astype(float)
    signed = np.hstack([np.maximum(q, 0), np.minimum(q, 0)])
    lists = topk.Lists(np.arange(60), x)
    for depth in range(1, 61):
        lower, upper = lists.bounds(depth)
        assert (signed @ lower.T <= q @ x.T).all() and (signed @ upper.T >= q @ x.T).all()
    assert np.array_equal(signed @ lower.T, q @ x.T)


def test_reading_stops_before_the_end(monkeypatch):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, (2_000, 4)), [[50.0, 50, 50, 50]] * 5]).round()
    depths = []
    own = topk.Lists.bounds
    monkeypatch.setattr(topk.Lists, "bounds", lambda self, depth: depths.append(depth) or own(self, depth))
    topk.search(np.ones((1, 4)), np.array([-1]), np.arange(len(x)), x, 5)
    assert max(depths) < len(x) / 2
