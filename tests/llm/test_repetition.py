import random

import pytest

from crawlspark.llm import repetition

SCHEMA = "doc_id long, text string, kept string, n_words string"


def words_of(text):
    return (text or "").encode().split()


def brute(text):
    w = words_of(text)
    n, longest = len(w), [0] * len(w)
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and i + k < n and j + k < n and w[i + k] == w[j + k]:
                k += 1
            longest[i] = max(longest[i], k)

    def cover(least):
        return len({p for i in range(n) if longest[i] >= least for p in range(i, i + longest[i])})

    lines = [x for x in (text or "").split("\n") if words_of(x)]
    chars = sum(len(x.decode()) for x in w)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    base = n < 50 or 100 * cover(3) > 50 * n
    kept = not base and cover(10) <= 0.3 * n and max(longest, default=0) <= 50
    return (n, chars, symbols, len(lines) - len(set(lines)), cover(3), base, cover(10), max(longest, default=0), kept)


def texts():
    random.seed(2)
    out = [None, "", " \n\t", "a", "a a", "a b a b a b a b", "x\n\nx\n x\nx", "é#  漢|<>\x85b\u2003c", "\x1ca b"]
    for _ in range(60):
        pool = [f"w{i}" for i in range(random.choice([2, 5, 400]))]
        text = random.choices(pool, k=random.choice([3, 49, 50, 90]))
        if random.random() < 0.6:
            part = text[: random.choice([5, 21, 40])]
            text = text + part * random.choice([1, 2])
        out.append(random.choice([" ", "\n"]).join(text))
    out.append(" ".join(f"u{i}" for i in range(200)) + " " + " ".join(f"u{i}" for i in range(30)))
    return out


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_covered", "longest_repeat", "kept")


@pytest.mark.parametrize("at_once", [400_000, 10])
def test_like_brute_force(frame, rows, monkeypatch, at_once):
    monkeypatch.setattr(repetition, "WORDS_AT_ONCE", at_once)
    data = [(i if i != 4 else None, t) for i, t in enumerate(texts())] + [(1, "b")] * 2
    found = repetition.repetition_rules(frame([(*d, "x", "y") for d in data], SCHEMA))
    assert rows(found, "doc_id", *FIELDS) == sorted([(i, *brute(t)) for i, t in data], key=str)


def test_long_repeats():
    first = [f"u{i}" for i in range(20_000)]
    found = repetition.judge([" ".join(first), " ".join(first + ["x"] + first), " ".join(["a"] * 30_000)])
    assert found["longest_repeat"].tolist() == [0, 20_000, 29_999]
    assert found["kept"].tolist() == [True, False, False]
    assert found["n_covered"].tolist() == [0, 40_000, 30_000]


@pytest.mark.parametrize("at_once", [400_000, 10])
def test_long_texts_are_measured_alike(monkeypatch, at_once):
    monkeypatch.setattr(repetition, "WORDS_AT_ONCE", at_once)
    data = [*texts(), " ".join(["a"] * 3_000), " ".join(["a", "b"] * 999 + ["b"])]
    found = repetition.judge(data)
    monkeypatch.setattr(repetition, "MAX_RANKED", 0)
    assert repetition.judge(data).equals(found)


def test_scattered_short_lines():
    random.seed(8)
    lines = [" ".join(f"r{i}x{j}" for j in range(12)) for i in range(3)]
    own = [" ".join(f"w{i}x{j}" for j in range(18)) for i in range(6)]
    text = "\n".join(x for i in range(6) for x in (lines[i % 3], own[i]))
    found = repetition.judge([text, "\n".join(own + lines)])
    assert found["n_covered"].tolist() == [72, 0]
    assert found["base_failed"].tolist() == [False, False]
    assert found["kept"].tolist() == [False, True]


def test_empty(frame):
    assert repetition.repetition_rules(frame([], SCHEMA)).count() == 0
