"""Operator 6: quality rules on repetition, from suffix arrays and longest common prefixes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from crawlspark.llm.common import bound_batches

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
MIN_WORDS = 50
WINDOW = 3
MIN_REPEAT = 10  # words: shorter repeats do not count as covered
MAX_COVERED = 0.3  # of a text's words, all places of a repeat counted
MAX_REPEAT = 50  # words
WORDS_AT_ONCE = 400_000
MAX_RANKED = 1_000_000  # words above which one long text is measured in a pass that keeps no ranks of doublings

RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, n_covered long, longest_repeat long, kept boolean"
)
FIELDS = [x.split()[0] for x in RESULT.split(", ")[1:]]


def repeat_lengths(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each word's place, the length of the longest string from there that its text has twice.

    ``words`` are word numbers of texts one after another, ``counts`` the words of each text. The
    suffixes of every text are sorted by prefix doubling, all texts at once; suffixes that are already
    alone take no more part. The longest common prefix of neighbours in the suffix array then comes
    from the ranks of the doublings, or, where these would take much memory, from a pass over the text
    that keeps none of them; the larger of a suffix's two is the answer.
    """
    n = len(words)
    keep = n <= MAX_RANKED
    text = np.repeat(np.arange(len(counts)), counts)
    end = np.repeat(np.cumsum(counts), counts)
    # rank by text, then word: suffixes of different texts never share a prefix
    rank = _dense(text.astype(np.int64) * (int(words.max(initial=0)) + 1) + words)
    ranks, step = [rank] if keep else [], 1
    active = _shared(rank, np.arange(n))
    while len(active):
        further = active + step
        inside = further < end[active]
        second = np.where(inside, rank[np.minimum(further, n - 1)] + 1, 0)
        # a rank is the place of its first suffix, so splitting one leaves the others as they are
        order = np.argsort(rank[active] * (n + 1) + second)
        a, s = rank[active][order], second[order]
        first = np.concatenate(([True], (a[1:] != a[:-1])))
        new = first | np.concatenate(([True], s[1:] != s[:-1]))
        at = np.arange(len(order))
        group = np.maximum.accumulate(np.where(first, at, 0))
        part = np.maximum.accumulate(np.where(new, at, 0))
        rank = rank.copy() if keep else rank
        rank[active[order]] = a + part - group
        if keep:
            ranks.append(rank)
        step *= 2
        active = _shared(rank, active)
    array = np.argsort(rank)
    common = _common_by_ranks(array, text, end, ranks) if keep else _common_in_order(words, array, rank, end)
    longest = np.zeros(n, np.int64)
    longest[array[:-1]] = common
    longest[array[1:]] = np.maximum(longest[array[1:]], common)
    return longest


def _common_by_ranks(array: np.ndarray, text: np.ndarray, end: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """Words that neighbours in the suffix array share, from the ranks of all doublings."""
    n = len(array)
    one, two = array[:-1].copy(), array[1:].copy()
    common = np.zeros(max(0, n - 1), np.int64)
    same = np.flatnonzero(text[one] == text[two])
    one, two, length = one[same], two[same], np.zeros(len(same), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        x, y = one + length, two + length
        inside = (x < end[one]) & (y < end[two])
        x, y = np.minimum(x, n - 1), np.minimum(y, n - 1)
        equal = inside & (ranks[level][x] == ranks[level][y])
        # equal ranks of a level mean 2**level equal words, inside the text
        length += np.where(equal, 1 << level, 0)
    common[same] = length
    return common


def _common_in_order(words: np.ndarray, array: np.ndarray, rank: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The same from one pass in text order: a suffix shares all but one word of what the one before shares."""
    n = len(words)
    common = np.zeros(max(0, n - 1), np.int64)
    w, a, r, e, out = map(memoryview, (words, array, rank, end, common))
    h = 0
    for i in range(n - 1):
        p = r[i]
        j = a[p + 1] if p < n - 1 else -1
        if j < 0 or e[i] != e[j]:
            h = 0
            continue
        stop = e[i] - max(i, j)
        while h < stop and w[i + h] == w[j + h]:
            h += 1
        out[p] = h
        h -= h > 0
    return common


def _dense(values: np.ndarray) -> np.ndarray:
    """Rank of each value as the number of smaller ones."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    first = np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(values) else np.zeros(0, bool)
    rank = np.empty(len(values), np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(len(values)), 0))
    return rank


def _shared(rank: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Those places whose rank another has too."""
    return among[np.bincount(rank[among], minlength=len(rank))[rank[among]] > 1] if len(among) else among


def covered(lengths: np.ndarray, counts: np.ndarray, least: int) -> np.ndarray:
    """Words of each text in the union of its repeats of at least ``least`` words."""
    n = len(lengths)
    long = np.flatnonzero(lengths >= least)
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, long, 1)
    np.add.at(change, long + lengths[long], -1)
    inside = np.concatenate(([0], np.cumsum(np.cumsum(change)[:-1] > 0)))
    ends = np.cumsum(counts)
    return inside[ends] - inside[ends - counts]


def _repeated_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(SPACES)] if "\n" in text else []
    return len(lines) - len(set(lines))


def _figures(texts: list[str]) -> pd.DataFrame:
    """The figures of each text, in order."""
    words = [t.encode().split() for t in texts]
    counts = np.array([len(w) for w in words], np.int64)
    numbers = pd.factorize(np.array(list(chain.from_iterable(words)), object))[0].astype(np.int64)
    lengths = repeat_lengths(numbers, counts)
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, np.repeat(np.arange(len(texts)), counts), lengths)
    return pd.DataFrame(
        {
            "n_words": counts,
            "word_chars": [len(t) - sum(map(t.count, SPACES)) for t in texts],
            "n_symbols": [sum(map(t.count, SYMBOLS)) for t in texts],
            "n_dup_lines": list(map(_repeated_lines, texts)),
            "n_repeat_words": covered(lengths, counts, WINDOW),
            "n_covered": covered(lengths, counts, MIN_REPEAT),
            "longest_repeat": longest,
        }
    )


def judge(texts: list[str | None]) -> pd.DataFrame:
    """Figures and verdict of each text, in order; some 400,000 words, or one text, at a time."""
    groups, size = [[]], 0
    for text in texts:
        if size > 6 * WORDS_AT_ONCE:
            groups.append([])
            size = 0
        groups[-1].append(text or "")
        size += len(text or "")
    out = pd.concat([_figures(g) for g in groups], ignore_index=True)
    words, repeated = out["n_words"], out["n_repeat_words"]
    out["base_failed"] = (words < MIN_WORDS) | (100 * repeated > 50 * words)
    within = (out["n_covered"] <= MAX_COVERED * words) & (out["longest_repeat"] <= MAX_REPEAT)
    out["kept"] = ~out["base_failed"] & within
    return out


def repetition_rules(docs: DataFrame) -> DataFrame:
    """Figures and verdict for every row of ``docs(doc_id, text)``.

    A text fails the base rule with under 50 words, or with over half of its words in 3-word windows
    that it has twice. It fails the method's if the union of all substrings of 10 words or more that it
    has twice covers over 30 % of its words, or if the longest has over 50 words. Null counts as empty:
    no words, so it fails the base rule. Every text is judged alone and whole, so repeated rows agree
    and an empty table gives no rows; other columns are not read. Memory grows with the longest text, by
    some hundred bytes a word, however often its words repeat.
    """
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = judge(batch["text"].to_pylist())
            columns = [batch["doc_id"], *(pa.array(found[c]) for c in FIELDS)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *FIELDS])

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)
