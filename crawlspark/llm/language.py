"""Operator 9: language identification by prediction by partial matching on bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.common import bound_batches, crc_of, saved

ORDER = 2  # the longest context, in symbols
BLOCK_BYTES = 64 * 1024 * 1024  # languages whose tables fill this are scored together
UNKNOWN = "und"
TEXTS_AT_ONCE = 4_000_000  # bytes



def _symbols() -> np.ndarray:
    """Symbol of each byte: a-z, digits as one, other ASCII as one, and every byte beyond ASCII."""
    table = np.full(256, 0, np.int64)
    table[ord("0") : ord("9") + 1] = 1
    table[ord("a") : ord("z") + 1] = np.arange(2, 28)
    table[128:] = np.arange(28, 156)
    return table


SYMBOLS = _symbols()
N = 156


def _stream(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of lower-cased texts, each behind ORDER blanks, and where each text begins and ends."""
    coded = [b" " * ORDER + t.lower().encode() for t in texts]
    ends = np.cumsum([len(c) for c in coded])
    begins = ends - [len(c) - ORDER for c in coded]
    return SYMBOLS[np.frombuffer(b"".join(coded), np.uint8)], begins, ends


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    begin, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size > TEXTS_AT_ONCE:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def context_counts(docs: DataFrame) -> DataFrame:
    """``lang, code, n``: how often each symbol follows each context, over whole texts of all rows."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch["lang"].to_pylist(), batch["text"].to_pylist()
            for lang in sorted(set(langs)):
                own = [t for t, x in zip(texts, langs, strict=True) if x == lang]
                for i, j in _groups(own):
                    symbols, begins, ends = _stream(own[i:j])
                    codes = (symbols[:-2] * N + symbols[1:-1]) * N + symbols[2:]
                    # the blanks in front of a text are context, not text
                    counted = np.ones(len(symbols), bool)
                    counted[np.concatenate([begins - k for k in range(1, ORDER + 1)])] = False
                    n = np.bincount(codes[counted[2:]], minlength=1)
                    found = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int64()), pa.array(n[found], pa.int64())],
                        ["lang", "code", "n"],
                    )

    rows = docs.select("lang", "text").mapInArrow(run, "lang string, code long, n long")
    return rows.groupBy("lang", "code").agg(F.sum("n").alias("n"))


class Model:
    """Code lengths in bits of every symbol after every context, for each language.

    The context tree of a language holds all contexts of up to ORDER symbols it was trained on. A
    symbol is coded in the longest such context; if that has not seen it, an escape is coded and the
    next shorter context tried without the symbols just ruled out, down to equal odds for all symbols.
    Escapes have the weight of a context's distinct symbols. The statistics are frozen, so a code length
    depends on context and symbol alone and is read from a table.
    """

    def __init__(
        self, langs: list[str], counts: list[tuple[np.ndarray, np.ndarray]], used: np.ndarray | None = None
    ) -> None:
        """``used``: the symbols that some text had, where ``counts`` are not all there are."""
        self.langs = langs
        if used is None:
            used = np.zeros(N, bool)
            for codes, _ in counts:
                for _ in range(ORDER + 1):
                    used[codes % N] = True
                    codes = codes // N
        used[0] = True
        self.size = int(used.sum()) + 1  # and one for all symbols never seen
        self.symbols = np.where(used, np.cumsum(used) - 1, self.size - 1)[SYMBOLS]
        narrow = np.where(used, np.cumsum(used) - 1, self.size - 1)
        self.bits = np.stack([self._table(narrow, *c) for c in counts]) if langs else np.zeros((0, self.size**3), np.float32)

    def _table(self, narrow: np.ndarray, codes: np.ndarray, n: np.ndarray) -> np.ndarray:
        a = self.size
        seen = np.zeros((a, a, a))
        seen[narrow[codes // (N * N)], narrow[codes // N % N], narrow[codes % N]] = n
        orders = [seen, seen.sum(axis=0)[None], seen.sum(axis=(0, 1))[None, None]]
        left = np.ones((a, a, a), bool)  # symbols that no longer context has ruled out
        bits = np.zeros((a, a, a))
        done = np.zeros((a, a, a), bool)
        spent = np.zeros((a, a, 1))
        for count in orders:
            own = np.where(left, count, 0.0)
            total, kinds = own.sum(axis=2, keepdims=True), (own > 0).sum(axis=2, keepdims=True)
            weight = total + kinds
            here = own > 0
            with np.errstate(divide="ignore", invalid="ignore"):
                cost = -np.log2(own / weight)
                escape = np.where(total > 0, -np.log2(kinds / weight), 0.0)
            bits = np.where(here & ~done, spent + np.where(here, cost, 0.0), bits)
            done |= here
            spent = spent + escape
            left &= ~here
        rest = np.maximum(1, left.sum(axis=2, keepdims=True))
        return np.where(done, bits, spent + np.log2(rest)).astype(np.float32).reshape(-1)

    def lengths(self, texts: list[str]) -> np.ndarray:
        """Code length in bits of each whole text (rows) in each language."""
        coded = [b" " * ORDER + t.lower().encode() for t in texts]
        ends = np.cumsum([len(c) for c in coded])
        s = self.symbols[np.frombuffer(b"".join(coded), np.uint8)]
        codes = (s[:-2] * self.size + s[1:-1]) * self.size + s[2:]
        # code i is that of byte i + ORDER
        begins = ends - [len(c) for c in coded]
        out = np.zeros((len(texts), len(self.langs)))
        full = np.flatnonzero(ends - begins > ORDER)
        if len(full):
            at = np.stack([begins[full], ends[full] - ORDER], axis=1).reshape(-1)
            for i, bits in enumerate(self.bits):
                own = np.append(bits[codes], 0.0)
                out[full, i] = np.add.reduceat(own, at, dtype=np.float64)[::2]
        return out


def models(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Model]:
    """The models of all languages of ``docs(lang, text)``, blocks of languages in order of their names.

    Rows without a language or a text teach nothing. A block's tables have at most ``block_bytes``, or are
    those of one language; the driver holds one block at a time, and the names. All blocks count the same
    symbols, so that their code lengths compare. Without any language there is one empty model.
    """
    known = docs.filter("lang is not null and text is not null")
    counts = saved(context_counts(known), "context-counts")
    langs = sorted(r["lang"] for r in known.select("lang").distinct().collect())
    places = F.array(*(F.expr(f"code div {N**k} % {N}") for k in range(ORDER + 1)))
    used = np.zeros(N, bool)
    # at most N rows
    used[[r[0] for r in counts.select(F.explode(places)).distinct().collect()]] = True
    used[0] = True
    together = max(1, block_bytes // (4 * (int(used.sum()) + 1) ** (ORDER + 1)))
    for i in range(0, max(1, len(langs)), together):
        block = langs[i : i + together]
        rows = counts.filter(F.col("lang").isin(block)).toArrow().to_pandas() if block else None
        own = [rows[rows["lang"] == lang] for lang in block]
        yield Model(block, [(x["code"].to_numpy(), x["n"].to_numpy()) for x in own], used.copy())


def train(docs: DataFrame) -> Model:
    """One model of all languages, whatever its size."""
    (model,) = models(docs, 1 << 62)
    return model


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def shortest(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bits of the shortest code of each text, its language, and the odds of all languages over this one.

    Infinite, ``und`` and 0 where there is no letter or no language.
    """
    least = np.full(len(texts), np.inf)
    langs = np.full(len(texts), UNKNOWN, object)
    odds = np.zeros(len(texts))
    found = [i for i, t in enumerate(texts) if model.langs and has_letter(t)]
    for a, b in _groups([texts[i] for i in found]):
        own = found[a:b]
        bits = model.lengths([texts[i] for i in own])
        least[own] = bits.min(axis=1)
        langs[own] = [model.langs[x] for x in bits.argmin(axis=1)]
        odds[own] = np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
    return least, langs, odds


def _merged(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same over the languages of both; of equal codes the first stays."""
    least = np.minimum(a[0], b[0])
    known = np.isfinite(least)
    odds = np.zeros(len(least))
    for bits, _, own in (a, b):
        odds[known] += own[known] * np.exp2(np.maximum(least[known] - bits[known], -1000))
    return least, np.where(b[0] < a[0], b[1], a[1]), odds


def identify(docs: DataFrame, folds: int = 5, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs(doc_id, text, lang)``.

    Learns from rows with a text and a language whose crc32(doc_id as text) mod ``folds`` is not 0; the
    others are held out. The language with the shortest code of the whole text wins, the first by name
    if several do; the score is its share of the odds. ``und`` with score 0 for null, texts without a
    letter (Unicode category L), or if nothing was learned. All languages are learned: where their tables
    pass ``block_bytes``, blocks of them score the texts one after another, and what is shortest so far is
    written with the texts. Repeated rows are learned from and predicted as often as they occur; a null
    doc_id counts as an empty one; an empty table gives no rows.
    """
    spark = docs.sparkSession
    held_out = F.pmod(crc_of(F.col("doc_id")), F.lit(folds)) == 0
    blocks = models(docs.filter(~held_out).select("lang", "text"), block_bytes)
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    schema = "doc_id long, held_out boolean, text string, least double, lang_pred string, odds double"
    model = next(blocks)
    for further in blocks:
        rows = saved(_scored(rows, spark.sparkContext.broadcast(model), schema), "shortest-codes")
        model = further
    done = _scored(rows, spark.sparkContext.broadcast(model), schema)
    score = F.when(F.col("odds") > 0, 1 / F.col("odds")).otherwise(F.lit(0.0))
    return done.select("doc_id", "held_out", "lang_pred", score.alias("score"))


def _scored(rows: DataFrame, model: Broadcast, schema: str) -> DataFrame:
    """``rows`` with the shortest code of this model's languages, and of those before it."""
    bound_batches(rows.sparkSession)
    earlier = "least" in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shortest(model.value, batch["text"].to_pylist())
            if earlier:
                before = (batch["least"].to_numpy(), np.array(batch["lang_pred"].to_pylist(), object), batch["odds"].to_numpy())
                found = _merged(before, found)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], batch["text"], pa.array(found[0]), pa.array(found[1], pa.string()), pa.array(found[2])],
                ["doc_id", "held_out", "text", "least", "lang_pred", "odds"],
            )

    return rows.mapInArrow(run, schema)
