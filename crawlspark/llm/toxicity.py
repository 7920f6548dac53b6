"""Operator 2: toxicity from the nearest labelled examples, found by exact TF-IDF cosine."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.common import bound_batches, crc_of, saved

EXAMPLES = 8_192  # labelled texts of each class that are kept as examples, at most
CALIBRATION = 8_192  # labelled texts that set the scale of the scores, at most
VOCABULARY = 4_096  # terms, at most
MIN_TEXTS = 3  # toxic examples a term must be in
MIN_RATIO = 2.0  # times as frequent in toxic examples as in others, at the lower end of its 95 % range
NEIGHBOURS = 16
SHRINK = 0.3  # similarity that stands for the base rate in every vote
OTHER_WORDS = 0.4  # weight of every word in what a vector has outside the vocabulary
BLOCK = 64
STEMS = (3, 5, 7)
THRESHOLD = 0.3
CACHE_WORDS = 300_000
BLOCKS_AT_ONCE = 8

WORDS = re.compile(r"\w+")


def words_of(text: str | None) -> Counter:
    return Counter(WORDS.findall((text or "").lower()))


def stems(word: str) -> list[str]:
    """Longer words also count by how they begin."""
    return [word[:n] + "*" for n in STEMS if len(word) > n]


def all_terms(text: str | None) -> set[str]:
    found = set(words_of(text))
    return found | {s for w in found for s in stems(w)}


class Vocabulary(dict):
    """Numbers of the terms that a word counts for; those of frequent words are kept."""

    def __init__(self, terms: list[str]) -> None:
        self.number = {t: i for i, t in enumerate(terms)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = tuple(i for t in (word, *stems(word)) if (i := self.number.get(t)) is not None)
        if len(self) < CACHE_WORDS:
            self[word] = found
        return found

    def __reduce__(self):
        return Vocabulary, (list(self.number),)

    def counts(self, words: Counter) -> dict[int, int]:
        """How often each term occurs."""
        out: dict[int, int] = {}
        for word, n in words.items():
            for i in self[word]:
                out[i] = out.get(i, 0) + n
        return out


class Weights:
    """Terms and their weights; makes the vectors of whole texts."""

    def __init__(self, terms: list[str], idf: np.ndarray) -> None:
        self.terms, self.idf = Vocabulary(terms), idf

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Terms of the vocabulary in a whole text and their weights in a vector of length 1.

        All words of the text are one more component, which no two texts share, so that a few terms
        weigh less in a long text.
        """
        words = words_of(text)
        counts = self.terms.counts(words)
        at = np.array(sorted(counts), np.int64)
        weight = (1 + np.log(np.array([counts[i] for i in at], float))) * self.idf[at]
        return at, weight / (np.sqrt((weight * weight).sum() + OTHER_WORDS**2 * words.total()) or 1)


class Index:
    """Examples as unit vectors in an inverted index with the largest weight of each term in each block."""

    def __init__(self, weights: Weights, ids: list[int | None], labels: list[int], vectors: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.vector = weights.vector
        # examples that share their weightiest term are put together, which keeps blocks' maxima tight
        lead = [(int(v[0][v[1].argmax()]) if len(v[0]) else -1) for v in vectors]
        order = sorted((i for i in range(len(ids)) if lead[i] >= 0), key=lambda i: (lead[i], labels[i], str(ids[i])))
        self.ids, self.labels = [ids[i] for i in order], np.array([labels[i] for i in order], float)
        self.rate = (sum(labels) + 0.1) / (len(labels) + 1)
        self.blocks = -(-len(order) // BLOCK)
        terms = np.concatenate([np.zeros(0, np.int64), *(vectors[i][0] for i in order)])
        values = np.concatenate([np.zeros(0), *(vectors[i][1] for i in order)])
        places = np.repeat(np.arange(len(order)), [len(vectors[i][0]) for i in order])
        by_term = np.argsort(terms, kind="stable")
        n_terms = len(weights.idf)
        cuts = np.searchsorted(terms[by_term], np.arange(1, n_terms))
        self.places = np.split(places[by_term], cuts)
        self.weights = np.split(values[by_term], cuts)
        self.block_of = [p // BLOCK for p in self.places]
        self.most = np.zeros((n_terms, self.blocks))
        np.maximum.at(self.most, (terms, places // BLOCK), values)

    def nearest(self, at: np.ndarray, weight: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k most similar examples, ties to the smaller place; those without a
        common term are none.

        Blocks are scored in the order of their upper bounds, some at once, and no more once the next
        bound is under the k-th best cosine.
        """
        if not len(at) or not self.blocks:
            return np.zeros(0, np.int64), np.zeros(0)
        bound = weight @ self.most[at]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        best_place, best, begin, step = np.zeros(0, np.int64), np.zeros(0), 0, BLOCKS_AT_ONCE
        # sums of products in another order may differ in their last bits
        while begin < len(order) and (len(best) < k or bound[order[begin]] >= best[-1] - 1e-9):
            chosen = np.zeros(self.blocks, bool)
            chosen[order[begin : begin + step]] = True
            begin, step = begin + step, 4 * step
            score = np.zeros(len(self.ids))
            for t, w in zip(at, weight, strict=True):
                part = chosen[self.block_of[t]]
                score[self.places[t][part]] += w * self.weights[t][part]
            hit = np.flatnonzero(score)
            best_place, best = np.concatenate([best_place, hit]), np.concatenate([best, score[hit]])
            if len(best) > 4 * k:
                top = best >= np.partition(best, -k)[-k] - 1e-8
                best_place, best = best_place[top], best[top]
            first = np.lexsort((best_place, -np.round(best, 9)))[:k]
            best_place, best = best_place[first], best[first]
        return best_place, best

    def vote(self, text: str | None) -> tuple[float, list]:
        """Share of the similarity that is to toxic examples, drawn to the base rate where there is
        little, and the nearest examples."""
        places, cosines = self.nearest(*self.vector(text))
        vote = (cosines @ self.labels[places] + SHRINK * self.rate) / (cosines.sum() + SHRINK)
        return float(vote), [self.ids[p] for p in places]


class Scorer:
    """Votes on the scale of a logistic curve, fitted to the votes on labelled texts that are no examples."""

    def __init__(self, index: Index, votes: list[float], labels: list[int]) -> None:
        self.index = index
        self.a = self.b = None
        x, y = np.array(votes, float), np.array(labels, float)
        if len(x):
            wanted = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
            self.a, self.b = _logistic(x, wanted)

    def score(self, text: str | None) -> tuple[float, list]:
        vote, evidence = self.index.vote(text)
        if self.a is None:  # nothing to calibrate with
            return vote, evidence
        return float(1 / (1 + np.exp(-np.clip(self.a * vote + self.b, -50, 50)))), evidence


def _logistic(x: np.ndarray, wanted: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and offset by Newton's method with a slight penalty."""
    design, beta = np.stack([x, np.ones_like(x)], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (wanted - p) - 1e-3 * beta
        bend = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(beta[0]), 1e-6), float(beta[1])


def _term_texts(docs: DataFrame, carried: list[str], terms: list[str] | None) -> DataFrame:
    """``term`` and sums: texts that hold it, and sums of the carried columns over them."""
    bound_batches(docs.sparkSession)
    fields = ", ".join(["term string", "n long", *(f"{c} long" for c in carried)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(terms or [])
        for batch in batches:
            sums = [Counter() for _ in range(len(carried) + 1)]
            values = [batch[c].to_pylist() for c in carried]
            for i, text in enumerate(batch["text"].to_pylist()):
                if terms is None:
                    found = all_terms(text)
                else:
                    found = {terms[i] for i in vocabulary.counts(words_of(text))}
                sums[0].update(found)
                for s, v in zip(sums[1:], values, strict=True):
                    if v[i]:
                        s.update(found)
            keys = list(sums[0])
            columns = [pa.array(keys, pa.string()), *(pa.array([s[k] for k in keys], pa.int64()) for s in sums)]
            yield pa.RecordBatch.from_arrays(columns, ["term", "n", *carried])

    rows = docs.select("text", *carried).mapInArrow(run, fields)
    return rows.groupBy("term").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in carried))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 4,
    held_fold: int = 2,
    examples: int = EXAMPLES,
    calibration: int = CALIBRATION,
) -> Scorer:
    """The scorer learned from ``labels(doc_id, toxic)`` outside the held-out fold.

    Examples and calibration texts are samples by hash, bounded by their parameters; which terms tell
    the classes apart is counted in them. Document frequencies are those of all rows of ``docs``. Texts
    stay on the executors: the driver reads the examples' vectors and the votes on calibration texts.
    """
    learned = (
        labels.filter("doc_id is not null and toxic is not null")
        .filter(F.pmod(crc_of(F.col("doc_id")), F.lit(folds)) != held_fold)
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .withColumn("h", F.xxhash64(F.lit(7), "doc_id"))
        .withColumn("example", F.pmod("h", F.lit(4)) != 0)
    )
    parts = [
        learned.filter(F.col("example") & (F.col("toxic") == label)).orderBy("h", "doc_id").limit(examples) for label in (0, 1)
    ]
    parts.append(learned.filter(~F.col("example")).orderBy("h", "doc_id").limit(calibration))
    # at most 2 x examples + calibration rows of four numbers
    chosen = F.broadcast(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    texts = saved(docs.select("doc_id", "text").join(chosen, "doc_id").dropDuplicates(["doc_id"]), "labelled")

    kept = texts.filter("example")
    n, n_toxic = kept.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    clean = F.col("n") - F.col("toxic") + 0.5
    rate, other = F.col("toxic") / F.lit(max(1, n_toxic)), clean / F.lit(max(1, n - n_toxic))
    certain = F.log(rate / other) - 1.65 * F.sqrt(1 / F.col("toxic") + 1 / clean)
    found = (
        _term_texts(kept, ["toxic"], None)
        .filter((F.col("toxic") >= MIN_TEXTS) & (certain >= F.log(F.lit(MIN_RATIO))))
        .orderBy((rate * F.log(rate / other)).desc(), "term")
        .limit(VOCABULARY)
        .collect()
    )
    terms = sorted(r["term"] for r in found)
    total = docs.count()
    held = {r["term"]: r["n"] for r in _term_texts(docs, [], terms).collect()} if terms else {}
    idf = np.array([np.log((1 + total) / (1 + held.get(t, 0))) + 1 for t in terms])
    weights = Weights(terms, idf)
    own = _vectors(kept, weights).toArrow().sort_by([("h", "ascending"), ("doc_id", "ascending")])
    vectors = list(zip(*(_arrays(own[c], t) for c, t in (("at", np.int64), ("weight", float))), strict=True))
    index = Index(weights, own["doc_id"].to_pylist(), own["toxic"].to_pylist(), vectors)
    rest = _votes(texts.filter(~F.col("example")), index).toArrow().sort_by([("h", "ascending"), ("doc_id", "ascending")])
    return Scorer(index, rest["vote"].to_pylist(), rest["toxic"].to_pylist())


def _arrays(column: pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    """The lists of a column."""
    held = column.combine_chunks()
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(held).to_numpy(zero_copy_only=False))]).astype(np.int64)
    return np.split(held.flatten().to_numpy(zero_copy_only=False).astype(kind), ends[1:-1]) if len(held) else []


def _vectors(texts: DataFrame, weights: Weights) -> DataFrame:
    """``h, doc_id, toxic, at, weight``: the vectors of the examples, made where their texts are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [weights.vector(t) for t in batch["text"].to_pylist()]
            at, weight = pa.array([x for x, _ in found], pa.list_(pa.int32())), pa.array([x for _, x in found], pa.list_(pa.float64()))
            kept = [batch[c] for c in ("h", "doc_id", "toxic")]
            yield pa.RecordBatch.from_arrays([*kept, at, weight], ["h", "doc_id", "toxic", "at", "weight"])

    fields = "h long, doc_id long, toxic int, at array<int>, weight array<double>"
    return texts.select("h", "doc_id", "toxic", "text").mapInArrow(run, fields)


def _votes(texts: DataFrame, index: Index) -> DataFrame:
    """``h, doc_id, toxic, vote`` for the calibration texts."""
    held = texts.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes = pa.array([held.value.vote(t)[0] for t in batch["text"].to_pylist()], pa.float64())
            kept = [batch[c] for c in ("h", "doc_id", "toxic")]
            yield pa.RecordBatch.from_arrays([*kept, votes], ["h", "doc_id", "toxic", "vote"])

    return texts.select("h", "doc_id", "toxic", "text").mapInArrow(run, "h long, doc_id long, toxic int, vote double")


def score_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 4, held_fold: int = 2, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence`` for every row of ``docs(doc_id, text)``.

    A score comes from the whole text alone. ``evidence`` holds the doc_ids of the nearest examples,
    nearest first. A null or empty text has no neighbour and the score of the base rate. Without labels
    every text has the same low score. An id with several labels is toxic if one says so; labels with a
    null id or mark are not used. Repeated rows are scored alike; a null doc_id counts as an empty one
    for the fold; an empty table gives no rows; other columns are not read.
    """
    scorer = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, folds, held_fold, **options))
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scorer.value.score(t) for t in batch["text"].to_pylist()]
            scores = [s for s, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["held_out"],
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()),
                    pa.array([e for _, e in found], pa.list_(pa.int64())),
                ],
                ["doc_id", "held_out", "score", "predicted", "evidence"],
            )

    held_out = F.pmod(crc_of(F.col("doc_id")), F.lit(folds)) == held_fold
    return docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int, evidence array<long>"
    )


def without_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is under the threshold."""
    scorer = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **options))
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [scorer.value.score(t)[0] < THRESHOLD for t in batch["text"].to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
