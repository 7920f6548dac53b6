"""Operator 1: exact top-k by inner product, from sorted lists read in sequence without random access."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlspark.llm.common import saved

K = 5
EVERY = 50
SCALE = 256
VECTORS = 32_768  # of a task
QUERIES = 4_096  # of a task
LISTS = 4_096  # vectors whose components are sorted into one set of lists
QUERY_BLOCK = 256
DEPTHS = (0.125, 0.25, 0.5, 0.75, 1.0)  # of the lists


class Lists:
    """For every component the vectors sorted by it, read from either end."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        n = len(ids)
        order = np.argsort(-vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(vectors, order, axis=0)
        self.rank = np.empty_like(order)
        np.put_along_axis(self.rank, order, np.arange(n)[:, None], axis=0)
        self.n = n

    def bounds(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """What may be said of all vectors when ``depth`` entries have been read at both ends.

        Lower and upper values: first the lists read from their largest, for positive weights, then
        those from their smallest, for negative ones. An unread entry lies between the last one read
        and the list's other end.
        """
        n, x, s = self.n, self.vectors, self.sorted
        high, low = s[depth - 1], s[n - depth]
        top, bottom = self.rank < depth, self.rank >= n - depth
        lower = np.hstack([np.where(top, x, s[-1]), np.where(bottom, x, s[0])])
        upper = np.hstack([np.where(top, x, high), np.where(bottom, x, low)])
        return lower, upper


def search(queries: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """``query row, vec_id, score`` of the k best of ``vectors`` for each query but itself; all if fewer.

    For each set of lists and block of queries the lists are read deeper step by step. A vector's score
    lies between bounds from what has been read of it; one whose upper bound is under the k-th best
    lower bound, earlier sets included, cannot qualify. Reading stops when few others are left, whose
    scores are then resolved. Equal scores go to the smaller id, so bounds that tie are kept.
    """
    best_score = np.full((len(queries), k), -np.inf)
    best_id = np.full((len(queries), k), np.iinfo(np.int64).max)
    signed = np.hstack([np.maximum(queries, 0), np.minimum(queries, 0)])
    for start in range(0, len(ids), LISTS):
        lists = Lists(ids[start : start + LISTS], vectors[start : start + LISTS])
        steps = [max(1, int(np.ceil(d * lists.n))) for d in DEPTHS]
        open_blocks = {
            i: (lists.ids[None, :] != query_ids[i : i + QUERY_BLOCK, None]) for i in range(0, len(queries), QUERY_BLOCK)
        }
        for depth in steps:
            lower, upper = lists.bounds(depth)
            for i in list(open_blocks):
                part, left = slice(i, i + QUERY_BLOCK), open_blocks[i]
                low = np.where(left, signed[part] @ lower.T, -np.inf)
                known = np.hstack([best_score[part], np.partition(low, -min(k, lists.n), axis=1)[:, -k:]])
                limit = np.partition(known, -k, axis=1)[:, -k]
                left &= signed[part] @ upper.T >= limit[:, None]
                if depth < lists.n and left.sum() > 4 * k * len(left):
                    continue
                row, column = np.nonzero(left)
                score = np.einsum("ij,ij->i", queries[part][row], lists.vectors[column])
                _merge(best_score[part], best_id[part], row, lists.ids[column], score)
                del open_blocks[i]
            if not open_blocks:
                break
    row, place = np.nonzero(np.isfinite(best_score))
    return row, best_id[row, place], best_score[row, place]


def _merge(score: np.ndarray, ids: np.ndarray, row: np.ndarray, new_ids: np.ndarray, new: np.ndarray) -> None:
    """Put new candidates of the rows among their best, in place."""
    k = score.shape[1]
    rows = np.concatenate([np.repeat(np.arange(len(score)), k), row])
    all_scores, all_ids = np.concatenate([score.reshape(-1), new]), np.concatenate([ids.reshape(-1), new_ids])
    order = np.lexsort((all_ids, -all_scores, rows))
    begin = np.searchsorted(rows[order], np.arange(len(score)))
    take = order[begin[:, None] + np.arange(k)]
    score[:], ids[:] = all_scores[take], all_ids[take]


def top_k(embeddings: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best others for each vec_id divisible by ``every``.

    Components count as floor(scale x component) and scores are their integer inner products (exact
    below 2^53). Rows without an id, a vector or with a null or non-finite component take no part;
    vectors of different lengths are not compared. Rows that repeat id and vector count once; an id
    with several vectors is as many candidates and queries. Too few others give shorter lists, an empty
    table none. Queries and vectors are dealt by hash into blocks, each pair of blocks is one task, and
    a task holds at most about 32,768 vectors and 4,096 queries however large the table is.
    """
    whole = F.col("embedding")
    finite = F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    vector = F.transform(whole, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    rows = saved(
        embeddings.select("vec_id", "embedding")
        .filter(F.col("vec_id").isNotNull() & whole.isNotNull() & finite)
        .select("vec_id", vector.alias("v"))
        .groupBy("vec_id", "v")
        .agg(F.count("*").alias("n"))
        .select("vec_id", "v", F.xxhash64("vec_id", "v").alias("h"), F.size("v").alias("dim")),
        "vectors",
    )
    asks = F.col("vec_id") % every == 0
    n, n_queries = rows.agg(F.count("*"), F.count_if(asks)).first()
    groups, parts = -(-n // VECTORS) or 1, -(-n_queries // QUERIES) or 1

    def dealt(df: DataFrame, own: str, number: int, other: str, others: int) -> DataFrame:
        copies = F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other)
        return df.select("*", F.pmod("h", F.lit(number)).cast("int").alias(own), copies)

    vectors = dealt(rows, "grp", groups, "part", parts)
    queries = dealt(rows.filter(asks), "part", parts, "grp", groups)

    def run(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(v):
            return pd.DataFrame({"query_id": [], "q": [], "vec_id": [], "score": []}).astype("int64")
        ids = q["vec_id"].to_numpy()
        row, found, score = search(
            np.stack(q["v"].to_numpy()).astype(np.float64),
            ids,
            v["vec_id"].to_numpy(),
            np.stack(v["v"].to_numpy()).astype(np.float64),
            k,
        )
        return pd.DataFrame({"query_id": ids[row], "q": q["h"].to_numpy()[row], "vec_id": found, "score": score.astype(np.int64)})

    key = ["dim", "grp", "part"]
    found = (
        queries.groupBy(*key)
        .cogroup(vectors.groupBy(*key))
        .applyInPandas(run, "query_id long, q long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
