"""Exact top-k by inner product, reading sorted lists only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SCALE = 64
TOP = 20
#: Candidates of one block, and queries that read its lists together.
BLOCK, BATCH = 4096, 256
#: Shares of each list that are read before bounds are compared; the last resolves everything.
DEPTHS = (0.25, 0.5, 1.0)
#: Below this share of open candidates the final scores are computed for them alone.
FEW = 0.02


class SortedLists:
    """The candidates of a block as one sorted list for each component.

    A list is read from its top for queries whose component is positive and from its end for
    negative ones. What a candidate's component adds to a score is known once its place in the list
    has been read; until then it lies between what the place just read and the far end would add.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order].astype(np.float64)
        n, size = self.vectors.shape
        self.lists = np.sort(self.vectors, axis=0)  # ascending
        places = np.argsort(np.argsort(self.vectors, axis=0, kind="stable"), axis=0)
        self.down, self.up = n - 1 - places, places

    def _bounds(self, queries: np.ndarray, read: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of all scores after ``read`` entries of each list."""
        n = len(self.ids)
        plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
        both = np.concatenate([plus, minus], axis=1)
        top, end = self.lists[max(0, n - read)], self.lists[min(n - 1, read - 1)]
        down, up = self.down < read, self.up < read

        def score(unread_down: np.ndarray, unread_up: np.ndarray) -> np.ndarray:
            known = [np.where(down, self.vectors, unread_down), np.where(up, self.vectors, unread_up)]
            return both @ np.concatenate(known, axis=1).T

        return score(self.lists[0], self.lists[-1]), score(top, end)

    def top(self, own: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each query the k best (id, score), best first, ties to the smaller id; ``own`` ids are left out."""
        n = len(self.ids)
        open_ = self.ids[None, :] != own[:, None]
        exact = None
        for share in DEPTHS:
            read = max(1, min(n, int(np.ceil(share * n))))
            low, high = self._bounds(queries, read)
            if read == n:
                exact = low
                break
            worst = np.where(open_, low, -np.inf)
            kth = np.partition(worst, n - k, axis=1)[:, n - k] if n > k else np.full(len(queries), -np.inf)
            open_ &= high >= kth[:, None]  # who could still tie stays
            if open_.mean() < FEW:
                break
        for i in range(len(queries)):
            at = np.flatnonzero(open_[i])
            scores = exact[i, at] if exact is not None else self.vectors[at] @ queries[i]
            best = np.argsort(-scores, kind="stable")[:k]  # ids ascend, so ties keep the smaller one first
            yield self.ids[at[best]], scores[best]


def _usable(vector: Column) -> Column:
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~odd


def top_k(vectors: DataFrame, every: int = 20, k: int = TOP, block: int = BLOCK) -> DataFrame:
    """The ``k`` best candidates of every query, (query_id, rank, vec_id, score).

    ``vectors`` has vec_id and embedding; components become floor(64 x). Queries are the rows whose
    vec_id is divisible by ``every``; candidates are all rows of equal length but those with the
    query's own vec_id. Candidates are cut into blocks of about ``block`` rows by a hash of vec_id,
    and every query visits every block: a query set against all rows, as the result asks for. In a
    block no score is looked up for a single candidate before the end: sorted lists are read deeper
    and deeper, lower and upper bounds are kept, candidates that cannot reach the k-th lower bound
    are closed, and the final scores of the others are resolved. A block's best are merged per query.

    Rows with a null vec_id, a null vector, or a null or non-finite component take no part; an
    empty vector scores 0 with other empty ones; repeated rows are candidates each and ask once, rows
    of one vec_id with unlike vectors ask each; fewer rows than ``k`` give all of them; no rows give none. Scores are exact while below 2^53.
    """
    ints = F.transform("embedding", lambda x: F.floor(F.lit(SCALE) * x.cast("double")).cast("long"))
    rows = vectors.filter(F.col("vec_id").isNotNull() & _usable(F.col("embedding")))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), ints.alias("v"), F.size("embedding").alias("dim"))
    sizes = rows.groupBy("dim").count().collect()  # one row for each length of vector that occurs
    blocks = F.lit(1)
    for r in sizes:
        blocks = F.when(F.col("dim") == r["dim"], F.lit(-(-r["count"] // block))).otherwise(blocks)
    of = F.pmod(F.xxhash64("vec_id", "v"), blocks).cast("int")
    every_block = F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1))
    queries = rows.filter(F.col("vec_id") % every == 0).distinct()
    queries = queries.select("dim", every_block.alias("block"), F.xxhash64("vec_id", "v").alias("h"), "vec_id", "v")
    # queries of a block are dealt to several tasks, each with the block's candidates
    asked = sum(r["count"] for r in sizes) // every + 1
    parts = max(1, asked // (16 * BATCH))
    candidates = rows.select("dim", of.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "vec_id", "v")
    queries = queries.select("dim", "block", F.pmod("h", F.lit(parts)).cast("int").alias("part"), "h", "vec_id", "v")

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"h": [], "query_id": [], "vec_id": [], "score": []}, dtype=np.int64)]
        if len(left) and len(right):
            size = key[0]
            lists = SortedLists(right["vec_id"].to_numpy(), np.array(right["v"].tolist(), np.int64).reshape(len(right), size))
            for low in range(0, len(left), BATCH):
                part = left.iloc[low : low + BATCH]
                own = part["vec_id"].to_numpy()
                queries = np.array(part["v"].tolist(), np.float64).reshape(len(part), size)
                for h, q, (ids, scores) in zip(part["h"], own, lists.top(own, queries, k), strict=True):
                    out.append(pd.DataFrame({"h": h, "query_id": q, "vec_id": ids, "score": scores.astype(np.int64)}))
        return pd.concat(out)

    keys = ["dim", "block", "part"]
    found = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(run, "h long, query_id long, vec_id long, score long")
    best = W.partitionBy("query_id", "h").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
