"""Exact top-k search by inner product: the threshold algorithm over sorted lists of each dimension."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Vectors of a shard, which has lists of its own; queries of a pass over all shards.
SHARD_ROWS, QUERY_ROWS = 1 << 14, 1 << 13
#: Entries that are read from every list before scores are looked up and the bound is drawn again.
DEPTH = 256


class SortedLists:
    """The rows of a shard ordered by each component."""

    def __init__(self, keys: np.ndarray, vectors: np.ndarray):
        self.keys, self.vectors, self.looked_up = keys, vectors, 0  # the last is of the latest search
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(vectors, self.order, axis=0)

    def search(self, query: np.ndarray, own: int, k: int, floor: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Scores and keys of the best ``k`` rows but ``own``; ``floor``: a score that k rows elsewhere reach.

        Lists are read from the end that the query's sign favours. No unseen row can beat the sum of the
        query's weights times the values the reading has come to; reading stops when that bound is below the
        k-th score found (a tie goes on, since a smaller key may come).
        """
        rows, dims = self.vectors.shape
        used = np.flatnonzero(query)
        seen = np.zeros(rows, bool)
        if not len(used):  # every score is 0
            seen[:] = True
        forward = query[used] < 0
        scores, found = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for depth in range(0, rows if len(used) else 0, DEPTH):
            last = min(depth + DEPTH, rows)
            step = np.arange(depth, last)[:, None]
            place = np.where(forward, step, rows - 1 - step)
            met = seen.copy()
            met[self.order[place, used]] = True
            new = np.flatnonzero(met & ~seen)
            seen = met
            scores = np.concatenate([scores, self.vectors[new] @ query])
            found = np.concatenate([found, new])
            keep = self.keys[found] != own
            scores, found = scores[keep], found[keep]
            if len(scores) > k:
                # All rows at the k-th score stay, so that ties are settled by key.
                cut = np.partition(scores, len(scores) - k)[len(scores) - k]
                keep = scores >= cut
                scores, found = scores[keep], found[keep]
            kth = scores.min() if len(scores) >= k else None
            if floor is not None:
                kth = floor if kth is None else max(kth, floor)
            bound = int((query[used] * self.sorted[place[-1], used]).sum())
            if kth is not None and bound < kth:
                break
        if not len(used):
            found = np.flatnonzero(self.keys != own)
            scores = np.zeros(len(found), np.int64)
        self.looked_up = int(seen.sum())
        best = np.lexsort((self.keys[found], -scores))[:k]
        return scores[best], self.keys[found[best]]


def whole(vector: str, scale: int) -> Column:
    """floor(scale * x) of every component; null if the vector is null, or has a null or non-finite component."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(sound, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding", scale: int = 1024
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` its k best rows of ``vectors`` but those of its key.

    Scores are inner products of ``floor(scale * component)``, ties go to the smaller key, results are exact.
    Vectors are cut into shards of at most ``SHARD_ROWS`` rows where they lie, without a shuffle; each
    shard sorts its rows by every dimension and runs the threshold algorithm for every query, with the
    k-th score of the shards before it in the task as a floor. Queries are sent in blocks of at most
    ``QUERY_ROWS``, one pass each, so no broadcast grows. Each task returns at most k rows a query.

    Vectors that are null or hold a null or non-finite component take no part, nor do rows with a null
    key, nor queries without rows of the same length. Repeated rows of a key are rows of their own, as
    candidates and as queries alike. Fewer than k candidates give all of them; an empty table gives none.
    """
    def sound(rows: DataFrame) -> DataFrame:
        return rows.select(F.col(key).cast("long").alias("key"), whole(f"`{vector}`", scale).alias("v")).where(
            "key IS NOT NULL AND v IS NOT NULL")

    asked, rows = sound(queries), sound(vectors)
    spark = vectors.sparkSession
    out = None
    for block in _query_blocks(asked):
        sent = spark.sparkContext.broadcast(block)
        best = rows.mapInArrow(_search(sent, k), "query bigint, copy bigint, key bigint, score bigint")
        order = Window.partitionBy("query", "copy").orderBy(F.desc("score"), "key", "copy")
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        out = best if out is None else out.unionByName(best)
    if out is None:
        out = spark.createDataFrame([], "query bigint, copy bigint, key bigint, score bigint, rank int")
    return out.select(F.col("query").alias("query_id"), "rank", F.col("key").alias("vec_id"), "score")


def _query_blocks(asked: DataFrame) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    keys, vectors = [], []
    for row in asked.toLocalIterator():
        keys.append(row["key"])
        vectors.append(np.array(row["v"], np.int64))
        if len(keys) >= QUERY_ROWS:
            yield np.array(keys, np.int64), vectors
            keys, vectors = [], []
    if keys:
        yield np.array(keys, np.int64), vectors


def _search(sent, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, asked = sent.value
        best: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in queries]
        floors: list[int | None] = [None] * len(queries)

        def search(keys: np.ndarray, vectors: np.ndarray) -> None:
            lists = SortedLists(keys, vectors)
            for i, query in enumerate(asked):
                if len(query) != vectors.shape[1]:
                    continue
                score, key = lists.search(query, int(queries[i]), k, floors[i])
                best[i].append((score, key))
                score, key = (np.concatenate(x) for x in zip(*best[i]))
                order = np.lexsort((key, -score))[:k]
                best[i] = [(score[order], key[order])]
                if len(order) == k:
                    floors[i] = int(score[order[-1]])

        held: dict[int, list] = {}
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            lists = batch.column(1)
            size = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            at = np.cumsum(size) - size
            for dims in np.unique(size).tolist():
                rows = np.flatnonzero(size == dims)
                held.setdefault(dims, []).append((keys[rows], flat[at[rows][:, None] + np.arange(dims)]))
                if sum(len(x) for x, _ in held[dims]) >= SHARD_ROWS:
                    search(*(np.concatenate(x) for x in zip(*held.pop(dims))))
        for parts in held.values():
            search(*(np.concatenate(x) for x in zip(*parts)))
        rows = [(i, *best[i][0]) for i in range(len(queries)) if best[i]]
        if rows:
            many = [len(key) for _, _, key in rows]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat([queries[i] for i, _, _ in rows], many)), pa.array(np.repeat([i for i, _, _ in rows], many)),
                pa.array(np.concatenate([key for _, _, key in rows])), pa.array(np.concatenate([s for _, s, _ in rows])),
            ], ["query", "copy", "key", "score"])

    return run


def op2_threshold_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(rows, rows.where("vec_id % 100 = 0"), 10)


OP2_SQL = """
WITH v AS (SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
