"""Exact top-k search by the threshold algorithm over sorted per-dimension lists.

Every query meets every block of candidates once. In a block each dimension's values stand sorted, and a query reads all
lists from their end that is better for it, in steps of growing depth. Each candidate met in a list is scored in full;
no candidate not met yet can score more than the bound, the query's product with the values at the depth reached.
Reading stops when the bound is below the kth score: candidates that only tie with it are still read, so ties are right.

Candidates are dealt into blocks of about `block_rows` and queries into blocks of about `query_rows`, both by row and not by
id, and each pair of blocks is one group: its memory is bounded, whatever the corpus holds.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.text import Shelf

K = 5
EVERY = 50
SCALE = 256
BLOCK_ROWS = 1024
QUERY_ROWS = 2048
FIRST_DEPTH = 4
DEEPER = 4


def threshold_search(
    vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, queries: np.ndarray, query_rows: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best candidates of each query but its own row, ties to the smaller id, as parallel arrays of query,
    candidate and score. Vectors are whole numbers, and products exact: in floating point as long as 53 bits hold them."""
    n = len(vectors)
    top = max(1, np.abs(vectors).max(initial=0)) * max(1, np.abs(queries).max(initial=0)) * max(1, vectors.shape[1])
    kind = np.float64 if top < 1 << 53 else np.int64
    vectors, queries = vectors.astype(kind), queries.astype(kind)
    falling = np.argsort(-vectors, axis=0, kind="stable")
    values = np.take_along_axis(vectors, falling, axis=0)
    depths = [min(n, FIRST_DEPTH)]
    while depths[-1] < n:
        depths.append(min(n, depths[-1] * DEEPER))
    ends = np.array(depths) - 1
    bounds = np.maximum(queries, 0) @ values[ends].T + np.minimum(queries, 0) @ values[n - 1 - ends].T
    out = []
    for q, query in enumerate(queries):
        from_top, from_end = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        met = np.zeros(n, bool)
        best_at, best = np.zeros(0, np.int64), np.zeros(0, kind)
        before = 0
        for depth, bound in zip(depths, bounds[q]):
            seen = met.copy()
            met[falling[before:depth, from_top]] = True
            met[falling[n - depth : n - before, from_end]] = True
            if depth == n:
                met[:] = True
            new = np.flatnonzero(met & ~seen)
            new = new[rows[new] != query_rows[q]]
            at = np.concatenate([best_at, new])
            score = np.concatenate([best, vectors[new] @ query])
            if len(at) > k:
                # All that may be among the k best, before ties are broken by id.
                keep = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
                keep = keep[np.lexsort((rows[at[keep]], ids[at[keep]], -score[keep]))][:k]
                at, score = at[keep], score[keep]
            best_at, best, before = at, score, depth
            if len(best) == k and bound < best.min():
                break
        out.append((np.full(len(best), q), best_at, best.astype(np.int64)))
    return tuple(np.concatenate(part) for part in zip(*out))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors as rows; a vector with fewer components than the longest is filled with zeros."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def exact_top_k(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    every: int = EVERY,
    scale: int = SCALE,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """For every row whose id is divisible by `every`: query_id, rank, vec_id, score of its k best among all other rows.

    Components x count as floor(scale * x) and scores are integer inner products; of equal scores the smaller vec_id is
    better. A vector that is null or has a null or non-finite component takes no part, nor does a row without id.
    Of vectors of different length the shorter ends in zeros. Rows that repeat an id are rows like any other: a query is
    answered for each, and they are candidates. A query without candidates has no rows; an empty table gives none.
    Other columns, whatever their names, are not looked at.
    """
    shelf = Shelf(vectors.sparkSession, "top-k")
    vector = F.col("vector")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    given = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector")
    ).filter(F.col("vec_id").isNotNull() & vector.isNotNull() & finite)
    whole = F.transform(vector, lambda x: F.floor(x * scale).cast("long"))
    rows = shelf.put(given.select("vec_id", whole.alias("vector"), F.monotonically_increasing_id().alias("row")), "rows")
    asked = F.pmod("vec_id", F.lit(every)) == 0
    sizes = rows.agg(F.count("*").alias("n"), F.count_if(asked).alias("queries")).first()
    blocks, turns = math.ceil(sizes["n"] / block_rows) or 1, math.ceil(sizes["queries"] / query_rows) or 1

    def dealt(df: DataFrame, own: str, n: int, other: str, times: int) -> DataFrame:
        """Each row in its own block, once for every block of the other side."""
        every_block = F.explode(F.sequence(F.lit(0), F.lit(times - 1)))
        return df.withColumn(own, F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")).withColumn(other, every_block)

    candidates = dealt(rows, "block", blocks, "turn", turns)
    queries = dealt(rows.filter(asked), "turn", turns, "block", blocks).select(
        F.col("block").alias("at"), F.col("turn").alias("by"), F.col("row").alias("query"),
        F.col("vec_id").alias("query_id"), F.col("vector").alias("asked"),
    )

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64)] * 5
        if left.num_rows and right.num_rows:
            a, b = _matrix(left["vector"]), _matrix(right["asked"])
            width = max(a.shape[1], b.shape[1])
            a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
            ids, at = left["vec_id"].to_numpy(), left["row"].to_numpy()
            asked_ids, asked_rows = right["query_id"].to_numpy(), right["query"].to_numpy()
            q, c, score = threshold_search(a, ids, at, b, asked_rows, k)
            found = [asked_rows[q], asked_ids[q], at[c], ids[c], score]
        return pa.table(dict(zip(["query", "query_id", "row", "vec_id", "score"], found)))

    best = (
        candidates.groupBy("block", "turn")
        .cogroup(queries.groupBy("at", "by"))
        .applyInArrow(search, "query long, query_id long, row long, vec_id long, score long")
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
