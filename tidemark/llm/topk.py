"""Exact top-k inner products with Fagin's threshold algorithm over sorted per-dimension lists.

Candidates are dealt to blocks of about 8,192 vectors, queries to blocks of about 2,048, and each
pair of blocks is one group of a cogroup. In it every dimension has its candidates sorted by
value. A query walks all lists at once, from the largest value where its own component is
positive and from the smallest where it is negative, scores the vectors it meets, and stops as
soon as no vector not yet met can reach its k-th score. The best k of each block are merged per
query; a query's rows are k per block, cut before and after the shuffle.

Nulls, ties and odd input: vectors that are null, or hold null or non-finite components, take no
part, nor do rows without an id; equal scores go by the smaller id; equal rows count once; shorter
vectors are filled up with zeros; empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrowmap import ship_package

CANDIDATES, QUERIES = 8_192, 2_048
FIRST_DEPTH = 32


def whole_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v): vectors as floor(scale * x), without those that are not fully finite."""
    x = F.col("embedding")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < F.lit(float("inf"))))
    return (
        vectors.where(F.col("vec_id").isNotNull() & x.isNotNull())
        .where(finite)
        .select(
            F.col("vec_id").cast("bigint").alias("vec_id"),
            F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("bigint")).alias("v"),
        )
        .distinct()
    )


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def threshold_search(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """(query row, candidate row, score) of the best k candidates of each query."""
    n = len(ids)
    # By id within equal values, so that ties are met in a fixed order.
    by_id = np.argsort(ids, kind="stable")
    ids, vectors = ids[by_id], vectors[by_id]
    order = np.argsort(vectors, axis=0, kind="stable")
    values = np.take_along_axis(vectors, order, axis=0)
    # Sums of whole numbers are exact in doubles up to 2**53.
    peak = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * vectors.shape[1]
    kind = np.float64 if peak < 2**53 else object
    table = vectors.astype(kind)
    rows, found, scores = [], [], []
    for r, query in enumerate(queries):
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        q = query.astype(kind)
        met = np.zeros(n, bool)
        best = np.zeros(0, kind)
        best_at = np.zeros(0, np.int64)
        done, depth = 0, FIRST_DEPTH
        while True:
            upto = min(depth, n)
            lists = [order[n - upto : n - done, up].ravel(), order[done:upto, down].ravel()]
            fresh = np.zeros(n, bool)
            for x in lists:
                fresh[x] = True
            if upto == n:
                fresh[:] = True  # where all components are zero no list has met anything
            fresh &= ~met
            met |= fresh
            at = np.flatnonzero(fresh)
            at = at[ids[at] != query_ids[r]]
            if len(at):
                best = np.concatenate([best, table[at] @ q])
                best_at = np.concatenate([best_at, at])
                keep = np.lexsort((ids[best_at], -best))[:k]
                best, best_at = best[keep], best_at[keep]
            if upto == n:
                break
            bound = (values[n - upto, up].astype(kind) * q[up]).sum() + (values[upto - 1, down].astype(kind) * q[down]).sum()
            # A vector not yet met may still equal the bound, and win by its id.
            if len(best) == k and best[-1] > bound:
                break
            done, depth = upto, depth * 2
        rows += [r] * len(best_at)
        found += ids[best_at].tolist()
        scores += [int(s) for s in best]
    return rows, found, scores


def _search(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        width = max(int(np.diff(t["v"].combine_chunks().offsets.to_numpy()).max(initial=0)) for t in (left, right))
        query_ids = left["vec_id"].to_numpy()
        rows, ids, scores = threshold_search(
            right["vec_id"].to_numpy(), _matrix(right["v"], width), query_ids, _matrix(left["v"], width), k
        )
        return pa.table([pa.array(query_ids[rows]), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], schema=schema)

    return run


def top_products(candidates: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's best k of all candidates but itself.

    Both inputs are (vec_id, v) of whole numbers. They are counted first, to size the blocks.
    """
    ship_package(candidates.sparkSession)
    by = -(-max(1, candidates.count()) // CANDIDATES)
    qy = -(-max(1, queries.count()) // QUERIES)
    draw = F.xxhash64("vec_id")
    c = candidates.withColumns(
        {"cb": F.pmod(draw, F.lit(by)), "qb": F.explode(F.sequence(F.lit(0), F.lit(qy - 1)).cast("array<bigint>"))}
    )
    q = queries.withColumns(
        {"qb": F.pmod(draw, F.lit(qy)), "cb": F.explode(F.sequence(F.lit(0), F.lit(by - 1)).cast("array<bigint>"))}
    )
    found = (
        q.groupBy("qb", "cb")
        .cogroup(c.groupBy("qb", "cb"))
        .applyInArrow(_search(k), "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
