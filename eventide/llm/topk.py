"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Vectors become integers, ``floor(256 x)``; a vector's terms are its non-zero
components. Candidates are dealt into blocks of about ``CANDIDATE_BLOCK`` rows
and queries into blocks of about ``QUERY_BLOCK``, and each pair of blocks is
one task: postings (term -> candidate places and weights) are built from the
block, each query row scatters ``query weight x posting weight`` into dense
score arrays, term after term, and a partition selection keeps k candidates per
query. The kept rows of all blocks merge per query in a window over k rows per
block. Nothing is pruned, so the result is exact; the work is queries times
candidates by definition and is spread over all pairs of blocks.

Defined results: vectors that are null, empty of non-null values, or hold a null or a
non-finite component, and rows with a null id, take no part; equal rows count
once; rows with one id and different vectors are different candidates, none of
them candidate for a query of that id; vectors of different lengths meet on
their common components; scores are 64-bit integers, and vectors so long that a
score may not fit (or finite components beyond 64 bits) raise an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import written

K = 5
QUERY_BLOCK, CANDIDATE_BLOCK = 2048, 8192
QUERY_ROWS = 64  # score arrays held at a time


def quantized(vector: Column) -> Column:
    """floor(256 x) of every component, null where the vector takes no part."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(vector.isNotNull() & F.coalesce(whole, F.lit(False)),
                  F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("long")))


def _matrix(lists: pa.ListArray) -> np.ndarray:
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy()
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes),
        np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def search_block(query_ids, queries, ids, vectors, k: int):
    """(query place, candidate id, score) of the k best candidates of each
    query in one block, ties to the smaller id."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    postings = []  # term -> (places or all of them, weights)
    for t in range(vectors.shape[1]):
        at = np.flatnonzero(vectors[:, t])
        postings.append((slice(None), vectors[:, t].copy()) if len(at) == len(ids) else (at, vectors[at, t]))
    out_q, out_id, out_score = [], [], []
    for lo in range(0, len(query_ids), QUERY_ROWS):
        part = queries[lo:lo + QUERY_ROWS]
        scores = np.zeros((len(part), len(ids)), np.int64)
        for t in range(min(part.shape[1], len(postings))):
            places, weights = postings[t]
            rows = np.flatnonzero(part[:, t])
            if not len(rows) or not len(weights):
                continue
            if len(rows) == len(part) and isinstance(places, slice):
                scores += part[:, t, None] * weights
            elif isinstance(places, slice):
                scores[rows] += part[rows, t, None] * weights
            else:
                scores[np.ix_(rows, places)] += part[rows, t, None] * weights
        for r in range(len(part)):
            mine, own = scores[r], query_ids[lo + r]
            other = np.flatnonzero(ids != own)
            mine = mine[other]
            if len(mine) > k:
                kth = np.partition(mine, len(mine) - k)[len(mine) - k]
                best = np.concatenate((np.flatnonzero(mine > kth), np.flatnonzero(mine == kth)))
                best = best[np.lexsort((other[best], -mine[best]))][:k]
            else:
                best = np.lexsort((other, -mine))
            out_q.append(np.full(len(best), lo + r))
            out_id.append(ids[other[best]])
            out_score.append(mine[best])
    join = (lambda x: np.concatenate(x) if x else np.zeros(0, np.int64))
    return join(out_q), join(out_id), join(out_score)


def top_k(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score over (vec_id, embedding)."""
    rows = written(vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), quantized(F.col("embedding")).alias("v"),
        is_query.alias("q")).where("vec_id is not null and v is not null and size(v) > 0").distinct(), "topk-rows")
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    n = rows.agg(F.count("*").alias("c"), F.sum(F.col("q").cast("long")).alias("q"), F.max(length).alias("longest"),
                 F.max(F.when(F.col("q"), length)).alias("longest_query")).first()
    if n["q"] and n["longest"] * n["longest_query"] >= 2.0 ** 62:  # no score is above the product of lengths
        raise ValueError("inner products of these vectors may not fit 64-bit integers")
    candidate_blocks = max(1, -(-n["c"] // CANDIDATE_BLOCK))
    query_blocks = max(1, -(-(n["q"] or 0) // QUERY_BLOCK))
    deal = (lambda blocks: F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)))
    spread = (lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    queries = rows.where("q").select("vec_id", "v", F.lit(True).alias("q"), deal(query_blocks).alias("qb"),
                                     spread(candidate_blocks).alias("cb"))
    candidates = rows.select("vec_id", "v", F.lit(False).alias("q"), deal(candidate_blocks).alias("cb"),
                             spread(query_blocks).alias("qb")).select("vec_id", "v", "q", "qb", "cb")

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        q = table.column("q").to_numpy()
        ids = table.column("vec_id").to_numpy()
        v = _matrix(pa.concat_arrays(table.column("v").chunks))
        at, got, score = search_block(ids[q], v[q], ids[~q], v[~q], k)
        own = pa.concat_arrays(table.column("v").chunks).filter(pa.array(q))
        return pa.table({"query_id": pa.array(ids[q][at], pa.int64()), "of": own.take(pa.array(at, pa.int64())),
                         "vec_id": pa.array(got, pa.int64()), "score": pa.array(score, pa.int64())})
    kept = queries.unionByName(candidates).groupBy("qb", "cb").applyInArrow(
        run, "query_id long, of array<long>, vec_id long, score long")
    best = Window.partitionBy("query_id", "of").orderBy(F.desc("score"), "vec_id")
    return kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
