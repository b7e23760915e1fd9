"""Packing into length buckets that waste least padding.

A document's length is its number of pre-tokens (runs of ASCII letters and
digits or non-ASCII characters, and single other visible signs), at least 1; any length column may be given instead.
The histogram of all lengths gives the bucket boundaries by dynamic
programming: ``cost[k][j] = min over i of cost[k-1][i] + padding(i, j)``, each
row by one walk along a convex hull of lines, in time linear in the distinct
lengths, in whole numbers. No length is binned, so the padding is the least
possible whatever the corpus holds, and every boundary is the length of a
document.

Batches form inside each bucket: a batch holds as many documents as
``token_budget`` takes at the bucket's padded length, at least one. Places in a
bucket come from counts per (bucket, chunk) and a running sum over those few
counts, then a numbering inside each chunk; rows go to chunks by hash, so no
task gets a whole bucket and only the last batch of a bucket is not full. A
chunk has about ``CHUNK_ROWS`` rows, more where that would make over
``CHUNKS`` of them: the broadcast counts have that bound.

Defined results: null and empty texts have length 1; rows with equal or null
ids are separate documents; nothing is cut, a document longer than the budget
is a batch of its own; an empty table has no rows. Columns that clash with the
added ones are replaced.
"""

from __future__ import annotations

from array import array
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import releasing, text_key, written

BUCKETS = 16
TOKEN_BUDGET = 16_384
CHUNK_ROWS = 20_000
CHUNKS = 100_000
ADDED = ["n_tokens", "bucket", "padded_tokens", "batch", "slot"]


_WORD = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
_SIGN = np.array([33 <= c <= 126 and not chr(c).isalnum() for c in range(256)])
SLICE_BYTES = 1 << 22


def count_tokens(texts: pa.Array) -> np.ndarray:
    """Pre-tokens of each text: runs of ASCII letters and digits or non-ASCII
    characters, and single other visible characters; at least 1."""
    out = []
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    lo = 0
    while lo < len(texts):
        hi = lo + max(1, int(np.searchsorted(np.cumsum(size[lo:]), SLICE_BYTES, "right")))
        raw = "".join(t or "" for t in texts.slice(lo, hi - lo).to_pylist()).encode()
        data = np.frombuffer(raw, np.uint8)
        ends = np.cumsum(size[lo:hi])
        begins = ends - size[lo:hi]
        word = _WORD[data]
        first = word.copy()
        first[1:] &= ~word[:-1]
        edge = begins[begins < len(data)]
        first[edge] = word[edge]
        total = np.concatenate(([0], np.cumsum(first | _SIGN[data])))
        out.append(total[ends] - total[begins])
        lo = hi
    return np.maximum(1, np.concatenate(out)) if out else np.zeros(0, np.int64)


def token_lengths(documents: DataFrame) -> DataFrame:
    """doc_id, key (digest of the text), n_tokens per row."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("key"), pa.array(count_tokens(b.column("text")), pa.int64())],
                ["doc_id", "key", "n_tokens"])
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", text_key(F.col("text")).alias("key"), "text").mapInArrow(
        releasing(run), f"doc_id {kind}, key binary, n_tokens long")


def next_row(lengths: list[int], rows: list[int], best: list[int]) -> tuple[list[int], array]:
    """The dynamic program with one bucket more: ``new[j]`` is the least
    ``best[i] + lengths[j-1] * (rows[j] - rows[i])`` over i < j, and the i that
    gives it. For a fixed i that is a line in ``lengths[j-1]`` of slope
    ``-rows[i]``; slopes fall with i and lengths rise with j, so the lines that
    are lowest somewhere form a hull that is walked once. Whole numbers of any
    size: no rounding."""
    hull, at = [0], 0
    new, arg = [0], array("l", [0])
    for j, size in enumerate(lengths, 1):
        while at + 1 < len(hull) and (best[hull[at + 1]] - size * rows[hull[at + 1]]
                                      < best[hull[at]] - size * rows[hull[at]]):
            at += 1
        i = hull[at]
        new.append(best[i] + size * (rows[j] - rows[i]))
        arg.append(i)
        # line j enters; a line below which the neighbours always are leaves
        while len(hull) > at + 1:
            a, b = hull[-2], hull[-1]
            if (best[j] - best[a]) * (rows[b] - rows[a]) > (best[b] - best[a]) * (rows[j] - rows[a]):
                break
            hull.pop()
        hull.append(j)
    return new, arg


def best_boundaries(lengths: list[int], counts: list[int], buckets: int = BUCKETS) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least total padding
    over the histogram (``lengths`` distinct, rising)."""
    n = len(lengths)
    if n <= buckets:
        return list(lengths)
    rows = list(accumulate(counts, initial=0))
    # padded tokens of lengths i..j-1 in one bucket; the true tokens are the same for every cut
    best = [0, *(size * held for size, held in zip(lengths, rows[1:], strict=True))]
    back = []
    for _ in range(1, buckets):
        best, arg = next_row(lengths, rows, best)
        back.append(arg)
    out, j = [], n
    for arg in reversed(back):
        out.append(lengths[j - 1])
        j = arg[j]
        if j == 0:
            break
    else:
        out.append(lengths[j - 1])
    return sorted(out)


def boundaries_of(lengths: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Boundaries over the global histogram of the column ``n_tokens``. The driver
    gets one (length, count) per distinct length: no more than the longest
    document has tokens, and fewer than the root of twice the corpus's tokens."""
    hist = lengths.groupBy("n_tokens").agg(F.count("*").alias("n")).orderBy("n_tokens").toArrow()
    return best_boundaries(hist.column("n_tokens").to_pylist(), hist.column("n").to_pylist(), buckets)


def place(lengths: DataFrame, boundaries: list[int], token_budget: int = TOKEN_BUDGET) -> DataFrame:
    """Adds bucket, padded_tokens, batch, slot to rows (doc_id, key, n_tokens)."""
    bounds = F.array(*[F.lit(b).cast("long") for b in boundaries])
    bucket = F.size(F.filter(bounds, lambda b: b < F.col("n_tokens")))
    rows = lengths.withColumn("bucket", bucket).withColumn(
        "padded_tokens", F.get(bounds, F.col("bucket")))
    full = rows.groupBy("bucket").agg(F.count("*").alias("n")).collect()  # one row a bucket
    held = {r["bucket"]: r["n"] for r in full}
    chunk_rows = max(CHUNK_ROWS, sum(held.values()) // CHUNKS)
    chunks = F.array(*[F.lit(max(1, -(-held.get(k, 0) // chunk_rows))) for k in range(len(boundaries))])
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "key", "seq"), F.get(chunks, F.col("bucket"))))
    rows = written(rows, "packing-rows")
    counts = rows.groupBy("bucket", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("bucket").alias("b"), F.col("chunk").alias("c"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("bucket", "chunk").orderBy("doc_id", "key", "seq")
    fit = F.greatest(F.lit(1).cast("long"), F.expr(f"{int(token_budget)}L div padded_tokens"))
    number = F.col("before") + F.row_number().over(inside) - 1
    return rows.join(F.broadcast(counts), (F.col("bucket") == F.col("b")) & (F.col("chunk") == F.col("c"))) \
        .withColumn("at", number).withColumn("fit", fit).withColumn(
        "batch", F.concat_ws("-", F.col("bucket"), F.expr("at div fit"))).withColumn(
        "slot", F.pmod("at", "fit").cast("int")).drop("b", "c", "before", "at", "fit", "chunk")


def pack(documents: DataFrame, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET,
         length: Column | None = None) -> DataFrame:
    """One row per document row: doc_id, text_key (digest that tells apart rows
    with one id), n_tokens, bucket, padded_tokens, batch, slot."""
    if length is None:
        one = token_lengths(documents)
    else:
        one = documents.select("doc_id", text_key(F.col("text")).alias("key"), F.greatest(
            F.coalesce(length.cast("long"), F.lit(1).cast("long")), F.lit(1).cast("long")).alias("n_tokens"))
    lengths = written(one.withColumn("seq", F.monotonically_increasing_id()), "packing-lengths")
    bounds = boundaries_of(lengths, buckets)
    if not bounds:
        return lengths.select("doc_id", F.col("key").alias("text_key"), "n_tokens", F.lit(0).alias("bucket"),
                              F.lit(0).cast("long").alias("padded_tokens"), F.lit("").alias("batch"),
                              F.lit(0).alias("slot"))
    return place(lengths, bounds, token_budget).select(
        "doc_id", F.col("key").alias("text_key"), "n_tokens", "bucket", "padded_tokens", "batch", "slot")
