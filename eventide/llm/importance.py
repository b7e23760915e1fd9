"""Resampling of documents towards a target by hashed n-gram importance weights.

Words are cut out by a dictionary automaton: the distinct words of a slice of text,
each between two delimiters, go into an Aho-Corasick automaton with the CRC-32 and
the length of the word as payload, and one scan of the slice emits the payload of
every word in order. Runs of several words are never built as text: the checksum of
``a b`` follows from those of ``a`` and ``b`` and the length of ``b``, since
appending bytes is a linear map of the checksum. A feature's bucket is its checksum
modulo ``buckets``. The dictionary holds every word of its slice (``SLICE_WORDS``
words at most), so nothing is looked up elsewhere and its size does not grow with
the corpus.

Each row's buckets are written once (2 bytes a word); bucket counts of all rows are
summed per task and then by bucket. A bucket's gain is 1000 times the log of its
smoothed share of the target over that of the corpus, a row's weight the mean gain
of its features, all floored to integers. A Gumbel number made of the id is added
and the highest scores are drawn: sampling without replacement, in proportion to
the weights.

Ranks are counted, not sorted in one place: scores are integers whose range the
counts bound (a few 10,000 values), so one histogram gives how many rows score
higher, and only rows of equal score are ordered by id.

Defined results: null and empty texts have no features and weight 0; rows with
fewer than ``least_words`` words are scored, not drawn; a null id draws its number as
the text ``null`` and comes last among equal scores; repeated rows are rows of their
own. Other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import written

BUCKETS = 10_000
SEED = 2024
PERCENT, LEAST_WORDS = 10, 20
SLICE_WORDS = 200_000
# ASCII letters lowered, digits and all non-ASCII bytes kept, the rest blank
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
               for b in range(256))
# Fixed value: the reflected polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320


def _zero_byte(c: int) -> int:
    for _ in range(8):
        c = c >> 1 ^ (POLYNOMIAL if c & 1 else 0)
    return c


def _tables(columns: list[int]) -> np.ndarray:
    """The linear map with these images of the 32 unit vectors, as four tables of
    256 entries, one per byte."""
    out = np.zeros((4, 256), np.uint32)
    for bit in range(32):
        of = np.arange(256) >> (bit % 8) & 1
        out[bit // 8] ^= (of * columns[bit]).astype(np.uint32)
    return out


def _apply(table: np.ndarray, c: np.ndarray) -> np.ndarray:
    return table[0][c & 255] ^ table[1][c >> 8 & 255] ^ table[2][c >> 16 & 255] ^ table[3][c >> 24]


def _zeros() -> list[np.ndarray]:
    """Maps of 2^k zero bytes."""
    out = [_tables([_zero_byte(1 << b) for b in range(32)])]
    unit = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(31):
        out.append(_tables(_apply(out[-1], _apply(out[-1], unit)).tolist()))
    return out


ZEROS = _zeros()
_BLANK = zlib.crc32(b" ")


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of texts put together: of the first ones, of the second ones, and the
    second ones' bytes."""
    out = first.astype(np.uint32)
    for k in range(int(length.max(initial=0)).bit_length()):
        out = np.where(length >> k & 1, _apply(ZEROS[k], out), out)
    return out ^ second


def payloads(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(CRC-32, bytes) of each word, as one automaton scan per slice emits them."""
    crc, size = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for lo in range(0, len(words), SLICE_WORDS):
        part = words[lo:lo + SLICE_WORDS]
        found = ahocorasick.Automaton()
        distinct = sorted(set(part))
        for i, w in enumerate(distinct):
            found.add_word(f" {w.decode('latin-1')} ", i)
        found.make_automaton()
        at = np.fromiter((i for _, i in found.iter(f" {b' '.join(part).decode('latin-1')} ")), np.int64, len(part))
        crc.append(np.array([zlib.crc32(w) for w in distinct], np.uint32)[at])
        size.append(np.array([len(w) for w in distinct], np.int64)[at])
    return np.concatenate(crc), np.concatenate(size)


def hashed_features(rows: list[list[bytes]], most_words: int, buckets: int) -> Iterator[np.ndarray]:
    """Per row of words the buckets of its runs of 1 to ``most_words`` words."""
    crc, size = payloads([w for r in rows for w in r])
    ends = np.cumsum([len(r) for r in rows])
    runs = [crc]
    for n in range(2, most_words + 1):
        longer = runs[-1][:len(crc) - n + 1]       # the run of n - 1 words, a blank, and the next word
        blank = np.full(len(longer), _BLANK, np.uint32)
        longer = joined_crc(longer, blank, np.ones(len(longer), np.int64))
        runs.append(joined_crc(longer, crc[n - 1:], size[n - 1:]))
    for end, r in zip(ends.tolist(), rows, strict=True):
        first = end - len(r)
        yield np.concatenate([h[first:max(first, end - n)] for n, h in enumerate(runs)]) % np.uint32(buckets)


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_PLAIN).split()


def features(table: DataFrame, *keep: str, most_words: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """The ``keep`` columns, n_words, and buckets (little-endian, 2 bytes each where
    they fit) per row with a ``text``."""
    kind = np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")
    schema = "".join(f"{c} {table.schema[c].dataType.simpleString()}, " for c in keep)

    def run(batches):
        for b in batches:
            texts, lo = b.column("text"), 0
            while lo < b.num_rows:
                rows, total = [], 0
                while lo + len(rows) < b.num_rows and total < SLICE_WORDS:
                    rows.append(_words(texts[lo + len(rows)].as_py()))
                    total += len(rows[-1])
                got = [h.astype(kind).tobytes() for h in hashed_features(rows, most_words, buckets)]
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(c).slice(lo, len(rows)) for c in keep],
                     pa.array([len(r) for r in rows], pa.int64()), pa.array(got, pa.binary())],
                    [*keep, "n_words", "buckets"])
                lo += len(rows)
    return table.select(*keep, "text").mapInArrow(run, f"{schema}n_words long, buckets binary")


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows, summed in each task first."""
    kind = np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for v in b.column("buckets"):
                total += np.bincount(np.frombuffer(v.as_buffer(), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["bucket", "n"])
    got = found.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return out


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """1000 times the log of a bucket's smoothed share of the target over that of
    the corpus, floored."""
    t_all, s_all, n = int(target.sum()), int(corpus.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log(float((t + 1) * (s_all + n)) / float((s + 1) * (t_all + n))))
                     for t, s in zip(target.tolist(), corpus.tolist(), strict=True)], np.int64)


def weighted(found: DataFrame, gain: np.ndarray, *keep: str) -> DataFrame:
    """The ``keep`` columns, n_words, n_features and weight (mean gain, floored)."""
    kind = np.dtype("<u2") if len(gain) <= 1 << 16 else np.dtype("<u4")
    schema = "".join(f"{c} {found.schema[c].dataType.simpleString()}, " for c in keep)

    def run(batches):
        for b in batches:
            each = [np.frombuffer(v.as_buffer(), kind) for v in b.column("buckets")]
            weight = [int(gain[h].sum()) // len(h) if len(h) else 0 for h in each]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in keep], b.column("n_words"),
                 pa.array([len(h) for h in each], pa.int64()), pa.array(weight, pa.int64())],
                [*keep, "n_words", "n_features", "weight"])
    return found.mapInArrow(run, f"{schema}n_words long, n_features long, weight long")


def gumbel_millis(doc_id: Column, seed: int = SEED) -> Column:
    """1000 times a standard Gumbel number made of the id, floored."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("long")


def resample(documents: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             most_words: int = 1, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (from 1 for the highest
    score; null where not drawn) per row. ``percent`` of the rows with
    ``least_words`` words are drawn."""
    found = written(features(documents, "doc_id", most_words=most_words, buckets=buckets), "features")
    gain = gains(bucket_counts(features(target, most_words=most_words, buckets=buckets), buckets),
                 bucket_counts(found, buckets))
    scored = written(weighted(found, gain, "doc_id").withColumn(
        "score", F.col("weight") + gumbel_millis(F.col("doc_id"), seed)), "scored")
    able = F.col("n_words") >= least_words
    # one row per score: their number is bounded by the range of gains and Gumbel numbers
    each = scored.where(able).groupBy("score").agg(F.count("*").alias("n")).toArrow().sort_by([("score", "descending")])
    n = each.column("n").to_numpy()
    higher = np.cumsum(n) - n
    draw = percent * int(n.sum()) // 100
    some = higher < draw
    spark = documents.sparkSession
    levels = spark.createDataFrame(pa.table({"score": each.column("score").filter(pa.array(some)),
                                             "higher": pa.array(higher[some], pa.int64())}))
    least = min(each.column("score").filter(pa.array(some)).to_pylist(), default=None)
    near = able & (F.col("score") >= least) if least is not None else F.lit(False)
    place = F.col("higher") + F.row_number().over(
        Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last()))
    drawn = scored.where(near).join(F.broadcast(levels), "score").withColumn("rank", place)
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    return drawn.select(*columns, F.when(F.col("rank") <= draw, F.col("rank")).cast("long").alias("rank")).unionByName(
        scored.where(~near).select(*columns, F.lit(None).cast("long").alias("rank")))
