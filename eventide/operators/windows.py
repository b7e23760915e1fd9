"""Sliding-window mean and threshold alert (J3).

The reference windows by arrival time (``window(120 s, 24 s)`` over
micro-batches). Here windows are event-time, epoch aligned: window starts are
multiples of the slide, each window is ``[start, start + length)``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.operators.values import ALERT_THRESHOLD, flag_and_join

# The reference's window is 20 batches of 6 s, sliding by 4.
WINDOW_SECONDS = 120
SLIDE_SECONDS = 24


def _seconds(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n)


def sliding_mean(reads: DataFrame, length: int = WINDOW_SECONDS, slide: int = SLIDE_SECONDS,
                 ts: str = "ts") -> DataFrame:
    """Mean reading per (window_start, day).

    Bounded input: pre-aggregate first, then fan out. Rows are summed into
    buckets of ``gcd(length, slide)`` seconds (each bucket lies wholly inside
    every window that touches it), so the raw rows are hashed once; only the
    small per-bucket (sum, count) rows are copied into the
    ``ceil(length / slide)`` windows that contain them and re-aggregated.
    Spark's native sliding ``window()`` would instead expand every raw row
    5-fold before the partial aggregate. The mean is sum / count of exact
    integer sums, so it is identical to a direct ``avg``.

    Streaming input: the native ``window()`` (state per open window; needs a
    watermark on ``ts`` for append mode).
    """
    if reads.isStreaming:
        w = F.window(ts, f"{length} seconds", f"{slide} seconds")
        return (reads.groupBy(w.start.alias("window_start"), "day")
                .agg(F.avg("reading").alias("mean")))
    return window_means(bucket_sums(reads, length, slide, ts), length, slide)


def bucket_sums(reads: DataFrame, length: int = WINDOW_SECONDS, slide: int = SLIDE_SECONDS,
                ts: str = "ts") -> DataFrame:
    """(bucket, day, s, c): sum and count per ``gcd(length, slide)`` seconds. Two
    such tables of different records add up (:func:`merge_buckets`)."""
    g = math.gcd(length, slide)
    return (reads.groupBy(F.window(ts, f"{g} seconds").start.alias("bucket"), "day")
            .agg(F.sum("reading").alias("s"), F.count(F.lit(1)).alias("c")))


def merge_buckets(stored: DataFrame, delta: DataFrame) -> DataFrame:
    """Buckets of earlier records and of new ones as one table."""
    return stored.unionByName(delta).groupBy("bucket", "day").agg(F.sum("s").alias("s"), F.sum("c").alias("c"))


def windows_over(bucket: str, length: int = WINDOW_SECONDS, slide: int = SLIDE_SECONDS) -> Column:
    """Starts of the windows that may hold a bucket: the latest start at or before
    it, then the ``ceil(length / slide) - 1`` earlier ones."""
    last_start = F.window(bucket, f"{slide} seconds").start
    return F.transform(F.sequence(F.lit(0), F.lit(math.ceil(length / slide) - 1)),
                       lambda i: last_start - _seconds(i * slide))


def window_means(buckets: DataFrame, length: int = WINDOW_SECONDS, slide: int = SLIDE_SECONDS) -> DataFrame:
    """Mean per (window_start, day) from bucket sums."""
    fanned = (buckets.select("day", "s", "c", "bucket",
                             F.explode(windows_over("bucket", length, slide)).alias("window_start"))
              .where(F.col("window_start") + _seconds(F.lit(length)) > F.col("bucket")))
    # hashed by the window alone: the aggregate per day and the one per window
    # that may follow both keep this partitioning
    return (fanned.repartition("window_start").groupBy("window_start", "day")
            .agg((F.sum("s") / F.sum("c")).alias("mean")))


def changed_windows(stored: DataFrame, delta: DataFrame, length: int = WINDOW_SECONDS, slide: int = SLIDE_SECONDS,
                    threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """The alert rows (window_start, data, result) of the windows that hold a bucket
    of ``delta``, from all their buckets: what an incremental view has to replace,
    whether the new records are late or not."""
    touched = delta.select(F.explode(windows_over("bucket", length, slide)).alias("window_start"), "bucket").where(
        F.col("window_start") + _seconds(F.lit(length)) > F.col("bucket")).select("window_start").distinct()
    means = window_means(merge_buckets(stored, delta), length, slide)
    return windowed_alert(means.join(touched, "window_start", "left_semi"), threshold)


def threshold_flag(means: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """``(day, mean > 22)`` per window."""
    return means.select("window_start", "day", (F.col("mean") > F.lit(threshold)).alias("flag"))


def windowed_alert(means: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """One row per window: days joined with ``=`` and the AND of their flags.

    At most ``length / 86400 + 1`` days fall in one window, so the joined list
    is tiny and bounded.
    """
    return flag_and_join(means, by=("window_start",), threshold=threshold)


def alert_rows(means: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """The rows the alert job inserts: (data, result), both as text."""
    a = windowed_alert(means, threshold)
    return a.select("data", F.col("result").cast("string").alias("result"))
