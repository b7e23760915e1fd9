"""The reference's nine jobs as compositions of the operators.

Batch forms take a bounded record envelope and return DataFrames; the
streaming forms are in :mod:`eventide.streaming.jobs`. ``catch_up_*`` run a
job over every batch not yet committed and commit results and offsets
together through :class:`eventide.sinks.commit_log.CommitLog`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.operators import logs, offsets, tokens, values, windows
from eventide.schemas import UV_BITMAP, UV_MEMBER, WORD_TOTAL
from eventide.session import stored
from eventide.sinks import bucketed
from eventide.sinks.commit_log import CommitLog


def j1_word_count(records: DataFrame) -> DataFrame:
    """J1: word count per micro-batch."""
    return tokens.word_count_per_batch(tokens.tokenize(records, keep=("batch_id",)))


def j2_token_pairs(records: DataFrame) -> DataFrame:
    """J2: (word, 1) per token."""
    return tokens.token_pairs(tokens.tokenize(records))


def j3_temperature_alert(records: DataFrame) -> DataFrame:
    """J3: sliding mean per day, threshold, one joined row per window (text)."""
    return windows.alert_rows(windows.sliding_mean(values.readings(records)))


def j4_running_totals(records: DataFrame) -> DataFrame:
    """J4: per-word totals over everything consumed."""
    return tokens.running_total(tokens.tokenize(records))


def j5_pv_uv(records: DataFrame) -> dict[str, DataFrame]:
    """J5: hourly / site-hourly PV and daily UV from log lines."""
    parsed = logs.parse_log(records)
    return {"pv": logs.pv_rollup(parsed), "uv": logs.uv_by_day(parsed),
            "metrics": logs.metric_keys(parsed)}


def j6_sorted_word_count(records: DataFrame) -> DataFrame:
    """J6: per-batch word count ordered by count (descending) within batch."""
    return j1_word_count(records).orderBy("batch_id", F.col("n").desc(), "word")


def j7_value_count(records: DataFrame) -> DataFrame:
    """J7: count of identical whole values per batch."""
    return values.value_count_per_batch(records)


def j8_delimited_events(records: DataFrame) -> dict[str, DataFrame]:
    """J8: three-field split plus the batch sizes."""
    return {"fields": values.split_three_fields(records), "sizes": values.batch_size(records)}


def j9_offset_report(records: DataFrame) -> dict[str, DataFrame]:
    """J9: offset ranges and partitions per batch."""
    return {"ranges": offsets.offset_ranges(records),
            "partitions": offsets.partitions_per_batch(records)}


# ------------------------------------------------------------ catch-up runs

def catch_up(log: CommitLog, records: DataFrame,
             builders: dict[str, Callable[[DataFrame], DataFrame]]) -> int | None:
    """Run ``builders`` over every pending record and commit their outputs
    with the new positions. Per-batch outputs are additive across commits (a
    batch whose partitions arrive unevenly lands in two commits): readers sum
    them by key, e.g. :func:`committed_per_batch`."""
    pend = log.pending(records)
    return log.commit(pend, {name: build(pend) for name, build in builders.items()})


def committed_per_batch(log: CommitLog, name: str, keys: list[str], value: str = "n") -> DataFrame:
    """Committed per-batch counts of ``name``, summed over commits."""
    return log.table(name).groupBy(*keys).agg(F.sum(value).alias(value))


def catch_up_word_totals(log: CommitLog, records: DataFrame, buckets: int | None = None) -> int | None:
    """J4 with replay safety: fold every pending record into the stored
    totals (full outer merge with the newest committed version) and commit
    the new version together with the positions.

    With ``buckets`` the totals are kept as that many sorted files by word (the
    same number on every run): the stored side of the merge is then neither
    shuffled nor sorted, and only the new counts move. As many buckets as
    ``spark.sql.shuffle.partitions`` save a second shuffle of those."""
    path = log.latest_path("totals") if buckets else None
    state = (bucketed.read_bucketed(log.spark, path, WORD_TOTAL, "word", buckets) if path
             else log.latest("totals", WORD_TOTAL))
    pend = log.pending(records)
    merged = tokens.merge_totals(state, tokens.running_total(tokens.tokenize(pend)))
    writers = {"totals": lambda df, at: bucketed.write_bucketed(
        df if path else df.repartition(buckets, "word"), at, "word", buckets)} if buckets else None
    return log.commit(pend, {"totals": merged}, writers)


def catch_up_pv_uv(log: CommitLog, records: DataFrame) -> int | None:
    """J5 with replay safety: the PV increments and UV members of every
    pending record, committed with the positions (the reference's MULTI/EXEC).

    One GROUPING SETS aggregate over one parse of the pending lines holds
    both: (hour) and (hour, site_id) rows are PV increments, (day, user_id)
    rows are the day's members, which are folded into the stored sets: a bitmap
    per day and 32,768 ids, and a table of ids that are no plain numbers.
    """
    pend = log.pending(records)
    rows = stored(logs.pv_uv_sets(logs.parse_log(pend)), "pv-uv")
    members = rows.where(F.col("gid") == logs.GID_UV_MEMBER).select("day", "user_id")
    return log.commit(pend, {
        "pv_uv": rows.where(F.col("gid") != logs.GID_UV_MEMBER),
        "uv_bitmaps": logs.merge_bitmaps(log.latest("uv_bitmaps", UV_BITMAP), logs.uv_bitmaps(members)),
        "uv_others": logs.merge_members(log.latest("uv_others", UV_MEMBER), logs.other_members(members))})


def committed_pv(log: CommitLog) -> DataFrame:
    """PV counters: the sum of every committed increment."""
    rows = log.table("pv_uv").where(F.col("gid").isin(logs.GID_PV_HOUR, logs.GID_PV_SITE_HOUR))
    return rows.groupBy("hour", "site_id").agg(F.sum("n").alias("pv"))


def committed_uv(log: CommitLog) -> DataFrame:
    """UV per day: the bits of the newest committed sets, counted."""
    return logs.uv_from_bitmaps(log.latest("uv_bitmaps", UV_BITMAP), log.latest("uv_others", UV_MEMBER))


# ------------------------------------------------------- sorted batches (J6)

def write_sorted_batches(counts: DataFrame, path: str, mode: str = "append") -> None:
    """Counts (batch_id, word, n) as one folder per batch whose files, read in the
    order of their names, list the batch's words by falling count, ties by word. A
    range shuffle over (batch, count, word) gives the order, so a large batch is
    spread over several files; batches that ``path`` holds already stay."""
    order = ("batch_id", F.col("n").desc(), "word")
    counts.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).partitionBy(
        "batch_id").parquet(path)


def sort_new_batches(counts: DataFrame, path: str) -> int:
    """Adds the batches of a stream's output (``counts``: closed batches, each
    whole) that ``path`` does not hold yet; returns how many. One list of batch ids
    is compared, no rows of earlier batches are read."""
    spark = counts.sparkSession
    try:
        done = spark.read.parquet(path).select(F.col("batch_id").cast("bigint")).distinct()
        new = counts.join(done, "batch_id", "left_anti")
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        new = counts
    new = stored(new.select("batch_id", "word", "n"), "new-batches")
    n = new.select("batch_id").distinct().count()
    if n:
        write_sorted_batches(new, path)
    return n
