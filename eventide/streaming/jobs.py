"""Streaming forms of the jobs.

Each function takes a streaming record envelope and returns a streaming
DataFrame plus the output mode it needs.

* Per-batch results (J1, J6, J7, J9) restart every batch, while a streaming
  ``groupBy`` is cumulative: they are keyed by a batch clock and closed by a
  watermark on it, so a batch's groups are emitted, and their state dropped,
  once ``lateness_batches`` newer batches were seen. The *time* clock slices
  the record time (one global clock, safe when partitions advance unevenly);
  the *offset* clock uses the envelope's ``batch_id`` (balanced replays).
* Cumulative results: running totals (update mode, one row per word), PV
  counters (update mode, evicted per hour), UV (append, per closed day).
* The alert windows close behind a watermark on the record time ``ts``;
  rows are pre-aggregated into buckets before the sliding windows.
"""

from __future__ import annotations

import math
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.operators import logs, tokens, values
from eventide.operators.values import ALERT_THRESHOLD, DAY_JOINER
from eventide.operators.windows import SLIDE_SECONDS, WINDOW_SECONDS
from eventide.session import checkpoint_root

# Fixed value: the reference's micro-batch interval (seconds).
BATCH_INTERVAL_S = 6


def observed(records: DataFrame, name: str = "records") -> DataFrame:
    """Per-trigger record count and offset bounds as observed metrics
    (``rdd.count()`` / offset logging of the reference), reported in
    ``query.lastProgress["observedMetrics"][name]`` without an extra job."""
    return records.observe(name, F.count(F.lit(1)).alias("n"),
                           F.min("offset").alias("min_offset"),
                           F.max("offset").alias("max_offset"))


def batch_clock(records: DataFrame, interval_s: int = BATCH_INTERVAL_S,
                lateness_batches: int = 1) -> DataFrame:
    """Offset clock: stamp each record with its batch's time and set a
    watermark on it.

    ``batch_ts = (batch_id + 1) * interval`` after the epoch (the epoch itself
    is Spark's initial watermark, so batch 0 must not sit on it). A record
    of batch b is late once a record of batch b + lateness_batches was seen.
    ``batch_id`` comes from per-partition offsets, so this clock is only
    global when partitions advance evenly (a replay of the envelope).
    """
    return (records.withColumn("batch_ts", F.timestamp_seconds((F.col("batch_id") + 1) * interval_s))
            .withWatermark("batch_ts", f"{lateness_batches * interval_s} seconds"))


def once_per_offset(records: DataFrame) -> DataFrame:
    """Each record once, however often the source delivers it (a producer or a
    replay that repeats slices). ``records`` must carry a watermark; positions are
    remembered until it has passed them, so state is bounded."""
    return records.dropDuplicatesWithinWatermark(["topic", "partition", "offset"])


def _per_batch(records: DataFrame, clock: str, interval_s: int, lateness_batches: int, once: bool = False):
    """(records, group keys, finish) for results that restart every batch.

    * ``offset``: :func:`batch_clock` over the envelope's ``batch_id``;
    * ``time``: tumbling ``interval_s`` slices of the record time ``ts`` (the
      broker's append time for Kafka), one global clock however unevenly the
      partitions advance: a hot partition holding a third of the records
      cannot push the watermark past the others' records. ``batch_id`` is
      the slice number ``epoch seconds div interval``.

    ``once`` drops records that were delivered before.
    """
    if clock == "offset":
        r = batch_clock(records, interval_s, lateness_batches)
        r = once_per_offset(r) if once else r
        return r, [F.col("batch_ts"), F.col("batch_id")], lambda df: df.drop("batch_ts")
    if clock == "time":
        # a record without a time fits no slice: fail rather than lose it
        clocked = F.coalesce(F.col("ts"), F.raise_error(F.lit(
            "the time clock needs a record time; use clock=offset")).cast(records.schema["ts"].dataType))
        r = records.withColumn("ts", clocked).withWatermark("ts", f"{lateness_batches * interval_s} seconds")
        r = once_per_offset(r) if once else r
        key = F.window("ts", f"{interval_s} seconds").alias("slice")

        def finish(df: DataFrame) -> DataFrame:
            bid = F.expr(f"unix_seconds(slice.start) div {int(interval_s)}")
            return df.withColumn("batch_id", bid).drop("slice")
        return r, [key], finish
    raise ValueError(f"unknown clock {clock}")


def word_count_per_batch(records: DataFrame, lateness_batches: int = 1, clock: str = "offset",
                         interval_s: int = BATCH_INTERVAL_S, once: bool = False) -> tuple[DataFrame, str]:
    """J1/J6: word count per batch, emitted when the batch closes."""
    r, keys, finish = _per_batch(records, clock, interval_s, lateness_batches, once)
    clock_cols = ("batch_ts", "batch_id") if clock == "offset" else ("ts",)
    t = tokens.tokenize(r, keep=clock_cols)
    out = t.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("n"))
    return finish(out), "append"


def value_count_per_batch(records: DataFrame, lateness_batches: int = 1, clock: str = "offset",
                          interval_s: int = BATCH_INTERVAL_S, once: bool = False) -> tuple[DataFrame, str]:
    """J7: count of identical whole values per batch, emitted when it closes."""
    r, keys, finish = _per_batch(records, clock, interval_s, lateness_batches, once)
    out = r.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    return finish(out), "append"


def offset_report(records: DataFrame, lateness_batches: int = 1, clock: str = "offset",
                  interval_s: int = BATCH_INTERVAL_S, once: bool = False) -> tuple[DataFrame, str]:
    """J9: (topic, partition, batch_id, from, until, n) per closed batch."""
    r, keys, finish = _per_batch(records, clock, interval_s, lateness_batches, once)
    out = r.groupBy(*keys, "topic", "partition").agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset"),
        F.count(F.lit(1)).alias("n"))
    return finish(out), "append"


def three_fields(records: DataFrame) -> tuple[DataFrame, str]:
    """J8: stateless split, appended as records arrive."""
    return values.split_three_fields(records), "append"


def running_totals(records: DataFrame) -> tuple[DataFrame, str]:
    """J4: per-word totals across batches; state holds one row per word."""
    return tokens.running_total(tokens.tokenize(records)), "update"


def top_words(records: DataFrame, k: int = 10) -> tuple[DataFrame, str]:
    """J1/J6 preview on a stream: the k most frequent words so far.

    Sorting a stream is only allowed after an aggregate in complete mode; the
    result table is k rows, re-emitted every trigger.
    """
    totals = tokens.running_total(tokens.tokenize(records))
    return tokens.top_words(totals, k, count_col="cnt"), "complete"


def _hour_time(parsed: DataFrame, lateness: str) -> DataFrame:
    """Event time from the parsed hour text (not the broker's timestamp),
    with a watermark. Grouping by a window over it keeps a group open until
    the watermark passes the window's end, then evicts it: state holds the
    open hours / days only. A line whose hour text is not a valid time is
    placed by its record time; its group key stays the text, as in the batch
    form. A line with neither fails."""
    own = F.coalesce(F.try_to_timestamp("hour", F.lit("yyyy-MM-dd-HH")), F.col("ts").cast("timestamp"),
                     F.raise_error(F.lit("a line needs a valid hour or a record time")).cast("timestamp"))
    return (parsed.withColumn("hour_ts", own)
            .withWatermark("hour_ts", lateness))


def pv_counters(records: DataFrame, lateness: str = "1 hour", mode: str = "update") -> tuple[DataFrame, str]:
    """J5 counters: hourly and site-hourly PV, updated every trigger; a
    closed hour's counters leave the state store ``lateness`` after it ends. In
    ``append`` mode an hour is emitted once, when it closes: the file sink then
    holds the closed hours and the state the open ones
    (:func:`eventide.streaming.state.pv_counters` reads both)."""
    p = _hour_time(logs.parse_log(records, keep=("ts",)), lateness).withColumn(
        "w", F.window("hour_ts", "1 hour"))
    agg = (p.groupingSets([[F.col("w"), F.col("hour")],
                           [F.col("w"), F.col("hour"), F.col("site_id")]],
                          F.col("w"), F.col("hour"), F.col("site_id"))
           .agg(F.count(F.lit(1)).alias("pv")))
    return agg.drop("w"), mode


def uv_by_day(records: DataFrame, lateness: str = "1 hour") -> tuple[DataFrame, str]:
    """J5 UV: exact distinct users per day, emitted once the day closes.

    Two chained aggregations: distinct (day, user) pairs, then a count per
    day. A day's state is dropped ``lateness`` after the day ends, so it
    stays bounded by the open days.
    """
    p = _hour_time(logs.with_day(logs.parse_log(records, keep=("ts",))), lateness)
    pairs = p.groupBy(F.window("hour_ts", "1 day").alias("w"), "day", "user_id").agg(
        F.count(F.lit(1)).alias("hits"))
    per_day = pairs.groupBy("w", "day").agg(F.count(F.lit(1)).alias("uv"))
    return per_day.drop("w"), "append"


def windowed_alert(records: DataFrame, lateness: str = "1 hour",
                   length: int = WINDOW_SECONDS, slide: int = SLIDE_SECONDS,
                   threshold: float = ALERT_THRESHOLD) -> tuple[DataFrame, str]:
    """J3: sliding mean per (window, day), then one row per window, emitted
    when the window closes behind the watermark.

    Three chained aggregations, the streaming form of the batch plan's
    pre-aggregation: (sum, count) per ``gcd(length, slide)`` bucket and day;
    closed buckets re-windowed by their event time (``window_time``, which
    falls in exactly the sliding windows that contain the whole bucket); then
    days joined per window. Raw rows are aggregated once instead of being
    copied into every overlapping window.
    """
    g = math.gcd(length, slide)
    r = values.readings(records.withWatermark("ts", lateness))
    buckets = r.groupBy(F.window("ts", f"{g} seconds").alias("b"), "day").agg(
        F.sum("reading").alias("s"), F.count(F.lit(1)).alias("c"))
    means = (buckets.groupBy(F.window(F.window_time("b"), f"{length} seconds",
                                      f"{slide} seconds").alias("w"), "day")
             .agg((F.sum("s") / F.sum("c")).alias("mean")))
    alert = means.groupBy("w").agg(
        F.concat_ws(DAY_JOINER, F.sort_array(F.collect_list("day"))).alias("data"),
        F.bool_and(F.col("mean") > F.lit(threshold)).alias("result"))
    return alert.select(F.col("w.start").alias("window_start"), "data", "result"), "append"


def start(df: DataFrame, mode: str, sink: str, checkpoint: str | None = None,
          path: str | None = None, name: str | None = None, trigger: dict | None = None):
    """Start a query: ``parquet`` (exactly-once file sink, append only),
    ``console`` (preview), ``memory`` (tests; results on the driver) or ``state``
    (no output: the results are the state in the checkpoint, read by
    :mod:`eventide.streaming.state`).

    The checkpoint (offsets, commits, state) defaults to
    ``<spark.checkpoint.dir>/streams/<name>``: a stable, shared location, so a
    restarted query (or one whose executors were lost) resumes exactly where
    it committed. ``trigger`` defaults to the reference's 6 s interval;
    replays pass ``{"availableNow": True}``.
    """
    if sink == "parquet" and mode != "append":
        raise ValueError(f"the parquet file sink is append-only; a {mode}-mode job goes to "
                         "console/memory, keeps its results in the checkpoint (--sink state), or runs as a "
                         "catch-up commit (--catch-up)")
    if checkpoint is None:
        if not name:
            raise ValueError("a stream needs a name or an explicit checkpoint location")
        checkpoint = os.path.join(checkpoint_root(df.sparkSession), "streams", name)
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    trig = trigger or {"processingTime": f"{BATCH_INTERVAL_S} seconds"}
    w = w.trigger(**trig)
    if sink == "parquet":
        return w.format("parquet").option("path", path).start()
    if sink == "memory":
        return w.format("memory").queryName(name).start()
    if sink == "state":
        return w.format("noop").start()
    if sink == "console":
        return w.format("console").option("truncate", "false").start()
    raise ValueError(f"unknown sink {sink}")


def progress_offsets(query) -> list[dict]:
    """Offset ranges of the query's recent micro-batches from its progress
    reports (``startOffset`` / ``endOffset`` per source): the live form of
    the offset report, with the rows that came too late for the watermark
    (``late_rows``, per batch). Small metadata only."""
    out = []
    for p in query.recentProgress:
        late = sum(o.get("numRowsDroppedByWatermark", 0) for o in p.get("stateOperators", []))
        for s in p.get("sources", []):
            out.append({"batch_id": p["batchId"], "source": s.get("description"),
                        "start": s.get("startOffset"), "end": s.get("endOffset"),
                        "rows": s.get("numInputRows"), "late_rows": late})
    return out


__all__ = ["observed", "batch_clock", "word_count_per_batch", "value_count_per_batch", "offset_report",
           "three_fields", "running_totals", "top_words", "pv_counters", "uv_by_day", "windowed_alert",
           "start", "progress_offsets", "once_per_offset"]
