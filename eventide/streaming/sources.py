"""Streaming record sources: Kafka and a parquet replay log.

Both produce the record envelope (topic, partition, offset, batch_id, ts,
key, value), so every operator runs unchanged on either.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.operators.offsets import MAX_POSITIONS

# Kafka's "earliest" marker in startingOffsets JSON.
EARLIEST = -2
LATEST = -1


def max_offsets_per_trigger(rate_per_partition: int, n_partitions: int, interval_s: float) -> int:
    """The reference caps records per second per partition; Spark's
    ``maxOffsetsPerTrigger`` is a total per trigger: cap x partitions x interval."""
    return int(rate_per_partition * n_partitions * interval_s)


def starting_offsets(positions: DataFrame, partitions: dict[str, int],
                     default: int = EARLIEST, max_rows: int = MAX_POSITIONS) -> str:
    """``startingOffsets`` JSON from ledger rows (topic, partition, until_offset).

    Kafka needs every partition listed once specific offsets are given, so
    ``partitions`` names each topic's partition count; a partition without a
    stored position starts at ``default`` (-2 earliest, -1 latest), as the
    reference's default of 0 on a fresh topic. The ledger has one row per
    topic-partition; the collect is bounded by ``max_rows`` and checked.
    """
    rows = (positions.where(F.col("topic").isin(list(partitions)))
            .select("topic", "partition", "until_offset").limit(max_rows + 1).collect())
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} stored positions")
    stored = {(r["topic"], int(r["partition"])): int(r["until_offset"]) for r in rows}
    return json.dumps({t: {str(p): stored.get((t, p), default) for p in range(n)}
                       for t, n in partitions.items()})


def starting_times(partitions: dict[str, int], epoch_ms: int) -> dict[str, dict[int, int]]:
    """One start time for every partition (``partitions``: topic -> their number)."""
    return {t: dict.fromkeys(range(n), int(epoch_ms)) for t, n in partitions.items()}


def kafka_options(bootstrap: str, topics: list[str] | None = None,
                  assign: dict[str, list[int]] | None = None,
                  starting: str = "earliest", max_offsets: int | None = None,
                  max_poll_records: int | None = None, min_partitions: int | None = None,
                  fail_on_data_loss: bool = True, extra: dict | None = None,
                  starting_times: dict[str, dict[int, int]] | None = None) -> dict[str, str]:
    """Options for ``spark.readStream.format("kafka")``.

    * ``topics``: Subscribe; ``assign``: fixed partitions (Assign);
    * ``starting``: ``earliest`` / ``latest`` / JSON from :func:`starting_offsets`;
      the reference's ``none`` policy is a JSON with every partition listed;
    * ``max_offsets``: rate cap per trigger (see :func:`max_offsets_per_trigger`);
    * ``starting_times``: topic -> partition -> epoch milliseconds: each partition
      starts at its first record of that time or later (at its end if there is none)
      instead of at ``starting``; see :func:`starting_times`;
    * ``min_partitions``: split large topic-partitions over more tasks.

    Spark tracks consumed offsets in the query checkpoint; nothing is
    committed to the consumer group.
    """
    if (topics is None) == (assign is None):
        raise ValueError("give exactly one of topics (subscribe) or assign")
    o = {"kafka.bootstrap.servers": bootstrap, "startingOffsets": starting,
         "failOnDataLoss": str(fail_on_data_loss).lower()}
    if starting_times is not None:
        del o["startingOffsets"]
        o["startingOffsetsByTimestamp"] = json.dumps(
            {t: {str(p): int(ms) for p, ms in ps.items()} for t, ps in starting_times.items()})
        o["startingOffsetsByTimestampStrategy"] = "latest"
    if topics is not None:
        o["subscribe"] = ",".join(topics)
    else:
        o["assign"] = json.dumps({t: sorted(ps) for t, ps in assign.items()})
    if max_offsets is not None:
        o["maxOffsetsPerTrigger"] = str(max_offsets)
    if max_poll_records is not None:
        o["kafka.max.poll.records"] = str(max_poll_records)
    if min_partitions is not None:
        o["minPartitions"] = str(min_partitions)
    o.update(extra or {})
    return o


def _kafka_envelope(raw: DataFrame, cap: int) -> DataFrame:
    return raw.select(
        "topic", "partition", "offset",
        F.expr(f"`offset` div {int(cap)}").alias("batch_id"),
        F.col("timestamp").alias("ts"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"))


def kafka_records(spark: SparkSession, options: dict[str, str], cap: int) -> DataFrame:
    """Kafka source as the record envelope (key/value cast to text)."""
    return _kafka_envelope(spark.readStream.format("kafka").options(**options).load(), cap)


# options that only a streaming Kafka read accepts
_STREAM_ONLY = ("maxOffsetsPerTrigger", "minOffsetsPerTrigger", "maxTriggerDelay")


def kafka_batch_options(options: dict[str, str], positions: DataFrame,
                        partitions: dict[str, int]) -> dict[str, str]:
    """Options for a bounded read of everything after the committed
    positions, up to the log end at read time (``endingOffsets=latest``)."""
    o = {k: v for k, v in options.items() if k not in _STREAM_ONLY}
    o["startingOffsets"] = starting_offsets(positions, partitions)
    o["endingOffsets"] = "latest"
    return o


def pinned_end(ends: DataFrame, starting: str) -> str:
    """``endingOffsets`` JSON: the ends (topic, partition, until_offset) seen
    once; a partition without new records ends where it starts."""
    seen = {(r["topic"], int(r["partition"])): int(r["until_offset"]) for r in ends.collect()}
    return json.dumps({t: {p: seen.get((t, int(p)), at) for p, at in ps.items()}
                       for t, ps in json.loads(starting).items()})


def kafka_batch_records(spark: SparkSession, options: dict[str, str], positions: DataFrame,
                        partitions: dict[str, int], cap: int, load=None) -> DataFrame:
    """The pending records of a consumer as one bounded DataFrame: the input
    of a catch-up commit (results and positions stored together).

    ``latest`` is resolved anew by every action, so the ends are read once (one
    row per topic-partition) and every later read gets them as fixed offsets:
    records that arrive meanwhile belong to the next run."""
    load = load or (lambda o: spark.read.format("kafka").options(**o).load())
    opts = kafka_batch_options(options, positions, partitions)
    ends = load(opts).groupBy("topic", "partition").agg((F.max("offset") + 1).alias("until_offset"))
    opts["endingOffsets"] = pinned_end(ends, opts["startingOffsets"])
    return _kafka_envelope(load(opts), cap)


def write_replay_log(records: DataFrame, path: str, slices: int,
                     files_per_slice: int | None = None) -> None:
    """Lay a bounded envelope out as a replay log of ``slices`` appends.

    The file source hands files to micro-batches in modification-time order,
    so slices are appended in batch order (one write job each, a filtered
    pass over ``records``): a replay then sees records in offset order and no
    event is late. ``files_per_slice`` lays each slice out as that many files
    by topic-partition range (as a Kafka micro-batch has one task per
    partition), so ``maxFilesPerTrigger = files_per_slice`` replays one slice
    per micro-batch. ``ts`` becomes a ``timestamp`` because watermarks
    reject ``timestamp_ntz``.
    """
    out = records.withColumn("ts", F.col("ts").cast("timestamp"))
    lo_hi = out.agg(F.min("batch_id"), F.max("batch_id")).first()
    if lo_hi[0] is None:  # no records: nothing to replay
        return
    lo, hi = int(lo_hi[0]), int(lo_hi[1])
    step = max(1, -(-(hi - lo + 1) // slices))
    for start in range(lo, hi + 1, step):
        piece = out.where((F.col("batch_id") >= start) & (F.col("batch_id") < start + step))
        if files_per_slice:
            piece = piece.repartitionByRange(files_per_slice, "topic", "partition")
        piece.write.mode("append").parquet(path)


def replay_records(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Stream a replay log; ``maxFilesPerTrigger`` plays the rate cap."""
    schema = spark.read.parquet(path).schema
    return (spark.readStream.schema(schema)
            .option("maxFilesPerTrigger", max_files_per_trigger).parquet(path))
